"""Dimension builders (D1-D8, J10): distinct cleaned members plus a dense surrogate key.

Every builder reads only the columns it needs from staging (column pruning reaches the
Parquet scan), reduces to distinct values first (partial aggregation before the
shuffle), and numbers members by their natural key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import decode_skill_map
from ..functions.text import (clean_company, clean_platform, clean_schedule, default_unknown,
                              not_blank, parse_location, skill_name)
from .keys import dense_key


def dimension(df: DataFrame, source: Column, key: str, name: str, where: Column | None = None) -> DataFrame:
    """Distinct non-NULL values of ``source`` as (key, name), keys 1..n by name."""
    rows = df.where(where) if where is not None else df
    members = rows.select(source.alias(name)).where(F.col(name).isNotNull()).distinct()
    return dense_key(members, [name], key).select(key, name)


def dim_companies(staging: DataFrame, col: str = "company_name") -> DataFrame:
    """``SELECT DISTINCT TRIM(COALESCE(c,'Unknown')) WHERE TRIM(c) != ''``.

    A NULL name fails the filter, so no 'Unknown' member is created here.
    """
    return dimension(staging, clean_company(col), "company_id", "company_name", not_blank(col))


def dim_platforms(staging: DataFrame, col: str = "job_via") -> DataFrame:
    return dimension(staging, clean_platform(col), "platform_id", "platform_name",
                     F.col(col).isNotNull() & not_blank(col))


def dim_schedule_types(staging: DataFrame, col: str = "job_schedule_type") -> DataFrame:
    return dimension(staging, clean_schedule(col), "schedule_type_id", "schedule_type_name",
                     F.col(col).isNotNull() & not_blank(col))


def location_rows(staging: DataFrame, loc: str = "job_location", country: str = "job_country") -> DataFrame:
    """Distinct (location, country) pairs, parsed: one parse per distinct pair."""
    pairs = staging.select(F.col(loc).alias("_src_location"), F.col(country).alias("_src_country")).distinct()
    city, state = parse_location("_src_location")
    return pairs.select(
        city.alias("main_city"), state.alias("main_state_province"),
        default_unknown("_src_country").alias("country"),
        default_unknown("_src_location").alias("full_location"),
        "_src_location", "_src_country")


def dim_locations(staging: DataFrame, loc: str = "job_location", country: str = "job_country",
                  unique: str = "lookup_key") -> DataFrame:
    """Location members with surrogate keys.

    ``unique="lookup_key"``: one member per (country, full_location), the key the fact
    lookup uses; city and state are the largest parsed values.
    ``unique="nulls_distinct"``: the 4-column UNIQUE of SQL, where a NULL city or state
    never conflicts, so such rows are kept once per source pair (and can share a lookup
    key, which doubles fact rows downstream).
    """
    rows = location_rows(staging, loc, country)
    if unique == "lookup_key":
        members = rows.groupBy("country", "full_location").agg(
            F.max("main_city").alias("main_city"), F.max("main_state_province").alias("main_state_province"))
        order = ["country", "full_location"]
    elif unique == "nulls_distinct":
        partial = F.col("main_city").isNull() | F.col("main_state_province").isNull()
        complete = (rows.where(~partial)
                    .select("main_city", "main_state_province", "country", "full_location").distinct()
                    .withColumn("_src_location", F.lit(None).cast("string"))
                    .withColumn("_src_country", F.lit(None).cast("string")))
        members = complete.unionByName(rows.where(partial))
        order = ["country", "full_location", "main_city", "main_state_province", "_src_location", "_src_country"]
    else:
        raise ValueError(f"unique must be 'lookup_key' or 'nulls_distinct', not {unique!r}")
    keyed = dense_key(members, order, "location_id")
    return keyed.select("location_id", "main_city", "main_state_province", "country", "full_location")


def category_skill_pairs(staging: DataFrame, dict_col: str = "job_type_skills") -> DataFrame:
    """(category, raw item) for every list item of the skill dict; non-list values give a NULL item."""
    m = decode_skill_map(dict_col)
    entries = staging.select(F.explode(m).alias("category", "items"))
    return entries.select("category", F.explode_outer("items").alias("item"))


def dim_skill_categories(staging: DataFrame, dict_col: str = "job_type_skills") -> DataFrame:
    """Every dict key as it is (no trim, no case change), keys 1..n by name."""
    m = decode_skill_map(dict_col)
    names = staging.select(F.explode(F.map_keys(m)).alias("category_name")).distinct()
    return dense_key(names, ["category_name"], "category_id").select("category_id", "category_name")


def skills_categorized(staging: DataFrame, dict_col: str = "job_type_skills") -> DataFrame:
    """(skill_name, category_name) from the dict: empty items skipped before stripping."""
    pairs = category_skill_pairs(staging, dict_col)
    return pairs.where(F.col("item").isNotNull() & (F.col("item") != "")).select(
        skill_name("item").alias("skill_name"), F.col("category").alias("category_name"))


def skills_uncategorized(staging: DataFrame, list_col: str = "job_skills", drop_blank: bool = False) -> DataFrame:
    """(skill_name, NULL) from the skill lists; NULL items are dropped, '' stays unless ``drop_blank``."""
    items = staging.select(F.explode(list_col).alias("item")).where(F.col("item").isNotNull())
    out = items.select(skill_name("item").alias("skill_name"), F.lit(None).cast("string").alias("category_name"))
    return out.where(F.col("skill_name") != "") if drop_blank else out


def dim_skills(staging: DataFrame, categories: DataFrame, dict_col: str = "job_type_skills",
               list_col: str = "job_skills", drop_blank: bool = False) -> DataFrame:
    """One row per skill with its category id.

    Dict skills and list skills are unioned and grouped once: ``min`` skips the NULL
    category of list-only skills, so a skill seen in any dict gets the smallest of its
    categories (one of the outcomes the first-insert-wins rule allows).
    """
    both = skills_categorized(staging, dict_col).unionByName(skills_uncategorized(staging, list_col, drop_blank))
    members = both.groupBy("skill_name").agg(F.min("category_name").alias("category_name"))
    keyed = dense_key(members, ["skill_name"], "skill_id")
    return map_category_id(keyed, categories).select("skill_id", "skill_name", "category_id")


def map_category_id(skills: DataFrame, categories: DataFrame) -> DataFrame:
    """Category name -> id (left join; the categories frame is small and AQE broadcasts it)."""
    return skills.join(categories.select("category_name", "category_id"), "category_name", "left")
