"""Star schema over the 3NF tables.

Dimensions reuse the 3NF surrogate keys where the grain is unchanged; the location
dimension drops ``full_location`` and so gets new keys plus a 3NF-id -> key map. The
junk dimension of the three flags is computed by rule (8 combinations) and its key is
derived arithmetically in the fact, so the fact needs no join for it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import null_key
from .keys import dense_key

# Fixed labels of the junk dimension's combination name.
REMOTE_LABELS = ("Remote", "On-site")
DEGREE_LABELS = ("Degree", "No Degree")
INSURANCE_LABELS = ("Health Insurance", "No Health Insurance")
FULL_TIME_PATTERN = "%full-time%"


def star_dim_company(companies: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """company_key, company_name, company_size, industry (the last two only from ``enrichment``)."""
    base = companies.select(F.col("company_id").alias("company_key"), "company_name")
    if enrichment is None:
        return base.withColumns({"company_size": F.lit(None).cast("string"),
                                 "industry": F.lit(None).cast("string")})
    return base.join(enrichment.select("company_name", "company_size", "industry"), "company_name", "left") \
        .select("company_key", "company_name", "company_size", "industry")


def star_dim_location(locations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dim_location(location_key, city, state_province, country), map(location_id, location_key))."""
    members = locations.select(F.col("main_city").alias("city"), F.col("main_state_province").alias("state_province"),
                               "country").distinct()
    dim = dense_key(members, ["country", "state_province", "city"], "location_key") \
        .select("location_key", "city", "state_province", "country")
    same = [locations["main_city"].eqNullSafe(dim["city"]),
            locations["main_state_province"].eqNullSafe(dim["state_province"]),
            locations["country"] == dim["country"]]
    mapping = locations.join(dim, same, "inner").select("location_id", "location_key")
    return dim, mapping


def star_dim_date(jobs: DataFrame, col: str = "job_posted_date") -> DataFrame:
    """Every calendar day between the first and last posting date (ISO day of week, 1 = Monday).

    Only the two bounds reach the driver; the days are generated by ``spark.range`` in
    parallel, so the size depends on the calendar span, not on the number of postings.
    """
    spark = jobs.sparkSession
    bounds = jobs.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return spark.createDataFrame([], "full_date date, year int, quarter int, month int, day int, day_of_week int")
    return calendar(spark, bounds["lo"], bounds["hi"])


def calendar(spark: SparkSession, lo: _dt.date, hi: _dt.date) -> DataFrame:
    days = (hi - lo).days + 1
    d = F.date_add(F.lit(lo), F.col("id").cast("int"))
    return spark.range(days).select(d.alias("full_date")).select(
        "full_date", F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day"),
        (F.weekday("full_date") + 1).alias("day_of_week"))


def star_dim_job_title(jobs: DataFrame) -> DataFrame:
    """title_key per distinct short title; category and seniority have no source column."""
    titles = jobs.select("job_title_short").where(F.col("job_title_short").isNotNull()).distinct()
    return dense_key(titles, ["job_title_short"], "title_key").select(
        "title_key", "job_title_short", F.lit(None).cast("string").alias("job_title_category"),
        F.lit(None).cast("string").alias("seniority_level"))


def star_dim_platform(platforms: DataFrame) -> DataFrame:
    return platforms.select(F.col("platform_id").alias("platform_key"), "platform_name",
                            F.lit(None).cast("string").alias("platform_type"))


def star_dim_schedule_type(schedules: DataFrame) -> DataFrame:
    return schedules.select(F.col("schedule_type_id").alias("schedule_key"), "schedule_type_name",
                            F.lower("schedule_type_name").like(FULL_TIME_PATTERN).alias("is_full_time"))


def star_dim_skill(skills: DataFrame, categories: DataFrame) -> DataFrame:
    return skills.join(categories, "category_id", "left").select(
        F.col("skill_id").alias("skill_key"), "skill_name", F.col("category_name").alias("skill_category"))


def attributes_key(remote: Column, degree: Column, insurance: Column) -> Column:
    """Junk-dimension key from three booleans: 1 + 4*remote + 2*degree + insurance."""
    b = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return (F.lit(1) + F.lit(4) * b(remote) + F.lit(2) * b(degree) + b(insurance)).cast("long")


def star_dim_attributes(spark: SparkSession) -> DataFrame:
    """All 8 flag combinations with key and label such as 'Remote + No Degree + No Health Insurance'."""
    bit = lambda i: (F.col("id").bitwiseAND(F.lit(i)) != 0)
    rows = spark.range(8).select(bit(4).alias("is_remote"), bit(2).alias("has_degree_req"),
                                 bit(1).alias("has_health_insurance"))
    label = F.concat_ws(" + ",
                        F.when(F.col("is_remote"), REMOTE_LABELS[0]).otherwise(REMOTE_LABELS[1]),
                        F.when(F.col("has_degree_req"), DEGREE_LABELS[0]).otherwise(DEGREE_LABELS[1]),
                        F.when(F.col("has_health_insurance"), INSURANCE_LABELS[0]).otherwise(INSURANCE_LABELS[1]))
    return rows.select(attributes_key(F.col("is_remote"), F.col("has_degree_req"), F.col("has_health_insurance"))
                       .alias("attributes_key"), "is_remote", "has_degree_req", "has_health_insurance",
                       label.alias("attribute_combination_name"))


def posting_flags(jobs: DataFrame) -> dict[str, Column]:
    """Star flags: NULL counts as false (the 3NF default), degree requirement is the inverse."""
    return {
        "is_remote": F.coalesce(F.col("job_work_from_home"), F.lit(False)),
        "has_degree_requirement": ~F.coalesce(F.col("job_no_degree_mention"), F.lit(False)),
        "has_health_insurance": F.coalesce(F.col("job_health_insurance"), F.lit(False)),
    }


def star_fact_postings(jobs: DataFrame, bridge: DataFrame, location_map: DataFrame, titles: DataFrame,
                       as_of: _dt.date | str) -> DataFrame:
    """One row per posting: keys of every dimension plus the measures.

    ``as_of`` fixes ``days_since_posted`` (never the wall clock, so reruns agree).
    The skill count is a partial aggregation of the bridge joined on job_id.
    """
    flags = posting_flags(jobs)
    counts = bridge.groupBy("job_id").agg(F.count(F.lit(1)).alias("skill_count"))
    # NULL keys become values that match nothing, spread over all partitions.
    f = (jobs.withColumns({"location_id": F.coalesce("location_id", -F.col("job_id")),
                           "job_title_short": null_key("job_title_short", "job_id")})
         .join(location_map, "location_id", "left")
         .join(titles.select("job_title_short", "title_key"), "job_title_short", "left")
         .join(counts, "job_id", "left"))
    full_date = F.to_date("job_posted_date")
    return f.select(
        F.col("job_id").alias("job_key"), F.col("company_id").alias("company_key"), "location_key",
        full_date.alias("full_date"), F.col("platform_id").alias("platform_key"),
        F.col("schedule_type_id").alias("schedule_key"), "title_key",
        attributes_key(flags["is_remote"], flags["has_degree_requirement"], flags["has_health_insurance"])
        .alias("attributes_key"),
        "salary_year_avg", "salary_hour_avg",
        F.coalesce(F.col("skill_count"), F.lit(0)).cast("long").alias("skill_count"),
        flags["is_remote"].cast("int").alias("is_remote"),
        flags["has_degree_requirement"].cast("int").alias("has_degree_requirement"),
        flags["has_health_insurance"].cast("int").alias("has_health_insurance"),
        F.datediff(F.lit(as_of).cast("date"), full_date).alias("days_since_posted"))


def star_bridge_skills(bridge: DataFrame) -> DataFrame:
    return bridge.select(F.col("job_id").alias("job_key"), F.col("skill_id").alias("skill_key"))


def skills_by_category(bridge: DataFrame, skills: DataFrame, categories: DataFrame) -> DataFrame:
    """Postings per (category, skill) with category subtotals and a grand total (ROLLUP).

    ``level`` is the grouping id: 0 = skill row, 1 = category subtotal, 3 = grand total,
    so an uncategorized skill (category NULL) is not confused with a subtotal. The three
    levels are computed separately instead of ROLLUP + COUNT(DISTINCT), which would copy
    every bridge row three times before the distinct shuffle: bridge pairs are unique,
    so a skill's postings are a plain count; the upper levels count distinct
    (category, job) and job ids, each de-duplicated map-side first.
    """
    named = bridge.join(star_dim_skill(skills, categories).select(
        F.col("skill_key").alias("skill_id"), "skill_name", F.col("skill_category").alias("category_name")),
        "skill_id", "inner")
    per_skill = named.groupBy("category_name", "skill_name").agg(
        F.lit(0).alias("level"), F.count(F.lit(1)).cast("long").alias("n_postings"))
    per_category = named.select("category_name", "job_id").distinct().groupBy("category_name").agg(
        F.lit(None).cast("string").alias("skill_name"), F.lit(1).alias("level"),
        F.count(F.lit(1)).cast("long").alias("n_postings"))
    total = named.select("job_id").distinct().agg(
        F.lit(None).cast("string").alias("category_name"), F.lit(None).cast("string").alias("skill_name"),
        F.lit(3).alias("level"), F.count(F.lit(1)).cast("long").alias("n_postings"))
    cols = ["category_name", "skill_name", "level", "n_postings"]
    return per_skill.select(*cols).unionByName(per_category.select(*cols)).unionByName(total.select(*cols))


def postings_by_location(jobs: DataFrame, locations: DataFrame) -> DataFrame:
    """Postings and yearly-salary total per (country, city)."""
    return jobs.join(locations.select("location_id", "country", F.col("main_city").alias("city")), "location_id", "left") \
        .groupBy("country", "city").agg(F.count(F.lit(1)).cast("long").alias("n_postings"),
                                        F.sum("salary_year_avg").cast("double").alias("total_salary_year"))


def postings_by_platform_company(jobs: DataFrame, platforms: DataFrame, companies: DataFrame) -> DataFrame:
    """Postings per (platform, company) - the flagship report."""
    named = (jobs.join(platforms, "platform_id", "left").join(companies, "company_id", "left"))
    return named.groupBy("platform_name", "company_name").agg(F.count(F.lit(1)).cast("long").alias("n_postings"))
