"""Fact table of postings (F1-F6, J1-J5, O1) and staging-level counts (A1).

The four lookups are plain left equi-joins on the same cleaning expressions the
dimensions were built with. AQE turns each into a broadcast join when the dimension's
measured size is under the broadcast threshold and keeps a sort-merge join (with skew
splitting) when it is not; nothing is broadcast on faith. Keys that can be NULL are
replaced by distinct non-matching values, and keys that default to 'Unknown' are salted,
so rows without a value do not pile into one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (clean_company, clean_platform, clean_schedule, coalesce_title,
                              default_unknown, has_title, null_key)
from ..schemas import TARGET_SCHEMAS, UNKNOWN
from ..session import fresh_dir
from .keys import dense_key, insert_if_absent, number_written

FACT_COLUMNS = TARGET_SCHEMAS["jobs"].names


def titled(staging: DataFrame) -> DataFrame:
    """Rows with at least one title (F2)."""
    return staging.where(has_title("job_title", "job_title_short"))


def count_eligible(staging: DataFrame) -> DataFrame:
    """COUNT(*) of rows with a title (A1), as a one-row frame."""
    return titled(staging).agg(F.count(F.lit(1)).alias("eligible_rows"))


#: Copies of the 'Unknown' members that a lookup deals the rows without a value over.
UNKNOWN_SALTS = 32


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], keep: list[str], salt_by: str | None = None) -> DataFrame:
    """Left join ``df`` to ``dim`` where df[k] == dim[v] for each k -> v in ``on``; add ``keep``.

    With ``salt_by`` the keys that default to 'Unknown', which may hold a large part of all
    rows, are dealt over UNKNOWN_SALTS salts.
    """
    right = dim.select(*[F.col(v).alias(k) for k, v in on.items()], *keep)
    keys = list(on.keys())
    if salt_by is None:
        return df.join(right, keys, "left")
    hot = F.lit(False)
    for k in keys:
        hot = hot | F.coalesce(F.col(k) == UNKNOWN, F.lit(False))
    left = df.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(salt_by), F.lit(UNKNOWN_SALTS))).otherwise(0).cast("int"))
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(UNKNOWN_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(right.withColumn("_salt", F.explode(salts)), [*keys, "_salt"], "left").drop("_salt")


def with_lookup_keys(staging: DataFrame, id: str = "id") -> DataFrame:
    """The expressions the fact joins on."""
    return staging.withColumns({
        "_company_key": clean_company("company_name"),
        "_country_key": default_unknown("job_country"),
        "_location_key": default_unknown("job_location"),
        "_platform_key": null_key(clean_platform("job_via"), id),
        "_schedule_key": null_key(clean_schedule("job_schedule_type"), id),
    })


#: What a posting brings to the fact, and what its lookups read.
MEASURES = ["job_title_short", "job_work_from_home", "job_posted_date", "job_no_degree_mention", "job_health_insurance",
            "salary_rate", "salary_year_avg", "salary_hour_avg", "search_location"]
SOURCES = ["company_name", "job_country", "job_location", "job_via", "job_schedule_type"]


def _projected(staging: DataFrame) -> DataFrame:
    return titled(staging).select(F.col("id").alias("staging_id"), coalesce_title("job_title", "job_title_short").alias("job_title"),
                                  *MEASURES, *SOURCES)


def postings(staging: DataFrame) -> DataFrame:
    """The titled rows with ``job_id`` dense in staging ``id`` order, before any lookup.

    They are written once, in the order in which staging stands, and numbered in place: only ids
    and places are shuffled. A bridge needs no more than this of the fact.
    """
    path = fresh_dir(staging.sparkSession, "postings")
    _projected(staging).write.parquet(path)
    return number_written(staging.sparkSession.read.parquet(path), "staging_id", "job_id")


def look_up(rows: DataFrame, companies: DataFrame, locations: DataFrame, platforms: DataFrame, schedules: DataFrame,
            unknown_member: bool = False) -> DataFrame:
    """The four lookups of postings (J1-J4), each a left join of its own; see ``fact_jobs``."""
    s = with_lookup_keys(rows, "staging_id")
    if unknown_member:
        # NULL and blank names both resolve to the 'Unknown' member.
        companies = with_unknown_company(companies)
        s = s.withColumn("_company_key", F.coalesce(F.nullif(F.col("_company_key"), F.lit("")), F.lit("Unknown")))
    j = lookup(s, companies, {"_company_key": "company_name"}, ["company_id"], salt_by="staging_id")
    j = lookup(j, locations, {"_country_key": "country", "_location_key": "full_location"}, ["location_id"], salt_by="staging_id")
    j = lookup(j, platforms, {"_platform_key": "platform_name"}, ["platform_id"])
    return lookup(j, schedules, {"_schedule_key": "schedule_type_name"}, ["schedule_type_id"])


def one_member_per_key(locations: DataFrame) -> bool:
    """Whether a lookup key names one location at most (not so where NULL and 'Unknown' are two members)."""
    return not locations.groupBy("country", "full_location").count().where("count > 1").limit(1).count()


def fact_jobs(staging: DataFrame, companies: DataFrame, locations: DataFrame, platforms: DataFrame,
              schedules: DataFrame, unknown_member: bool = False, keep_staging_id: bool = False,
              numbered: DataFrame | None = None) -> DataFrame:
    """One row per titled staging row (more if a lookup key matches several members).

    ``job_id`` is dense in staging ``id`` order, given before the lookups (``numbered``, as
    ``postings`` returns it, is used where the caller has it already). Where a key matches several
    members the looked-up rows are written and numbered by (staging id, location). Postings
    without a company member stay NULL and the NOT NULL check reports them; with
    ``unknown_member`` NULL and blank names resolve to an 'Unknown' member that is added when missing.
    """
    cols = FACT_COLUMNS + (["staging_id"] if keep_staging_id else [])
    dims = (companies, locations, platforms, schedules, unknown_member)
    if one_member_per_key(locations):
        return look_up(postings(staging) if numbered is None else numbered, *dims).select(*cols)
    path = fresh_dir(staging.sparkSession, "looked-up")
    look_up(_projected(staging), *dims).select(*(c for c in [*FACT_COLUMNS, "staging_id"] if c != "job_id")).write.parquet(path)
    return dense_key(staging.sparkSession.read.parquet(path), ["staging_id", "location_id"], "job_id").select(*cols)


def with_unknown_company(companies: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Add an 'Unknown' member (next key) when it is missing."""
    extra = companies.sparkSession.createDataFrame([(unknown,)], "company_name string")
    return insert_if_absent(companies, extra, ["company_name"], "company_id")
