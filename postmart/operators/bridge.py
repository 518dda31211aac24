"""Posting-to-skill bridge.

The source SQL joins jobs back to staging on (title, posted date), unnests the skill
list, matches skills and then drops repeated pairs. Joining first makes a popular
(title, date) produce jobs x staging rows x skills rows before the dedupe. Here the
staging side is reduced to distinct (title, date, skill_id) first, so each job meets
each of its group's skills once: the pairs are unique by construction and the work is
linear in the output. ``match="id"`` links each job to its own staging row instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import skill_match_key


def explode_skills(staging: DataFrame, list_col: str = "job_skills",
                   keys: tuple[str, ...] = ("id", "job_title", "job_posted_date")) -> DataFrame:
    """One row per list item (NULL and empty lists give no rows), as ``s_name``."""
    return staging.select(*keys, F.explode(list_col).alias("s_name"))


def match_skill(exploded: DataFrame, skills: DataFrame) -> DataFrame:
    """Inner join on ``LOWER(TRIM(item)) = LOWER(skill_name)``."""
    right = skills.select(F.lower("skill_name").alias("_skill_key"), "skill_id")
    return exploded.withColumn("_skill_key", skill_match_key("s_name")).join(right, "_skill_key", "inner") \
        .drop("_skill_key")


def rejoin_staging(jobs: DataFrame, staging: DataFrame, match: str = "title_date") -> DataFrame:
    """Jobs joined back to their staging rows (J6), one row per (job, staging row)."""
    if match == "title_date":
        left = jobs.select("job_id", "job_title", "job_posted_date")
        right = staging.select(F.col("id").alias("stg_id"), "job_title", "job_posted_date")
        return left.join(right, ["job_title", "job_posted_date"], "inner").select("job_id", "stg_id")
    if match == "id":
        return jobs.select("job_id", F.col("staging_id").alias("stg_id"))
    raise ValueError(f"match must be 'title_date' or 'id', not {match!r}")


def rejoin_groups(jobs: DataFrame, staging: DataFrame) -> DataFrame:
    """What ``rejoin_staging`` links, per (title, date): jobs, staging rows and the pairs they make.

    All pairs of a popular title and date are m x m rows; their number is a product of two counts.
    """
    keys = ["job_title", "job_posted_date"]
    left = jobs.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_jobs"))
    right = staging.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_staging"))
    return left.join(right, keys, "inner").withColumn("n_pairs", F.col("n_jobs") * F.col("n_staging"))


def bridge_job_skills(jobs: DataFrame, staging: DataFrame, skills: DataFrame, match: str = "title_date",
                      list_col: str = "job_skills") -> DataFrame:
    """Distinct (job_id, skill_id) pairs (J9 with the pair dedupe A6 built in).

    ``match="title_date"`` reproduces the source join on (job_title, job_posted_date):
    postings sharing both exchange skills and NULL dates link nothing. ``match="id"``
    needs ``jobs`` built with ``keep_staging_id=True``.
    """
    matched = match_skill(explode_skills(staging, list_col), skills)
    if match == "title_date":
        per_group = matched.select("job_title", "job_posted_date", "skill_id").distinct()
        return jobs.select("job_id", "job_title", "job_posted_date") \
            .join(per_group, ["job_title", "job_posted_date"], "inner").select("job_id", "skill_id")
    if match == "id":
        per_row = matched.select(F.col("id").alias("staging_id"), "skill_id").distinct()
        return jobs.select("job_id", "staging_id").join(per_row, "staging_id", "inner").select("job_id", "skill_id")
    raise ValueError(f"match must be 'title_date' or 'id', not {match!r}")


def count_bridge(jobs: DataFrame, staging: DataFrame, skills: DataFrame, list_col: str = "job_skills") -> DataFrame:
    """Rows of the title/date join before the pair dedupe (A2), without building them.

    Per (title, date) group the join yields jobs x matched items rows, so the count is
    the sum of those products: two aggregations and one join of group-level rows.
    """
    per_jobs = jobs.groupBy("job_title", "job_posted_date").agg(F.count(F.lit(1)).alias("_n_jobs"))
    matched = match_skill(explode_skills(staging, list_col), skills)
    per_items = matched.groupBy("job_title", "job_posted_date").agg(F.count(F.lit(1)).alias("_n_items"))
    joined = per_jobs.join(per_items, ["job_title", "job_posted_date"], "inner")
    return joined.agg(F.coalesce(F.sum(F.col("_n_jobs") * F.col("_n_items")), F.lit(0)).cast("long")
                      .alias("bridge_rows_before_dedupe"))


def pair_dedupe(pairs: DataFrame, keys: tuple[str, ...] = ("job_id", "skill_id")) -> DataFrame:
    """Drop repeated key pairs (``ON CONFLICT DO NOTHING`` on the primary key)."""
    return pairs.dropDuplicates(list(keys))
