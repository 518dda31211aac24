"""A third of the rows on one key: results stay whole and exact under skew-split joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postmart.operators import bridge as B
from postmart.operators import dimensions as D
from postmart.operators import facts as FX
from postmart.operators import quality as Q
from postmart.schemas import STAGING_SCHEMA

N = 3000


@pytest.fixture()
def forced_sort_merge(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_staging(spark):
    day = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1, N + 1):
        hot = i % 3 == 0
        rows.append({
            "id": i, "job_title": "hot title" if hot else f"title {i}",
            "job_posted_date": day if hot else day + dt.timedelta(days=i % 400),
            "job_via": "via HotBoard" if hot else f"via Board{i % 7}",
            "company_name": "HotCo" if hot else f"Co{i % 50}",
            "job_location": "X, Y", "job_country": "C",
            "job_schedule_type": None if hot else "Full-time",
            "job_skills": ["python", f"s{i % 5}"],
        })
    names = [f.name for f in STAGING_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], STAGING_SCHEMA).repartition(6)


def test_hot_keys_whole_results(spark, forced_sort_merge):
    stg = skewed_staging(spark)
    comp, loc = D.dim_companies(stg), D.dim_locations(stg)
    plat, sch = D.dim_platforms(stg), D.dim_schedule_types(stg)
    jobs = FX.fact_jobs(stg, comp, loc, plat, sch, keep_staging_id=True)
    assert jobs.count() == N
    assert jobs.select("job_id").distinct().count() == N
    assert jobs.agg(F.min("job_id"), F.max("job_id")).first() == (1, N)
    hot_plat = plat.where(F.col("platform_name") == "HotBoard").first()["platform_id"]
    assert jobs.where(F.col("platform_id") == hot_plat).count() == N // 3
    assert jobs.where(F.col("schedule_type_id").isNull()).count() == N // 3
    skills = D.dim_skills(stg, D.dim_skill_categories(stg))
    pairs = B.bridge_job_skills(jobs, stg, skills)
    # hot group: N/3 postings share title and date, so each gets the union of the group's skills (python + s0..s4)
    expected = (N // 3) * 6 + (N - N // 3) * 2
    assert pairs.count() == expected
    assert pairs.dropDuplicates().count() == expected
    hot_items = (N // 3) * 2
    assert B.count_bridge(jobs, stg, skills).first()[0] == (N // 3) * hot_items + (N - N // 3) * 2
    assert Q.duplicate_rows(stg.select("job_title", "job_posted_date"), ["job_title", "job_posted_date"]).first()[0] \
        == N // 3 - 1
