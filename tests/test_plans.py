"""Plan shapes the scale design relies on (checked on the executed, AQE-final plans)."""

import contextlib
import io

from pyspark.sql import functions as F

from postmart.catalog import Mart
from postmart.operators import bridge as B
from postmart.operators import facts as FX
from postmart.operators import keys as K
from postmart.sources import fixture as FIX
from postmart.sources import ingest as I

from sf_dirs import SF_SMALL


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue().split("== Initial Plan ==")[0]


def test_fact_lookups_scan_staging_once_without_shuffling_it(spark):
    m = Mart.get(spark, SF_SMALL)
    s = FX.with_lookup_keys(FX.titled(m.staging))
    j = FX.lookup(s, m.companies, {"_company_key": "company_name"}, ["company_id"])
    j = FX.lookup(j, m.locations, {"_country_key": "country", "_location_key": "full_location"}, ["location_id"])
    j = FX.lookup(j, m.platforms, {"_platform_key": "platform_name"}, ["platform_id"])
    j = FX.lookup(j, m.schedules, {"_schedule_key": "schedule_type_name"}, ["schedule_type_id"])
    plan = final_plan(j.select("id", "company_id", "location_id", "platform_id", "schedule_type_id"))
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan
    staging_scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "job_via" in line]
    assert len(staging_scans) == 1
    assert "job_skills" not in staging_scans[0]            # only the needed columns are read


def test_arrival_ids_do_not_shuffle_rows(spark):
    m = Mart.get(spark, SF_SMALL)
    lines = final_plan(I.arrival_ids(I.scan_csv(spark, m.csv_path)).select("id", "job_title")).splitlines()
    row_scan = [i for i, line in enumerate(lines) if "FileScan csv" in line and "job_title" in line]
    broadcast = [i for i, line in enumerate(lines) if "BroadcastExchange" in line]
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line and "BroadcastExchange" not in line]
    assert len(row_scan) == 1 and len(broadcast) == 1
    # the rows stream straight into the join; every shuffle is inside the per-split offsets
    assert row_scan[0] < broadcast[0] and all(i > broadcast[0] for i in shuffles)


def test_bridge_dedupes_staging_before_the_join(spark):
    m = Mart.get(spark, SF_SMALL)
    plan = final_plan(B.bridge_job_skills(m.jobs, m.staging, m.skills))
    # the distinct (title, date, skill) aggregation runs below the join on (title, date)
    join_at = next(i for i, line in enumerate(plan.splitlines()) if "Join [job_title" in line)
    below = "\n".join(plan.splitlines()[join_at:])
    assert "HashAggregate(keys=[job_title" in below and "skill_id" in below


def test_job_ids_move_no_fact_columns(spark):
    m = Mart.get(spark, SF_SMALL)
    j = FX.fact_jobs(m.staging, m.companies, m.locations, m.platforms, m.schedules, keep_staging_id=True)
    plan = final_plan(j)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "company_name" in line and "salary_rate" in line]
    assert len(scans) == 1                                          # the postings are read once
    joins = [line for line in plan.splitlines() if "HashJoin" in line]
    assert "SortMergeJoin" not in plan
    for key in ("_company_key", "_location_key", "_platform_key", "_schedule_key", "__pm_file"):
        assert len([line for line in joins if key in line]) == 1, key   # each lookup, and the runs' offsets, once
    # nothing that carries fact columns is shuffled: what is lies below the broadcasts
    shuffles = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert not [line for line in shuffles if "staging_id" in line or "salary_rate" in line]
    fact = next(i for i, line in enumerate(plan.splitlines()) if line == scans[0])
    broadcast = next(i for i, line in enumerate(plan.splitlines()) if "BroadcastExchange" in line)
    assert fact < broadcast and not [i for i, line in enumerate(plan.splitlines()) if line in shuffles and i < fact]


def test_raw_postings_are_dealt_once_by_ranges(spark):
    """One shuffle of narrow rows: no hash shuffle of orders or items, no map-side lists, no sort of wide rows."""
    lines = final_plan(FIX.postings_raw(spark, SF_SMALL)).splitlines()
    shuffles = [line for line in lines if "Exchange" in line and "BroadcastExchange" not in line]
    assert len(shuffles) == 1 and "rangepartitioning(id" in shuffles[0]
    assert not any("ObjectHashAggregate" in line for line in lines)
    sorts = [line for line in lines if "Sort [" in line]
    assert len(sorts) == 1


def test_files_of_several_stretches_are_numbered_in_place(spark, scratch, monkeypatch):
    """A file may hold rows from before and after another file's, as a task that read two files writes it."""
    ids = spark.range(0, 3000, numPartitions=1).select("id", F.col("id").cast("string").alias("wide"))
    ids.repartition(2, F.expr("id div 1000") == 1).sortWithinPartitions("id").write.parquet(f"{scratch}/stretches")
    moved = []
    monkeypatch.setattr(K, "dense_key", lambda df, *a, _real=K.dense_key, **k: moved.append(df.columns) or _real(df, *a, **k))
    got = K.number_written(spark.read.parquet(f"{scratch}/stretches"), "id", "n", start=1)
    assert sorted((r.id, r.n) for r in got.collect()) == [(i, i + 1) for i in range(3000)]
    assert not [c for c in moved if "wide" in c]


def test_csv_is_written_without_building_or_moving_the_raw_table(spark):
    m = Mart.get(spark, SF_SMALL, fresh=True)
    got = I.create_row_id(m.scanned).select("id", "job_title", "company_name").orderBy("id").collect()
    assert "raw" not in m.__dict__ and "text" not in m.__dict__
    want = FIX.postings_raw(spark, SF_SMALL).orderBy("id").select("job_title").collect()
    assert [r.id for r in got] == list(range(1, len(want) + 1)) and [r.job_title for r in got] == [r.job_title for r in want]
