"""Whole loads: ingest, validation gate, publish, transform-only rerun, streaming feed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from postmart.plans import jobs as J
from postmart.schemas import RAW_COLUMNS
from postmart.sources import fixture as FIX
from postmart.sources import ingest as I
from postmart.sources import tables as TB
from postmart.streaming.staging_feed import staging_feed

from sf_dirs import SF_SMALL


def write_fixture_csv(spark, path):
    I.write_csv(FIX.postings_text(spark, SF_SMALL).select("id", *RAW_COLUMNS), path)


def test_csv_round_trip_keeps_whitespace_and_newlines(spark, scratch):
    rows = [(1, " a ", "line1\nline2", "['x', 'y']", "NA"), (2, "  ", "", "[]", "b")]
    df = spark.createDataFrame(rows, "id long, job_title string, job_location string, job_skills string, job_via string")
    for c in RAW_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    I.write_csv(df.select("id", *RAW_COLUMNS), f"{scratch}/csv")
    got = I.create_row_id(I.parse_cells(I.scan_csv(spark, f"{scratch}/csv", multiline=True))).orderBy("id").collect()
    assert [r["job_title"] for r in got] == [" a ", "  "]
    assert got[0]["job_location"] == "line1\nline2" and got[1]["job_location"] is None
    assert got[0]["job_skills"] == ["x", "y"] and got[1]["job_skills"] is None
    assert got[0]["job_via"] is None and got[1]["job_via"] == "b"


def test_run_full_fails_on_null_company_then_quarantine_publishes(spark, scratch):
    csv, base = f"{scratch}/in", f"{scratch}/mart"
    write_fixture_csv(spark, csv)
    rep = J.run_full(spark, csv, base)
    assert rep.ok is False and "not_null:jobs.company_id" in rep.violations
    assert TB.current_run(spark, base) is None          # nothing published, staging included
    assert not TB.staging_exists(spark, base)
    J.run_ingest_only(spark, csv, base)
    rep2 = J.run_transform_only(spark, base, on_violation="quarantine")
    assert rep2.ok and TB.current_run(spark, base) == rep2.run_id
    assert rep2.violations["quarantined:jobs"] == rep.violations["not_null:jobs.company_id"]
    jobs = TB.read_table(spark, base, "jobs")
    assert jobs.where(F.col("company_id").isNull()).count() == 0
    staged = TB.read_table(spark, base, "staging").count()
    assert staged == FIX.postings_raw(spark, SF_SMALL).count()
    # a rerun of the transform leaves staging alone and republishes
    rep3 = J.run_transform_only(spark, base, on_violation="quarantine")
    assert rep3.ok and TB.read_table(spark, base, "staging").count() == staged
    assert rep3.counts == rep2.counts


def test_unknown_member_load_passes(spark, scratch):
    csv, base = f"{scratch}/in", f"{scratch}/mart"
    write_fixture_csv(spark, csv)
    J.run_ingest_only(spark, csv, base)                 # leftovers a full run must replace
    rep = J.run_full(spark, csv, base, unknown_member=True)
    assert rep.ok, rep.message
    n = FIX.postings_raw(spark, SF_SMALL).count()
    staged = TB.read_table(spark, base, "staging")
    assert staged.count() == n and staged.agg(F.min("id"), F.max("id")).first() == (1, n)
    assert TB.read_table(spark, base, "companies").where(F.col("company_name") == "Unknown").count() == 1
    assert not os.path.isdir(TB.run_path(base, rep.run_id, "_work"))   # key tags go with the publication
    rows = J.run_star(spark, base, dt.date(1999, 1, 1))
    assert rows["fact_job_postings"] == rep.counts["jobs"] and rows["bridge_job_skills"] == rep.counts["job_skills"]
    assert rows["dim_attributes"] == 8 and TB.star_table(spark, base, "dim_company").count() == rep.counts["companies"]
    assert spark.conf.get("spark.postmart.scratchDir", None) is None
    path = TB.run_path(base, rep.run_id, "jobs")
    stamps = spark.read.parquet(path).select("created_at").distinct().collect()
    assert len(stamps) == 1 and stamps[0][0] is not None       # one load stamp per run


def test_gate_stops_before_staging(spark, scratch):
    df = spark.createDataFrame([(1, "century")], "id long, salary_rate string")
    for c in RAW_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    I.write_csv(df.select("id", *RAW_COLUMNS), f"{scratch}/bad")
    rep = J.run_full(spark, f"{scratch}/bad", f"{scratch}/mart")
    assert rep.ok is False and "salary_rate" in rep.message
    assert not TB.staging_exists(spark, f"{scratch}/mart")


def test_ingest_only_appends_with_rising_ids(spark, scratch):
    csv, base = f"{scratch}/in", f"{scratch}/mart"
    write_fixture_csv(spark, csv)
    J.run_ingest_only(spark, csv, base)
    J.run_ingest_only(spark, csv, base)
    s = TB.read_table(spark, base, "staging")
    n = FIX.postings_raw(spark, SF_SMALL).count()
    assert s.count() == 2 * n and s.select("id").distinct().count() == 2 * n
    assert s.agg(F.min("id"), F.max("id")).first() == (1, 2 * n)


def test_declare_and_publish_pointer(spark, scratch):
    base = f"{scratch}/mart"
    TB.declare_tables(spark, base, "r1", reset_staging=True)
    TB.publish(spark, base, "r1")
    assert TB.current_run(spark, base) == "r1"
    assert TB.read_table(spark, base, "jobs").count() == 0
    assert TB.read_table(spark, base, "staging").count() == 0


def test_streaming_feed_matches_batch_ingest(spark, scratch):
    landing, base = f"{scratch}/landing", f"{scratch}/mart"
    write_fixture_csv(spark, landing)
    q = staging_feed(spark, landing, base, checkpoint=f"{scratch}/ckpt", files_per_batch=2)
    q.awaitTermination(300)
    s = TB.read_table(spark, base, "staging")
    n = FIX.postings_raw(spark, SF_SMALL).count()
    assert s.count() == n and s.select("id").distinct().count() == n
    batch = I.stage(J.read_postings_csv(spark, landing)).drop("id")
    assert sorted(map(tuple, s.drop("id").collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)


def test_scan_csv_maps_by_header_name(spark, scratch):
    df = spark.createDataFrame([("x", "T", "extra")], "job_title string, company_name string, surprise string")
    df.write.option("header", True).csv(f"{scratch}/h")
    got = I.scan_csv(spark, f"{scratch}/h", with_source=False)
    assert got.columns == ["job_title", "company_name"] and tuple(got.first()) == ("x", "T")
    import pytest
    with pytest.raises(ValueError):
        I.scan_csv(spark, f"{scratch}/h", extra="error")


def test_arrival_ids_equal_dense_ranking(spark, scratch):
    write_fixture_csv(spark, f"{scratch}/in")
    scanned = I.scan_csv(spark, f"{scratch}/in", multiline=False)
    a = I.arrival_ids(scanned, "id", start=5).select("id", "job_title", "company_name")
    from postmart.operators.keys import dense_key
    b = dense_key(scanned, ["_src_file", "_src_block", "_src_pos"], "id", start=5).select("id", "job_title", "company_name")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    n = scanned.count()
    assert a.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (5, n + 4, n)


def test_arrival_ids_follow_file_and_split_order(spark, scratch):
    n = 20000
    df = spark.range(n).select(F.col("id"), F.format_string("%07d", "id").alias("job_title"),
                               F.lit("x" * 40).alias("company_name"))
    for c in RAW_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    I.write_csv(df.select("id", *RAW_COLUMNS).repartition(3), f"{scratch}/seq")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        scanned = I.scan_csv(spark, f"{scratch}/seq", multiline=False)
        assert scanned.select("_src_file", "_src_block").distinct().count() > 10   # many splits per file
        got = I.arrival_ids(scanned, "id").select("id", F.col("job_title").cast("long").alias("seq"))
        assert got.where(F.col("id") != F.col("seq") + 1).count() == 0
        assert got.count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def postings(spark, path, **cells):
    """One-posting CSV with the given cells."""
    good = dict(job_title_short="Baker", job_title="Pastry Baker", job_location="Lyon", job_via="via Pain", job_schedule_type="Temp",
                job_posted_date="2024-07-08", job_country="Kenya", salary_rate="day", company_name="Four",
                job_skills="['choux']", job_type_skills="{'dough': ['choux']}")
    rows = [good | {k: v[i] for k, v in cells.items()} for i in range(len(next(iter(cells.values()))))]
    df = spark.createDataFrame([(i, *(r.get(c) for c in RAW_COLUMNS)) for i, r in enumerate(rows)],
                               "id long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS))
    I.write_csv(df, path)


@pytest.mark.parametrize("cells, rule", [
    ({"job_title": ["fine", "t" * 600]}, "length:jobs.job_title"),
    ({"job_type_skills": ["{'dough': ['choux']}", "{'%s': ['choux']}" % ("c" * 60)]}, "length:skill_categories.category_name"),
    ({"company_name": ["Four", None]}, "not_null:jobs.company_id"),
])
def test_violations_are_refused_or_quarantined(spark, scratch, cells, rule):
    postings(spark, f"{scratch}/in", **cells)
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/mart")
    assert rep.ok is False and rep.violations.get(rule) == 1
    assert TB.current_run(spark, f"{scratch}/mart") is None
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/mart", on_violation="quarantine")
    assert rep.ok, rep.message
    written = {t: TB.read_table(spark, f"{scratch}/mart", t) for t in ("companies", "locations", "platforms", "schedule_types",
                                                                      "skill_categories", "skills", "jobs", "job_skills")}
    assert not any(J.violation_counts(written).values())


def test_quarantine_follows_foreign_keys(spark):
    tables = {
        "companies": spark.createDataFrame([(1, "a"), (2, None)], "company_id long, company_name string"),
        "jobs": spark.createDataFrame([(1, "t", "s", 1, 1, "year"), (2, "t", "s", 2, 1, "year"), (3, "t", "s", 1, 1, "century")],
                                      "job_id long, job_title string, job_title_short string, company_id long, "
                                      "location_id long, salary_rate string"),
        "job_skills": spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "job_id long, skill_id long")}
    kept, dropped = J.quarantine(tables)
    assert [r["job_id"] for r in kept["jobs"].collect()] == [1] and [r["job_id"] for r in kept["job_skills"].collect()] == [1]
    assert dropped["companies"].count() == 1 and dropped["jobs"].count() == 2 and dropped["job_skills"].count() == 2


def test_rate_and_overflow_stop_at_the_gate(spark, scratch):
    for k, cells in enumerate(({"salary_rate": ["century"]}, {"salary_year_avg": ["1e12"]})):
        postings(spark, f"{scratch}/in{k}", **cells)
        rep = J.run_full(spark, f"{scratch}/in{k}", f"{scratch}/mart")
        assert rep.ok is False and next(iter(cells)) in rep.message


def test_lost_dates_are_counted_or_read_by_format(spark, scratch):
    postings(spark, f"{scratch}/in", job_posted_date=["2024-01-02", "01/15/2023 10:00"])
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/a")
    assert rep.ok and rep.lost["job_posted_date"] == 1
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/b", date_format=["yyyy-MM-dd", "MM/dd/yyyy HH:mm"])
    assert rep.lost["job_posted_date"] == 0
    dates = {str(r[0]) for r in TB.read_table(spark, f"{scratch}/b", "jobs").select("job_posted_date").collect()}
    assert dates == {"2024-01-02 00:00:00", "2023-01-15 10:00:00"}
    report = spark.read.parquet(f"{rep.quality}/missing_values")
    assert report.where("column_name = 'search_location'").first()["missing_count"] == 2


def test_other_headers_stop_the_read(spark, scratch):
    spark.createDataFrame([("c", "t")], "company_name string, job_title string").write.option("header", True).csv(f"{scratch}/h")
    spark.createDataFrame([("t", "c")], "job_title string, company_name string").write.mode("append").option(
        "header", True).csv(f"{scratch}/h")
    with pytest.raises(Exception):
        I.scan_csv(spark, f"{scratch}/h").collect()


def test_feed_stops_at_shifted_columns_and_numbers_splits(spark, scratch):
    good = {c: c for c in RAW_COLUMNS}
    turned = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    spark.createDataFrame([tuple(good[c] for c in turned)], turned).write.option("header", True).csv(f"{scratch}/bad")
    with pytest.raises(Exception):
        staging_feed(spark, f"{scratch}/bad", f"{scratch}/a", checkpoint=f"{scratch}/c1").processAllAvailable()
    n = 20000
    df = spark.range(n).select("id", *[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in RAW_COLUMNS])
    I.write_csv(df.coalesce(1), f"{scratch}/big")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        staging_feed(spark, f"{scratch}/big", f"{scratch}/b", checkpoint=f"{scratch}/c2").awaitTermination(300)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    ids = TB.read_table(spark, f"{scratch}/b", "staging").agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(ids) == (1, n, n)


def test_pointer_is_never_absent(spark, scratch):
    base = f"{scratch}/mart"
    assert TB.current_run(spark, base) is None
    for run in ("r1", "r2", "r0"):
        TB.publish(spark, base, run)
        assert TB.current_run(spark, base) == run
    assert spark.read.text(f"{base}/_current").count() == 3      # lines are added, none is replaced


def test_errors_are_not_taken_for_an_empty_mart(spark):
    with pytest.raises(Exception):
        TB.staging_exists(spark, "nosuchscheme://x/y")


def test_report_holds_the_structure_of_skill_cells(spark, scratch):
    postings(spark, f"{scratch}/in", job_skills=["['a', 'b']", "junk"], job_type_skills=["{'k': ['a']}", "{'open': "])
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/mart")
    assert rep.ok
    for name, want in (("job_skills", (2, 1, 1)), ("job_type_skills", (2, 1, 1))):
        assert tuple(spark.read.parquet(f"{rep.quality}/structure_{name}").first()) == want
    profile = spark.read.parquet(f"{rep.quality}/data_profile")
    assert not profile.where("column_name LIKE '\\\\_%'").count()
