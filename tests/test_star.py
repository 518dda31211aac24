"""Star schema pieces and slowly changing dimensions on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from postmart.operators import scd as SCD
from postmart.operators import star as H


def test_calendar_iso_weekday(spark):
    rows = H.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 7)).orderBy("full_date").collect()
    assert len(rows) == 7 and rows[0]["day_of_week"] == 1 and rows[6]["day_of_week"] == 7  # Mon .. Sun
    assert rows[0]["quarter"] == 1 and rows[0]["year"] == 2024


def test_attributes_dimension(spark):
    rows = {r["attributes_key"]: r for r in H.star_dim_attributes(spark).collect()}
    assert sorted(rows) == list(range(1, 9))
    assert rows[1]["attribute_combination_name"] == "On-site + No Degree + No Health Insurance"
    assert rows[8]["attribute_combination_name"] == "Remote + Degree + Health Insurance"
    assert rows[5]["attribute_combination_name"] == "Remote + No Degree + No Health Insurance"


def test_schedule_full_time_flag(spark):
    df = spark.createDataFrame([(1, "Full-time"), (2, "Part-time"), (3, "Full-time and Part-time")],
                               "schedule_type_id long, schedule_type_name string")
    got = {r["schedule_key"]: r["is_full_time"] for r in H.star_dim_schedule_type(df).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_fact_flags_null_as_false_and_inverted_degree(spark):
    jobs = spark.createDataFrame([(1, None, None, None), (2, True, True, False)],
                                 "job_id long, job_work_from_home boolean, job_no_degree_mention boolean, "
                                 "job_health_insurance boolean")
    flags = H.posting_flags(jobs)
    got = {r["job_id"]: tuple(r)[1:] for r in jobs.select("job_id", *[v.alias(k) for k, v in flags.items()]).collect()}
    assert got == {1: (False, True, False), 2: (True, False, False)}


def test_scd_type2_and_type1(spark):
    cur = spark.createDataFrame([
        (1, "a", dt.date(2020, 1, 1), None, True), (2, "b", dt.date(2020, 1, 1), None, True),
        (3, "c", dt.date(2020, 1, 1), None, True), (1, "old", dt.date(2019, 1, 1), dt.date(2020, 1, 1), False)],
        "k long, attr string, valid_from date, valid_to date, is_current boolean")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k long, attr string")
    out = SCD.scd_dimension(cur, new, ["k"], ["attr"], "2021-01-01")
    rows = sorted((r["k"], r["attr"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"], r["change"])
                  for r in out.collect())
    assert rows == [
        (1, "a", "2020-01-01", "None", True, "unchanged"),
        (1, "old", "2019-01-01", "2020-01-01", False, "history"),
        (2, "B", "2021-01-01", "None", True, "opened"),
        (2, "b", "2020-01-01", "2021-01-01", False, "closed"),
        (3, "c", "2020-01-01", "None", True, "unchanged"),
        (4, "d", "2021-01-01", "None", True, "new"),
    ]
    gone = SCD.scd_dimension(cur, new, ["k"], ["attr"], "2021-01-01", close_missing=True)
    assert gone.where((F.col("k") == 3) & F.col("is_current")).count() == 0
    t1 = {r["k"]: r["attr"] for r in SCD.scd_dimension(cur, new, ["k"], ["attr"], "2021-01-01", kind=1)
          .where("is_current").collect()}
    assert t1 == {1: "a", 2: "B", 3: "c", 4: "d"}


def test_scd_tells_values_apart_that_join_to_equal_text(spark):
    import datetime as dt
    from postmart.operators.scd import scd_dimension
    cur = spark.createDataFrame([(1, "a\x01b", "c", dt.date(2020, 1, 1), None, True)],
                                "k long, x string, y string, valid_from date, valid_to date, is_current boolean")
    new = spark.createDataFrame([(1, "a", "b\x01c")], "k long, x string, y string")
    assert {r["change"] for r in scd_dimension(cur, new, ["k"], ["x", "y"], "2021-01-01").collect()} == {"closed", "opened"}
