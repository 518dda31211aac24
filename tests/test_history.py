"""Versions from any order of observations, facts as of their time, keys kept over reloads."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postmart.operators import keys as K
from postmart.operators import scd as SCD
from postmart.plans import jobs as J
from postmart.schemas import RAW_COLUMNS
from postmart.sources import fixture as FIX
from postmart.sources import ingest as I
from postmart.sources import tables as TB

from sf_dirs import SF_SMALL

DAY = dt.datetime(2024, 1, 1)


def brute_history(rows):
    best = {}
    for key, state, at, arrival in rows:
        if key is not None and at is not None:
            best[key, at] = max(best.get((key, at), (arrival, state)), (arrival, state))
    out = []
    for key in {k for k, _ in best}:
        starts = []
        for at in sorted(a for k, a in best if k == key):
            state = best[key, at][1]
            if not starts or starts[-1][1] != state:
                starts.append((at, state))
        for i, (at, state) in enumerate(starts):
            to = starts[i + 1][0] if i + 1 < len(starts) else None
            out.append((key, state, at, to, to is None))
    return sorted(out, key=repr)


def observations(rnd, n=600):
    rows = [(rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice("ab"), DAY + dt.timedelta(days=rnd.choice([0, 1, 31, 32, 33, 90, 400, rnd.randrange(900)])), i)
            for i in range(n)]
    return rows + [(1, "a", None, n), rows[0]]


@pytest.mark.parametrize("bin_days", [1, 32, 10_000])
def test_history_by_gaps_and_islands(spark, bin_days):
    rows = observations(random.Random(bin_days))
    df = spark.createDataFrame(rows, "k int, state string, at timestamp_ntz, load int").repartition(4)
    got = SCD.history(df, ["k"], ["state"], "at", "load", bin_days)
    assert got.columns == ["k", "state", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_history(rows)
    assert SCD.history(df.where("false"), ["k"], ["state"], "at").count() == 0


def test_late_rows_give_the_same_history(spark):
    rows = observations(random.Random(5), 200)
    early = spark.createDataFrame(rows[::2], "k int, state string, at timestamp_ntz, load int")
    late = spark.createDataFrame(rows[1::2], "k int, state string, at timestamp_ntz, load int")
    assert sorted(map(tuple, SCD.history(early.union(late), ["k"], ["state"], "at", "load").collect()), key=repr) == brute_history(rows)


@pytest.mark.parametrize("bin_days", [1, 40])
def test_as_of_equals_brute_force(spark, bin_days):
    rnd = random.Random(7)
    versions = [(k, DAY + dt.timedelta(days=d), f"{k}-{d}") for k in (1, 2, 3) for d in sorted(rnd.sample(range(500), 12))]
    versions += [(1, versions[0][1], "zz"), (4, None, "never"), (None, DAY, "no member")]
    fact = [(i, rnd.choice([1, 1, 1, 2, 5, None]), None if i % 50 == 0 else DAY + dt.timedelta(days=rnd.randrange(-20, 900), hours=rnd.randrange(24)))
            for i in range(500)]
    by = collections.defaultdict(dict)
    for k, at, name in versions:
        if k is not None and at is not None:
            by[k][at] = max(by[k].get(at, ""), name)
    want = {i: max(((v, n) for v, n in by.get(k, {}).items() if at is not None and v <= at), default=(None, None))[1] for i, k, at in fact}
    f = spark.createDataFrame(fact, "id int, member int, happened timestamp_ntz").repartition(3)
    v = spark.createDataFrame(versions, "k int, valid_from timestamp_ntz, name string")
    got = SCD.as_of(f, v, {"member": "k"}, "happened", ["name"], bin_days=bin_days)
    assert got.columns == ["id", "member", "happened", "name"]
    assert {r.id: r.name for r in got.collect()} == want and got.count() == len(fact)
    assert SCD.as_of(f, v.where("false"), {"member": "k"}, "happened", ["name"]).where("name IS NOT NULL").count() == 0


def test_carried_keys(spark):
    known = spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("gone", "y", 9)], "n string, m string, id long")
    built = spark.createDataFrame([(1, "a", None, "p"), (2, "aa", "x", "q"), (3, "b", "x", "r"), (4, "c", None, "s")], "id long, n string, m string, extra string")
    got = K.carry_keys(built, known, ["n", "m"], "id")
    assert sorted(map(tuple, got.collect())) == [(1, "a", None, "p"), (2, "b", "x", "r"), (10, "aa", "x", "q"), (11, "c", None, "s")]
    assert K.carry_keys(built, None, ["n", "m"], "id") is built
    assert K.carry_keys(built.where("false"), known, ["n", "m"], "id").count() == 0


def test_reloads_keep_the_keys_of_members(spark, scratch):
    text = FIX.postings_text(spark, SF_SMALL).select("id", *RAW_COLUMNS).where("length(trim(company_name)) > 0")
    base, seen = f"{scratch}/mart", {}
    for n, part in enumerate(("id % 3 = 0", "id % 3 <> 1", "id % 3 = 1")):   # grown, then a load in which members are gone
        I.write_csv(text.where(part), f"{scratch}/in{n}")
        rep = J.run_full(spark, f"{scratch}/in{n}", base, on_violation="quarantine", stable_keys=True, report=False)
        assert rep.ok
        for name, (natural, key) in J.DIMENSION_KEYS.items():
            rows = TB.read_table(spark, base, name).select(key, *natural).collect()
            assert len({r[0] for r in rows}) == len(rows)
            given = seen.setdefault(name, {})
            for r in rows:
                assert given.setdefault(tuple(r[1:]), r[0]) == r[0], (name, r)
            assert len(set(given.values())) == len(given)
    jobs = TB.read_table(spark, base, "jobs")
    assert jobs.join(TB.read_table(spark, base, "companies"), "company_id", "left_anti").count() == 0


def test_dates_in_the_columns_own_format_load(spark, scratch):
    text = FIX.postings_text(spark, SF_SMALL).select("id", *RAW_COLUMNS).where("length(trim(company_name)) > 0 AND job_posted_date IS NOT NULL")
    us = text.withColumn("job_posted_date", F.date_format(F.col("job_posted_date").cast("timestamp_ntz"), "MM/dd/yyyy HH:mm"))
    us = us.withColumn("job_posted_date", F.when(F.col("id") % 40 == 0, "soon").otherwise(F.col("job_posted_date")))
    I.write_csv(us, f"{scratch}/in")
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/strict", on_violation="quarantine", report=False, most_lost=0)
    assert not rep.ok and "job_posted_date" in rep.message and rep.lost["job_posted_date"] == us.where("id % 40 = 0").count()
    assert not TB.exists(spark, f"{scratch}/strict/runs/{rep.run_id}/_work")
    rep = J.run_full(spark, f"{scratch}/in", f"{scratch}/mart", on_violation="quarantine", report=False)
    assert rep.ok
    staged = TB.read_table(spark, f"{scratch}/mart", "staging")
    assert staged.where("job_posted_date IS NULL").count() == rep.lost["job_posted_date"] > 0
    want = text.where("id % 40 <> 0").agg(F.min(F.col("job_posted_date").cast("timestamp_ntz")), F.max(F.col("job_posted_date").cast("timestamp_ntz"))).first()
    assert staged.agg(F.min("job_posted_date"), F.max("job_posted_date")).first() == want
