"""Surrogate keys and insert-if-absent."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postmart.operators import keys as K


def test_dense_key_equals_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=13).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = K.dense_key(df, ["k"], "key", partitions=7)
    expect = df.withColumn("key", F.row_number().over(Window.orderBy("k")).cast("long"))
    assert sorted(got.collect()) == sorted(expect.select("k", "key").collect())


def test_dense_key_nulls_first_and_start(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r["k"]: r["key"] for r in K.dense_key(df, ["k"], "key", start=10).collect()}
    assert got == {None: 10, "a": 11, "b": 12}


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    new = spark.createDataFrame([("y",), ("z",), ("z",), ("a",)], "name string")
    got = sorted(K.insert_if_absent(existing, new, ["name"], "id").collect())
    assert [tuple(r) for r in got] == [(1, "x"), (2, "y"), (3, "a"), (4, "z")]


def test_insert_if_absent_nulls_distinct(spark):
    existing = spark.createDataFrame([(1, None, "c")], "id long, city string, country string")
    new = spark.createDataFrame([(None, "c"), (None, "c"), ("m", "c")], "city string, country string")
    got = K.insert_if_absent(existing, new, ["city", "country"], "id").collect()
    assert len(got) == 3  # NULL city never conflicts; in-batch exact duplicates collapse
    same = K.insert_if_absent(existing, new, ["city", "country"], "id", nulls_distinct=False).collect()
    assert len(same) == 2


def test_dense_key_coalesced_ranges(spark):
    df = spark.range(0, 3000, numPartitions=5).select(((F.col("id") * 31) % 3001).alias("k"))
    a = K.dense_key(df, ["k"], "key")
    b = K.dense_key(df, ["k"], "key", partitions=40)
    expect = df.withColumn("key", F.row_number().over(Window.orderBy("k")).cast("long"))
    assert sorted(a.collect()) == sorted(expect.collect()) == sorted(b.collect())


@pytest.mark.parametrize("layout", ["sorted", "runs", "overlapping", "shuffled", "empty"])
def test_number_written_equals_global_row_number(spark, scratch, layout, monkeypatch):
    ids = spark.range(0, 6000, numPartitions=1).select((F.col("id") * 3 + 5).alias("k"), F.col("id").cast("string").alias("v"))
    table = {"sorted": ids.repartitionByRange(5, "k").sortWithinPartitions("k"),
             # every file holds several stretches of the order, none of which meets another
             "runs": ids.repartition(3, F.expr("k div 900")).sortWithinPartitions(F.expr("k div 900") % 2, "k"),
             "overlapping": ids.repartition(4, F.col("k") % 4).sortWithinPartitions("k"),
             "shuffled": ids.repartition(4).sortWithinPartitions(F.xxhash64("k")), "empty": ids.where("k < 0")}[layout]
    monkeypatch.setattr(K, "CHUNK_ROWS", 700)
    table.write.parquet(f"{scratch}/t")
    got = K.number_written(spark.read.parquet(f"{scratch}/t"), "k", "n", start=4)
    assert got.columns == ["k", "v", "n"]
    want = ids.withColumn("n", ((F.col("k") - 5) / 3 + 4).cast("long")) if layout != "empty" else ids.where("k < 0").withColumn("n", F.lit(1))
    assert sorted(got.collect()) == sorted(want.collect())


def test_number_written_beyond_the_bounds(spark, scratch, monkeypatch):
    monkeypatch.setattr(K, "MOST_RUNS", 3)
    spark.range(0, 500).repartition(3, F.expr("id div 20")).sortWithinPartitions("id").write.parquet(f"{scratch}/t")
    got = K.number_written(spark.read.parquet(f"{scratch}/t"), "id", "n", start=0)
    assert [(r.id, r.n) for r in got.orderBy("id").collect()] == [(i, i) for i in range(500)]
