"""Pages over tied keys, and the format of a date column."""

import pytest
from pyspark.sql import functions as F

from postmart.functions import parse as P
from postmart.operators import paging as O


@pytest.mark.parametrize("near_front", [100_000, 0])
def test_consecutive_pages_partition_rows_with_equal_keys(spark, monkeypatch, near_front):
    monkeypatch.setattr(O, "NEAR_FRONT", near_front)
    df = spark.range(0, 2000, numPartitions=7).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % 2003).alias("v"))
    seen = [r["v"] for at in range(0, 2000, 500) for r in O.page(df, ["k"], 500, at).collect()]
    assert len(seen) == 2000 and set(seen) == {(i * 7919) % 2003 for i in range(2000)}


def test_pages_on_either_side_of_the_front_agree(spark):
    df = spark.range(0, 200_000, numPartitions=8).select((F.col("id") % 3).alias("k"), F.col("id"), F.lit(None).cast("map<string,int>").alias("m"))
    pages = [O.page(df, ["k"], 50_000, at).agg(F.sum("id"), F.count("id"), F.min("k"), F.max("k")).first() for at in range(0, 200_000, 50_000)]
    assert sum(p[0] for p in pages) == 199_999 * 100_000 and [p[1] for p in pages] == [50_000] * 4
    assert [(p[2], p[3]) for p in pages] == [(0, 0), (0, 1), (1, 2), (2, 2)]


def test_order_index_reads_only_the_ranges_of_a_page(spark, scratch):
    df = spark.range(0, 5000, numPartitions=3).select(F.lit("x").alias("k"), ((F.col("id") * 31) % 5003).alias("v"))
    index = O.OrderIndex.build(df, ["k"], f"{scratch}/index", ranges=10)
    want = sorted((i * 31) % 5003 for i in range(5000))
    assert index.count() == 5000
    for limit, offset in ((700, 0), (700, 700), (10, 4995), (5000, 0), (3, 6000)):
        assert sorted(r["v"] for r in index.page(limit, offset).collect()) == want[offset:offset + limit]
    # ten folders, one of which holds the page
    assert len(index.page(10, 2505).inputFiles()) == 10
    plan = spark._jvm.PythonSQLUtils.explainString(index.page(10, 2505)._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(_range" in plan or "PartitionFilters: [(_range" in plan
    empty = O.OrderIndex.build(df.where("v < 0"), ["k"], f"{scratch}/empty")
    assert empty.count() == 0 and empty.page(5).count() == 0


@pytest.mark.parametrize("cells, expected", [
    (["3/4/2024", "12/31/2024 ", None, "x"], "M/d/yyyy"), (["3/4/2024", "31/12/2024"], "d/M/yyyy"),
    (["3/4/2024 10:00", "1/25/2024 7:30"], "M/d/yyyy H:m"), (["13/1/2024", "14/1/2024 10:00", "1/2/2024 11:00", "1/3/2024 12:00"], "d/M/yyyy H:m"),
    (["2024-01-02", "2024-01-02"], "yyyy-M-d"), (["2024-01-02T10:00:00"], "yyyy-M-d'T'H:m:s"), (["Jan 5, 2024"], "MMM d, yyyy"),
    (["5-Jan-2024"], "d-MMM-yyyy"), (["1.2.2024 03:04 PM"], "M.d.yyyy h:m a"), (["no date", None], None), ([], None)])
def test_infer_format(spark, cells, expected):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert P.infer_format(df, "c") == expected
    if expected:
        read = [r[0] for r in df.where("c LIKE '%20%'").select(P.to_timestamp(F.trim("c"), expected)).collect()]
        assert any(x is not None for x in read)
