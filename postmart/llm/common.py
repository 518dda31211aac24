"""Shared pieces of the pipeline operators: tables, written intermediates, hot keys, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmart.session import fresh_dir

#: At most this many keys can each hold more than 1/HOT_SHARE of all rows: the size bound of every broadcast of hot keys.
HOT_SHARE = 1000


#: Rows of an Arrow batch between the JVM and Python: texts are long, and both sides hold whole batches.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session pass at most BATCH_ROWS rows at once, unless it is set to fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts or pages, to be read in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: ends the lineage, so that lost executors cost a reread only."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def spread_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Hot keys of a table of (key, n): (key, _salts), at most HOT_SHARE rows whatever the data.

    A key is hot when it holds more than 1/HOT_SHARE of all rows; it gets one salt for each
    such share, so no salted key holds more than that.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    share = max(total // HOT_SHARE, 256)
    return (counts.where(F.col(n) > share)
            .select(key, (F.ceil(F.col(n) / share)).cast("int").alias("_salts")))


def join_spread(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, salt_by: list[str],
                how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` with ``right`` unique by it; rows of hot keys are dealt over salts."""
    hot = F.broadcast(hot)  # at most HOT_SHARE rows, see spread_keys
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*salt_by), F.col("_salts"))).cast("int")
    a = left.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    b = (right.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
         .drop("_salts"))
    return a.join(b, [key, "_salt"], how).drop("_salt")


def id_bitmap(ids: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """A bitmap of 2**bits bits of a column of 64-bit hashes, gathered as at most 2**(bits - 6) words: its size is fixed."""
    found = (ids.select(F.shiftrightunsigned(column, 64 - bits).alias("at"))
             .selectExpr("at div 64 AS word", "shiftleft(1L, CAST(at % 64 AS INT)) AS bit")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be among those of the bitmap: all that are, and few others while it is sparse.

    It saves shuffling rows that a join would drop; a full bitmap lets all rows pass.
    """
    at = hashes.view(np.uint64) >> np.uint64(64 - (len(bitmap).bit_length() - 1 + 6))
    word = bitmap[(at >> np.uint64(6)).astype(np.int64)].view(np.uint64)
    return (word >> (at & np.uint64(63))) & np.uint64(1) > 0


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected (a, b): one (node, component) row per node, component the smallest node.

    Alternating large-star and small-star steps, each a grouped minimum and a join; every
    round is written to the shared folder. Stars settle in two rounds, chains in a number of
    rounds that is logarithmic in their length.
    """
    spark = edges.sparkSession
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .distinct(), "components")
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = cut(small, "components")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


__all__ = ["table", "cut", "is_empty", "partitions", "spread_keys", "join_spread", "id_bitmap", "in_bitmap", "components", "SparkSession"]
