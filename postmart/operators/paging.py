"""Ordering, paging and heads.

A load never pages: each table is one distributed write. ``page`` and ``head_n`` are
for readers. Their order is total: columns named by the caller first, then all others, so rows
that are equal by the named columns have the same places whichever page is asked for. Near the
front Spark plans ORDER BY + OFFSET + LIMIT as a per-task top-(offset+limit) and one small
merge; a page farther out is cut by position from the range-partitioned order, so no task
ever sorts all rows before it. Who reads page after page builds an ``OrderIndex``: the rows
are sorted once, and each page reads only the ranges that it touches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir
from .keys import dense_key


def order_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Global ascending order, NULLs first (a range-partitioned sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])


def positions(df: DataFrame, cols: Sequence[str], out: str = "position") -> DataFrame:
    """The place of each row in the order, from 1, without a global window."""
    return dense_key(df, list(cols), out)


def total_order(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """``cols``, then every other column, NULLs first: rows equal in all of them are interchangeable.

    Maps and variants have no order of their own; their JSON text stands for them.
    """
    def sortable(c):
        bare = isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))
        return (F.to_json(c) if bare else F.col(c)).asc_nulls_first()
    return [sortable(c) for c in [*cols, *(c for c in df.columns if c not in cols)]]


#: Rows up to which a page is taken by a top-k; the order is the same on either side.
NEAR_FRONT = 100_000


def page(df: DataFrame, order_cols: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset+1 .. offset+limit of the totally ordered frame."""
    order = total_order(df, order_cols)
    if offset + limit > NEAR_FRONT:
        at = dense_key(df, order, "_position")
        return at.where((F.col("_position") > offset) & (F.col("_position") <= offset + limit)).drop("_position")
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def head_n(df: DataFrame, order_cols: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by the total order."""
    return df.orderBy(*total_order(df, order_cols)).limit(n)


_RANGE, _PLACE = "_range", "_place"


@dataclass
class OrderIndex:
    """A table sorted once into ranges, a folder each, with the number of rows before each range beside it.

    ``rows`` lie under ``path``/rows by range and place within it; ``path``/ranges has a row for
    each range (as many as shuffle partitions), the only thing a page brings to the driver.
    """

    spark: SparkSession
    path: str
    schema: T.StructType | None = None      # of the rows as written; without it their files tell it

    @classmethod
    def build(cls, df: DataFrame, order_cols: Sequence[str], path: str | None = None, ranges: int | None = None) -> "OrderIndex":
        """Sort ``df`` by the total order into ``ranges`` (default: shuffle partitions) and write it."""
        spark = df.sparkSession
        path = path or fresh_dir(spark, "order-index")
        order = total_order(df, order_cols)
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        pid = F.spark_partition_id()
        (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn(_RANGE, pid).withColumn(_PLACE, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
         .write.partitionBy(_RANGE).parquet(f"{path}/rows"))
        schema = T.StructType([*df.schema, T.StructField(_PLACE, T.LongType()), T.StructField(_RANGE, T.IntegerType())])
        counts = spark.read.schema(schema).parquet(f"{path}/rows").groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))  # a row per range
        counts.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/ranges")
        return cls(spark, path, schema)

    def count(self) -> int:
        return self.spark.read.parquet(f"{self.path}/ranges").agg(F.sum("n")).first()[0] or 0

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """Rows offset+1 .. offset+limit, in any order of rows; only the ranges that hold them are read."""
        ranges = self.spark.read.parquet(f"{self.path}/ranges").where(
            (F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).collect()
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        rows = reader.parquet(f"{self.path}/rows")
        inside = F.lit(False)
        for r in ranges:
            inside = inside | ((F.col(_RANGE) == r[_RANGE]) & (F.col(_PLACE) >= offset - r["before"])
                               & (F.col(_PLACE) < offset + limit - r["before"]))
        return rows.where(inside).drop(_RANGE, _PLACE)
