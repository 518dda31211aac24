"""Surrogate keys (D9) and insert-if-absent.

``dense_key`` numbers rows 1..n by a global order without funnelling the data through
one task (a global ``row_number()`` window does that). Rows are range-partitioned and
sorted on the order columns; in that same stage each row is tagged with its partition
index and its position inside the partition, and the tagged rows are written once as a
Parquet table in the shared scratch folder (``spark.checkpoint.dir``). The written
table cuts the lineage: whatever is retried or re-read later sees the same tags.
Partition sizes come from a scan of the tag column, their running offsets - one small
row per partition, a bounded broadcast - are added to the positions.

``number_written`` gives the same numbers to a table that already stands on disk in runs of
ascending rows, as a load in arrival order writes it, without moving the rows: a row's place is
its file and its index in the file, which no retry or other split of the files changes. A file may
hold several ascending runs, in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_dir

_PID = "__pm_pid"
_POS = "__pm_pos"
_OFF = "__pm_off"


def _order_exprs(order_cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]


def dense_key(df: DataFrame, order_cols: Sequence[str | Column], out: str, start: int = 1,
              partitions: int | None = None) -> DataFrame:
    """Add ``out`` = start, start+1, ... following ``order_cols`` (ascending, NULLs first).

    The order columns must identify rows uniquely; otherwise ties are numbered in an
    unspecified order. The range shuffle uses ``partitions`` or else
    ``spark.sql.shuffle.partitions`` (AQE may merge small neighbours, which keeps the
    order).
    """
    spark = df.sparkSession
    order = _order_exprs(order_cols)
    ranged = (df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)) \
        .sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    # monotonically_increasing_id = (partition index << 33) + position in the partition.
    tagged = ranged.withColumn(_PID, pid).withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    path = fresh_dir(spark, "keys")
    tagged.write.parquet(path)
    tagged = spark.read.parquet(path)
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__pm_n"))
    # One row per partition: a window without partitioning over n rows is cheap.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("__pm_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    keyed = tagged.join(F.broadcast(offsets), _PID, "inner")
    return keyed.withColumn(out, (F.col(_OFF) + F.col(_POS) + F.lit(start)).cast("long")).drop(_PID, _POS, _OFF)


#: Runs of ascending rows up to which their offsets (about 48 bytes each) are broadcast.
MOST_RUNS = 200_000
#: Rows of a file among which one task looks for runs.
CHUNK_ROWS = 1 << 20
_FILE, _ROW, _CHUNK = "__pm_file", "__pm_row", "__pm_chunk"


def _runs(placed: DataFrame, order_col: str) -> DataFrame:
    """Maximal runs of ascending ``order_col`` in each chunk of a file: first row, rows, smallest and largest value."""
    by = Window.partitionBy(_FILE, _CHUNK).orderBy(_ROW)
    begins = F.coalesce(F.lag(order_col).over(by) >= F.col(order_col), F.lit(True)).cast("long")
    return (placed.select(_FILE, _CHUNK, _ROW, order_col).withColumn("_begins", begins)
            .withColumn("_run", F.sum("_begins").over(by)).groupBy(_FILE, _CHUNK, "_run")
            .agg(F.min(_ROW).alias("_first"), F.count(F.lit(1)).alias("_n"),
                 F.min(order_col).alias("_low"), F.max(order_col).alias("_high")))


def _ranked_runs(placed: DataFrame, order_col: str) -> DataFrame:
    """Offsets of the maximal runs of rows that follow each other both in a file's chunk and in the global order.

    For files that hold several ascending stretches, whose runs by ``_runs`` overlap: values and
    places alone are sorted, ties by place.
    """
    ranked = dense_key(placed.select(order_col, _FILE, _CHUNK, _ROW), [order_col, _FILE, _ROW], "_rank", 0)
    by = Window.partitionBy(_FILE, _CHUNK).orderBy(_ROW)
    begins = F.coalesce(F.lag("_rank").over(by) + 1 != F.col("_rank"), F.lit(True)).cast("long")
    return (ranked.select(_FILE, _CHUNK, _ROW, "_rank").withColumn("_begins", begins)
            .withColumn("_run", F.sum("_begins").over(by)).groupBy(_FILE, _CHUNK, "_run")
            .agg(F.min(_ROW).alias("_first"), F.count(F.lit(1)).alias("_n"), F.min("_rank").alias(_OFF)))


def _kept_runs(runs: DataFrame) -> DataFrame:
    path = fresh_dir(runs.sparkSession, "runs")
    runs.write.parquet(path)
    return runs.sparkSession.read.parquet(path)


def number_written(written: DataFrame, order_col: str, out: str, start: int = 1) -> DataFrame:
    """Add ``out`` = start, start+1, ... following ``order_col`` to a Parquet table as it was read.

    Only ``order_col`` and the rows' places (file and ``_metadata.row_index``) are shuffled, to
    find the runs of ascending rows in each file. The runs' offsets, counted to be few, are
    broadcast, and each row adds its distance from the start of its run. Where runs overlap, as in
    files that a task wrote from several, they are cut by a sort of values and places. A table
    of too many runs is numbered by ``dense_key``: the same numbers, by a sort of its rows.
    """
    spark = written.sparkSession
    placed = written.select("*", F.xxhash64("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW)) \
        .withColumn(_CHUNK, F.expr(f"{_ROW} div {CHUNK_ROWS}"))
    files = written.select(F.col("_metadata.file_path").alias("path")).distinct().agg(
        F.count("path").alias("paths"), F.count_distinct(F.xxhash64("path")).alias("hashes")).first()
    if files["paths"] != files["hashes"]:
        return dense_key(written, [order_col], out, start)
    runs = _kept_runs(_runs(placed, order_col))
    if runs.count() > MOST_RUNS:
        return dense_key(written, [order_col], out, start)
    earlier = Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)  # over MOST_RUNS rows at most
    ordered = runs.select(_FILE, _CHUNK, "_first", "_n", "_low", F.max("_high").over(earlier).alias("_before"),
                          F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_OFF))
    if ordered.where("_before >= _low").limit(1).count():
        ordered = _kept_runs(_ranked_runs(placed, order_col))
        if ordered.count() > MOST_RUNS:
            return dense_key(written, [order_col], out, start)
    offsets = ordered.select(F.col(_FILE).alias("_f"), F.col(_CHUNK).alias("_c"), "_first", "_n", _OFF)
    inside = ((F.col(_FILE) == F.col("_f")) & (F.col(_CHUNK) == F.col("_c")) & (F.col(_ROW) >= F.col("_first"))
              & (F.col(_ROW) < F.col("_first") + F.col("_n")))
    return (placed.join(F.broadcast(offsets), inside, "inner")
            .withColumn(out, (F.col(_OFF) + F.col(_ROW) - F.col("_first") + F.lit(start)).cast("long"))
            .drop(_FILE, _ROW, _CHUNK, "_f", "_c", "_first", "_n", _OFF))


def max_key(df: DataFrame, key: str) -> int:
    """Largest key in ``df`` (0 when empty): one scalar through the driver."""
    row = df.agg(F.max(key).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def insert_if_absent(existing: DataFrame, new: DataFrame, natural_key: Sequence[str], key: str,
                     nulls_distinct: bool = True, order_cols: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... SELECT DISTINCT ... ON CONFLICT (natural_key) DO NOTHING`` as a frame.

    Existing rows stay as they are; new rows whose natural key already exists are
    skipped; the rest get keys after the current largest. With ``nulls_distinct`` (the
    SQL default) a key with a NULL part never conflicts, so such rows are always added
    (exact duplicates among them are still removed, as DISTINCT does).
    """
    natural_key = list(natural_key)
    cols = [c for c in existing.columns if c != key]
    others = [c for c in cols if c not in natural_key]
    incoming = new.select(*cols).distinct()
    has_null = F.lit(False)
    for c in natural_key:
        has_null = has_null | F.col(c).isNull()
    if nulls_distinct:
        # Rows with a NULL key part never conflict: they bypass the per-key pick.
        complete = incoming.where(~has_null)
        if others:
            complete = complete.groupBy(*natural_key).agg(*[F.min(c).alias(c) for c in others])
        incoming = complete.unionByName(incoming.where(has_null))
    elif others:
        incoming = incoming.groupBy(*natural_key).agg(*[F.min(c).alias(c) for c in others])
    n, e = incoming.alias("n"), existing.select(*natural_key).alias("e")
    same = [(F.col(f"n.{c}") == F.col(f"e.{c}")) if nulls_distinct else F.col(f"n.{c}").eqNullSafe(F.col(f"e.{c}"))
            for c in natural_key]
    fresh = n.join(e, same, "left_anti")
    start = max_key(existing, key) + 1
    keyed = dense_key(fresh, order_cols or cols, key, start=start)
    return existing.unionByName(keyed.select(key, *cols))


def carry_keys(built: DataFrame, known: DataFrame | None, natural_key: Sequence[str], key: str) -> DataFrame:
    """A rebuilt dimension with the keys its members had before; new members get the next ones.

    ``built`` has one row per natural key and a key of its own (its order is the order of the new
    keys); ``known`` holds every (natural key, key) given so far, members that are gone included,
    so that no key ever names two members. NULL parts of a natural key are equal here. Both are
    hashed on the natural key once; only new members are sorted.
    """
    if known is None:
        return built
    natural_key = list(natural_key)
    others = [c for c in built.columns if c not in (*natural_key, key)]
    k = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural_key], F.col(key).alias("_known"))
    same = F.lit(True)
    for c in natural_key:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    path = fresh_dir(built.sparkSession, "carried")
    built.join(k, same, "left").select(*natural_key, *others, F.col(key).alias("_built"), "_known").write.parquet(path)
    placed = built.sparkSession.read.parquet(path)
    old = placed.where("_known IS NOT NULL").select(F.col("_known").alias(key), *natural_key, *others)
    new = dense_key(placed.where("_known IS NULL").drop("_known"), ["_built"], key, start=max_key(known, key) + 1)
    return old.unionByName(new.drop("_built")).select(*built.columns)
