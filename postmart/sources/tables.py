"""Table storage: staging append, declared targets, run folders and publish.

Targets are Parquet folders. A load writes every table of a run into
``<base>/runs/<run_id>/<table>``, checks them, and only then appends a line to the
pointer table ``<base>/_current`` (text written through Spark, so it works on any file
system the cluster uses). Readers take the latest line, so a published run is named at
every moment. Older runs stay readable; a failed run is never visible. Staging is appended
at ``<base>/staging``, or in the folder of the full run that rebuilt it last, which is
published with that run.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import REFRESH_ORDER, STAGING_SCHEMA, TARGET_SCHEMAS


def staging_path(base: str, run_id: str | None = None) -> str:
    """Folder of staging: of the run that rebuilt it, or of a mart where no run has."""
    return run_path(base, run_id, "staging") if run_id else f"{base.rstrip('/')}/staging"


def run_path(base: str, run_id: str, name: str | None = None) -> str:
    root = f"{base.rstrip('/')}/runs/{run_id}"
    return f"{root}/{name}" if name else root


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def append(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append rows to a Parquet table (S3); ``partitions`` sets the number of files."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("append").parquet(path)


def append_staging(staged: DataFrame, base: str, batch: str | None = None, partitions: int | None = None,
                   rebuild: bool = False) -> str:
    """Add one load batch to staging; rewriting the same ``batch`` replaces only that batch.

    Staging is partitioned by ``load_batch``, so a retried batch (same name) overwrites
    its own folder and nothing else: appends are idempotent. With ``rebuild`` the batch is
    a run id and becomes a whole staging table of its own in that run's folder, which
    readers see once the run is published.
    """
    batch = batch or new_run_id()
    out = staged.select(*[f.name for f in STAGING_SCHEMA.fields]).withColumn("load_batch", F.lit(batch))
    if partitions:
        out = out.repartition(partitions)
    path = staging_path(base, batch) if rebuild else current_staging(staged.sparkSession, base)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_batch").parquet(path)
    return batch


def _staging_files_schema() -> T.StructType:
    return T.StructType(STAGING_SCHEMA.fields + [T.StructField("load_batch", T.StringType())])


def staging_exists(spark: SparkSession, base: str) -> bool:
    return exists(spark, current_staging(spark, base))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder; any other error than its absence is raised."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found))


def current_staging(spark: SparkSession, base: str) -> str:
    """The staging folder that readers see and batches are appended to."""
    line = _pointer(spark, base)
    return staging_path(base, line[2] if line and line[2] else None)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables."""
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _pointer(spark: SparkSession, base: str, name: str = "_current") -> tuple[str, str, str] | None:
    """The latest line of a pointer table: (time in nanoseconds, run, run that rebuilt staging or '')."""
    path = f"{base.rstrip('/')}/{name}"
    if not exists(spark, path):
        return None
    row = spark.read.text(path).agg(F.max("value").alias("v")).first()
    return tuple(row["v"].split("\t")) if row and row["v"] else None


def read_table(spark: SparkSession, base: str, name: str, run_id: str | None = None) -> DataFrame:
    """Read staging or a published table (S4); column pruning reaches the scan."""
    if name == "staging":
        path = staging_path(base, run_id) if run_id else current_staging(spark, base)
        return spark.read.schema(_staging_files_schema()).parquet(path) \
            .select(*[f.name for f in STAGING_SCHEMA.fields])
    rid = run_id or current_run(spark, base)
    if rid is None:
        raise FileNotFoundError(f"no published run under {base}")
    return spark.read.schema(TARGET_SCHEMAS[name]).parquet(run_path(base, rid, name))


def declare_tables(spark: SparkSession, base: str, run_id: str, reset_staging: bool = False) -> None:
    """Create every target (and optionally staging) empty, with its declared schema."""
    if reset_staging:
        empty = spark.createDataFrame([], STAGING_SCHEMA).withColumn("load_batch", F.lit("empty"))
        empty.write.mode("overwrite").partitionBy("load_batch").parquet(staging_path(base))
    for name, schema in TARGET_SCHEMAS.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(run_path(base, run_id, name))


def _declared(name: str) -> T.StructType:
    """The declared columns of a target, in order; a frame that does not have them with these types is refused.

    That no NULL stands where none may is for the checks to say.
    """
    return T.StructType([T.StructField(f.name, f.dataType) for f in TARGET_SCHEMAS[name].fields])


def write_tables(tables: dict[str, DataFrame], base: str, run_id: str,
                 run_ts: _dt.datetime | None = None) -> dict[str, str]:
    """Write each target of a run (S7) as it is declared (S5), parents first; returns name -> path.

    With ``run_ts`` every row carries ``created_at`` = that one instant (C7).
    """
    paths = {}
    for name in reversed(REFRESH_ORDER):
        if name in tables:
            path = run_path(base, run_id, name)
            out = tables[name].to(_declared(name))
            if run_ts is not None:
                out = stamp(out, run_ts)
            out.write.mode("overwrite").parquet(path)
            paths[name] = path
    return paths


def publish(spark: SparkSession, base: str, run_id: str, rebuilt_staging: bool = False, name: str = "_current") -> None:
    """Point readers at ``run_id`` (S6): a line is added, the previous run stays on disk, untouched."""
    old = _pointer(spark, base, name)
    staging = run_id if rebuilt_staging else (old[2] if old else "")
    line = f"{time.time_ns():020d}\t{run_id}\t{staging}"
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{base.rstrip('/')}/{name}")


def current_run(spark: SparkSession, base: str) -> str | None:
    line = _pointer(spark, base)
    return line[1] if line else None


def stamp(df: DataFrame, run_ts: _dt.datetime, col: str = "created_at") -> DataFrame:
    """One load timestamp per run (C7): a literal, identical on every row and task."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp"))


def star_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the star schema that was published last."""
    line = _pointer(spark, base, "_star_current")
    if line is None:
        raise FileNotFoundError(f"no published star schema under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/star/{line[1]}/{name}")
