"""Incremental staging feed: new CSV files in a landing folder -> staging batches.

The batch ingest (``run_ingest_only``) re-expressed on Structured Streaming, for
landing folders that keep receiving files. Each micro-batch runs the same parse and
coercion and is written as its own ``load_batch`` partition named after the batch id,
so a retried batch overwrites exactly its own output (exactly-once together with the
stream's checkpoint). Ids continue after the rows staged by other batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import PANDAS_NA_TOKENS, RAW_COLUMNS, SEMI_STRUCTURED
from ..session import shared_dir
from ..sources import ingest as I
from ..sources import tables as TB


def _next_id(spark: SparkSession, base: str, batch: str) -> int:
    if not TB.staging_exists(spark, base):
        return 1
    others = spark.read.schema(TB._staging_files_schema()).parquet(TB.current_staging(spark, base)) \
        .where(F.col("load_batch") != batch)
    row = others.agg(F.max("id").alias("m")).first()
    return (int(row["m"]) if row and row["m"] is not None else 0) + 1


def staging_feed(spark: SparkSession, landing: str, base: str, checkpoint: str | None = None,
                 files_per_batch: int = 10, available_now: bool = True, multiline: bool = False) -> StreamingQuery:
    """Start the feed; with ``available_now`` it processes what is there and stops.

    Files must have the posting columns as their header, in order; another header stops the feed.
    """
    stream = (I.csv_reader(spark.readStream, RAW_COLUMNS, multiline)
              .option("maxFilesPerTrigger", files_per_batch).csv(landing))
    plain = [c for c in RAW_COLUMNS if c not in SEMI_STRUCTURED]
    cleaned = stream.withColumns({c: F.when(F.col(c).isin(PANDAS_NA_TOKENS), None).otherwise(F.col(c))
                                  for c in plain}).withColumns({
        "_src_file": F.col("_metadata.file_path"), "_src_block": F.col("_metadata.file_block_start")})

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        name = f"stream-{batch_id:012d}"
        # Positions are taken where the files are read and written once, so that both passes of
        # the id assignment (split sizes, then ranks) see the same ones.
        staged_in = f"{base.rstrip('/')}/_feed/{name}"
        batch_df.withColumn("_src_pos", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged_in)
        batch = batch_df.sparkSession.read.parquet(staged_in)
        start = _next_id(batch_df.sparkSession, base, name)
        I.parse_cells(I.arrival_ids(batch, "id", start)).write.mode("overwrite").parquet(f"{staged_in}-parsed")
        raw = I.mend_unread(batch_df.sparkSession.read.parquet(f"{staged_in}-parsed"))
        TB.append_staging(I.stage(raw), base, batch=name)
        for done in (staged_in, f"{staged_in}-parsed"):
            TB.remove(batch_df.sparkSession, done)

    writer = (cleaned.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or shared_dir(spark, "feed-checkpoints", "staging")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
