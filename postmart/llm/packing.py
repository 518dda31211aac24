"""Best-fit packing planned on a histogram of lengths.

Documents become token pieces of at most ``capacity`` ids. How many pieces there are of each
length (at most ``capacity`` numbers) is all the planner sees: it runs best-fit decreasing
over counts and writes runs of slots, "the pieces of this length with ranks a to b go to the
sequences from s on, k to each, from this offset". Documents take their slots by joining on
rank within length. The ranks come from counts per (length, bucket) and a window inside the
bucket, so a length that many documents share is numbered by many tasks.

Defined results: a null or empty text is the single end id; a null doc_id stays null; repeated
rows are packed once each; equal lengths are ranked by bucket, doc_id and piece; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import cut, partitions
from .wordpiece import word_ids

CAPACITY = 4096
END_ID = 1
TOKEN_SLICE = 1 << 20

PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
                       T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                       T.StructField("ids_crc32", T.LongType())])
RUNS = "length long, rank_from long, rank_to long, first_sequence long, per_sequence long, first_offset long"


def split_pieces(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut documents of these lengths (each at least 1): (document, piece, start, length) of every piece."""
    many = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), many)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = piece * capacity
    return doc, piece, start, np.minimum(lengths[doc] - start, capacity)


def token_pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int):
    """For each slice of texts: (doc ids, piece, start, length, place in ids, ids with end ids)."""
    encoder = word_ids(path)
    for batch in batches:
        data, offsets = tv.strings(batch.column(1))
        for a, b in tv.slices(offsets, TOKEN_SLICE):
            ids, at = encoder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ids = np.insert(ids, at[1:], end_id)
            at = at + np.arange(len(at))
            doc, piece, start, length = split_pieces(np.diff(at), capacity)
            yield batch.column(0).slice(a, b - a).take(pa.array(doc)), piece, start, length, at[doc] + start, ids


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of (doc_id, text): doc_id, piece, start, length and the CRC-32 of the ids."""
    def run(batches):
        for doc, piece, start, length, place, ids in token_pieces(batches, path, capacity, end_id):
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * p:4 * (p + n)]) for p, n in zip(place.tolist(), length.tolist())]
            yield pa.record_batch([doc.cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=PIECES.names)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over counts; rows as in RUNS.

    Sequences with equal room are kept as ranges. A range with room r takes r // length pieces
    in each sequence, since a sequence just begun is the tightest that still fits. Each touch at
    least halves a range's room and each length adds at most four ranges, so there are no more
    than 4 * capacity * log2(capacity) runs whatever the number of documents.
    """
    room: list[int] = []                      # distinct amounts of room, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}
    runs: list[tuple[int, ...]] = []
    used = 0

    def put(r: int, first: int, many: int) -> None:
        if r > 0 and many > 0:
            if r not in ranges:
                bisect.insort(room, r)
                ranges[r] = []
            ranges[r].append((first, many))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect.bisect_left(room, length)
            if i < len(room):
                r = room[i]
                first, many = ranges[r].pop()
                if not ranges[r]:
                    del ranges[r], room[i]
            else:
                r, first, many = capacity, used, -(-left // (capacity // length))
                used += many
            each = r // length
            full = min(many, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - r))
                put(r - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < many and left:          # fewer than a whole sequence takes
                runs.append((length, rank, rank + left, first + full, left, capacity - r))
                put(r - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(r, first + full, many - full)
    return runs


def rank_within(pieces: DataFrame, key: str, order: list[str], buckets: int) -> DataFrame:
    """Add ``rank``: rows of each key numbered from 0 without a gap, by (bucket, order)."""
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = dealt.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order)) - 1
    return (dealt.withColumn("_inside", inside).join(base, [key, "_bucket"])
            .withColumn("rank", F.col("_base") + F.col("_inside")).drop("_base", "_inside", "_bucket"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of (doc_id, piece, start, length, ids_crc32) its sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = cut(pieces, "pieces")
    histogram = {r["length"]: r["n"]           # at most `capacity` rows
                 for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(histogram, capacity), RUNS)
    ranked = rank_within(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], max(64, partitions(spark)))
    step = F.col("rank") - F.col("rank_from")
    return (ranked.join(F.broadcast(plan), "length")  # its size is bounded, see plan_slots
            .where("rank >= rank_from AND rank < rank_to")
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.floor(step / F.col("per_sequence"))).alias("sequence_id"),
                    (F.col("first_offset") + step % F.col("per_sequence") * F.col("length")).alias("offset")))


def best_fit_pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack (doc_id, text) into sequences of at most ``capacity`` ids; one row per piece."""
    return pack(tokenize(docs, tokenizer_path, capacity, end_id), capacity)
