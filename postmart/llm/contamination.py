"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits of any script without case. Windows of ``seed`` words that a document
shares with an item are the seeds: a bitmap of fixed size, gathered from the items' windows,
lets a document's other windows go before anything is shuffled; what passes is joined to the
items' windows exactly. A (document, item) pair whose shared windows, each counted at all its places in
the item, could reach the threshold is tiled: Karp-Rabin window hashes give all common strings of at least ``seed`` words, the
longest unmarked one is marked on both sides, again and again. The share of an item's words
that is marked is its coverage, whatever the order of the passages in the document.

Defined results: null, empty or shorter texts and items (fewer than ``seed`` words) never match;
each row of documents is judged alone, so repeated rows give repeated results; items with equal
ids are separate items; among equally long matches the first in the item, then in the document,
is marked; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import cut

SEED = 5
THRESHOLD = 0.5
BITMAP_BITS = 24  # 2 MiB, whatever the benchmark's size
MOST_PAIRS = 1 << 20  # window pairs looked at together when two texts are tiled

HITS = "doc_id long, words binary, seeds array<long>"
RESULT = ("row long, item_id long, coverage double, matched_words long, item_words long, n_tiles long, "
          "longest_tile long")


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes both of whose bits, its first and its next BITMAP_BITS bits, are set."""
    out = np.ones(len(hashes), bool)
    for shift in (64 - BITMAP_BITS, 64 - 2 * BITMAP_BITS):
        bit = (hashes >> np.uint64(shift)).astype(np.int64) & ((1 << BITMAP_BITS) - 1)
        out &= (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
    return out


def _rows(batches, seed: int, bitmap: np.ndarray | None):
    """Rows of HITS for (id, text): of all texts with a window, or of those with a window in the bitmap.

    With a bitmap the seeds are distinct, without they are there once for each place.
    """
    for batch in batches:
        data, offsets = tv.strings(batch.column(1))
        for a, b in tv.slices(offsets):
            words, at = tv.word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            hashes, _, first = tv.windows(words, at, seed)
            hit = np.ones(len(hashes), bool) if bitmap is None else _marked(bitmap, hashes)
            rows = np.flatnonzero(tv.sums(hit, first))
            if len(rows):
                own = [hashes[first[i]:first[i + 1]][hit[first[i]:first[i + 1]]] for i in rows]
                seeds = [(h if bitmap is None else np.unique(h)).view(np.int64) for h in own]
                yield pa.record_batch([
                    batch.column(0).take(pa.array(a + rows)).cast(pa.int64()),
                    pa.array([words[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary()),
                    pa.array(seeds, pa.list_(pa.int64()))], names=["doc_id", "words", "seeds"])


def common_strings(doc: np.ndarray, item: np.ndarray, seed: int, most: int = MOST_PAIRS) -> list[tuple[int, int, int]]:
    """Maximal common strings of at least ``seed`` words: (length, place in item, place in document).

    Pairs of equal windows are looked at about ``most`` at a time; of those only the first and the
    last of each string stay, so texts that say one thing all over need no room for all pairs.
    """
    whole = np.array([0, len(doc)]), np.array([0, len(item)])
    of_doc, of_item = (tv.windows(w, at, seed)[0] for w, at in zip((doc, item), whole))
    order = np.argsort(of_item, kind="stable")
    left = np.searchsorted(of_item[order], of_doc, side="left")
    many = np.searchsorted(of_item[order], of_doc, side="right") - left
    where = np.flatnonzero(many)
    if not len(where):
        return []
    many = many[where]
    slices = np.flatnonzero(np.diff((np.cumsum(many) - 1) // most)) + 1
    begins, ends = [], []
    for some, count in zip(np.split(where, slices), np.split(many, slices)):
        i = np.repeat(some, count)
        j = order[np.repeat(left[some], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        begin = (i == 0) | (j == 0) | (of_doc[i - 1] != of_item[j - 1])
        end = np.ones(len(i), bool)
        inside = np.flatnonzero((i < len(of_doc) - 1) & (j < len(of_item) - 1))
        end[inside] = of_doc[i[inside] + 1] != of_item[j[inside] + 1]
        begins.append((i[begin], j[begin]))
        ends.append((i[end], j[end]))
    (i, j), (last, at) = ([np.concatenate(c) for c in zip(*x)] for x in (begins, ends))
    by, to = np.lexsort((i, i - j)), np.lexsort((last, last - at))  # along diagonals, where begins and ends alternate
    return list(zip((last[to] - i[by] + seed).tolist(), j[by].tolist(), i[by].tolist()))


def tile(doc: np.ndarray, item: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two arrays of word hashes: the tiles as (length, place in item, place in document)."""
    heap = [(-n, j, i) for n, j, i in common_strings(doc, item, seed)]
    heapq.heapify(heap)
    in_doc, in_item, tiles = np.zeros(len(doc), bool), np.zeros(len(item), bool), []
    while heap:
        n, j, i = heapq.heappop(heap)
        n = -n
        taken = in_doc[i:i + n] | in_item[j:j + n]
        if taken.any():                             # what is left of it competes again
            free = np.flatnonzero(np.diff(np.concatenate(([False], ~taken, [False])).astype(np.int8)))
            for a, b in zip(free[::2].tolist(), free[1::2].tolist()):
                if b - a >= seed:
                    heapq.heappush(heap, (a - b, j + a, i + a))
            continue
        in_doc[i:i + n] = in_item[j:j + n] = True
        tiles.append((n, j, i))
    return tiles


def _tag(docs: DataFrame, keep: list[str], seed: int, bitmap, with_text: bool) -> DataFrame:
    """doc (a struct of the columns to keep), text (if asked for), words, seeds (null without any in the bitmap) and row."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            at = pa.array(np.arange(len(batch)))
            words: list[bytes | None] = [None] * len(batch)
            seeds: list[np.ndarray | None] = [None] * len(batch)
            for hit in _rows([pa.record_batch([at, batch.column(1)], names=["doc_id", "text"])], seed, bitmap.value):
                for k, w, s in zip(*(c.to_pylist() for c in hit.columns)):
                    words[k], seeds[k] = w, s
            found = [pa.array(words, pa.binary()), pa.array(seeds, pa.list_(pa.int64()))]
            if with_text:
                yield pa.record_batch([batch.column(0), batch.column(1), *found], names=schema.names)
            else:
                full = found[0].is_valid()
                yield pa.record_batch([c.filter(full) for c in (batch.column(0), *found)], names=schema.names)
    schema = rows.select("doc", *["text"][:with_text], F.lit(None).cast("binary").alias("words"),
                         F.lit(None).cast("array<long>").alias("seeds")).schema
    return cut(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "tagged")


def judge(docs: DataFrame, items: DataFrame, keep: list[str], seed: int, threshold: float,
          with_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(tagged rows of documents, RESULT rows with the number of the document's row)."""
    spark = docs.sparkSession
    item_rows = cut(items.select(F.col("item_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
                    .mapInArrow(lambda batches: _rows(batches, seed, None), HITS)
                    .withColumn("item", F.monotonically_increasing_id()), "items")
    windows = (item_rows.select("item", (F.octet_length("words") / 8).cast("long").alias("item_words"),
                                F.explode("seeds").alias("seed"))
               .groupBy("item", "item_words", "seed").agg(F.count("*").alias("places")))
    bits = [F.shiftrightunsigned("seed", s).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
            for s in (64 - BITMAP_BITS, 64 - 2 * BITMAP_BITS)]
    found = (windows.select(F.explode(F.array(*bits)).alias("at"))
             .selectExpr("at div 8 AS byte", "shiftleft(1, CAST(at % 8 AS INT)) AS bit").groupBy("byte")
             .agg(F.bit_or("bit").alias("bits")).toPandas())  # at most 2**(BITMAP_BITS - 3) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    bitmap[found["byte"].to_numpy(np.int64)] = found["bits"].to_numpy(np.uint8)
    tagged = _tag(docs, keep, seed, spark.sparkContext.broadcast(bitmap), with_text)
    hits = tagged.where("words IS NOT NULL")
    # A tile of n words holds n - seed + 1 windows, so c places of shared windows in the item cover at most c * seed words.
    pairs = (hits.select("row", F.explode("seeds").alias("seed")).join(windows, "seed")
             .groupBy("row", "item").agg(F.sum("places").alias("n"), F.first("item_words").alias("item_words"))
             .where(F.col("n") * seed >= F.col("item_words") * threshold).select("row", "item"))

    def run(batches):
        for batch in batches:
            out = []
            for row, words, item_id, item in zip(*(c.to_pylist() for c in batch.columns)):
                item = np.frombuffer(item, np.uint64)
                tiles = tile(np.frombuffer(words, np.uint64), item, seed)
                marked = sum(n for n, _, _ in tiles)
                if marked >= threshold * len(item):
                    out.append((row, item_id, marked / len(item), marked, len(item), len(tiles),
                                max((n for n, _, _ in tiles), default=0)))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.record_batch([pa.array(c, pa.float64() if k == 2 else pa.int64()) for k, c in enumerate(columns)],
                                  names=[c.split()[0] for c in RESULT.split(", ")])
    of_item = item_rows.select("item", F.col("doc_id").alias("item_id"), F.col("words").alias("item_text"))
    return tagged, (pairs.join(hits.select("row", "words"), "row").join(of_item, "item")
                    .select("row", "words", "item_id", "item_text").mapInArrow(run, RESULT))


def contaminated(docs: DataFrame, items: DataFrame, seed: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (row of documents, item) whose tiles cover at least ``threshold`` of the item's words."""
    tagged, found = judge(docs, items, ["doc_id"], seed, threshold)
    return (found.join(tagged.select("row", F.col("doc.doc_id").cast("long").alias("doc_id")), "row")
            .select("doc_id", *(c.split()[0] for c in RESULT.split(", ")[1:])))


def drop_contaminated(docs: DataFrame, items: DataFrame, seed: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents, with all columns, that cover no item."""
    tagged, found = judge(docs, items, [c for c in docs.columns if c != "text"], seed, threshold, with_text=True)
    bad = cut(found.select("row").distinct(), "contaminated")
    columns = [F.col("text").cast(docs.schema[c].dataType).alias(c) if c == "text" else F.col("doc")[c].alias(c)
               for c in docs.columns]
    # Only rows with shared windows take part in the join.
    return (tagged.where("words IS NULL").select(*columns)
            .unionByName(tagged.where("words IS NOT NULL").join(bad, "row", "left_anti").select(*columns)))
