"""Hard-negative mining by exact integer scores, several candidates to a multiplication.

Vectors become integers, floor(256 * x) for each component. To score a block of candidates
against a block of anchors, the components of several candidates are biased to be non-negative
and put into separated fields of one wide integer; one multiplication for each component of an
anchor then scores all of them, and the exact scores are cut out of the sum again
(Kronecker substitution). The wide integers are held by doubles while they stay below 2**53,
where a double is an exact integer, so that the products run in the linear algebra library;
blocks whose scores are wider than that are packed into Python's integers instead. How many
candidates fit is worked out for each block from its own largest components.

Anchors and candidates are dealt over a grid by hashes of their ids: every cell holds at most
about ANCHOR_BLOCK anchors and CANDIDATE_BLOCK candidates, so neither a hot label nor a hot
vector makes a large group. A first pass scores rows of the same label and keeps the best
positives of each cell, a second scores the others between the bounds that the positives set
and keeps the best of each cell for each positive. Only those few rows of a cell are shuffled
for the final choice. Every anchor meets every candidate: nothing is sampled or left out.

Defined results: rows with a null vec_id, label or vector, or with a null or non-finite
component take no part. A row is known by its vec_id: of several rows with one vec_id the one
with the smallest label and then vector counts, once. Shorter vectors count as followed by
zeros. Equal scores are ordered by vec_id. A score of more than 38 digits counts as the largest
(or smallest) number of 38 digits; one beyond 64 bits is ranked as it is and reported as null. An anchor without positives, and a positive without negatives, give no row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SCALE = 256
#: Rows of a cell on either side: a candidate is shuffled once for every ANCHOR_BLOCK anchors.
ANCHOR_BLOCK, CANDIDATE_BLOCK = 4096, 8192
#: Scores at once in a task.
CELL_PIECE = 1 << 20
EXACT_BITS = 53
MOST = 10 ** 38 - 1

POSITIVES = "anchor_id long, positive_id long, score decimal(38,0)"
NEGATIVES = "anchor_id long, positive_id long, positive_score decimal(38,0), negative_id long, negative_score decimal(38,0)"


def clean(rows: DataFrame, label: Column | None = None, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one for each vec_id; vectors of floats stay floats."""
    element = rows.schema[vector].dataType.elementType.simpleString()
    kind = element if element in ("float", "double") else "double"
    fine = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is not below infinity
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                        (F.col("label") if label is None else label).cast("long").alias("label"),
                        F.col(vector).cast(f"array<{kind}>").alias("vector"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(fine)
            .groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
            .select("vec_id", "row.label", "row.vector"))


def integers(lists: pa.ListArray) -> np.ndarray:
    """floor(256 * x) of every component, one row a vector: doubles where they are exact, else Python's integers."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    wide = int(size.max(initial=0))
    at = np.arange(wide) < size[:, None]
    out = np.zeros((len(size), wide))
    out[at] = flat
    if not out.size or np.abs(out).max() * SCALE < 2.0 ** EXACT_BITS:
        return np.floor(out * SCALE)
    exact = [int(x) * SCALE if abs(x) >= 2.0 ** EXACT_BITS else int(np.floor(x * SCALE)) for x in out.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(out.shape)


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products of integer rows, exactly: (anchors, candidates) as 64-bit or Python integers."""
    wide = max(anchors.shape[1], candidates.shape[1])
    anchors, candidates = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) if x.shape[1] < wide else x
                           for x in (anchors, candidates))
    n = len(candidates)
    if not n or not len(anchors) or not wide:
        return np.zeros((len(anchors), n), np.int64)
    bias = int(np.abs(candidates).max())
    # No field of the sum is larger than this; all are signed, so each takes one bit more.
    most = max(int(sum(abs(int(x)) for x in row)) for row in _largest(anchors)) * 2 * bias
    width = most.bit_length() + 1
    fields = max(EXACT_BITS // width, 1)
    native = width * fields <= EXACT_BITS and anchors.dtype != object and candidates.dtype != object
    if not native:
        fields, anchors, candidates = 4, _objects(anchors), _objects(candidates)
    packed = np.zeros((-(-n // fields), wide), dtype=anchors.dtype)
    for f in range(fields):
        part = candidates[f::fields] + bias
        packed[:len(part)] += part * (2 ** (width * f))
    total = anchors @ packed.T
    total = total.astype(np.int64) if native else total
    offset = (anchors.sum(axis=1) * bias)[:, None]
    offset = offset.astype(np.int64) if native else offset
    out = np.empty((len(anchors), n), total.dtype)
    half, full = 1 << (width - 1), 1 << width
    for f in range(fields):
        field = (total + half) % full - half       # the signed field at the bottom
        total = (total - field) // full
        part = out[:, f::fields]
        part[...] = (field - offset)[:, :part.shape[1]]
    return out if native else np.minimum(np.maximum(out, -MOST), MOST)


def _largest(anchors: np.ndarray) -> np.ndarray:
    """The anchor with the largest sum of sizes: it bounds every field."""
    return anchors[[int(np.argmax(np.abs(anchors).sum(axis=1)))]]


def _objects(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([int(v) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The rows of each group's first k by descending score and ascending id, in that order."""
    if not len(group):
        return np.zeros(0, np.int64)
    order = np.argsort(ids, kind="stable")
    down = -score[order]
    order = order[np.argsort(down, kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    g = group[order]
    begin = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    rank = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return order[rank < k]


def _decimals(x: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in x.tolist()], pa.decimal128(38, 0))


def _cell_positives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The best k candidates of an anchor's own label in one cell."""
    a_id, a_label, a = _columns(anchors)
    c_id, c_label, c = _columns(candidates)
    found = []
    for label in np.intersect1d(a_label, c_label).tolist():
        rows, cols = np.flatnonzero(a_label == label), np.flatnonzero(c_label == label)
        step = max(CELL_PIECE // len(cols), 1)
        for r in (rows[i:i + step] for i in range(0, len(rows), step)):
            s = scores(a[r], c[cols])
            at, to = np.nonzero(a_id[r][:, None] != c_id[cols][None, :])
            s = s[at, to]
            take = best(at, s, c_id[cols][to], k)
            found.append((a_id[r][at[take]], c_id[cols][to[take]], s[take]))
    ids, others, s = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return pa.table([pa.array(ids, pa.int64()), pa.array(others, pa.int64()), _decimals(s)],
                    names=["anchor_id", "positive_id", "score"])


def _cell_negatives(anchors: pa.Table, candidates: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """For each (anchor, positive) the best k candidates of other labels within the bounds, in one cell."""
    a_id, a_label, a = _columns(anchors)
    c_id, c_label, c = _columns(candidates)
    positive, p_score = anchors["positive_id"].to_pylist(), anchors["positive_score"].to_pylist()
    found: list[tuple] = []
    step = max(CELL_PIECE // max(len(c_id), 1), 1)
    for i in range(0, len(a_id), step):
        s = scores(a[i:i + step], c)
        other = a_label[i:i + step, None] != c_label[None, :]
        pairs = [(r, int(p), int(q)) for r in range(s.shape[0]) for p, q in zip(positive[i + r], p_score[i + r])]
        if not pairs:
            continue
        # low * positive <= 100 * negative <= high * positive, as whole numbers
        least = [-(-low * q // 100) for _, _, q in pairs]
        most = [high * q // 100 for _, _, q in pairs]
        row = np.array([r for r, _, _ in pairs])
        kind = s.dtype if s.dtype == object else np.float64
        below = np.full(s.shape[0], np.inf, dtype=kind)
        above = np.full(s.shape[0], -np.inf, dtype=kind)
        np.minimum.at(below, row, np.array(least, dtype=kind))
        np.maximum.at(above, row, np.array(most, dtype=kind))
        # Only scores within some positive's bounds are looked at again.
        at, to = np.nonzero(other & (s >= below[:, None]) & (s <= above[:, None]))
        s, first = s[at, to], np.searchsorted(at, np.arange(step + 1))
        for (r, p, q), lo, hi in zip(pairs, least, most):
            mine = slice(first[r], first[r + 1])
            fit = np.flatnonzero((s[mine] >= lo) & (s[mine] <= hi)) + first[r]
            take = fit[best(np.zeros(len(fit), np.int64), s[fit], c_id[to[fit]], k)]
            found.extend((int(a_id[i + r]), p, q, int(c_id[to[t]]), int(s[t])) for t in take.tolist())
    ids, ps, qs, ns, ss = zip(*found) if found else ((),) * 5
    return pa.table([pa.array(ids, pa.int64()), pa.array(ps, pa.int64()), _decimals(np.array(qs, dtype=object)),
                     pa.array(ns, pa.int64()), _decimals(np.array(ss, dtype=object))],
                    names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows["vec_id"].to_numpy(), rows["label"].to_numpy(), integers(rows["vector"])


def _dealt(rows: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
    """Each row in its own block, once for every block of the other side."""
    return (rows.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(own_blocks)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))))


def _first(found: DataFrame, by: list[str], score: str, id: str, k: int, rank: str = "rank") -> DataFrame:
    """The first k of each group, over the few rows that each cell has left."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(id))
    return found.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 3, low: int = 50,
         high: int = 95, anchor_block: int = ANCHOR_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """Hard negatives of ``anchors`` among ``rows``, both as ``clean`` returns them
    and written, for they are read several times.

    For each anchor and each of its first positives (rows of its label) the first rows of other
    labels whose score lies between ``low`` and ``high`` percent of the positive's: (anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score).
    """
    anchors = cut(anchors, "anchors")
    a_blocks = -(-max(anchors.count(), 1) // anchor_block)
    c_blocks = max(-(-max(rows.count(), 1) // candidate_block), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    cell = ["a_block", "c_block"]
    grid = _dealt(rows, "c_block", c_blocks, "a_block", a_blocks).groupBy(*cell)

    def side(df: DataFrame):
        return _dealt(df, "a_block", a_blocks, "c_block", c_blocks).groupBy(*cell)

    near = side(anchors).cogroup(grid).applyInArrow(
        lambda left, right: _cell_positives(left, right, n_positives), POSITIVES)
    chosen = (_first(near, ["anchor_id"], "score", "positive_id", n_positives)
              .groupBy(F.col("anchor_id").alias("vec_id"))
              .agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("p"))  # n_positives at most
              .select("vec_id", F.col("p.positive_id").alias("positive_id"), F.col("p.score").alias("positive_score")))
    with_positives = cut(anchors.join(chosen, "vec_id"), "positives")
    far = side(with_positives).cogroup(grid).applyInArrow(
        lambda left, right: _cell_negatives(left, right, n_negatives, low, high), NEGATIVES)
    out = _first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id",
                      *(F.col(c).try_cast("long").alias(c) for c in ("positive_score", "negative_score")))
