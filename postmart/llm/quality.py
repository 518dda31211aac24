"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

A text is a sparse vector: its distinct words without case, hashed to 2**BUCKET_BITS places with
a weight that falls with their number, and its statistics (STATISTICS below: shares of symbols,
capitals, repeats and so on, and its length as the only metadata), each spread over a few
bins by linear interpolation. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)

where the last term is all pairwise interactions, of low rank, in linear time.

The model is fitted on the driver by Adam on at most ``most_rows`` labelled rows (a documented
bound, taken by a hash of the id): its size and the rows' are bounded. Scoring covers all rows.

Defined results: a null or empty text has only its length bins; a null doc_id is scored like any
other and counts as held out if crc32('') mod 5 is 0, which holds; repeated rows get equal
scores; labels without doc_id or label are ignored, several labels of one id are averaged; with
no labels or one class the score is that class's share (0.5 without labels); other columns are
ignored, and lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

BUCKET_BITS = 14
RANK = 8
BINS = 10
MOST_ROWS = 12_000
EPOCHS = 7
LEAST_STEPS = 300  # a small sample is gone through more often
FOLDS = 5
LEAST_SCORE = 0.3

#: name -> value at which the last bin is reached; bins are even on the square root of the share.
STATISTICS = {"words": 1.0, "symbols": 1.0, "pipes": 1.0, "capitals": 1.0, "digits": 0.5, "marks": 1.0,
              "word_length": 1.0, "repeated_lines": 1.0, "repeated_windows": 1.0, "distinct_words": 1.0,
              "stops": 0.5, "line_words": 1.0, "non_ascii": 0.5, "single_case_words": 1.0}
FEATURES = len(STATISTICS) * BINS + (1 << BUCKET_BITS)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_UPPER, _LOWER = tv.byte_class((0x41, 0x5A)), tv.byte_class((0x61, 0x7A))
_OF = {"symbols": tv.byte_class(*((ord(c), ord(c)) for c in "#*$%&<>@^~=+{}[]\\/_")), "pipes": tv.byte_class((0x7C, 0x7C)),
       "digits": tv.byte_class((0x30, 0x39)), "marks": tv.byte_class((0x21, 0x21), (0x3F, 0x3F)),
       "stops": tv.byte_class((0x2C, 0x2C), (0x2E, 0x2E)), "non_ascii": tv.byte_class((0xC0, 0xFF))}


def _repeated(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each text's hashes, the share that equals an earlier one."""
    size = np.diff(at)
    own = np.repeat(tv.mix(np.arange(len(size), dtype=np.uint64)), size)
    again = pd.Series(tv.mix(hashes + own)).duplicated().to_numpy()
    return tv.sums(again, at) / np.maximum(size, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a slice of texts: (place, weight, first entry of each text)."""
    docs = len(offsets) - 1
    words, at = tv.word_hashes(data, offsets)
    size = np.diff(at)
    n, chars = np.maximum(size, 1), np.maximum(np.diff(offsets), 1)
    lines, line_ends, first_line = tv.runs(data != 0x0A, offsets)
    many_lines = np.maximum(np.diff(first_line), 1)
    triples, _, first_triple = tv.windows(words, at, 3)
    upper, lower = tv.sums(_UPPER[data], offsets), tv.sums(_LOWER[data], offsets)
    repeated = _repeated(words, at)
    share = {k: tv.sums(t[data], offsets) / n for k, t in _OF.items()}
    share |= {
        "words": np.log2(size + 1) / 16, "capitals": upper / np.maximum(upper + lower, 1),
        "word_length": np.minimum(chars / n, 25) / 25, "distinct_words": 1 - repeated,
        "repeated_lines": _repeated(tv.span_hashes(data, lines, line_ends), first_line),
        "repeated_windows": _repeated(triples, first_triple), "line_words": np.log2(size / many_lines + 1) / 10,
        "digits": share["digits"] / 5, "non_ascii": share["non_ascii"] / 5,
        "single_case_words": np.minimum(upper, lower) / np.maximum(upper + lower, 1) * 2}
    place, weight = [], []
    for k, (name, most) in enumerate(STATISTICS.items()):
        x = np.sqrt(np.clip(share[name] / most, 0, 1)) * (BINS - 1)
        low = np.minimum(x.astype(np.int64), BINS - 2)
        place += [k * BINS + low, k * BINS + low + 1]
        weight += [1 - (x - low), x - low]
    bucket = (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    key = pd.unique((np.repeat(np.arange(docs), size) << BUCKET_BITS) | bucket)
    doc = key >> BUCKET_BITS
    kinds = np.bincount(doc, minlength=docs)
    heavy = 2.0 / np.sqrt(np.maximum(kinds, 16))
    statistics = 2 * len(STATISTICS)
    count = kinds + statistics
    first = np.concatenate(([0], np.cumsum(count)))
    out_place, out_weight = np.empty(first[-1], np.int32), np.empty(first[-1], np.float32)
    cell = first[:-1, None] + np.arange(statistics)
    out_place[cell], out_weight[cell] = np.stack(place, 1), np.stack(weight, 1)
    rest = np.ones(first[-1], bool)
    rest[cell] = False
    out_place[rest] = (key & ((1 << BUCKET_BITS) - 1)) + len(STATISTICS) * BINS  # doc is ascending, as cells are
    out_weight[rest] = heavy[doc]
    return out_place, out_weight, first


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, place: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores before the logistic; every text has at least one entry."""
        v = self.factors[place] * weight[:, None]
        total = np.add.reduceat(v, first[:-1], axis=0)
        square = np.add.reduceat((v * v).sum(axis=1), first[:-1])
        return self.bias + np.add.reduceat(self.linear[place] * weight, first[:-1]) + 0.5 * (
            (total * total).sum(axis=1) - square)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(place: np.ndarray, weight: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = EPOCHS,
        batch: int = 128, rate: float = 0.02, decay: float = 1e-4) -> Model:
    """Adam on the log loss; rows in a fixed shuffled order."""
    share = float(label.mean()) if len(label) else 0.5
    model = Model(float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))),
                  np.zeros(FEATURES, np.float32), np.zeros((FEATURES, RANK), np.float32))
    if share in (0.0, 1.0) or not len(label):
        return model
    rng = np.random.RandomState(7)
    model.factors[:] = rng.normal(0, 0.02, model.factors.shape)
    params = np.concatenate([model.linear[:, None], model.factors], axis=1)
    epochs = max(epochs, -(-LEAST_STEPS * batch // len(label)))
    m, s, step = np.zeros_like(params), np.zeros_like(params), 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            size = first[rows + 1] - first[rows]
            at = np.concatenate(([0], np.cumsum(size)))
            take = np.arange(at[-1]) + np.repeat(first[rows] - at[:-1], size)
            p, x = place[take], weight[take]
            w = params[p]
            v = w[:, 1:] * x[:, None]
            total = np.add.reduceat(v, at[:-1], axis=0)
            score = model.bias + np.add.reduceat(w[:, 0] * x, at[:-1]) + 0.5 * (
                (total * total).sum(1) - np.add.reduceat((v * v).sum(1), at[:-1]))
            error = (logistic(score) - label[rows]) / len(rows)
            e = np.repeat(error, size) * x
            grad_v = e[:, None] * (np.repeat(total, size, axis=0) - v)
            known, inverse = np.unique(p, return_inverse=True)
            grad = np.stack([np.bincount(inverse, c, len(known)) for c in (e, *grad_v.T)], 1) + decay * params[known]
            step += 1
            m[known] = 0.9 * m[known] + 0.1 * grad
            s[known] = 0.999 * s[known] + 0.001 * grad * grad
            params[known] -= rate * (m[known] / (1 - 0.9 ** step)) / (np.sqrt(s[known] / (1 - 0.999 ** step)) + 1e-8)
            model.bias -= rate * float(error.sum())
    return Model(model.bias, params[:, 0].astype(np.float32), params[:, 1:].astype(np.float32))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Fit on at most ``most_rows`` labelled rows that are not held out."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out("doc_id"))
             .select(F.col("doc_id").cast("long"), F.col("quality").cast("double"))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows))

    def run(batches):
        for batch in batches:
            data, offsets = tv.strings(batch.column(1))
            for a, b in tv.slices(offsets):
                p, w, first = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.record_batch([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                    pa.array([p[x:y].tobytes() for x, y in zip(first, first[1:])], pa.binary()),
                    pa.array([w[x:y].tobytes() for x, y in zip(first, first[1:])], pa.binary())],
                    names=["doc_id", "label", "place", "weight"])
    # `known` has at most most_rows rows of twelve bytes
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .join(F.broadcast(known), "doc_id")
            # of several rows with one id always the same: the one whose text has the smallest digest
            .groupBy("doc_id", "label").agg(F.min_by("text", F.sha2("text", 256)).alias("text")).select("doc_id", "text", "label")
            .mapInArrow(run, "doc_id long, label int, place binary, weight binary").toArrow())
    rows = rows.take(np.argsort(rows["doc_id"].to_numpy(), kind="stable"))
    place = [np.frombuffer(x, np.int32) for x in rows["place"].to_pylist()]
    weight = [np.frombuffer(x, np.float32) for x in rows["weight"].to_pylist()]
    first = np.concatenate(([0], np.cumsum([len(x) for x in place]))).astype(np.int64)
    if not place:
        return fit(np.zeros(0, int), np.zeros(0), first, np.zeros(0))
    return fit(np.concatenate(place), np.concatenate(weight), first, rows["label"].to_numpy())


def scorer(model: Model):
    """Scores of a string column, slice by slice."""
    def run(column: pa.Array) -> np.ndarray:
        data, offsets = tv.strings(column)
        return np.concatenate([np.zeros(0)] + [
            logistic(model.margin(*features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])))
            for a, b in tv.slices(offsets)])
    return run


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES * (RANK + 1) numbers

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            x = score(batch.column(2)).astype(np.float64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(x, pa.float64()),
                                   pa.array((x >= LEAST_SCORE).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return docs.select(F.col("doc_id").cast("long"), held_out("doc_id"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def keep_quality(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of documents, all their columns, whose score is at least ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    text = docs.columns.index("text")

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(text)) >= least_score))
    return docs.mapInArrow(run, docs.schema)
