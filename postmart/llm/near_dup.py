"""Near-duplicate classes by ProbMinHash.

A text is the weighted set of its 5-word shingles (words are runs of letters and digits of any
script without case); a shingle said n times weighs 1 + log2(n) / 4, so that what a text says all
over counts for more, but does not drown the rest. A text of fewer words is one shingle. Signatures come from Poisson processes: every shingle sends arrivals
at a rate equal to its weight, each to one of 256 registers, until its next arrival is later than all
registers hold; a register keeps the shingle that came first. Registers of two texts agree with the
probability Jaccard similarity of the weighted sets, which is also what links are judged by, exactly:
the sum over common shingles d of 1 / sum over all shingles e of max(x_e / x_d, y_e / y_d).

1. Texts of equal words are one node; nodes only are compared.
2. Bands of 8 registers deal the nodes into buckets. In each bucket all members are verified
   against its most central node (the one in the fullest buckets), by their exact similarity:
   a star, not all pairs.
3. Verified links give components. Where the members that met one leader are still in different
   components, those members are compared with each other in blocks of BLOCK nodes: signatures
   first, then exactly, inside the task; only links are written. The signatures' cut lies four
   standard deviations below the threshold, so a link that banding finds is lost by that chance only.
4. Components of all links are the classes.

Two texts are linked when the probability Jaccard similarity of their weighted shingles is at least
``threshold``. Where no shingle is said twice, that is the Jaccard similarity of the sets.

Defined results: one row per row of documents with its class, named after the smallest doc_id in
it (null where no member has one); texts without words are in one class only with equal texts,
null being empty; repeated rows are in one class; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import components, cut, id_bitmap, in_bitmap, join_spread, partitions, spread_keys

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 256
ROWS = 8
GROUP = 64     # members verified against one copy of their leader
BLOCK = 256    # nodes on a side of a block of step 3
SLACK = 0.1    # four standard deviations of an estimate from 256 registers at 0.8


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE):
    """(shingle hashes, first of each text, two 64-bit hashes of each text's words)."""
    words, at = tv.word_hashes(data, offsets)
    size = np.diff(at)
    hashes, _, first = tv.windows(words, at, k)
    # the whole word sequence, twice, from position-dependent sums
    place = (np.arange(len(words)) - np.repeat(at[:-1], size)).astype(np.uint64)
    a = _sums64(tv.mix(words + tv.mix(place + np.uint64(1))), at)
    b = _sums64(tv.mix(words ^ tv.mix(place + np.uint64(1 << 40))), at)
    bare = np.flatnonzero((size == 0) & (np.diff(offsets) > 0))
    if len(bare):
        raw = tv.span_hashes(data, offsets[:-1][bare], offsets[1:][bare])
        a[bare], b[bare] = raw, tv.mix(raw + np.uint64(1))
    short = (size > 0) & (size < k)
    if short.any():
        count = np.diff(first) + short
        to = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(to[-1], np.uint64)
        out[to[:-1][short]] = tv.mix(a[short] + b[short])
        rest = np.ones(to[-1], bool)
        rest[to[:-1][short]] = False
        out[rest] = hashes
        hashes, first = out, to
    return hashes, first, a, b


def _sums64(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:], dtype=np.uint64)
    return total[bounds[1:]] - total[bounds[:-1]]


def weighted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: (hash, weight, first of each text)."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return h[at], 1 + np.log2(np.diff(np.append(at, len(h)))) / 4, np.searchsorted(doc[at], np.arange(len(first)))


def prob_min_hash(h: np.ndarray, weight: np.ndarray, first: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Signatures of texts of weighted shingles: (texts, registers) marks of eight bits of a shingle's hash.

    Registers with different shingles agree by chance once in 256 times.
    """
    texts = len(first) - 1
    time = np.full(texts * registers, np.inf)
    mark = np.zeros(texts * registers, np.uint8)
    text = np.repeat(np.arange(texts), np.diff(first))
    h, rate, now, step = h.copy(), weight.astype(float), np.zeros(len(h)), 0
    name = (tv.mix(h + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(56)).astype(np.uint8)
    while len(h):
        k = int(np.clip(8000 // len(h), 1, 64))      # a few shingles send several arrivals at once
        draw = tv.mix(h[:, None] + (np.arange(step, step + k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :])
        wait = -np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 9007199254740992.0) / rate[:, None]
        times = now[:, None] + np.cumsum(wait, axis=1)
        step += k
        now = times[:, -1].copy()
        cell = text[:, None] * registers + (tv.mix(draw) % np.uint64(registers)).astype(np.int64)
        times, cell, names = times.ravel(), cell.ravel(), np.repeat(name, k)
        good = times < time[cell]
        times, cell, names = times[good], cell[good], names[good]
        np.minimum.at(time, cell, times)
        won = times == time[cell]
        mark[cell[won]] = names[won]
        limit = time.reshape(texts, registers).max(axis=1)
        alive = now < limit[text]                    # all later arrivals of the others come too late
        h, rate, now, text, name = h[alive], rate[alive], now[alive], text[alive], name[alive]
    return mark.reshape(texts, registers)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(texts, bands) bucket keys: of every ROWS = 8 registers, whose marks make one 64-bit number."""
    part = np.ascontiguousarray(signatures).view(np.uint64)
    return tv.mix(part + tv.mix(np.arange(part.shape[1], dtype=np.uint64) + np.uint64(1)))


Weighted = tuple[np.ndarray, np.ndarray]  # sorted distinct shingles and their weights


def similarity(a: Weighted, b: Weighted) -> float:
    """Probability Jaccard similarity of two weighted sets.

    With the common shingles in the order of their weight ratio x / y, the larger of the two ratios
    is x's for all that follow a shingle and y's for all before it, so running sums give every term.
    """
    (ha, x), (hb, y) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.searchsorted(hb, ha)
    at[at == len(hb)] = 0
    common = hb[at] == ha
    cx, cy = x[common], y[at[common]]
    shared = cx.sum()
    if (cx == cy).all():  # one ratio: every term has the same sum below the line
        return float(shared / (x.sum() + y.sum() - shared))
    order = np.argsort(cx / cy)
    cx, cy = cx[order], cy[order]
    only_x, only_y = x.sum() - shared, y.sum() - cy.sum()
    following = np.cumsum(cx[::-1])[::-1] + only_x
    earlier = np.cumsum(cy) - cy + only_y
    return float((1 / (following / cx + earlier / cy)).sum())


def similar(a: Weighted, b: Weighted, threshold: float) -> bool:
    """Whether the similarity reaches the threshold, the last bits of the sums aside."""
    return similarity(a, b) >= threshold - 1e-9


def _texts(batch_column):
    """The weighted shingles of each text of a column, one text after the other."""
    data, offsets = tv.strings(batch_column)
    for a, b in tv.slices(offsets):
        hashes, first, _, _ = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        h, weight, first = weighted(hashes, first)
        for i in range(b - a):
            yield h[first[i]:first[i + 1]], weight[first[i]:first[i + 1]]


def _rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), F.col("text").cast("string").alias("text"))


def sign(docs: DataFrame, keep: list[str], with_text: bool) -> DataFrame:
    """doc (a struct of the columns to keep), text (if asked for), key and mark (of its words, 128 and 64 bits),
    signature (null without words) and row. Written once, so that the row numbers hold."""
    rows = _rows(docs, keep)

    def run(batches):
        for batch in batches:
            data, offsets = tv.strings(batch.column(1))
            for a, b in tv.slices(offsets):
                hashes, first, x, y = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                full = np.flatnonzero(np.diff(first))
                signature = prob_min_hash(*weighted(hashes, np.append(first[:-1][full], first[-1])))
                of: list[bytes | None] = [None] * (b - a)
                for i, s in zip(full.tolist(), signature):
                    of[i] = s.tobytes()
                lead = [c.slice(a, b - a) for c in (batch.column(0), batch.column(1))[:1 + with_text]]
                yield pa.record_batch([*lead, _keys(x, y), pa.array(x.view(np.int64)), pa.array(of, pa.binary())],
                                      names=schema.names)
    schema = rows.select("doc", *["text"][:with_text], F.lit(b"").alias("key"), F.lit(0).cast("long").alias("mark"),
                         F.lit(None).cast("binary").alias("signature")).schema
    return cut(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "signatures")


def _keys(x: np.ndarray, y: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in np.stack([x, y], 1)], pa.binary())


def _texts_of(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(key, text) of the texts whose mark may be in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            data, offsets = tv.strings(batch.column(0))
            for a, b in tv.slices(offsets):
                _, _, x, y = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                hit = in_bitmap(shared.value, x)
                yield pa.record_batch([_keys(x[hit], y[hit]), batch.column(0).slice(a, b - a).filter(pa.array(hit))],
                                      names=["key", "text"])
    return docs.select(F.col("text").cast("string")).mapInArrow(run, "key binary, text string")


def _bands(batches):
    for batch in batches:
        key = band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, REGISTERS))
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)),
                               pa.array(np.repeat(batch.column(0).to_numpy(), key.shape[1]))], names=["band", "node"])


def star_pairs(nodes: DataFrame) -> DataFrame:
    """(leader, node): in every bucket of several nodes each one with the most central, for (node, signature)."""
    bands = nodes.select("node", "signature").mapInArrow(_bands, "band long, node long")
    sizes = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(bands.join(sizes, "band"), "members")
    central = members.groupBy("node").agg(F.sum("n").alias("centrality"))
    leaders = (members.join(central, "node").groupBy("band")
               .agg(F.max(F.struct("centrality", (-F.col("node")).alias("minus"))).alias("top"))
               .select("band", (-F.col("top.minus")).alias("leader")))
    return members.join(leaders, "band").where("leader <> node").select("leader", "node").distinct()


def verify(pairs: DataFrame, sizes: DataFrame, hot: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (leader, node) pairs whose texts are similar. ``sizes``: (leader, n), ``hot``: its hot leaders, ``texts``: (node, text)."""
    dealt = join_spread(pairs, sizes, "leader", hot, ["node"]).select(
        "leader", "node", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / GROUP)).alias("part"))
    heads = dealt.select("leader", "part").distinct().withColumn("node", F.col("leader"))
    rows = (dealt.select("leader", "part", "node", F.lit(1).alias("kind"))
            .unionByName(heads.select("leader", "part", "node", F.lit(0).alias("kind")))
            .join(texts, "node"))
    spark = pairs.sparkSession

    def run(batches):
        group, head = None, None
        for batch in batches:
            found = []
            ids = zip(*(batch.column(k).to_pylist() for k in range(4)))
            for (leader, part, node, kind), own in zip(ids, _texts(batch.column(4))):
                if kind == 0:
                    group, head = (leader, part), own
                elif (leader, part) == group and similar(head, own, threshold):
                    found.append((leader, node))
            columns = list(zip(*found)) or [[], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])
    return (rows.select("leader", "part", "node", "kind", "text")
            .repartition(partitions(spark), "leader", "part").sortWithinPartitions("leader", "part", "kind")
            .mapInArrow(run, "a long, b long"))


def _cross_links(threshold: float):
    """Links between different components in blocks of (leader, i, j, node, component, side, signature, text) rows."""
    least = threshold - SLACK

    def block(rows):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        sides = [[r for r in rows if r[2] == k] for k in (0, 1)]
        left, right = sides if sides[1] else (sides[0], sides[0])
        a, b = (np.frombuffer(b"".join(r[3] for r in s), np.uint8).reshape(len(s), -1) for s in (left, right))
        for i, one in enumerate(left):
            near = (b == a[i]).mean(axis=1)
            for k in np.flatnonzero(near >= least).tolist():
                two = right[k]
                x, y = find(one[1]), find(two[1])
                if x != y and similar(one[4], two[4], threshold):
                    root[x] = y
                    yield one[0], two[0]

    def run(batches):
        group, rows = None, []
        for batch in batches:
            ids = zip(*(batch.column(k).to_pylist() for k in range(7)))
            found = []
            for (leader, i, j, node, component, side, signature), own in zip(ids, _texts(batch.column(7))):
                if (leader, i, j) != group:
                    found += block(rows) if rows else []
                    group, rows = (leader, i, j), []
                rows.append((node, component, side, signature, own))
            columns = list(zip(*found)) or [[], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])
        if rows and (found := list(block(rows))):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
    return run


def cross_links(pairs: DataFrame, hot: DataFrame, parts: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links among the nodes that met one leader and are in different components.

    ``parts``: (node, component) of nodes with a link. Nodes of the leader's own component are
    compared with the others only, the others also with each other.
    """
    spark = pairs.sparkSession
    own = parts.withColumnRenamed("node", "leader").withColumnRenamed("component", "main")
    met = (join_spread(pairs.join(parts, "node", "left"), own, "leader", hot, ["node"], "left")
           .select("leader", "node", F.coalesce("component", "node").alias("component"),
                   F.coalesce("main", "leader").alias("main"))
           .withColumn("other", (F.col("component") != F.col("main")).cast("int")))
    sizes = (met.groupBy("leader").agg(F.count("*").alias("n"), F.sum("other").alias("others"),
                                       F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high")
             .select("leader", F.ceil(F.col("others") / BLOCK).alias("x"),
                     F.ceil((F.col("n") - F.col("others")) / BLOCK).alias("y")))
    # Blocks 0 to x-1 hold the others, x to x+y-1 the main component; pairs (i, j) with i < x and i <= j.
    placed = join_spread(met, sizes, "leader", hot, ["node"]).withColumn("block", F.when(
        F.col("other") == 1, F.pmod(F.xxhash64("node"), F.col("x"))).otherwise(
        F.col("x") + F.pmod(F.xxhash64("node"), F.col("y"))))
    mate = F.when(F.col("other") == 1, F.sequence(F.lit(0).cast("long"), F.col("x") + F.col("y") - 1)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("x") - 1))
    dealt = (placed.withColumn("mate", F.explode(mate))
             .select("leader", F.least("block", "mate").alias("i"), F.greatest("block", "mate").alias("j"), "node",
                     "component", (F.col("block") > F.col("mate")).cast("int").alias("side")))
    return (dealt.join(nodes.select("node", "signature", "text"), "node")
            .select("leader", "i", "j", "node", "component", "side", "signature", "text")
            .repartition(partitions(spark), "leader", "i", "j").sortWithinPartitions("leader", "i", "j")
            .mapInArrow(_cross_links(threshold), "a long, b long"))


def classify(docs: DataFrame, signed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """key, component, n (copies) and best (of its copies that with the smallest doc_id) of every distinct text."""
    doc_id = F.col("doc.doc_id").cast("long")
    texts = cut(signed.groupBy("key", "mark").agg(
        F.min("row").alias("node"), F.count("*").alias("n"),
        F.min(F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), "row")).alias("best")), "nodes")
    rows = signed.where("signature IS NOT NULL").select(F.col("row").alias("node"), "signature")
    pairs = cut(star_pairs(rows.join(texts.select("node"), "node")), "pairs")
    # Only texts with a pair are read again: the others go by a bitmap, before any shuffle.
    paired = cut(texts.select("key", "mark", "node").join(
        pairs.select("node").unionByName(pairs.select(F.col("leader").alias("node"))), "node", "left_semi"), "paired")
    bodies = _texts_of(docs, id_bitmap(paired, "mark")).dropDuplicates(["key"]).join(
        paired.select("key", "node"), "key")
    nodes = cut(bodies.select("node", "text").join(rows, "node"), "paired")
    sizes = cut(pairs.groupBy("leader").agg(F.count("*").alias("n")), "leaders")
    hot = spread_keys(sizes, "leader", "n")
    links = cut(verify(pairs, sizes, hot, nodes.select("node", "text"), threshold), "links")
    parts = components(links)
    more = cut(cross_links(pairs, hot, parts, nodes, threshold), "links")
    if more.take(1):  # the components so far stand for the links that made them
        parts = components(parts.selectExpr("node AS a", "component AS b").unionByName(more))
    return (texts.join(parts, "node", "left")
            .select("key", F.coalesce("component", "node").alias("component"), "n", "best"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and class_size of every row of (doc_id, text)."""
    signed = sign(docs, ["doc_id"], with_text=False)
    texts = cut(classify(docs, signed, threshold), "classes")
    classes = texts.groupBy("component").agg(F.min("best.doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    of_key = texts.select("key", "component").join(classes, "component").select("key", "class_id", "class_size")
    return (join_spread(signed.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "row", "key"), of_key, "key",
                        spread_keys(texts.select("key", "n"), "key", "n"), ["row"])
            .select("doc_id", "class_id", "class_size"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of each class the row with the smallest doc_id (nulls last, then the first row), with all its columns."""
    signed = sign(docs, [c for c in docs.columns if c != "text"], with_text=True)
    kept = classify(docs, signed, threshold).groupBy("component").agg(F.min("best").alias("best")).select("best.row")
    return signed.join(kept, "row", "left_semi").select(*(
        F.col("text").cast(docs.schema[c].dataType).alias(c) if c == "text" else F.col("doc")[c].alias(c)
        for c in docs.columns))
