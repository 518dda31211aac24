"""The prefix trie of conversations by digests of fixed-length blocks of turns.

A conversation is cut into blocks of BLOCK turns; the last, shorter one (empty where the length
is a multiple of BLOCK) is its tail. Blocks have digests, groups of FAN blocks have digests of
those, and so on, so the digest of everything in front of a block is put together from a
bounded number of digests for each level, and the levels are logarithmic in the longest
conversation: no step follows a conversation turn by turn, and none holds more than FAN digests.

Conversations are first grouped by whole blocks: those with the same digest in front and the
same block are one class with its counts. Inside a block that all of its prefix's conversations
share, every turn is a node of just these conversations. Only where classes of one prefix
diverge are the turn boundaries refined, by digests of the first 1 .. BLOCK turns of each class.
So the work on nodes grows with distinct classes, not with conversations.

What is summed over a subtree comes from sums over a node's members, without walking the trie:
a conversation owns the nodes of which it is the smallest member, which are the deepest ones of
its path, so all nodes below a node are owned by its members, and all of them but its smallest
own only nodes below it.

Digests are the first 128 bits of SHA-256. The digest of the ends at a node is taken over
chunks: sorted runs of ids become a few strings, and one task streams the strings of a node.

Defined results: turns are ordered by turn (null first), equal ones by role and text digest; a
null role or text is empty; rows with a null conv_id take no part; repeated rows are turns of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmart.operators.keys import dense_key

from .common import cut, join_spread, spread_keys

BLOCK, FAN = 4, 16


def digest(*parts: Column | str) -> Column:
    """128 bits of SHA-256 over binary columns, of which only the last may vary in size."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _joined(digests: Column | str) -> Column:
    return F.array_join(F.transform(digests, F.hex), "").cast("binary")


def _total(sizes: Column | str) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, turn, chars): each conversation's turns in order, the turn as its digest.

    Positions come from one order over all turns, so a conversation that holds a third of them is
    numbered by as many tasks as its rows need.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    seen = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("_turn"),
        digest(F.unhex(F.sha2(role, 256)), F.unhex(F.sha2(text, 256))).alias("turn"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("_row"))
    # Equal rows differ by _row alone, so many of them are no single range.
    keyed = dense_key(seen, ["conv", "_turn", "turn", "_row"], "_at", start=0)
    starts = keyed.groupBy("conv").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    hot = spread_keys(starts, "conv", "n")
    return (join_spread(keyed, starts.select("conv", "_first"), "conv", hot, ["_at"])
            .select("conv", (F.col("_at") - F.col("_first")).alias("pos"), "turn", "chars"))


def rebuild(turns: DataFrame, group: int = 100, most_shared: int = 6) -> DataFrame:
    """(conv, pos, turn, chars) of the rebuilt conversations, and one row with a null pos for each.

    Conversation c takes the first h turns of c - c % group, then its own after its first h;
    h is CRC-32 of c in decimal, modulo ``most_shared``.
    """
    turns = cut(turns, "turns")
    convs = (turns.groupBy("conv").agg((F.max("pos") + 1).alias("n"))
             .withColumn("h", F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most_shared))))
    heads = turns.where((F.col("conv") % group == 0) & (F.col("pos") < most_shared - 1)).withColumnRenamed("conv", "donor")
    lengths = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    convs = (convs.withColumn("donor", F.col("conv") - F.col("conv") % group).join(lengths, "donor", "left")
             .withColumn("taken", F.least("h", F.coalesce("donor_n", F.lit(0)))))
    shared = convs.join(heads, "donor").where("pos < h").select("conv", "pos", "turn", "chars")
    hot = spread_keys(convs, "conv", "n")
    own = (join_spread(turns, convs.select("conv", "h", "taken"), "conv", hot, ["pos"])
           .where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn", "chars"))
    none = convs.select("conv", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn"),
                        F.lit(0).cast("long").alias("chars"))
    return shared.unionByName(own).unionByName(none)


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv, block, turns, sizes): every block in order of turns, the last one shorter than BLOCK, perhaps empty."""
    total = turns.groupBy("conv").agg(F.count("pos").alias("n"))
    rows = turns.where("pos IS NOT NULL").select("conv", F.expr(f"pos div {BLOCK}").alias("block"),
                                                 F.struct("pos", "turn", "chars").alias("t"))
    tails = total.select("conv", F.expr(f"n div {BLOCK}").alias("block"), F.lit(None).cast(rows.schema["t"].dataType).alias("t"))
    return (rows.unionByName(tails).groupBy("conv", "block").agg(F.sort_array(F.collect_list("t")).alias("t"))  # BLOCK at most
            .select("conv", "block", F.col("t.turn").alias("turns"), F.col("t.chars").alias("sizes")))


def _with_prefixes(blocks: DataFrame) -> DataFrame:
    """Blocks with the digest of all in front of them (``prefix``), of all up to their end, and the characters in front.

    ``until`` of a tail is never used: only whole blocks have something behind them.
    """
    level = blocks.select("conv", F.col("block").alias("seg"), digest(_joined("turns")).alias("d"), _total("sizes").alias("c"))
    most = blocks.agg(F.max("block")).first()[0] or 0
    levels = []
    while True:
        # In a group of FAN neighbours each segment sees the digests in front of it in the group.
        grouped = level.groupBy("conv", F.expr(f"seg div {FAN}").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("seg", "d", "c"))).alias("g"))  # FAN at most
        in_front = F.transform("g", lambda x, i: F.struct(
            x["seg"].alias("seg"), _joined(F.slice("g.d", 1, i)).alias("front"), _total(F.slice("g.c", 1, i)).alias("before")))
        grouped = cut(grouped.select("conv", "up", in_front.alias("s"), digest(_joined("g.d")).alias("d"),
                                     _total("g.c").alias("c")), "trie-level")
        levels.append(grouped)
        if most < FAN:
            break
        most //= FAN
        level = grouped.select("conv", F.col("up").alias("seg"), "d", "c")
    # From the top down: what is in front of a group, then in front of each of its segments.
    above = None
    for grouped in reversed(levels):
        part = grouped.select("conv", "up", F.explode("s").alias("s")).select("conv", "up", "s.*")
        if above is None:
            above = part.select("conv", "seg", digest("front").alias("prefix"), F.col("before"))
        else:
            above = (part.join(above.select("conv", F.col("seg").alias("up"), F.col("prefix").alias("p"), F.col("before").alias("b")),
                               ["conv", "up"])
                     .select("conv", "seg", digest("p", "front").alias("prefix"),
                             (F.col("before") + F.col("b")).alias("before")))
    above = cut(above, "trie-prefixes")
    ends = above.select("conv", (F.col("seg") - 1).alias("block"), F.col("prefix").alias("until"))
    return (blocks.join(above.withColumnRenamed("seg", "block"), ["conv", "block"])
            .join(ends, ["conv", "block"], "left"))


def _node_keys() -> Column:
    """Digests of the nodes inside a block: of the prefix and its first 1, 2, .. turns; a whole block's last is the next prefix."""
    inner = F.transform("turns", lambda _, i: digest("prefix", _joined(F.slice("turns", 1, i + 1))))
    return F.when(F.size("turns") < BLOCK, inner).otherwise(F.concat(F.slice(inner, 1, BLOCK - 1), F.array("until")))


def _spread(classes: DataFrame, sums: list[str], with_shape: bool) -> DataFrame:
    """Nodes from classes: turns of diverging blocks grouped by their digest, those of shared blocks as they are."""
    shape = ["depth", "parent", "chars", "before"] if with_shape else []
    least = ["conv"] if with_shape else []
    turn = F.transform("keys", lambda k, i: F.struct(
        k.alias("key"), (F.col("block") * BLOCK + i + 1).alias("depth"),
        F.when(i == 0, F.col("prefix")).otherwise(F.get("keys", i - 1)).alias("parent"),
        F.get("sizes", i).alias("chars"),
        (F.col("before") + _total(F.slice("sizes", 1, i))).alias("before")))
    nodes = classes.select("alone", *sums, *least, F.explode(turn).alias("t")).select(
        "alone", "t.key", *(f"t.{c}" for c in shape), *least, *sums)
    refined = nodes.where("NOT alone").groupBy("key", *shape).agg(
        *(F.min(c).alias(c) for c in least), *(F.sum(c).alias(c) for c in sums))
    return nodes.where("alone").drop("alone").unionByName(refined)


EMPTY_SHA = hashlib.sha256(b"").hexdigest()
CHUNKS = "key binary, first long, ids string"
ENDS = "key binary, ends_sha256 string"


def _chunk(batches: Iterator[pa.RecordBatch]):
    """Sorted (key, conv) rows to one row for each run of a key in a batch: its ids joined."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
        runs = list(zip(begin, [*begin[1:], len(keys)]))
        yield pa.record_batch([pa.array([keys[a] for a, _ in runs], pa.binary()), pa.array([ids[a] for a, _ in runs], pa.int64()),
                               pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string())],
                              names=["key", "first", "ids"])


def _hash_chunks(batches: Iterator[pa.RecordBatch]):
    """Chunks sorted by (key, first) to one digest a key, holding one chunk at a time."""
    now, sha = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != now:
                if sha is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield _digests(done)
    if sha is not None:
        yield _digests([(now, sha.hexdigest())])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in rows], pa.binary()), pa.array([s for _, s in rows], pa.string())],
                           names=["key", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): the ids of a key in ascending order, comma-joined, by SHA-256."""
    chunks = (ends.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
              .mapInArrow(_chunk, CHUNKS))
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_chunks, ENDS)


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv, pos, turn, chars), as ``rebuild`` returns them.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; the
    root has depth 0 and no parent.
    """
    blocks = cut(_with_prefixes(cut(_blocks(turns), "trie-blocks")).withColumn("keys", _node_keys())
                 .withColumn("class", digest("prefix", _joined("turns"))), "trie-keys")
    # Whole blocks first: conversations of one class share prefix and block.
    grouped = (blocks.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"),
        *(F.first(c).alias(c) for c in ("prefix", "block", "before", "turns", "sizes", "keys"))))
    grouped = cut(grouped.where(F.size("turns") > 0).drop("turns"), "trie-classes")
    siblings = grouped.groupBy("prefix").agg(F.count(F.lit(1)).alias("classes"))
    hot = spread_keys(siblings, "prefix", "classes")
    classes = cut(join_spread(grouped, siblings, "prefix", hot, ["class"])
                  .withColumn("alone", F.col("classes") == 1).drop("classes"), "trie-siblings")
    one = blocks.where("block = 0").select(F.hex("prefix")).first()  # the same before every first block
    root = F.unhex(F.lit(one[0] if one else ""))
    top = blocks.where("block = 0").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).select(
        root.alias("key"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("before"), "conv", "n").where("n > 0")
    nodes = cut(_spread(classes, ["n"], True).unionByName(top), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    children = cut(children, "trie-children")
    nodes = cut(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "trie-nodes")
    # What each conversation owns, and whether it stands for a leaf.
    owned = nodes.groupBy("conv").agg(F.sum("chars").alias("own"),
                                      F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    totals = blocks.groupBy("conv").agg(F.sum(_total("sizes")).alias("total"), F.count(F.lit(1)).alias("blocks"))
    convs = cut(totals.join(owned, "conv", "left").fillna(0, ["own", "leaves"]), "trie-convs")
    sums = ["total", "own", "leaves"]
    hot = spread_keys(convs, "conv", "blocks")
    of_class = (join_spread(blocks.where(F.size("turns") > 0).select("class", "conv", "block"), convs.select("conv", *sums),
                            "conv", hot, ["block"])
                .groupBy("class").agg(*(F.sum(c).alias(c) for c in sums)))
    of_top = convs.agg(*(F.sum(c).alias(c) for c in sums)).select(root.alias("key"), *sums)
    of_node = _spread(classes.join(of_class, "class"), sums, False).unionByName(of_top)
    first = convs.select("conv", F.col("total").alias("first_total"), F.col("own").alias("first_own"))
    hot = spread_keys(nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conv", "n")
    ends = (blocks.where(F.size("turns") < BLOCK)
            .select("conv", F.when(F.size("turns") == 0, F.col("prefix")).otherwise(F.element_at("keys", -1)).alias("key")))
    full = (join_spread(nodes, first, "conv", hot, ["key"]).join(of_node, "key")
            .join(end_digests(ends), "key", "left"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    hot = spread_keys(children.withColumnRenamed("key", "parent"), "parent", "n_children")
    full = join_spread(full, parents, "parent", hot, ["key"], "left")
    in_members = F.col("total") - F.col("n") * F.col("before")
    once = F.col("own") - F.col("first_own") + F.col("first_total") - F.col("before")
    return full.select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id",
                       F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
                       (in_members - once).alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
