"""Byte-level BPE, hard negatives and the prefix trie against the library and brute force."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmart.llm import bytepair, negatives, prefix_trie
from postmart.llm import textvec as tv
from postmart.llm.common import cut

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- byte pairs


@pytest.fixture(scope="module")
def ranks_file():
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks_file):
    import public_tokenizers
    import tiktoken
    assert bytepair.PATTERN == public_tokenizers.PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks_file):
    return bytepair.Encoder(bytepair.load(ranks_file))


def encode(encoder, texts):
    data, offsets = tv.strings(pa.array(texts, pa.string()))
    ids, at = encoder.encode(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbzstmdrevl'' ’   \n\t\r\x1c\x85\xa0é中1٣½²̀.!?ǅ😀"), max_size=40), max_size=6))
def test_byte_pairs_equal_the_library(encoder, library, texts):
    assert encode(encoder, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_byte_pairs_equal_the_library_on_any_text(encoder, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encode(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_is_cut_as_by_the_library(encoder, library):
    texts = [f"a{chr(c)}b {chr(c)}'s" for c in [*range(0xD800), *range(0xE000, 0x20000), 0xE0100, 0x10FFFF]]
    assert encode(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_pre_tokens_are_merged_in_order(encoder, library):
    for text in ("ab" * 30_000, "=" * 5_000, "the" * 3_000, "\n" * 999, "é" * 4_000):
        assert encode(encoder, [text]) == [library.encode_ordinary(text)]


def test_perfect_hash_gives_every_entry_its_own_place(encoder):
    v = encoder.v
    assert sorted(v.ranks.tolist()) == list(range(len(v.ranks))) and v.table.n == len(v.ranks)
    assert v.by_bytes() == encoder.ranks
    for n in (1, 2, 3, 257):
        hashes = tv.mix(np.arange(n, dtype=np.uint64))
        assert sorted(bytepair.PerfectHash(hashes).places(hashes).tolist()) == list(range(n))


def test_encode_and_decode_whole_tables(spark, frame, ranks_file, library):
    rows = [(1, "Hello it's me, 中文 — 12½"), (2, None), (3, ""), (None, "x" * 500), (1, "Hello it's me, 中文 — 12½"), (4, "a\x00b")]
    v = bytepair.load(ranks_file)
    encoded = bytepair.encode(frame(rows), v)
    assert encoded.columns == ["doc_id", "ids"]
    got = bytepair.decode(encoded, v).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(map(repr, ((r.doc_id, r.ids, bytes(r.decoded)) for r in got))) == sorted(map(repr, want))
    assert bytepair.decode(bytepair.encode(frame([]), v), v).count() == 0
    some = spark.createDataFrame([(1, [5, 7]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.decoded and bytes(r.decoded) for r in bytepair.decode(some, v).orderBy("doc_id").collect()] == [
        library.decode_bytes([5, 7]), None, bytearray()]
    with pytest.raises(Exception, match="outside the vocabulary"):
        bytepair.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), v).collect()


def test_byte_pair_query(spark, library):
    from postmart.llm.queries import op11_byte_pairs
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = op11_byte_pairs(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


# ------------------------------------------------------------ hard negatives

def brute_mine(rows, anchor_of):
    """rows: (vec_id, label, vector)."""
    kept = {}
    for i, lab, v in rows:
        if None in (i, lab, v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (lab, v)), (lab, v))
    ints = {i: [math.floor(256 * x) for x in v] for i, (_, v) in kept.items()}
    out = set()
    for a in filter(anchor_of, kept):
        score = {c: sum(x * y for x, y in zip(ints[a], ints[c])) for c in kept}
        order = sorted((c for c in kept if c != a), key=lambda c: (-score[c], c))
        for p in [c for c in order if kept[c][0] == kept[a][0]][:5]:
            fit = [c for c in order if kept[c][0] != kept[a][0] and 50 * score[p] <= 100 * score[c] <= 95 * score[p]]
            out |= {(a, p, n, c, score[p], score[c]) for n, c in enumerate(fit[:3], 1)}
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 5), st.sampled_from([1, 3, 200, 2 ** 20, 2 ** 30, 2 ** 52]), st.randoms())
def test_packed_scores_are_exact(m, n, wide, most, r):
    a = [[r.randint(-most, most) for _ in range(wide)] for _ in range(m)]
    c = [[r.randint(-most, most) for _ in range(wide)] for _ in range(n)]
    got = negatives.scores(np.array(a, float).reshape(m, wide), np.array(c, float).reshape(n, wide))
    assert got.tolist() == [[sum(x * y for x, y in zip(p, q)) for q in c] for p in a]


def test_components_are_floors_at_any_size():
    vectors = [[0.1, -0.1, 1e300], [1e-300, -1e-300], [], [3.0, 2.0 ** 60 + 2.0 ** 10]]
    got = negatives.integers(pa.array(vectors, pa.list_(pa.float64())))
    assert got.tolist() == [[math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v] + [0] * (3 - len(v)) for v in vectors]


def mined(spark, rows, anchor="vec_id % 50 = 0", **blocks):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "'x' AS rank", "1 AS score")
    kept = cut(negatives.clean(df), "test-vectors")
    out = negatives.mine(kept, kept.where(anchor), **blocks)
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in out.collect()}


def test_mining_equals_brute_force(spark):
    r = random.Random(4)
    base = [[r.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, r.randrange(4), [x + r.gauss(0, .5) for x in r.choice(base)]) for i in range(400)]
    rows += [(401, 1, None), (402, None, base[0]), (403, 2, [None] * 6), (404, 2, [float("nan")] * 6), (None, 1, base[1]),
             (405, 2, [float("inf")] + base[0][1:]), (7, rows[7][1], rows[7][2]), (9, 0, base[3]), (100, 3, base[2]),
             (450, 5, [1.0]), (451, 5, []), (452, 1, base[0] + [9.0]), (500, 9, base[0]), (453, 2, [1e6] * 6)]
    rows += [(1000 + i, 1, base[0]) for i in range(300)]  # one hot vector: ties by id
    want = brute_mine(rows, lambda i: i % 50 == 0)
    assert len(want) > 100
    assert mined(spark, rows) == want
    assert mined(spark, rows, anchor_block=3, candidate_block=17) == want


def test_mining_beyond_64_bits_and_empty(spark):
    rows = [(0, 1, [1e14]), (1, 1, [1e14]), (2, 2, [0.9e14]), (3, 2, [0.3e14])]
    assert mined(spark, rows) == {(0, 1, 1, 2, None, None)}
    assert mined(spark, []) == set()
    assert mined(spark, [(0, 1, [1.0])]) == set()


def test_mining_query(spark):
    from postmart.llm.queries import op12_kronecker_negatives
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"])
            for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    got = op12_kronecker_negatives(spark, SF).collect()
    assert {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got} == brute_mine(
        rows, lambda i: i % 50 == 0) and got


# --------------------------------------------------------------- prefix trie

def brute_trie(rows):
    """rows: (conv_id, turn, role, text), without equal turns of one conversation."""
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                      key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def built_trie(df):
    return sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.rebuild(prefix_trie.number_turns(df))).collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS conv", "'x' AS pos", "1 AS key", "2 AS n", "3 AS block")


def test_trie_equals_brute_force(spark):
    r = random.Random(6)
    rows = []
    for c in range(260):
        for t in range(r.choice([0, 1, 2, 4, 5, 8, 9, 13])):
            rows.append((c, t if t else r.choice([None, 0]), r.choice(["user", None, ""]) if t % 4 == 0 else "bot",
                         r.choice(["a", "b" * 9, None, "é中", ""]) if t % 4 == 0 else f"t{t}"))
    for c in (300, 301, 302, 317, 950):      # long ones that part late: many blocks, more than one level
        for t in range(150):
            rows.append((c, t, "user", "same" if t < 90 + c % 7 else f"{c}"))
    rows += [(None, 1, "user", "x"), (401, 3, "bot", "z")]
    got = built_trie(conversations(spark, rows))
    assert [g for g in got if g[1] > 80] and got == brute_trie(rows)


@pytest.mark.parametrize("rows", [[], [(5, 1, None, None)], [(100, None, "u", "a"), (103, 0, "u", "a"), (199, 0, "u", "a")],
                                  [(7, 0, "u", "x"), (7, 0, "u", "x"), (7, 0, "u", "x"), (7, None, "u", "y")]])
def test_small_tries(spark, rows):
    assert built_trie(conversations(spark, rows)) == brute_trie(rows)


def test_trie_query(spark):
    from postmart.llm.queries import op13_prefix_trie
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    got = op13_prefix_trie(spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert dict(got.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in got.columns}
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)


def test_ends_are_hashed_in_chunks(spark):
    ends = spark.range(60_000).select(F.lit(b"k").alias("key"), F.col("id").alias("conv")).union(
        spark.createDataFrame([(b"other", 4), (b"other", -2)], "key binary, conv long")).repartition(7)
    got = {bytes(r.key): r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    assert got == {b"k": hashlib.sha256(",".join(map(str, range(60_000))).encode()).hexdigest(),
                   b"other": hashlib.sha256(b"-2,4").hexdigest()}
