import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postmart.llm import binary_pack, packing, wordpiece
from postmart.llm import textvec as tv

TEXTS = ["", "Hello World's don't 'S can'T é ÉÉ <|endoftext|> x<|y", "I'LL go; 12ab3 ...'s ''' 'll'", "中文 “quoted”. á Á",
         "ΑΣ ΣΑΣ. İI", "Straße ŞİĞ ŉ 'n' ſ ×÷", "\t a\x0bb\x0cc\x00d \x1c e\x85f", "don''t 're're 5's ½ ²3 ٣", "end<"]


def reference_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def encode(tokenizer, texts):
    data, offsets = tv.strings(pa.array(texts, pa.string()))
    ids, at = wordpiece.word_ids(tokenizer).encode(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_ids_equal_the_library(tokenizer):
    library = wordpiece.word_ids(tokenizer).library
    assert encode(tokenizer, [*TEXTS, None]) == [reference_ids(library, t) for t in [*TEXTS, None]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbz'',,.. \n\té É ßŞİ× 12<|>sStTdDlLvVrReEM“—中Σσ̱̇ſ"), max_size=30), max_size=6))
def test_ids_equal_the_library_on_any_text(tokenizer, texts):
    library = wordpiece.word_ids(tokenizer).library
    assert encode(tokenizer, texts) == [reference_ids(library, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_plan_places_every_piece_without_gap(case):
    capacity, lengths = case
    histogram = {}
    for n in lengths:
        histogram[n] = histogram.get(n, 0) + 1
    fill, count = {}, {}
    for n, a, b, first, each, offset in packing.plan_slots(histogram, capacity):
        for r in range(a, b):
            fill.setdefault(first + (r - a) // each, []).append((offset + (r - a) % each * n, n))
            count[n] = count.get(n, 0) + 1
    assert count == histogram
    for slots in fill.values():
        at = 0
        for offset, n in sorted(slots):
            assert offset == at
            at += n
        assert at <= capacity
    _, _, many = binary_pack.best_fit_decreasing(np.array(lengths, np.int64), capacity)
    assert len(fill) == many  # the plan over counts is best-fit decreasing


def brute_pieces(tokenizer, rows, capacity):
    library, out = wordpiece.word_ids(tokenizer).library, []
    for doc_id, text in rows:
        ids = reference_ids(library, text) + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            out.append((doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_both_packers(frame, tokenizer, capacity):
    rows = [(1, "one two three"), (2, None), (3, ""), (4, "long word " * 3000), (5, "same"), (5, "same"), (None, "x y"),
            *((10 + k, "tie") for k in range(40))]
    packed = packing.best_fit_pack(frame(rows), tokenizer, capacity).toPandas()
    written = binary_pack.read_pieces(binary_pack.pack_matrices(frame(rows), tokenizer, capacity)).toPandas()
    assert written["resets"].all()
    for got in (packed, written):
        got["doc_id"] = got["doc_id"].astype(object).where(got["doc_id"].notna(), None)
        own = [(None if r[0] is None else int(r[0]), *map(int, r[1:])) for r in
               got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)]
        assert sorted(own, key=str) == brute_pieces(tokenizer, rows, capacity)
        for _, of in got.sort_values("offset").groupby("sequence_id"):
            assert (of["length"].cumsum() - of["length"] == of["offset"]).all()
            assert of["length"].sum() <= capacity


def test_empty_table(frame, tokenizer):
    assert packing.best_fit_pack(frame([]), tokenizer).count() == 0
    assert binary_pack.pack_matrices(frame([]), tokenizer).count() == 0


def test_hot_length_is_ranked_in_buckets(frame, tokenizer):
    pieces = packing.tokenize(frame([(k, "same text") for k in range(500)]), tokenizer)
    ranks = packing.rank_within(pieces, "length", ["doc_id", "piece"], 16).toPandas()["rank"]
    assert sorted(ranks) == list(range(500))
