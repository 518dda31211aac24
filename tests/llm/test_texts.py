"""Repetition rules, near duplicates, decontamination: against brute force."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import regex

from hypothesis import given, settings
from hypothesis import strategies as st

from postmart.llm import contamination, near_dup, repetition
from postmart.llm import textvec as tv

def words_of(t):
    return regex.findall(r"[\p{L}\p{N}\p{M}]+", (t or "").casefold())


def brute_repetition(t, least):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = len(w)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = collections.Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    marked, longest, covered, places = [False] * n, [0] * n, [False] * n, collections.defaultdict(list)
    for i in range(n):
        if i < n - 2 and triples[tuple(w[i:i + 3])] > 1:
            marked[i:i + 3] = [True] * 3
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            longest[i] = max(longest[i], k)
        if longest[i] >= least:
            covered[i:i + longest[i]] = [True] * longest[i]
        for k in range(least, longest[i] + 1):
            places[tuple(w[i:i + k])].append(i)
    maximal = sum(len({w[i - 1] if i else None for i in p}) > 1 and
                  len({w[i + len(s)] if i + len(s) < n else None for i in p}) > 1 for s, p in places.items())
    return [n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(marked),
            max((x for x in longest if x >= least), default=0), sum(covered), maximal]


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "covered_words",
         "n_maximal_repeats"]


@pytest.mark.parametrize("most", [200, 1 << 20])
def test_repetition_counts(most):
    rnd = random.Random(0)
    texts = ["", None, " \n ", "a", "a a a a a a a a", *(
        "".join(rnd.choice(["a", "b", "é", " ", " ", "\n", "#"]) for _ in range(rnd.randint(0, 120))) for _ in range(150))]
    data, offsets = tv.strings(pa.array(texts))
    for a, b in tv.slices(offsets, most):
        x = repetition.measure(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], 3)
        for i in range(a, b):
            assert [int(x[c][i - a]) for c in NAMES] == brute_repetition(texts[i], 3), texts[i]


def test_repetition_verdict(frame):
    words = [f"w{k}" for k in range(3000)]
    clean = " ".join(words[:200])
    passage = " ".join(words[200:340])
    rows = [(1, clean), (2, None), (3, ""), (4, clean + " " + passage + " and " + passage), (5, " ".join(words[:9] * 40)),
            (6, clean), (6, clean), (None, clean), (7, " ".join(words) + "\n" + clean)]
    got = {(r.doc_id, r.n_words): r for r in repetition.repetition_rules(frame(rows)).collect()}
    assert got[1, 200].kept and got[6, 200].kept and got[None, 200].kept
    assert not got[2, 0].kept and got[2, 0].base_failed and got[3, 0].base_failed
    assert not got[4, 481].kept and got[4, 481].longest_repeat == 140
    assert got[5, 360].base_failed and not got[5, 360].kept
    assert repetition.repetition_rules(frame([])).count() == 0


def test_covered_fraction_alone_rejects(frame):
    """A passage of 100 words said four times in 1,000 passes the base rules and the limit on one repeat."""
    own = [f"w{k}" for k in range(600)]
    passage = [f"p{k}" for k in range(100)]

    def text(times):
        return " ".join(w for k in range(6) for w in own[100 * k:100 * k + 100] + passage * (k < times))
    rows = [(1, text(4)), (2, text(2)), (3, text(0)), (4, text(4) + " " + " ".join(f"t{k}" for k in range(600)))]
    got = {r.doc_id: r for r in repetition.repetition_rules(frame(rows)).collect()}
    assert not got[1].base_failed and got[1].longest_repeat == 100 and got[1].covered_words == 400 and not got[1].kept
    assert got[2].covered_words == 200 and not got[2].base_failed and got[2].kept == (200 <= repetition.MOST_COVERED * 800)
    assert got[3].kept and got[4].kept and got[4].covered_words == 400


def shingle_sets(rows):
    out = []
    for _, t in rows:
        w = words_of(t)
        said = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or collections.Counter([tuple(w)] if w else [])
        out.append((tuple(w) or ("raw", t or ""), {k: 1 + math.log2(n) / 4 for k, n in said.items()}))
    return out


def probability_jaccard(x, y):
    """The definition, term by term; only for sets that could reach 0.8."""
    common = x.keys() & y.keys()
    if len(common) < 0.5 * max(len(x), len(y)):
        return 0.0  # the test texts say few shingles more than once
    every = [(x.get(e, 0), y.get(e, 0)) for e in x.keys() | y.keys()]
    return sum(1 / sum(max(a / x[d], b / y[d]) for a, b in every) for d in common)


def brute_classes(rows):
    own, root = shingle_sets(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (k, s) in enumerate(own):
        for j in range(i):
            q, r = own[j]
            if k == q or (s and r and probability_jaccard(s, r) >= 0.8 - 1e-9):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values())


def edited(rnd, words, n):
    words = list(words)
    for i in rnd.sample(range(len(words)), n):
        words[i] = f"x{rnd.randint(0, 10 ** 6)}"
    return " ".join(words)


def test_a_line_said_often_makes_no_duplicates(frame):
    """Texts that share one line of hundreds of repeats and little else are not near duplicates."""
    rnd = random.Random(9)
    line = " ".join(["ha ho hi hu he"] * 300)
    rows = [(k, line + " " + " ".join(f"u{rnd.randint(0, 10 ** 6)}" for _ in range(60))) for k in range(30)]
    assert {r.class_size for r in near_dup.near_duplicates(frame(rows)).collect()} == {1}


def near_rows():
    rnd = random.Random(3)
    rows = [(0, None), (1, ""), (2, "!!"), (3, "??"), (4, "one two"), (5, "One, two!"), (6, "one two three"), (7, "!!")]
    for base in range(4):  # copies of copies, so that classes are more than stars
        words = [f"v{rnd.randint(0, 3000)}" for _ in range(150)]
        own = [words]
        for _ in range(25):
            own.append(edited(rnd, rnd.choice(own[-5:]), rnd.choice([1, 2, 3, 12])).split())
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate(own)]
    rows += [(len(rows), "long " + " ".join(f"q{k}" for k in range(30000)))]
    return rows + [rows[10], rows[10]]


def test_near_duplicates(frame):
    rows = near_rows()
    got = collections.defaultdict(list)
    for r in near_dup.near_duplicates(frame(rows)).collect():
        got[r.class_id].append(r.doc_id)
    assert sorted(sorted(map(str, g)) for g in got.values()) == brute_classes(rows)
    kept = near_dup.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(got)
    assert near_dup.near_duplicates(frame([])).count() == 0


def test_near_duplicates_without_ids(frame):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "other words here"), (None, "alone")]
    assert near_dup.keep_one(frame(rows)).count() == 3
    assert sorted(r.class_size for r in near_dup.near_duplicates(frame(rows)).collect()) == [1, 1, 2, 2]


def test_what_a_text_says_all_over_counts(frame):
    """A passage said 256 times makes another document; one that a tenth of the text is made of does not."""
    rnd = random.Random(11)
    rows, want = [], []
    for k in range(8):
        body = [f"b{k}x{rnd.randint(0, 10 ** 6)}" for _ in range(404)]
        passage = [f"p{k}x{rnd.randint(0, 10 ** 6)}" for _ in range(90)]
        rows += [(3 * k, " ".join(body)), (3 * k + 1, " ".join(body + passage * 256)), (3 * k + 2, " ".join(body + passage[:30] * 2))]
        want += [sorted([str(3 * k), str(3 * k + 2)]), [str(3 * k + 1)]]
    assert brute_classes(rows) == sorted(want)
    got = collections.defaultdict(list)
    for r in near_dup.near_duplicates(frame(rows)).collect():
        got[r.class_id].append(str(r.doc_id))
    assert sorted(map(sorted, got.values())) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.sampled_from([1, 1.25, 2, 3]), min_size=1),
       st.dictionaries(st.integers(0, 12), st.sampled_from([1, 1.25, 2, 3]), min_size=1))
def test_probability_jaccard_by_running_sums(x, y):
    def arrays(m):
        keys = sorted(m)
        return np.array(keys, np.uint64), np.array([m[k] for k in keys], float)
    common = x.keys() & y.keys()
    every = [(x.get(e, 0), y.get(e, 0)) for e in x.keys() | y.keys()]
    want = sum(1 / sum(max(a / x[d], b / y[d]) for a, b in every) for d in common)
    assert near_dup.similarity(arrays(x), arrays(y)) == pytest.approx(want)


def test_words_of_any_script_without_case(frame):
    text = "École Überraschung straße “quoted words” and\u00a0more — naïve 中文 words here, 12½ e\u0301tude of ten"
    other = text.upper().replace("“", "'").replace("”", "'").replace("\u00a0", "  ").replace("—", "...")
    data, offsets = tv.strings(pa.array([text, other, "plain ASCII", "Plain, ascii!"]))
    hashes, at = tv.word_hashes(data, offsets)
    split = [hashes[a:b].tolist() for a, b in zip(at, at[1:])]
    assert split[0] == split[1] and split[2] == split[3] and [len(x) for x in split[::2]] == [len(words_of(text)), 2]
    ascii_only = tv.word_hashes(*tv.strings(pa.array(["plain ASCII"])))[0].tolist()
    assert ascii_only == split[2]


def test_regular_texts_share_no_hash():
    """Strings on which polynomials modulo a power of two agree."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    for n in (64, 512, 1024, 2048, 4096):
        data, offsets = tv.strings(pa.array([a[:n], b[:n], a[:n]]))
        x, y, z = tv.span_hashes(data, offsets[:-1], offsets[1:]).tolist()
        assert x == z != y


def test_signatures_estimate_probability_jaccard():
    rnd = random.Random(1)
    texts = []
    for n, e in ((600, 0), (600, 10), (600, 30), (3000, 20), (90, 3)):
        a = [f"v{rnd.randint(0, 5000)}" for _ in range(n)]
        texts += [" ".join(a * (3 if n == 90 else 1)), edited(rnd, a * (3 if n == 90 else 1), e)]
    data, offsets = tv.strings(pa.array(texts))
    hashes, first, _, _ = near_dup.shingles(data, offsets)
    h, w, first = near_dup.weighted(hashes, first)
    own = [(h[i:j], w[i:j]) for i, j in zip(first, first[1:])]
    signs = near_dup.prob_min_hash(h, w, first)
    for k in range(0, len(texts), 2):
        wa, wb = (dict(zip(h[first[j]:first[j + 1]].tolist(), w[first[j]:first[j + 1]].tolist())) for j in (k, k + 1))
        want = sum(1 / sum(max(wa.get(q, 0) / wa[i], wb.get(q, 0) / wb[i]) for q in {*wa, *wb})
                   for i in {*wa} & {*wb}) if len(wa) < 700 else None
        close = near_dup.similarity(own[k], own[k + 1])
        if want is not None:
            assert close == pytest.approx(want)
            assert abs((signs[k] == signs[k + 1]).mean() - want) < 0.13


def brute_tiles(doc, item, least):
    """Greedy string tiling by looking at every pair of places."""
    marked_doc, marked_item, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while (i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k]
                       and not marked_doc[i + k] and not marked_item[j + k]):
                    k += 1
                if k > best[0]:
                    best = (k, j, i)
        k, j, i = best
        if k < least:
            return total
        marked_doc[i:i + k], marked_item[j:j + k] = [True] * k, [True] * k
        total += k


def test_tiles_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        doc = [rnd.randint(1, 3) for _ in range(rnd.randint(0, 30))]
        item = [rnd.randint(1, 3) for _ in range(rnd.randint(0, 20))]
        tiles = contamination.tile(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        assert sum(n for n, _, _ in tiles) == brute_tiles(doc, item, 3)
        for n, j, i in tiles:
            assert doc[i:i + n] == item[j:j + n]


def test_contamination(frame, spark):
    item = [f"t{k}" for k in range(40)]
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "too short"), (None, ""), (7, "x " * 3)],
                                  "item_id long, text string")
    other = " ".join(f"o{k}" for k in range(300))
    turned = " ".join(item[20:40]) + " " + other + " " + " ".join(item[:20])
    rows = [(1, other + " " + " ".join(item)), (2, turned), (3, other), (4, None), (5, ""), (6, " ".join(item[:15])),
            (1, other + " " + " ".join(item)), (None, " ".join(item).upper()), (8, "z " * 50000 + " ".join(item))]
    got = sorted(((r.doc_id, r.item_id, r.coverage, r.n_tiles) for r in
                  contamination.contaminated(frame(rows), items).collect()), key=str)
    assert got == sorted([(1, 7, 1.0, 1), (1, 7, 1.0, 1), (2, 7, 1.0, 2), (None, 7, 1.0, 1), (8, 7, 1.0, 1)], key=str)
    kept = contamination.drop_contaminated(frame(rows), items)
    assert kept.columns == frame(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert contamination.contaminated(frame([]), items).count() == 0
    assert contamination.contaminated(frame(rows), items.limit(0)).count() == 0


def test_repetitive_items_equal_brute_force(frame, spark):
    """Items whose distinct windows are few: words, lists and refrains said again and again."""
    rnd = random.Random(7)
    texts = ["ja " * 40, "la li lu " * 14, "0 1 0 0 " * 12, "so it goes and on it goes again " * 11 + "the end",
             " ".join(rnd.choice("ab") for _ in range(60)), " ".join(f"u{k}" for k in range(30))]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    other = " ".join(f"o{k}" for k in range(50))
    rows = [(k, f"{other} {t} {other}") for k, t in enumerate(texts)]
    rows += [(10 + k, " ".join(t.split()[:len(t.split()) * part // 100])) for k, t in enumerate(texts) for part in (45, 55)]
    rows += [(20, "ja " * 19), (21, "ja " * 20), (22, other), (23, f"ja ja ja ja ja {other} " * 4)]
    want = set()
    for i, t in rows:
        for k, item in enumerate(texts):
            n = brute_tiles(t.split(), item.split(), contamination.SEED)
            if n >= contamination.THRESHOLD * len(item.split()):
                want.add((i, k, n, len(t)))
    length = collections.Counter((i, len(t)) for i, t in rows)
    got = [(r.doc_id, r.item_id, r.matched_words) for r in contamination.contaminated(frame(rows), items).collect()]
    assert sorted(got) == sorted((i, k, n) for i, k, n, size in want for _ in range(length[i, size]))
    assert {(k, k) for k in range(len(texts))} <= {(i, k) for i, k, _, _ in want}


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_common_strings_in_slices(most):
    """Whatever the slices, all maximal common strings; a long run of one word against another takes little memory."""
    rnd = random.Random(13)
    for _ in range(150):
        doc, item = ([rnd.randint(1, 2) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        want = []
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
                    n += 1
                if n >= 3 and not (i and j and doc[i - 1] == item[j - 1]):
                    want.append((n, j, i))
        got = contamination.common_strings(np.array(doc, np.uint64), np.array(item, np.uint64), 3, most)
        assert sorted(got) == sorted(want)
    if most > 100:
        one = np.ones(20000, np.uint64)
        assert len(contamination.common_strings(one, one[:2000], 5)) == 20000 + 2000 - 2 * 5 + 1
