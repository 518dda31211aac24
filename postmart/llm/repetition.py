"""Quality rules on repetition within a text, from a suffix array over its words.

Suffixes are sorted by prefix doubling for a slice of texts at once (ranks never compare
suffixes of different texts); the ranks of each doubling give the longest common prefixes of
neighbours. Intervals of the LCP array are the right-maximal repeats, those whose occurrences
are preceded by different words are maximal. The union of all their spans is the union of
[i, i + longest repeat at i), which is how it is taken.

A text is kept unless the base rules fail it, its repeats of at least ``min_repeat`` words
cover more than ``most_covered`` of its words, or its longest repeat has more than
``most_longest`` words.

Every word in a repeat of 8 words is also in a repeat of 3, so a covered fraction near that of the
base rules (half of the words) would reject nothing they keep. Its limit is half of theirs: three
equal words in a row come up by themselves, in names and idioms, while eight are nearly always
copied, so a text may have fewer of them. The limit follows from that, not from any table.

Defined results: a null or empty text has no words, which fails the base rules; rows are
independent of each other (repeated rows give repeated results, a null doc_id stays null);
an empty table gives an empty result; other columns are ignored. Long texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

MIN_REPEAT = 8
MOST_COVERED = 0.25
MOST_LONGEST = 128
SYMBOLS = tv.byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, longest_repeat long, covered_words long, n_maximal_repeats long")


def suffix_array(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, LCP with the one before in the same text, word codes).

    ``words`` are codes or hashes of the words of several texts, text t at at[t]:at[t+1].
    """
    n = len(words)
    code = pd.factorize(words)[0].astype(np.int64)
    size = np.diff(at)
    doc, end = np.repeat(np.arange(len(size)), size), np.repeat(at[1:], size)
    key = doc * (code.max(initial=0) + 1) + code
    order = np.argsort(key)
    start = np.ones(n, bool)
    start[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    levels = [rank]
    alone = start & np.append(start[1:], True)
    active, h = order[~alone], 1
    while len(active):
        rank = rank.copy()
        after = active + h
        inside = after < end[active]
        second = np.zeros(len(active), np.int64)
        second[inside] = levels[-1][after[inside]] + 1
        key = levels[-1][active] * (n + 1) + second
        order = np.argsort(key)
        active, key = active[order], key[order]
        first = levels[-1][active]
        head = np.ones(len(active), bool)
        head[1:] = first[1:] != first[:-1]
        place = np.arange(len(active))
        base = np.maximum.accumulate(np.where(head, place, 0))
        start = np.ones(len(active), bool)
        start[1:] = key[1:] != key[:-1]
        rank[active] = first + np.maximum.accumulate(np.where(start, place, 0)) - base
        levels.append(rank)
        active = active[~(start & np.append(start[1:], True))]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]]) + 1
    a, b = suffixes[pair - 1], suffixes[pair]
    length = np.zeros(len(pair), np.int64)
    for j in range(len(levels) - 2, -1, -1):
        x, y = a + length, b + length
        some = np.flatnonzero((x < end[a]) & (y < end[b]))
        same = some[levels[j][x[some]] == levels[j][y[some]]]
        length[same] += 1 << j
    lcp[pair] = length
    return suffixes, lcp, code


def longest_repeats(suffixes: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each position the length of the longest string that begins there and occurs elsewhere in its text."""
    out = np.zeros(len(suffixes), np.int64)
    out[suffixes] = lcp
    out[suffixes[:-1]] = np.maximum(out[suffixes[:-1]], lcp[1:])
    return out


def covered(positions: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Marks of the union of [p, p + length) for distinct positions."""
    change = -np.bincount(positions + lengths, minlength=n + 1)
    change[positions] += 1
    return np.cumsum(change[:n]) > 0


def lcp_intervals(suffixes: np.ndarray, lcp: np.ndarray, code: np.ndarray, at: np.ndarray, least: int):
    """Maximal repeats of at least ``least`` words: (length, first and last place in the suffix array)."""
    n = len(suffixes)
    begins = np.zeros(n + 1, bool)
    begins[at[:-1][at[1:] > at[:-1]]] = True
    before = np.where(begins[suffixes], -1 - suffixes, code[suffixes - 1])
    change = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    deep = lcp >= least
    runs = np.flatnonzero(np.diff(np.concatenate(([False], deep, [False])).astype(np.int8)))
    for a, b in zip(runs[::2].tolist(), runs[1::2].tolist()):  # lcp[a:b] is deep; its suffixes are a-1 to b-1
        stack: list[tuple[int, int]] = []
        for k, length in enumerate([*lcp[a:b].tolist(), 0], a):
            left = k - 1
            while stack and stack[-1][0] > length:
                deeper, left = stack.pop()
                if change[k - 1] > change[left]:
                    yield deeper, left, k - 1
            if length and (not stack or stack[-1][0] < length):
                stack.append((length, left))


def measure(data: np.ndarray, offsets: np.ndarray, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts of every text of a slice, by column name."""
    docs = len(offsets) - 1
    solid = tv.SOLID[data]
    starts, ends, at = tv.runs(solid, offsets)
    words = tv.span_hashes(data, starts, ends)
    n = len(words)
    out = {"n_words": np.diff(at), "word_chars": tv.sums(solid & ((data & 0xC0) != 0x80), offsets),
           "n_symbols": tv.sums(SYMBOLS[data], offsets)}
    a, b, first = tv.runs(data != 0x0A, offsets)
    full = tv.sums(solid, np.stack([a, b], 1).ravel())[::2] > 0 if len(a) else np.zeros(0, bool)
    line_doc = np.repeat(np.arange(docs), np.diff(first)).astype(np.uint64)
    again = pd.Series(tv.mix(tv.span_hashes(data, a, b) + tv.mix(line_doc))).duplicated().to_numpy()
    out["n_dup_lines"] = tv.sums(full & again, first)
    if not n:
        zero = np.zeros(docs, np.int64)
        return out | dict.fromkeys(("n_repeat_words", "longest_repeat", "covered_words", "n_maximal_repeats"), zero)
    suffixes, lcp, code = suffix_array(words, at)
    longest = longest_repeats(suffixes, lcp)
    out["n_repeat_words"] = tv.sums(covered(np.flatnonzero(longest >= 3), 3, n), at)
    deep = np.flatnonzero(longest >= min_repeat)
    doc = np.repeat(np.arange(docs), np.diff(at))
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, doc[deep], longest[deep])
    found = [left for _, left, _ in lcp_intervals(suffixes, lcp, code, at, min_repeat)]
    return out | {"longest_repeat": top, "covered_words": tv.sums(covered(deep, longest[deep], n), at),
                  "n_maximal_repeats": np.bincount(doc[suffixes[np.array(found, np.int64)]], minlength=docs)}


def repetition_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, most_covered: float = MOST_COVERED,
                     most_longest: int = MOST_LONGEST) -> DataFrame:
    """Counts and verdict for every row of (doc_id, text)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            data, offsets = tv.strings(batch.column(1))
            for a, b in tv.slices(offsets):
                x = measure(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], min_repeat)
                x["base_failed"] = (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
                x["kept"] = ~(x["base_failed"] | (x["covered_words"] > most_covered * x["n_words"])
                              | (x["longest_repeat"] > most_longest))
                x["doc_id"] = batch.column(0).slice(a, b - a)
                yield pa.record_batch([pa.array(x[c]) for c in names], names=names)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
