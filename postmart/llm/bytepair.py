"""Byte-level BPE: texts to the ids of a rank file, and ids back to bytes.

Two tiers. Texts are cut into pre-tokens by the fixed pattern below, for a whole slice of texts
at once on the classes of their code points. A minimal perfect hash (hash and displace: one
displacement per bucket of about four keys, as many places as keys) then finds every pre-token
that is a vocabulary entry; the eight-byte words of the entry in the place found are compared
with the pre-token's, so a hit is exact. A pre-token that is no entry is merged from its bytes:
a doubly linked list of parts and a heap of (rank, start) of neighbouring parts, n log n for a
pre-token of n bytes, however long.

The vocabulary's tables are built once on the driver and broadcast: their size is that of the
rank file. Nothing is shuffled; a task holds one slice of texts (half a MiB, or one longer text).

Defined results: a null or empty text has no ids and decodes to no bytes; a null doc_id stays
null; repeated rows are encoded once each; an empty table gives an empty result; other columns
are ignored. Null ids decode to null, an id outside the vocabulary stops the job.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv

# Fixed value: the pattern of the pre-tokens, as the vocabularies' own library applies it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)

#: Pre-tokens outside the vocabulary kept by one Python worker; beyond it the table is begun anew.
MOST_KEPT = 400_000
#: Longer pre-tokens are merged each time: they seldom recur.
LONGEST_KEPT = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)  # masks of the first n bytes


def _words_of(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys as rows of little-endian eight-byte words, zero-padded, and their lengths."""
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    wide = -(-int(lengths.max()) // 8)
    raw = b"".join(k.ljust(8 * wide, b"\0") for k in keys)
    return np.frombuffer(raw, "<u8").reshape(len(keys), wide).astype(np.uint64), lengths


class PerfectHash:
    """Places 0 .. n-1 of n distinct keys, one each."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys share a 64-bit hash")
        self.n, self.buckets = n, max(n // 4, 1)
        self.shift = np.zeros(self.buckets, np.int64)  # tries of the bucket, or -1 - place for a single key
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(size) - size
        free = np.ones(n, bool)
        for b in np.argsort(-size, kind="stable").tolist():
            keys = hashes[order[first[b]:first[b] + size[b]]]
            if len(keys) < 2:
                break
            at = 0
            while True:
                tries = np.arange(at, at + 256)
                places = self._place(keys[:, None], tries[None, :])
                good = free[places].all(axis=0)
                rows = np.sort(places[:, good], axis=0)
                good = np.flatnonzero(good)[(rows[1:] != rows[:-1]).all(axis=0)]
                if len(good):
                    self.shift[b] = at + good[0]
                    free[places[:, good[0]]] = False
                    break
                at += 256
        single = np.flatnonzero(size == 1)
        self.shift[single] = -1 - np.flatnonzero(free)[:len(single)]

    def _place(self, hashes: np.ndarray, tries: np.ndarray) -> np.ndarray:
        return (tv.mix(hashes + tries.astype(np.uint64) * _STEP) % np.uint64(self.n)).astype(np.int64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each key; any place for what is no key."""
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._place(hashes, np.maximum(shift, 0)))


def _hash(words: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """A hash of keys given as successive words, each of the rows that reach that far."""
    h = tv.mix(words[0] + lengths.astype(np.uint64) * _STEP)
    for j, w in enumerate(words[1:], 1):
        far = lengths > 8 * j
        h[far] = tv.mix(h[far] * _STEP + w)
    return h


class Vocabulary:
    """Entries and ranks of a rank file, laid out in the places of the perfect hash."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs all 256 bytes")
        keys = list(ranks)
        words, lengths = _words_of(keys)
        hashes = _hash([words[lengths > 8 * j, j] for j in range(words.shape[1])], lengths)
        self.table = PerfectHash(hashes)
        place = self.table.places(hashes)
        self.words, self.lengths = np.empty_like(words), np.empty_like(lengths)
        self.words[place], self.lengths[place] = words, lengths
        self.ranks = np.empty(len(keys), np.int32)
        self.ranks[place] = list(ranks.values())
        by_rank = np.argsort(self.ranks)
        most = int(self.ranks.max()) + 1
        size = np.full(most, -1, np.int64)           # -1 marks a number that is no id
        size[self.ranks] = self.lengths
        start = np.zeros(most, np.int64)
        start[self.ranks[by_rank]] = np.cumsum(self.lengths[by_rank]) - self.lengths[by_rank]
        self.size, self.start = size, start
        self.bytes = np.frombuffer(b"".join(sorted(keys, key=ranks.get)), np.uint8)

    def by_bytes(self) -> dict[bytes, int]:
        raw = self.bytes.tobytes()
        return {raw[self.start[r]:self.start[r] + self.size[r]]: r for r in self.ranks.tolist()}


def load(path: str) -> Vocabulary:
    """A rank file: one base64 entry and its rank a line."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of a pre-token: again and again the neighbours of the lowest rank join, the leftmost of equals."""
    n = len(piece)
    after = list(range(1, n + 1))    # where the part that starts here ends
    before = list(range(-1, n))      # where the part in front of this one starts
    alive = bytearray(b"\1") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = after[i]
        if not alive[i] or middle >= n or after[middle] != end:
            continue  # a part of this pair has joined another meanwhile
        alive[middle] = 0
        after[i] = end
        if end < n:
            before[end] = i
            far = after[end]
            if far - i <= longest and (r := ranks.get(piece[i:far])) is not None:
                heapq.heappush(heap, (r, i, far))
        front = before[i]
        if front >= 0 and end - front <= longest and (r := ranks.get(piece[front:end])) is not None:
            heapq.heappush(heap, (r, front, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


_classes: list[np.ndarray] = []


def code_point_classes() -> np.ndarray:
    """Class of every code point, as the library's own regular expressions see letters, numbers and white space."""
    if not _classes:
        import tiktoken
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.zeros(0x110000, np.uint8)
        for mark, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
            found = tiktoken.Encoding("class", pat_str=pattern, special_tokens={},
                                      mergeable_ranks={bytes([b]): b for b in range(256)}).encode_ordinary(every)
            table[np.frombuffer(bytes(found).decode("utf-8").encode("utf-32-le"), "<u4")] = mark
        _classes.append(table)
    return _classes[0]


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the matches of PATTERN in each text, and the first match of each text (n + 1 entries).

    A match ends where the next one starts, the last of a text at its end: the pattern leaves nothing out.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kind = code_point_classes()[points]
    n = len(points)
    bounds = np.searchsorted(lead, offsets)
    first, last = tv.edges(bounds, n)
    space = kind == _SPACE
    begin = np.ones(n, bool)
    # A run of one class is one match, and takes one plain space in front of it along.
    begin[1:] = first[1:] | ((kind[1:] != kind[:-1]) & (space[1:] | (points[:-1] != 0x20)))
    # Before other characters, the last of several white space characters stands alone or joins them.
    begin[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~last[1:-1]
    # A quote that starts a match may start a contraction; what follows the contraction starts anew.
    quote = np.flatnonzero((points == 0x27) & begin)
    text_end = bounds[np.searchsorted(bounds, quote, side="right")]
    for ending in _CONTRACTIONS:
        end = quote + 1 + len(ending)
        hit = end <= text_end
        for j, letter in enumerate(ending, 1):
            hit[hit] = points[quote[hit] + j] == ord(letter)
        begin[quote[hit] + 1] = False
        end = end[hit & (end < text_end)]
        begin[end[kind[end] == _LETTER]] = True
    starts = np.flatnonzero(begin)
    return lead[starts], np.searchsorted(starts, bounds)


class Encoder:
    """One worker's encoder: the vocabulary, its entries by bytes, and the pre-tokens merged before."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ranks = vocabulary.by_bytes()
        self.longest = int(vocabulary.lengths.max())
        self.kept: dict[bytes, list[int]] = {}

    def _merged(self, piece: bytes) -> list[int]:
        got = self.kept.get(piece)
        if got is None:
            got = merge(piece, self.ranks, self.longest)
            if len(piece) <= LONGEST_KEPT:
                if len(self.kept) >= MOST_KEPT:
                    self.kept.clear()
                self.kept[piece] = got
        return got

    def _look_up(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The rank of each pre-token that is an entry, else -1."""
        wide = self.v.words.shape[1]
        padded = np.concatenate([data, np.zeros(8 * wide, np.uint8)])
        at = np.ndarray(len(data) + 8 * (wide - 1) + 1, "<u8", padded, strides=(1,))
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= self.longest)
        starts, lengths = starts[short], lengths[short]
        words = []
        for j in range(wide):
            far = lengths > 8 * j
            if not far.any():
                break
            words.append(at[starts[far] + 8 * j] & _KEEP[np.minimum(lengths[far] - 8 * j, 8)])
        if not words:
            return out
        place = self.v.table.places(_hash(words, lengths))
        same = self.v.lengths[place] == lengths
        for j, w in enumerate(words):
            far = np.flatnonzero(lengths > 8 * j)
            same[far] &= self.v.words[place[far], j] == w
        out[short[same]] = self.v.ranks[place[same]]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in (data, offsets)."""
        starts, at = pre_tokens(data, offsets)
        lengths = np.diff(np.append(starts, len(data)))
        found = self._look_up(data, starts, lengths)
        miss = np.flatnonzero(found < 0)
        raw = data.tobytes()
        parts = [self._merged(raw[a:b]) for a, b in zip(starts[miss].tolist(), (starts + lengths)[miss].tolist())]
        size = np.ones(len(starts), np.int64)
        size[miss] = [len(p) for p in parts]
        to = np.concatenate(([0], np.cumsum(size)))
        ids = np.repeat(found, size).astype(np.int32)
        ids[np.repeat(found < 0, size)] = [i for p in parts for i in p]
        return ids, to[at]


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The encoder of a broadcast vocabulary, one for each Python worker."""
    key = id(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def gather(v: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids, and the end of each id's bytes."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(v.size) or (v.size[ids] < 0).any()):
        raise ValueError("an id outside the vocabulary")
    size = v.size[ids]
    to = np.concatenate(([0], np.cumsum(size)))
    take = np.arange(to[-1]) + np.repeat(v.start[ids] - to[:-1], size)
    return v.bytes[take], to


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([*ENCODED, T.StructField("decoded", T.BinaryType())])


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the rank file

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared)
        for batch in batches:
            data, offsets = tv.strings(batch.column(1))
            for a, b in tv.slices(offsets):
                ids, at = encoder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
                yield pa.record_batch([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, ids): the bytes of the ids, one after another."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column(1)
            ids, offsets = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, to = gather(shared.value, ids.to_numpy(zero_copy_only=False))
            at = to[np.concatenate(([0], np.cumsum(offsets)))].astype(np.int64)
            mask = pa.array(~lists.is_valid().to_numpy(zero_copy_only=False))
            out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists),
                                                   [None, pa.py_buffer(at), pa.py_buffer(data.tobytes())])
            out = pc.if_else(mask, pa.scalar(None, pa.large_binary()), out).cast(pa.binary())
            yield pa.record_batch([batch.column(0), lists, out], names=["doc_id", "ids", "decoded"])
    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, DECODED)
