"""Word runs and rolling hashes of many texts at once, on the UTF-8 bytes of an Arrow array.

Everything here runs inside a task, on slices of a bounded number of bytes, so memory does
not depend on the size of a partition. Hashes are 64 bit and chain a scrambling step over
eight bytes at a time (no polynomial, whose structure regular texts can meet); two different
words or word windows share one with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 19
_STEP = U64(0xD1342543DE82EF95)
_LENGTH = U64(0x9E3779B97F4A7C15)
#: Longer spans are hashed one by one by a library function.
LONG_SPAN = 1024
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)  # masks of the first n bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges (a, b) of at most ``most`` bytes each; one longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table


#: Words of [^\x20\x09-\x0D]+ (no white space); ASCII letters and digits.
SOLID = ~byte_class((0x09, 0x0D), (0x20, 0x20))
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def edges(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the first and of the last byte of each text."""
    first, last = np.zeros(size, bool), np.zeros(size, bool)
    full = offsets[1:] > offsets[:-1]
    first[offsets[:-1][full]] = True
    last[offsets[1:][full] - 1] = True
    return first, last


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes inside each text: starts, ends, and the first run of each text."""
    if not len(mask):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first, last = edges(offsets, len(mask))
    before, after = np.empty_like(mask), np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    after[-1], after[:-1] = False, mask[1:]
    starts = np.flatnonzero(mask & (first | ~before))
    ends = np.flatnonzero(mask & (last | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every span."""
    size = ends - starts
    h = mix(size.astype(U64) * _LENGTH + _STEP)
    if not len(starts):
        return h
    at = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    active, done = np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(active):
        left = size[active] - done
        h[active] = mix(h[active] * _STEP + (at[starts[active] + done] & _KEEP[np.minimum(left, 8)]))
        done += 8
        active = active[left > 8]
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        h[i] = U64(int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little"))
    return h


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points belong to words: letters, digits and the marks that combine with them."""
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text in order, and the first word of each text (n + 1 entries).

    Words are runs of letters, digits and combining marks of any script, compared without case.
    """
    if (data < 0x80).all():
        folded, solid = LOWER[data], ALNUM[data]
    else:
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8").casefold().encode("utf-8") for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        folded = np.frombuffer(b"".join(texts), np.uint8)
        points = np.frombuffer(folded.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((folded & 0xC0) != 0x80)
        solid = np.repeat(_letter_table()[points], np.diff(np.append(lead, len(folded))))
    starts, ends, at = runs(solid, offsets)
    return span_hashes(folded, starts, ends), at


def windows(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k-word window inside a text: (hashes, first word of each, first window per text)."""
    n = len(words)
    size = np.maximum(np.diff(at) - k + 1, 0)
    first = np.concatenate(([0], np.cumsum(size)))
    if not first[-1]:
        return np.zeros(0, U64), np.zeros(0, np.int64), first
    h = np.zeros(n - k + 1, U64)
    for j in range(k):
        h = h * _STEP + words[j:n - k + 1 + j]
    where = np.arange(first[-1]) + np.repeat(at[:-1] - first[:-1], size)
    return mix(h[where]), where, first


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between successive bounds."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]
