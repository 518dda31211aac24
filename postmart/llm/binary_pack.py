"""Packed id matrices: best-fit decreasing with a segment tree over capacities.

Each task tokenizes its texts and packs them in blocks of a bounded number of ids, so nothing
is shuffled and a block is all that a task holds. Within a block pieces go by falling length to
the tightest open sequence; a segment tree whose leaves are amounts of free room (0 to capacity)
finds the smallest room that fits in log2(capacity) steps. One row is written per sequence:

* ``ids``: capacity ids as little-endian unsigned integers of ``id_bytes`` bytes, end padded with 0;
* ``cu_lengths``: cumulative segment lengths, from 0;
* ``positions``: capacity positions (two bytes each) that restart at 0 with each segment;
* ``doc_ids``, ``pieces``, ``starts``: where each segment comes from, so that overlong documents,
  cut at every capacity ids, can be put together again without loss.

Defined results: a null or empty text is its end id alone; repeated rows are written once each;
equal lengths keep input order; an empty table gives an empty table of the same schema; other
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packing import CAPACITY, END_ID, PIECES, token_pieces

BLOCK_IDS = 4_000_000

MATRIX = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("cu_lengths", T.ArrayType(T.IntegerType())), T.StructField("positions", T.BinaryType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("pieces", T.ArrayType(T.IntegerType())),
    T.StructField("starts", T.ArrayType(T.LongType()))])
PLACED = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()),
                       T.StructField("offset", T.LongType()), T.StructField("resets", T.BooleanType())])


class RoomTree:
    """Segment tree over amounts of room: counts of open sequences, and the smallest room of at least n."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of the tightest open sequence with room for ``need``."""
        count, i = self.count, need + self.leaves
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up to the first right-hand neighbour that has any
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:                        # down to its smallest room
                i <<= 1
                if not count[i]:
                    i += 1
        room = i - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()

    def _change(self, room: int, by: int) -> None:
        i, count = room + self.leaves, self.count
        while i:
            count[i] += by
            i >>= 1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every piece and the number of sequences."""
    tree, sequences = RoomTree(capacity), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        found = tree.take(need) if need < capacity else None
        if found is None:
            found, sequences = (capacity, sequences), sequences + 1
        room, s = found
        sequence[k], offset[k] = s, capacity - room
        if room > need:
            tree.add(room - need, s)
    return sequence, offset, sequences


def pack_matrices(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  id_bytes: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Rows of MATRIX for (doc_id, text). ``id_bytes`` is 2 for vocabularies of at most 65,536 ids, else 4."""
    if capacity > 65536:
        raise ValueError("positions are written in two bytes")

    def emit(block, first_sequence):
        doc = pa.concat_arrays([x[0] for x in block]).cast(pa.int64())
        piece, start, length = (np.concatenate([x[i] for x in block]) for i in (1, 2, 3))
        shift = np.cumsum([0, *(len(x[5]) for x in block)])
        place = np.concatenate([x[4] + s for x, s in zip(block, shift)])
        ids = np.concatenate([x[5] for x in block])
        if len(ids) and int(ids.max()) >= 1 << (8 * id_bytes):
            raise ValueError(f"the vocabulary has ids that {id_bytes} bytes do not hold")
        sequence, offset, many = best_fit_decreasing(length, capacity)
        order = np.lexsort((offset, sequence))
        sequence, offset, length, place = sequence[order], offset[order], length[order], place[order]
        first = np.searchsorted(sequence, np.arange(many + 1))
        for a in range(0, many, 512):
            b = min(a + 512, many)
            rows = slice(first[a], first[b])
            n = length[rows]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cell = np.repeat((sequence[rows] - a) * capacity + offset[rows], n) + inside
            matrix = np.zeros((b - a) * capacity, f"<u{id_bytes}")
            position = np.zeros((b - a) * capacity, "<u2")
            matrix[cell] = ids[np.repeat(place[rows], n) + inside]
            position[cell] = inside
            bounds = pa.array(first[a:b + 1] - first[a], pa.int32())
            per = np.diff(first[a:b + 1])
            ends = np.insert((offset + length)[rows], np.cumsum(per) - per, 0)  # each list begins with 0
            of = pa.array(np.concatenate(([0], np.cumsum(per + 1))), pa.int32())
            pick = pa.array(order[rows])
            yield pa.record_batch([
                pa.array(np.arange(a, b) + first_sequence, pa.int64()),
                pa.array([x.tobytes() for x in matrix.reshape(b - a, capacity)], pa.binary()),
                pa.ListArray.from_arrays(of, pa.array(ends, pa.int32())),
                pa.array([x.tobytes() for x in position.reshape(b - a, capacity)], pa.binary()),
                pa.ListArray.from_arrays(bounds, doc.take(pick)),
                pa.ListArray.from_arrays(bounds, pa.array(piece[order[rows]], pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(start[order[rows]], pa.int64()))], names=MATRIX.names)
        return many

    def run(batches):
        sequence, block, held = TaskContext.get().partitionId() << 40, [], 0
        for x in token_pieces(batches, tokenizer_path, capacity, end_id):
            block.append(x)
            held += len(x[5])
            if held >= block_ids:
                sequence += yield from emit(block, sequence)
                block, held = [], 0
        if block:
            yield from emit(block, sequence)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MATRIX)


def read_pieces(matrices: DataFrame, id_bytes: int = 2) -> DataFrame:
    """The segments of written matrices: their ids' CRC-32 and place, and whether positions restart right."""
    def run(batches):
        for batch in batches:
            out = []
            for s, ids, cu, pos, doc, piece, start in zip(*(c.to_pylist() for c in batch.columns)):
                row, at = np.frombuffer(ids, f"<u{id_bytes}"), np.frombuffer(pos, "<u2")
                raw = memoryview(row.astype("<u4")).cast("B")
                for k, (a, b) in enumerate(zip(cu, cu[1:])):
                    resets = bool((at[a:b] == np.arange(b - a)).all())
                    out.append((doc[k], piece[k], start[k], b - a, zlib.crc32(raw[4 * a:4 * b]), s, a, resets))
            columns = list(zip(*out)) or [[] for _ in PLACED]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                names=PLACED.names)
    return matrices.select(*MATRIX.names).mapInArrow(run, PLACED)
