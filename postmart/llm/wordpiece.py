"""Token ids of many texts with a public ``tokenizers`` file, encoding each distinct word part once.

The tokenizer splits a text at white space and at every change between letters and other
characters before it merges, so equal parts always get equal ids. Texts are cut at such
places on their bytes, the library encodes the parts not seen before, and the ids of a text
are gathered by table lookup. Cuts are made only where the tokenizer is certain to cut:

* at ASCII white space in every text;
* in texts of ASCII and Latin letters (U+00C0 to U+017F) also between letters and other
  characters, but never beside an apostrophe (contractions); there ASCII case is folded,
  as the tokenizer itself folds it. Texts with other characters, where composition may
  depend on case, are cut at white space only;
* texts with the mark of a special token go to the library whole.

The ids are those of ``encode(text, add_special_tokens=False)``; tests compare both.
"""

from __future__ import annotations

import numpy as np

from . import textvec as tv

#: Distinct parts kept by one Python worker; beyond it the table is begun anew.
MOST_PARTS = 1_000_000

_SPACE = ~tv.SOLID
_LETTER = tv.byte_class((0x41, 0x5A), (0x61, 0x7A))
_cache: dict[str, "WordIds"] = {}


def word_ids(path: str) -> "WordIds":
    """The encoder of a tokenizer file, one for each Python worker."""
    if path not in _cache:
        _cache[path] = WordIds(path)
    return _cache[path]


class WordIds:
    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        probes = ["the", "zq", "abcdefghijklmnopqrstuvwxyz"]
        self.plain = all(self._model(x) == self.library.encode(x, add_special_tokens=False).ids for x in probes)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)      # sorted hashes of known parts
        self.place = np.zeros((0, 2), np.int64)  # start and length in self.ids
        self.ids = np.zeros(0, np.int32)

    def _model(self, part: str) -> list[int]:
        return [t.id for t in self.library.model.tokenize(part)]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        raw = data.tobytes()
        parts = [raw[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
        # A part of a to z is not changed by any step before the merges: ask the model itself.
        direct = [self.plain and p.isascii() and p.isalpha() and p.islower() for p in parts]
        rest = iter(self.library.encode_batch_fast([p for p, d in zip(parts, direct) if not d],
                                                   add_special_tokens=False))
        got = [self._model(p) if d else next(rest).ids for p, d in zip(parts, direct)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for x in got for i in x), np.int32, int(size.sum()))
        place = np.stack([len(self.ids) + np.cumsum(size) - size, size], 1)
        self.ids = np.concatenate([self.ids, flat])
        order = np.argsort(keys)
        keys, place = keys[order], place[order]
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, place, axis=0)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in (data, offsets); call it on slices of bounded size."""
        special = self._special(data, offsets)
        ids, at = self._encode(data, offsets)
        if not special.any():
            return ids, at
        raw, out = data.tobytes(), []
        for i in range(len(special)):
            if special[i]:
                text = raw[offsets[i]:offsets[i + 1]].decode("utf-8")
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32))
            else:
                out.append(ids[at[i]:at[i + 1]])
        return np.concatenate(out), np.concatenate(([0], np.cumsum([len(x) for x in out])))

    @staticmethod
    def _special(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that hold '<|', with which every special token begins."""
        hits = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) > 1 else np.zeros(0, int)
        found = np.zeros(len(offsets) - 1, bool)
        found[np.searchsorted(offsets, hits, side="right") - 1] = True
        return found

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, docs = len(data), len(offsets) - 1
        if not n:
            return np.zeros(0, np.int32), np.zeros(docs + 1, np.int64)
        lead = (data >= 0xC3) & (data <= 0xC5)
        tail = np.zeros(n, bool)
        tail[1:] = lead[:-1]
        latin = lead | tail
        sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))  # the signs of times and division
        latin[sign] = latin[sign + 1] = False
        dotted = np.flatnonzero((data[:-1] == 0xC4) & (data[1:] == 0xB0))  # in lower case a letter and a combining mark
        latin[dotted] = latin[dotted + 1] = False
        strange = (data >= 0x80) & ~latin
        simple = tv.sums(strange, offsets) == 0
        simple = np.repeat(simple, np.diff(offsets))
        solid = tv.SOLID[data]
        letter = _LETTER[data] | latin
        first, _ = tv.edges(offsets, n)
        begin = np.zeros(n, bool)
        begin[1:] = solid[1:] & ~solid[:-1]
        quote = data == 0x27
        change = (letter[1:] != letter[:-1]) & ~quote[1:] & ~quote[:-1] & simple[1:]
        begin[1:] |= change & solid[1:] & solid[:-1]
        begin |= first & solid
        stop = solid.copy()  # a part ends before the next one, before white space and at the end of a text
        stop[:-1] &= ~solid[1:] | begin[1:] | first[1:]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        folded = np.where(simple, tv.LOWER[data], data)
        keys = tv.span_hashes(folded, starts, ends)
        distinct, where, inverse = _distinct(keys)
        if len(self.keys) + len(distinct) > MOST_PARTS:
            self._reset()
        known = np.searchsorted(self.keys, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = known < len(self.keys)
        fresh[inside] = self.keys[known[inside]] != distinct[inside]
        if fresh.any():
            new = where[fresh]
            self._learn(folded, starts[new], ends[new], distinct[fresh])
            known = np.searchsorted(self.keys, distinct)
        place = self.place[known][inverse]
        size = place[:, 1]
        to = np.concatenate(([0], np.cumsum(size)))
        take = np.arange(to[-1]) + np.repeat(place[:, 0] - to[:-1], size)
        return self.ids[take], to[np.searchsorted(starts, offsets)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each and the number of each key's value, by hashing."""
    import pandas as pd
    inverse, distinct = pd.factorize(keys)
    where = np.zeros(len(distinct), np.int64)
    where[inverse] = np.arange(len(keys))
    return distinct, where, inverse
