"""Token ids of whole texts from the ids of their distinct pieces.

Byte-level BPE never joins across a space that stands before something other than white space:
a run of white space leaves its last space to the word after it.  Texts are therefore cut at
those spaces, each distinct piece is encoded once (with the space before it), and the texts'
ids are gathered from the pieces' ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD_SPACE = re.compile(r" (?=\s|\Z)")
_CUT_SPACE = re.compile(r" (?=\S)")


class _Generation:
    """Pieces and their ids, end to end in one growing array."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.ids = np.zeros(8192, np.uint32)
        self.used = 0

    def add(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.index)
        for name, need in (("start", n + len(pieces)), ("size", n + len(pieces)), ("ids", self.used + len(flat))):
            a = getattr(self, name)
            if len(a) < need:
                setattr(self, name, np.concatenate([a, np.zeros(max(need - len(a), len(a) // 2), a.dtype)]))
        self.start[n : n + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(pieces)] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.index.update(zip(pieces, range(n, n + len(pieces))))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces end to end, and how many each has."""
        size, start = self.size[at], self.start[at]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.repeat(start - total[:-1], size) + np.arange(total[-1])], size


class PieceEncoder:
    """Ids of texts; ``whole`` encodes texts, ``following`` pieces that a space comes before (it
    returns their ids end to end, and how many each has).

    It remembers the pieces of the last two generations of ``cached`` pieces, so memory is
    bounded and frequent pieces stay.  Texts that hold a special string are encoded whole.
    """

    def __init__(self, whole: Callable[[list[str]], list[np.ndarray]], following: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: list[str], cached: int) -> None:
        self.whole, self.following, self.special, self.cached = whole, following, special, cached
        self.forget()

    def forget(self) -> None:
        """Give the memory of all pieces back."""
        self.now, self.before = _Generation(), _Generation()

    def _lookup(self, pieces: list[str]) -> np.ndarray:
        if len(self.now.index) > self.cached:
            self.now, self.before = _Generation(), self.now
        known = self.now.index.get
        place = np.array([known(p, -1) for p in pieces], np.int64)
        missing = np.flatnonzero(place < 0)
        earlier = self.before.index.get
        before = np.array([earlier(pieces[k], -1) for k in missing.tolist()], np.int64)
        for rows, coded in ((missing[before >= 0], self.before.gather), (missing[before < 0], None)):
            some = [pieces[k] for k in rows.tolist()]
            place[rows] = len(self.now.index) + np.arange(len(rows))  # where add puts them: they are distinct
            self.now.add(some, *(coded(before[before >= 0]) if coded else self.following(some)))
        return place

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        apart = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        for i, ids in zip(apart, self.whole([texts[i] for i in apart]) if apart else ()):
            out[i] = ids
        left = [i for i in range(len(texts)) if out[i] is None]
        odd = {i: _CUT_SPACE.split(texts[i]) for i in left if _ODD_SPACE.search(texts[i])}
        even = [i for i in left if i not in odd]
        lists = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
        bounds = np.concatenate([lists.offsets.to_numpy().astype(np.int64), np.cumsum([len(odd[i]) for i in odd], dtype=np.int64) + len(lists.values)])
        values = pa.concat_arrays([lists.values, pa.array([p for i in odd for p in odd[i]], pa.large_string())])
        rows = even + list(odd)
        if not rows:
            return out
        heads = self.whole(values.take(pa.array(bounds[:-1])).to_pylist())
        rest = np.ones(len(values), bool)
        rest[bounds[:-1]] = False
        coded = values.filter(pa.array(rest)).dictionary_encode()
        place = self._lookup(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        flat, size = self.now.gather(place)
        total = np.concatenate([[0], np.cumsum(size)])
        cut = total[bounds - np.arange(len(bounds))]
        for i, head, a, b in zip(rows, heads, cut[:-1].tolist(), cut[1:].tolist()):
            out[i] = np.concatenate([head, flat[a:b]]).astype("<u4", copy=False)
        return out
