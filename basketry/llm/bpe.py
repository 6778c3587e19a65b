"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A text is cut at the special tokens' strings, the rest by the byte-level pattern into words, and
every distinct word is merged.  A word's parts lie side by side in one array and the ranks of
its adjacent pairs in another: the least rank is found by a scan, the boundary between the two
parts is deleted by moving the rest of both arrays one place, and only the ranks on either side
of the new part are looked up again.  Words of one length class are the rows of a matrix and go
through these steps together.  For words of over ``SCAN_BYTES`` bytes repeated scans would be
quadratic; these use the same ranks with a heap and linked parts.

Decoding joins the bytes of the ids and reads them as UTF-8, with U+FFFD for what is not.

Texts are first cut at single spaces, which no word crosses, so that only pieces not met lately
are split and merged (``PieceEncoder``; its memory is bounded).  No data is shuffled.

Defined cases: a null text is an empty one (no ids, the empty text); unknown ids decode to
nothing; repeated rows give equal results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.pieces import PieceEncoder
from basketry.llm.texts import frugal, prepare

SCAN_BYTES = 64
CACHED = 250_000
#: Characters of text handled at a time in a task.
CHARS = 1 << 19

# Fixed value: the published pattern that splits text for byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NONE = np.int32(0x7FFFFFFF)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself if it is
    printable Latin-1 and no space, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Merges, bytes of ids and special strings of a byte-level BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        of_char = byte_characters()
        ids = data["model"]["vocab"]
        self.bytes_of = [b""] * (max([*ids.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = bytes(of_char[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.of_byte = np.zeros(256, np.int32)
        for c, b in of_char.items():
            self.of_byte[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int32)
        key = (left << 20) | right
        _, last = np.unique(key[::-1], return_index=True)  # a repeated pair has its last rank
        pick = len(key) - 1 - last
        self.pair, self.rank, self.made = key[pick], pick.astype(np.int32), made[pick]
        self._hashed()
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def _hashed(self) -> None:
        """The pairs in an open-addressing table of four times their number."""
        self.mask = np.int64((1 << int(np.ceil(np.log2(max(4, 4 * len(self.pair)))))) - 1)
        self.table = np.full(int(self.mask) + 1, -1, np.int32)
        left = np.arange(len(self.pair))
        place = self._place(self.pair)
        while len(left):
            free = self.table[place] < 0
            _, first = np.unique(place[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.table[place[won]] = left[won]
            keep = np.ones(len(left), bool)
            keep[won] = False
            left, place = left[keep], (place[keep] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the merges, or -1 (ids below 0 are in no pair)."""
        key = (left.astype(np.int64) << 20) | right
        place = self._place(key)
        out = np.full(len(key), -1, np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        while len(todo):
            at = self.table[place[todo]]
            known = at >= 0
            todo, at = todo[known], at[known]
            hit = self.pair[at] == key[todo]
            out[todo[hit]] = at[hit]
            todo = todo[~hit]
            place[todo] = (place[todo] + 1) & self.mask
        return out


def merge_short(words: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of words of at most ``SCAN_BYTES`` bytes."""
    size = np.array([len(w) for w in words])
    wide = int(size.max())
    part = np.full((len(words), wide + 1), -1, np.int32)
    inside = np.arange(wide)[None, :] < size[:, None]
    part[:, :wide][inside] = vocabulary.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    rank = np.full((len(words), wide), _NONE, np.int32)
    if wide > 1:
        at = np.flatnonzero((np.arange(wide)[None, :] < size[:, None] - 1).ravel())
        rows, cols = at // wide, at % wide
        found = vocabulary.find(part[rows, cols], part[rows, cols + 1])
        rank.ravel()[at] = np.where(found >= 0, vocabulary.rank[found], _NONE)
    out_part, out_size = part.copy(), size.copy()
    row = np.arange(len(words))
    while len(row):
        at = rank.argmin(1)
        here = np.arange(len(row))
        live = rank[here, at] != _NONE
        if not live.all():  # finished words leave the matrix
            gone = row[~live]
            out_part[gone, : part.shape[1]] = part[~live]
            out_size[gone] = size[~live]
            row, part, rank, size, at = row[live], part[live], rank[live], size[live], at[live]
            if not len(row):
                break
            most = int(size.max())
            part, rank = part[:, : most + 1], rank[:, :most]
            here = np.arange(len(row))
        made = vocabulary.made[vocabulary.find(part[here, at], part[here, at + 1])]
        # delete the boundary: what is right of it moves one place to the left
        cols = np.arange(part.shape[1] - 1)[None, :]
        part[:, :-1] = np.where(cols > at[:, None], part[:, 1:], part[:, :-1])
        part[:, -1] = -1
        part[here, at] = made
        cols = cols[:, : rank.shape[1] - 1]
        rank[:, :-1] = np.where(cols >= at[:, None], rank[:, 1:], rank[:, :-1])
        rank[:, -1] = _NONE
        size = size - 1
        found = vocabulary.find(made, part[here, at + 1])
        rank[here, at] = np.where(found >= 0, vocabulary.rank[found], _NONE)
        before = np.flatnonzero(at > 0)
        found = vocabulary.find(part[before, at[before] - 1], made[before])
        rank[before, at[before] - 1] = np.where(found >= 0, vocabulary.rank[found], _NONE)
    return [p[:n] for p, n in zip(out_part, out_size.tolist())]


def merge_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of one word of any length, in n log n steps."""
    ids = vocabulary.of_byte[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    found = vocabulary.find(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
    heap = [(int(vocabulary.rank[f]), i, ids[i], ids[i + 1]) for i, f in enumerate(found) if f >= 0]
    heapq.heapify(heap)
    pairs = vocabulary.pair_of
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if ids[i] == a else len(ids)
        if j >= len(ids) or ids[j] != b:
            continue
        ids[i], ids[j] = pairs[a, b][1], -1
        after[i] = after[j]
        if after[i] < len(ids):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(ids) and (ids[k], ids[after[k]]) in pairs:
                heapq.heappush(heap, (pairs[ids[k], ids[after[k]]][0], k, ids[k], ids[after[k]]))
    return np.array([x for x in ids if x >= 0], np.int32)


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    v = Vocabulary(path)
    v.pair_of = {(int(k) >> 20, int(k) & 0xFFFFF): (int(r), int(m)) for k, r, m in zip(v.pair, v.rank, v.made)}
    return v


def _merged(words: list[str], v: Vocabulary) -> list[np.ndarray]:
    raw = [w.encode("utf-8", "replace") for w in words]
    out: list = [None] * len(raw)
    order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
    while order and len(raw[order[-1]]) > SCAN_BYTES:
        i = order.pop()
        out[i] = merge_long(raw[i], v)
    for a in range(0, len(order), 20_000):
        some = order[a : a + 20_000]
        for i, ids in zip(some, merge_short([raw[i] for i in some], v)):
            out[i] = ids
    return out


def _of_words(lists: list[list[str]], v: Vocabulary) -> list[np.ndarray]:
    """Ids of lists of words; every distinct word is merged once."""
    words = list({w for ws in lists for w in ws})
    ids = dict(zip(words, _merged(words, v)))
    none = np.zeros(0, np.int32)
    return [ids[ws[0]] if len(ws) == 1 else np.concatenate([ids[w] for w in ws]) if ws else none for ws in lists]


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    v = load(path)

    def whole(texts: list[str]) -> list[np.ndarray]:
        if not any(s in t for t in texts for s in v.special):
            return _of_words([v.split.findall(t) for t in texts], v)
        out = []
        for sections in (v.cut.split(t) for t in texts):
            ids = _of_words([v.split.findall(p) for p in sections[::2]], v)
            special = [np.array([v.special[p]], np.int32) for p in sections[1::2]]
            out.append(np.concatenate([x for pair in zip(ids, [*special, ids[0][:0]]) for x in pair]))
        return out

    def following(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = _of_words([v.split.findall(" " + p) for p in pieces], v)
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64)

    return PieceEncoder(whole, following, list(v.special), CACHED)


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text, as little-endian unsigned 32-bit integers."""
    return [ids.astype("<u4").tobytes() for ids in _encoder(path).encode(texts)]


def decode_ids(ids: bytes, path: str) -> str:
    v = load(path)
    table = v.bytes_of
    return b"".join([table[i] if i < len(table) else b"" for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def groups(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (second column, null as empty) of some ``chars`` characters at a time."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            ids.append(doc)
            texts.append(text)
            held += len(text)
            if held >= chars:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, texts in groups(batches, CHARS):
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(encode_texts(texts, path), pa.binary())], ["doc_id", "ids"])
        _encoder.cache_clear()  # the worker lives on, maybe with other work
        load.cache_clear()

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(_encode(path)), "doc_id long, ids binary")


def _decode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(x.as_py() or b"", path) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of every row (doc_id, ids)."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(frugal(_decode(path)), "doc_id long, ids binary, text string")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of every row of ``docs``, encoded and decoded by one Python worker a
    task rather than a chain of two, which would hold the vocabulary twice."""
    prepare(docs.sparkSession)
    first, second = _encode(path), _decode(path)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        frugal(lambda batches: second(first(batches))), "doc_id long, ids binary, text string")
