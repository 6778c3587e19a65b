"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text.  A document
is cut into windows of ``WINDOW_WORDS`` words; every window is compressed with the ordinary
dictionary and with the ordinary plus the toxic one (both padded to one size, so that what the
toxic part cannot shorten costs the same bytes).  The bytes the toxic dictionary saves are
compared with thresholds, and a logistic model calibrated on labelled documents turns the
numbers and shares of windows over each threshold into a score between 0 and 1.

A label marks a whole document although most of its text is ordinary.  The toxic dictionary is
therefore trained on the spans of toxic documents made of byte n-grams that recur in toxic
documents and never occur in the ordinary sample.

Training uses a bounded sample of labelled rows: about ``TOXIC_ROWS`` toxic and
``ORDINARY_ROWS`` ordinary documents of at most ``ROW_BYTES`` bytes, picked by a hash.  Every
third document of the sample is kept from the dictionaries and used for the calibration.

Defined cases: null and empty texts have no window and get the calibrated score of no evidence;
A-Z and a-z are the same; without labelled documents of both kinds every score is 0; repeated
rows get the same score; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import column_bytes, frugal, held_out, prepare, slices, word_spans

TOXIC_ROWS = 3_600
ORDINARY_ROWS = 12_000
ROW_BYTES = 16_384
WINDOW_WORDS = 8
LEVEL = 12
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 1_536
#: Byte n-grams that tell toxic spans, and the share of toxic documents one must occur in.
GRAM, GRAM_SHARE = 6, 0.01
#: Bytes saved in a window.
THRESHOLDS = (2, 3, 4, 5, 6, 8)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _plain(text: str) -> bytes:
    """The text's words between single spaces, A-Z lower-cased, with a space at either end."""
    words = text.encode("utf-8", "replace").split()
    return (b" " + b" ".join(words) + b" ").translate(_FOLD.tobytes())


def _grams(data: bytes) -> np.ndarray:
    """The n-gram at each position, as an integer; those with a space inside as 0."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < GRAM:
        return np.zeros(0, np.uint64)
    n = len(b) - GRAM + 1
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value = (value << np.uint64(8)) | b[k : k + n]
    for k in range(1, GRAM - 1):
        value[b[k : k + n] == 32] = 0
    return value


def _dictionary(samples: list[bytes], size: int, **how: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, **how).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(samples)[-size:]


def _toxic_spans(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    known = np.unique(np.concatenate([np.zeros(1, np.uint64), *(np.unique(_grams(x)) for x in ordinary)]))
    each = [np.unique(_grams(x)) for x in toxic]
    gram, held = np.unique(np.concatenate([np.zeros(1, np.uint64), *each]), return_counts=True)
    telling = gram[(held >= max(2, GRAM_SHARE * len(toxic))) & ~np.isin(gram, known)]
    spans = []
    for data in toxic:
        found = np.isin(_grams(data), telling)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
        spans += [data[i : j + GRAM - 1] for i, j in zip(edge[::2].tolist(), edge[1::2].tolist())]
    return [b"".join(spans[i : i + 8]) for i in range(0, len(spans), 8)]


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    made = []
    for content in (ordinary + bytes(len(toxic)), ordinary + toxic):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))
    return made[0], made[1]


def window_savings(column: pa.Array, ordinary: bytes, toxic: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row of each window and the bytes the toxic dictionary saves there."""
    data, offsets = column_bytes(column)
    both = _compressors(ordinary, toxic)
    for start, stop in slices(data, offsets):
        row, begin, end = word_spans(data, offsets, start, stop)
        if not len(row):
            continue
        new = np.ones(len(row), bool)
        new[1:] = row[1:] != row[:-1]
        first = np.flatnonzero(new)
        nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        at = np.flatnonzero(nth % WINDOW_WORDS == 0)
        last = np.append(at[1:], len(row)) - 1
        text = _FOLD[data[start:stop]].tobytes()
        spans = np.stack([begin[at] - start, end[last] - begin[at]], axis=1).astype("<u8").tobytes()
        size = []
        for c in both:
            out = c.multi_compress_to_buffer(zstandard.BufferWithSegments(text, spans))
            size.append(np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out)))
        yield row[at], size[0] - size[1]


def _evidence(column: pa.Array, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per row: 1, then the log number and the share of windows over each threshold, then the
    log number of windows."""
    rows = len(column)
    windows = np.zeros(rows)
    over = np.zeros((len(THRESHOLDS), rows))
    for row, saved in window_savings(column, ordinary, toxic):
        windows += np.bincount(row, minlength=rows)
        for k, t in enumerate(THRESHOLDS):
            over[k] += np.bincount(row[saved >= t], minlength=rows)
    return np.stack([np.ones(rows), *np.log1p(over), *(over / np.maximum(windows, 1)), np.log1p(windows)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
    return w


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, wanted: dict[int, int], max_bytes: int) -> list[tuple[str, int]]:
    """(text, label) of a bounded sample: about ``wanted[v]`` documents of each label v, none
    held out, picked by a hash of the id (a threshold, so that no sort is needed)."""
    known = labels.where(F.col(label).isin(list(wanted))).where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("y"))
    held = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(1 << 30))
    pick = F.lit(False)
    for value, n in wanted.items():
        pick = pick | ((F.col("y") == value) & (place < int((1 << 30) * min(1.0, n / max(1, held.get(value, 0))))))
    chosen = known.where(pick)  # bounded by the numbers wanted, so it can be broadcast
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "doc_id")
    return [(r["text"], int(r["y"])) for r in rows.select("doc_id", "text", "y").orderBy("doc_id", "text").collect()]


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A model for ``score`` from documents and their labels (doc_id, toxic)."""
    rows = sample_rows(docs, labels, "toxic", {1: TOXIC_ROWS, 0: ORDINARY_ROWS}, ROW_BYTES)
    toxic, ordinary = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
    if len(toxic) < 3 or len(ordinary) < 3:
        return {}
    train = lambda x: [_plain(t) for i, t in enumerate(x) if i % 3]
    spans = _toxic_spans(train(toxic), train(ordinary)) or [b" "]
    pieces = [x[i : i + 256] for x in train(ordinary) for i in range(0, len(x), 256)][:30_000]
    plain = _dictionary([x for x in pieces if len(x) >= 16] or [b" "], ORDINARY_BYTES)
    bad = _dictionary(spans, TOXIC_BYTES, k=16, d=6)
    x = _evidence(pa.array(toxic[::3] + ordinary[::3], pa.string()), plain, bad)
    y = np.repeat([1.0, 0.0], [len(toxic[::3]), len(ordinary[::3])])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    return {"ordinary": plain, "toxic": bad, "mean": mean, "scale": scale, "weights": _logistic((x - mean) / scale, y)}


def _score(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model:
                x = (_evidence(batch.column(1), model["ordinary"], model["toxic"]) - model["mean"]) / model["scale"]
                p = 1 / (1 + np.exp(-np.clip(x @ model["weights"], -30, 30)))
            else:
                p = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(_score(model)), "doc_id long, score double")
