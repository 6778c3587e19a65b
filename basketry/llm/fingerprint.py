"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

Each paragraph (line) is hashed to a wide vector and a text's fingerprint is the sum of its
paragraphs' vectors, lane by lane: ``EXACT`` lanes modulo 2**64 and ``LIKE`` lanes modulo 2**16.
So the order of paragraphs does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector, without the rest of the text.

The EXACT lanes are the paragraph's 512-bit BLAKE2b digest; they decide equality.  In the LIKE
lanes each pair of neighbouring words of a line, each line's first word, and each run of nine bytes
of a long word (so that scripts without spaces count by character) adds 1 or -1 to one lane
(both chosen by its hash), so the squared length of the difference of two fingerprints estimates by how much the texts differ:
likeness = 1 - |a - b|**2 / (|a|**2 + |b|**2), within 0 and 1.

Defined cases: a null or empty text has no paragraph and the zero fingerprint, two such are
equal (likeness 1), one such and another text have likeness 0; an empty line is a paragraph;
rows with one doc_id are ordered by text; a null doc_id comes first; repeated rows each give a
row; extra columns are ignored; in a table of one row the next document is the row itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.order import range_of, split_points
from basketry.llm.texts import column_bytes, mix, prepare, slices, span_hashes, word_spans

EXACT, LIKE = 8, 256
#: Words of more bytes also count by their runs of ``RUN`` bytes (three characters of most scripts without spaces).
LONG, RUN = 32, 9
#: Characters of text handled at a time in a task.
CHARS = 1 << 21


def _like_lanes(texts: list[str]) -> np.ndarray:
    data, offsets = column_bytes(pa.array(texts, pa.large_string()))
    lanes = np.zeros((len(texts), LIKE), np.int64)
    line_end = np.flatnonzero(data == 10)
    held = None  # the last word of the slice before: its row, line and hash
    for start, stop in slices(data, offsets):
        row, begin, end = word_spans(data, offsets, start, stop)
        if not len(row):
            continue
        word = span_hashes(data, start, stop, begin, end, fold=False)
        line = np.searchsorted(line_end, begin)
        if held is not None:
            row, line, word = (np.concatenate([[h], x]).astype(x.dtype) for h, x in zip(held, (row, line, word)))
        pair = (row[1:] == row[:-1]) & (line[1:] == line[:-1])
        first = np.flatnonzero(~pair) + 1  # words that begin a line
        first = first if held is not None else np.append(0, first)
        grams = [(row[1:][pair], mix(word[:-1][pair] * np.uint64(0x9FB21C651E98DF25) + word[1:][pair])), (row[first], mix(word[first] + np.uint64(1)))]
        for of, gram in chain(grams, _long_words(data, begin, end, row[len(row) - len(begin) :])):
            value = 1 - 2 * ((gram >> np.uint64(32)) & np.uint64(1)).astype(np.int64)
            np.add.at(lanes.reshape(-1), of * LIKE + (gram % np.uint64(LIKE)).astype(np.int64), value)
        held = (row[-1], line[-1], word[-1])
    return lanes


def _long_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of every run of ``RUN`` bytes in words of more than ``LONG`` bytes, a few at a time."""
    for w in np.flatnonzero(end - begin > LONG).tolist():
        for start in range(int(begin[w]), int(end[w]) - RUN + 1, 1 << 18):
            size = min(1 << 18, int(end[w]) - RUN + 1 - start)
            gram = np.zeros(size, np.uint64)
            for k in range(RUN):
                gram = gram * np.uint64(0x100000001B3) + data[start + k : start + k + size].astype(np.uint64) + np.uint64(1)
            yield np.full(size, row[w]), mix(gram)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """EXACT (uint64) and LIKE (uint16) lanes of each text."""
    rows, digests = [], []
    for i, text in enumerate(texts):
        if text:
            for p in text.encode("utf-8", "surrogatepass").split(b"\n"):
                rows.append(i)
                digests.append(hashlib.blake2b(p).digest())
    exact = np.zeros((len(texts), EXACT), np.uint64)
    if rows:
        lanes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, EXACT)
        at = np.array(rows)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        exact[at[first]] = np.add.reduceat(lanes, first, axis=0)
    return exact, (_like_lanes(texts) & 0xFFFF).astype(np.uint16)


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Insert the paragraphs of one fingerprint into another (lanes wrap)."""
    return a[0] + b[0], a[1] + b[1]


def subtract(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Delete the paragraphs of one fingerprint from another."""
    return a[0] - b[0], a[1] - b[1]


def encode(exact: np.ndarray, like: np.ndarray) -> list[str]:
    raw = np.concatenate([exact.astype("<u8").view(np.uint8), like.astype("<u2").view(np.uint8)], axis=1)
    return [base64.b64encode(r.tobytes()).decode() for r in raw]


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    return raw[: 8 * EXACT].view("<u8").astype(np.uint64), raw[8 * EXACT :].view("<u2").astype(np.uint16)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints (arrays of rows)."""
    square = lambda x: (x.astype(np.uint16).view(np.int16).astype(np.float64) ** 2).sum(-1)
    both = square(a[1]) + square(b[1])
    same = (a[0] == b[0]).all(-1) & (a[1] == b[1]).all(-1)
    near = 1 - square(a[1] - b[1]) / np.maximum(both, 1)
    return np.where(same, 1.0, np.where(both == 0, 0.0, np.clip(near, 0, 1)))


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited_batch(ids: list, texts: list[str]) -> pa.RecordBatch:
    """One row for each text but the last, which is only the next of the one before."""
    half = [len(t) // 2 for t in texts[:-1]]
    edited = [t[: len(t) - h] + n[:h] for t, n, h in zip(texts, texts[1:], half)]
    exact, like = fingerprints(texts)
    of_text, of_next, of_edited = (exact[:-1], like[:-1]), (exact[1:], like[1:]), fingerprints(edited)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]), pa.array(encode(*of_text)), pa.array(encode(*of_edited)),
        pa.array(likeness(of_text, of_edited)), pa.array(likeness(of_text, of_next))], [c.split()[0] for c in _EDITED.split(", ")])


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, halo, doc_id, text) in order; a bucket ends with copies (halo > 0) of the
    row that follows its last one."""
    now, ids, texts, chars = None, [], [], 0
    closed = True
    for batch in batches:
        for bucket, halo, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            if bucket != now:
                now, ids, texts, chars, closed = bucket, [], [], 0, False
            if closed:
                continue
            texts.append(text)
            chars += len(text)
            if halo or chars >= CHARS and len(texts) > 1:
                if ids:
                    yield _edited_batch(ids, texts)
                ids, texts, chars = [], texts[-1:], len(text)
                closed = bool(halo)
            if not halo:
                ids.append(doc)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Of every row of ``docs`` (doc_id, text): the fingerprints of its text and of the text whose
    last half is replaced by the beginning of the next document's, and how like they are.

    Rows are dealt once, by ranges of doc_id; the first row of a range is also copied to the
    end of the range before, and the first of all to the end of the last.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = split_points(docs, "doc_id", 4 * parts)
    least = docs.agg(F.min("doc_id").alias("m"), F.max(F.col("doc_id").isNull()).alias("null")).first()
    none = -(1 << 63)
    first_of_all = none if least["null"] else least["m"]
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(none)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("bucket", range_of(F.col("key"), points))
    copies = F.array(
        F.struct("bucket", F.lit(0).alias("halo")),
        F.when(F.col("key").isin(points), F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(1).alias("halo"))),
        F.when(F.col("key") == F.lit(first_of_all), F.struct(F.lit(len(points)).alias("bucket"), F.lit(2).alias("halo"))))
    dealt = rows.select(F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("c"), "key", "doc_id", "text")
    dealt = dealt.select("c.bucket", "c.halo", "doc_id", "text", "key").repartition(parts, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "halo", "key", "text").drop("key")
    return ordered.mapInArrow(_edit, _EDITED)
