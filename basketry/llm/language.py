"""Language identification of mixed-language text.

Every word gets a score for each learned language: the log probabilities of its byte trigrams
(lower-cased UTF-8 with a space at either end).  The scripts of the word's letters narrow the
candidates to the languages written in one of them.  Viterbi then labels the words of a
document with the best sequence of languages, where every change costs ``SWITCH``, and runs of
one label are its spans.  A document's language is the one with most letters; its score is that
language's share of the letters.

The model is fitted on a bounded sample of about ``ROWS`` documents of each language, picked by
a hash; trigrams are counted in tasks, summed by Spark, and hashed to ``1 << FEATURE_BITS``
cells, so what reaches the driver is bounded by that and the number of languages.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no span; ties go
to the alphabetically first language; rows with a null lang teach nothing; without any lang in
the training rows every document is ``und``; repeated rows get equal results; other columns
are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import column_bytes, frugal, held_out, prepare, slices

ROWS = 3_000
FEATURE_BITS = 15
#: Cost of a change of language between two words, in natural-log units.
SWITCH = 8.0
#: A language is written in the scripts that hold this share of its letters.
SCRIPT_SHARE = 0.01
#: Words labelled at a time.
WORDS = 500_000

# First and last code point of the letters of common scripts.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F),
    ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x0370, 0x03FF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x06FF),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF),
    ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
)
_NAMES = sorted({s[0] for s in SCRIPTS})
_RANGES = sorted((a, b, _NAMES.index(n)) for n, a, b in SCRIPTS)
_FIRST = np.array([r[0] for r in _RANGES])
_LAST = np.array([r[1] for r in _RANGES])
_BIT = np.array([1 << r[2] for r in _RANGES], np.int64)
_OTHER = np.int64(1 << len(_NAMES))
_LATIN = np.int64(1 << _NAMES.index("Latin"))

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
#: Of U+2000-U+303F, which has most signs: the letters, letter numbers and marks of letters.
_SIGNS = 0x2000
_AMONG_SIGNS = np.array([unicodedata.category(chr(c))[0] == "L" or unicodedata.category(chr(c)) == "Nl"
                         or (0x2C00 <= c < 0x2E00 and unicodedata.category(chr(c)) == "Mn") for c in range(_SIGNS, 0x3040)])


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters: ASCII letters, and all of other characters but the
    punctuation and signs of U+0080-U+00BF and U+2000-U+303F."""
    is_letter = _ASCII_LETTER[data] | (data >= 0x80)
    after = np.append(data[1:], np.uint8(0))
    sign2 = np.flatnonzero((data == 0xC2) & ~np.isin(after, (0xAA, 0xB5, 0xBA)))
    sign3 = np.flatnonzero((data == 0xE2) | ((data == 0xE3) & (after == 0x80)))
    if len(sign3):
        d = np.append(data, np.zeros(2, np.uint8)).astype(np.int64)
        point = ((d[sign3] & 0x0F) << 12) | ((d[sign3 + 1] & 0x3F) << 6) | (d[sign3 + 2] & 0x3F)
        sign3 = sign3[~_AMONG_SIGNS[point - _SIGNS]]
    for at, size in ((sign2, 2), (sign3, 3)):
        for k in range(size):
            is_letter[at[at + k < len(data)] + k] = False
    return is_letter


def _script_bits(data: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A bit for the script of the character that starts at a byte; 0 elsewhere."""
    bits = np.where(_ASCII_LETTER[data], _LATIN, np.int64(0))
    lead = np.flatnonzero(letters & (data >= 0xC0))
    if len(lead):
        d = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        b = [d[lead + k] & 0x3F for k in range(4)]
        size = 2 + (d[lead] >= 0xE0) + (d[lead] >= 0xF0)
        point = np.select([size == 2, size == 3], [((d[lead] & 0x1F) << 6) | b[1], ((d[lead] & 0x0F) << 12) | (b[1] << 6) | b[2]], 0x10000)
        k = np.maximum(np.searchsorted(_FIRST, point, "right") - 1, 0)
        bits[lead] = np.where((point >= _FIRST[k]) & (point <= _LAST[k]), _BIT[k], _OTHER)
    return bits


def _features(data: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The hashed trigram centred at each byte; bytes outside words count as spaces."""
    x = np.full(len(data) + 2, 0x20, np.uint32)
    x[1:-1] = np.where(letters, data, 0x20)
    value = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)


def _words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slice by slice: row, first byte and length of each word, then the features of the
    slice's word bytes (word after word) and the words' scripts."""
    data, offsets = column_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    for start, stop in slices(data, offsets):
        piece = data[start:stop]
        inside = _letters(piece)
        if not inside.any():
            continue
        edge = np.zeros(len(piece) + 1, bool)
        edge[offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop, "right")] - start] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        begin = np.flatnonzero(first)
        at = np.flatnonzero(inside)
        of = np.searchsorted(at, begin)
        size = np.diff(np.append(of, len(at)))
        script = np.bitwise_or.reduceat(_script_bits(piece, inside)[at], of)
        yield np.searchsorted(offsets, begin + start, "right") - 1, begin + start, size, _features(piece, inside)[at], script


def _count(langs: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << FEATURE_BITS
        wide = cells + len(_NAMES) + 1
        count = np.zeros(len(langs) * wide, np.int64)
        for batch in batches:
            lang = pc.index_in(batch.column(1).cast(pa.string()), pa.array(langs, pa.string())).to_numpy(zero_copy_only=False)
            for row, _, size, feature, script in _words(batch.column(0)):
                of = lang[row].astype(np.int64)
                count += np.bincount(np.repeat(of, size) * wide + feature, minlength=len(count))
                for k in range(len(_NAMES) + 1):
                    has = (script >> k) & 1 > 0
                    np.add.at(count, of[has] * wide + cells + k, size[has])
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["cell", "n"])

    return run


def fit(docs: DataFrame) -> dict:
    """A model for ``identify`` from the rows of ``docs`` (doc_id, text, lang) not held out."""
    prepare(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    held = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(held)
    if not langs:
        return {}
    pick = F.lit(False)
    for lang in langs:
        share = min(1.0, ROWS / held[lang])
        pick = pick | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    cells = known.where(pick).select("text", "lang").mapInArrow(frugal(_count(langs)), "cell long, n long")
    wide = (1 << FEATURE_BITS) + len(_NAMES) + 1
    count = np.zeros(len(langs) * wide)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most langs * wide rows
        count[r["cell"]] = r["n"]
    count = count.reshape(len(langs), wide)
    grams, scripts = count[:, : 1 << FEATURE_BITS], count[:, 1 << FEATURE_BITS :]
    logs = np.log(grams + 0.5) - np.log((grams + 0.5).sum(1, keepdims=True))
    written = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    bits = [int(sum(1 << k for k in np.flatnonzero(w))) for w in written]
    return {"langs": langs, "logs": np.ascontiguousarray(logs.T.astype(np.float32)), "scripts": bits}


def word_scores(feature: np.ndarray, size: np.ndarray, script: np.ndarray, model: dict) -> np.ndarray:
    """Score of each word for each language; languages of other scripts are out, unless that
    leaves none."""
    of = np.concatenate([[0], np.cumsum(size)[:-1]])
    scores = np.add.reduceat(model["logs"][feature], of, axis=0)
    out = (script[:, None] & np.array(model["scripts"], np.int64)[None, :]) == 0
    out[out.all(1)] = False
    scores[out] = -1e6
    return scores


def best_labels(row: np.ndarray, scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi over the words of each row (rows ascending): the best sequence of labels, where
    each change costs ``switch``.  All rows advance together, the longest first."""
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(row)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    active = np.searchsorted(-size, -np.arange(size[0] + 1), "left")  # rows longer than t
    best = scores[first].astype(np.float64)
    kind = np.min_scalar_type(-max(1, scores.shape[1]))  # holds every label
    origin = np.zeros(scores.shape, kind)  # the label before, if this one is taken
    here = np.arange(scores.shape[1], dtype=kind)
    for t in range(1, int(size[0])):
        n = int(active[t])
        held = best[:n]
        top = held.argmax(1)
        change = held[np.arange(n), top] - switch
        stay = held >= change[:, None]
        at = first[:n] + t
        origin[at] = np.where(stay, here, top[:, None].astype(kind))
        best[:n] = np.where(stay, held, change[:, None]) + scores[at]
        best[:n] -= best[:n].max(1, keepdims=True)  # only differences matter
    label = np.zeros(len(row), kind)
    label[first + size - 1] = best.argmax(1)
    for t in range(int(size[0]) - 1, 0, -1):
        n = int(active[t])
        at = first[:n] + t
        label[at - 1] = origin[at, label[at]]
    return label


_FOUND = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first:long,last:long>>"
_SPAN = pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())])


def _labelled(ids: pa.Array, rows: int, parts: list[tuple], model: dict) -> pa.RecordBatch:
    langs = model["langs"] if model else []
    if not langs or not parts:
        return pa.RecordBatch.from_arrays([ids, pa.array(["und"] * rows, pa.string()), pa.array(np.zeros(rows)), pa.array([[]] * rows, pa.list_(_SPAN))], ["doc_id", "lang_pred", "score", "spans"])
    row, size, scores = (np.concatenate([p[i] for p in parts]) for i in range(3))
    label = best_labels(row, scores).astype(np.int64)
    letters = np.bincount(row * len(langs) + label, weights=size, minlength=rows * len(langs)).reshape(rows, len(langs))
    total = letters.sum(1)
    pred = letters.argmax(1)
    names = np.array(langs + ["und"], object)[np.where(total > 0, pred, len(langs))]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    at = np.flatnonzero(new)
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    spans = pa.StructArray.from_arrays([pa.array(np.array(langs, object)[label[at]], pa.string()), pa.array(nth[at]), pa.array(nth[np.append(at[1:], len(row)) - 1])], fields=list(_SPAN))
    cut = np.searchsorted(row[at], np.arange(rows + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        ids, pa.array(names, pa.string()), pa.array(letters.max(1) / np.maximum(total, 1)),
        pa.ListArray.from_arrays(pa.array(cut), spans)], ["doc_id", "lang_pred", "score", "spans"])


def _has_letter(batch: pa.RecordBatch, row: np.ndarray) -> np.ndarray:
    """Of words in rows without an ASCII letter: whether the row has a letter at all."""
    ok = np.ones(batch.num_rows, bool)
    plain = pc.fill_null(pc.match_substring_regex(batch.column(1), "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(~plain).tolist():
        ok[i] = any(c.isalpha() for c in batch.column(1)[i].as_py() or "")
    return ok[row]


def _identify(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            start = rows = held = 0
            parts: list[tuple] = []
            while start + rows < whole.num_rows:
                batch = whole.slice(start + rows, 256)
                if model:
                    for row, _, size, feature, script in _words(batch.column(1)):
                        scores = word_scores(feature, size, script, model)
                        keep = _has_letter(batch, row)
                        parts.append((row[keep] + rows, size[keep], scores[keep]))
                        held += len(row)
                rows += batch.num_rows
                if held >= WORDS:
                    yield _labelled(whole.column(0).slice(start, rows), rows, [p for p in parts if len(p[0])], model)
                    start, rows, held, parts = start + rows, 0, 0, []
            if rows:
                yield _labelled(whole.column(0).slice(start, rows), rows, [p for p in parts if len(p[0])], model)

    return run


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row of ``docs`` (doc_id, text).

    ``spans`` are runs of words with one language: its name and the run's first and last word.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(_identify(model)), _FOUND)


def language_of(text: Column, model: dict) -> Column:
    """The struct (lang, score) of a text column, for filtering rows in place."""
    label = _identify(model)

    def run(column: pa.Array) -> pa.Array:
        column = column.cast(pa.string())
        whole = pa.RecordBatch.from_arrays([pa.array(np.arange(len(column))), column], ["doc_id", "text"])
        parts = [pa.StructArray.from_arrays([b.column(1), b.column(2)], ["lang", "score"]) for b in label(iter([whole]))]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("lang", pa.string()), ("score", pa.float64())]))

    return F.arrow_udf(run, "struct<lang:string,score:double>")(text.cast("string"))
