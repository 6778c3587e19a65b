"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are the queries, in blocks of about ``BLOCK_PARTS`` passages; all passages of all documents are
searched for each block:

1. Every document becomes the sequence of its words' numbers in the block's vocabulary (0: not
   in it), written once to the shared folder.
2. Document frequencies of the vocabulary are counted over all documents.
3. A randomised SVD of TF-IDF passages gives a latent space of ``RANK`` dimensions: a random
   matrix is multiplied with the passages' matrix of word pairs, with power iterations in
   between.  The passages are all items (weighted) and all windows of the corpus.  Spark tasks add up the
   pairs of words in all windows once, and Spark sums and keeps them; a block of a vocabulary too large
   for that (``CELLS``) has its windows multiplied in every iteration.  The space holds the items' own
   rows whole, so that the product of an item with a passage is the same in it as over all words.
4. Documents are read in windows of ``WINDOW`` words, half overlapping, and an item is looked for
   in a window and as many words on either side as the item has.  A passage holds all that is
   read for ``RUN`` windows.  It is a candidate for an item when their latent product reaches
   the least that ``COVERED`` of the item's words can give, its lightest ones.  The other words
   of the passage and the size of the corpus do not count against it, so every pair that step
   5 accepts is a candidate.  Passages whose words cannot reach any item are skipped by an
   upper bound.
5. A candidate is verified window by window: the longest common subsequence with
   the item must cover ``COVERED`` of the item's words, and ``ANSWERED`` of the words of its
   answer must be found in order, unless ``SURE`` of the item is.  Both tolerate changed and
   inserted words.  The answer is the last sentence, or the last ``ANSWER_WORDS`` words if
   that has fewer.

Words are runs of letters, digits and non-ASCII characters, with A-Z lower-cased; in scripts
written without spaces (Han, Kana, Thai, Lao, Khmer, Myanmar) every character is a word, and
full-width punctuation separates words.  Items of fewer than ``LEAST_WORDS`` words are found
as an exact phrase.  Items of more
than ``WINDOW`` words are searched in equal parts, in as many blocks as those fill.  If
``COVERED`` of an item is found, so is that share of one of its parts at least; the whole item
is then verified on the words around that part, as many as the item has on either side.

Defined cases: null and empty texts have no passage; items without a word are not searched,
nor are null ones; equal items are all reported; repeated documents are each
reported; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import frugal, prepare, separators, word_hashes
from basketry.session import drop_path, write_table

WINDOW = 64
#: Windows of a passage.
RUN = 4
#: Least latent rank; a block of more parts has as many dimensions as parts.
RANK = 192
#: Words of the vocabulary in a part of a sum, and about so many entries of windows multiplied at a time.
PART, ENTRIES = 256, 1 << 12
#: Most pairs of words that a task adds up, pairs in a part of their sum, and pairs made at a time.
CELLS, CELLS_PART, PAIRS = 1 << 24, 1 << 14, 1 << 18
#: Least cosine that the recall of the latent space is tested for; no candidate depends on it.
COSINE = 0.3
COVERED = 0.7
ANSWERED = 0.5
#: Share of an item's words that needs no answer.
SURE = 0.8
ANSWER_WORDS = 5
LEAST_WORDS = 5
#: Parts of items in a block.
BLOCK_PARTS = 200
#: How much more an item weighs in the SVD than a passage of the corpus.
ITEM_WEIGHT = 10.0
#: Words read, and passages multiplied with the latent space, at a time in a task.
WORDS, PASSAGES = 500_000, 64

_SEPARATOR = separators(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_SENTENCE_END = re.compile(r"[.!?](?=\s)|[。！？]|\n")
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_FULL_WIDTH = r"[\x{3000}-\x{3003}\x{3008}-\x{3011}\x{3014}-\x{301F}\x{3030}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"


def _hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of each word, in order."""
    column = column.cast(pa.large_string())
    for pattern, space in ((_FULL_WIDTH, " "), (_UNSPACED, r" \1 ")):
        if pc.any(pc.match_substring_regex(column, pattern)).as_py():
            column = pc.replace_substring_regex(column, pattern, space)
    return word_hashes(column, _SEPARATOR)


def words_of(text: str) -> np.ndarray:
    parts = [h for _, h in _hashes(pa.array([text], pa.string()))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def answer_of(text: str) -> np.ndarray:
    """The words of the last sentence, or the last ``ANSWER_WORDS`` if it has fewer."""
    last = next((w for t in reversed(_SENTENCE_END.split(text)) if len(w := words_of(t))), np.zeros(0, np.uint64))
    return words_of(text)[-max(ANSWER_WORDS, len(last)):]


def parts_of(words: np.ndarray) -> list[np.ndarray]:
    """Parts of about equal length, of at most ``WINDOW`` words."""
    return np.array_split(words, -(-len(words) // WINDOW)) if len(words) else []


class Block:
    """Items, or parts of long ones: (item_id, words searched, answer words); ``whole`` has all
    words of the part's item, and the vocabulary those of all items."""

    def __init__(self, items: list[tuple[int, str]], first: int = 0, last: int | None = None) -> None:
        """Of the parts of these items, those from first to before last."""
        each = []
        for item, text in items:
            words, answer = words_of(text), answer_of(text)
            each += [(item, part, answer, words) for part in parts_of(words)]
        self.items: list[tuple[int, np.ndarray, np.ndarray]] = [p[:3] for p in each[first:last]]
        self.whole = [p[3] for p in each[first:last]]
        self.vocabulary = np.unique(np.concatenate(self.whole)) if self.whole else np.zeros(0, np.uint64)
        self.kind = "<u2" if len(self.vocabulary) < 65_535 else "<u4"
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """1 + the place in the vocabulary, 0 for other words."""
        out = np.zeros(len(words), self.kind)
        at = np.flatnonzero(self.maybe[(words >> np.uint64(44)).astype(np.int64)])
        if len(at):
            place = np.minimum(np.searchsorted(self.vocabulary, words[at]), len(self.vocabulary) - 1)
            hit = self.vocabulary[place] == words[at]
            out[at[hit]] = place[hit] + 1
        return out


def item_blocks(benchmark: DataFrame) -> Iterator[Block]:
    items, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        parts = len(parts_of(words_of(r["text"])))
        if items and held + parts > BLOCK_PARTS:
            yield Block(items)
            items, held = [], 0
        if parts > BLOCK_PARTS:
            for first in range(0, parts, BLOCK_PARTS):
                yield Block([(r["item_id"], r["text"])], first, first + BLOCK_PARTS)
            continue
        items.append((r["item_id"], r["text"]))
        held += parts
    if items:
        yield Block(items)


def _number(block: Block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width = np.dtype(block.kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                count = np.zeros(batch.num_rows, np.int64)
                parts = [np.zeros(0, block.kind)]
                for row, words in _hashes(batch.column(1)):
                    count += np.bincount(row, minlength=batch.num_rows)
                    parts.append(block.numbers(words))
                flat = np.concatenate(parts)
                cut = np.concatenate([[0], np.cumsum(count)]) * width
                seqs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), seqs.cast(pa.binary())], ["doc_id", "words"])

    return run


def _sequences(column: pa.Array, kind: str, words: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some rows at a time: the first row, all words, and the offsets of the rows."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in column]) // np.dtype(kind).itemsize
    at = 0
    while at < len(sizes):
        stop = at + 1
        held = int(sizes[at])
        while stop < len(sizes) and held + sizes[stop] <= words:
            held += int(sizes[stop])
            stop += 1
        flat = np.frombuffer(b"".join([column[i].as_py() or b"" for i in range(at, stop)]), kind).astype(np.int64)
        yield at, flat, np.concatenate([[0], np.cumsum(sizes[at:stop])])
        at = stop


def _frequencies(kind: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        docs = 0
        for batch in batches:
            docs += batch.num_rows
            for _, flat, offsets in _sequences(batch.column(0), kind):
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                known = flat > 0
                pair = np.unique(row[known] * (size + 1) + flat[known])
                total += np.bincount(pair % (size + 1), minlength=size + 1)
        total[0] = docs
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    return run


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and after-last word of the half-overlapping windows."""
    size = np.diff(offsets)
    half = WINDOW // 2
    count = np.where(size > 0, np.maximum(1, -(-(size - half) // half)), 0)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = offsets[row] + nth * half
    return row, first, np.minimum(first + WINDOW, offsets[row + 1])


def _passages(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window, and first and after-last word of the passages: all words within
    ``WINDOW`` of ``RUN`` windows in a row."""
    row, first, last = _windows(offsets)
    lead = np.flatnonzero((first - offsets[row]) % (RUN * WINDOW // 2) == 0)
    end = np.append(lead, len(row))[1:] - 1
    row, start = row[lead], first[lead]
    return row, start, np.maximum(start - WINDOW, offsets[row]), np.minimum(last[end] + WINDOW, offsets[row + 1])


def word_weights(df: np.ndarray) -> np.ndarray:
    """Weights of the words in df[word] documents, where df[0] is the number of documents."""
    n = df[0]
    weight = np.log((n + 1) / (df + 1)) + 0.1
    weight[0] = np.log((n + 1) / 2) * 0.5 + 0.1  # of words outside the vocabulary
    return weight


def _item_rows(block: Block, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(w) for _, w, _ in block.items])])
    flat = np.concatenate([block.numbers(w) for _, w, _ in block.items]).astype(np.int64)
    return _tfidf(flat, offsets[:-1], offsets[1:], weight)


def _tfidf(flat: np.ndarray, first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (window, word, weight) of windows with logarithmic term counts."""
    size = last - first
    window = np.repeat(np.arange(len(first)), size)
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    key, count = np.unique(window * len(weight) + flat[at], return_counts=True)
    window, word = key // len(weight), key % len(weight)
    # words outside the vocabulary all differ as far as is known
    value = np.where(word > 0, (1 + np.log(count)) * weight[word], np.sqrt(count) * weight[0])
    return window, word, value


def _window_entries(flat: np.ndarray, offsets: np.ndarray, weight: np.ndarray, entries: int) -> Iterator[tuple]:
    """Of all windows with a known word, about so many entries at a time: (window, word, value) of
    ``_tfidf`` and what the words outside the vocabulary add to each window's squared length."""
    _, first, last = _windows(offsets)
    known = np.concatenate([[0], np.cumsum(flat > 0)])
    some = np.flatnonzero(known[last] > known[first])  # the others add nothing
    first, last = first[some], last[some]
    lead, end = known[first], known[last]
    outside = (last - first - (end - lead)) * weight[0] ** 2
    words = flat[flat > 0]
    upto = np.cumsum(end - lead)
    cuts = np.searchsorted(upto, np.arange(entries, (upto[-1] if len(upto) else 0) + entries, entries))
    at = 0
    for cut in cuts:
        to = min(int(cut) + 1, len(some))
        if to > at:
            yield *_tfidf(words, lead[at:to], end[at:to], weight), outside[at:to]
        at = to


def _products(kind: str, weight: np.ndarray, omega) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sum over all passages a of a (a omega), in parts of ``PART`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = omega.value
        total = np.zeros(m.shape)
        for batch in batches:
            for _, flat, offsets in _sequences(batch.column(1), kind):
                for window, word, value, outside in _window_entries(flat, offsets, weight, ENTRIES):
                    gram_times(window, word, value, m, outside, total)
        yield _in_parts(total)

    return run


def _in_parts(total: np.ndarray) -> pa.RecordBatch:
    parts = range(0, len(total), PART)
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([total[k : k + PART].tobytes() for k in parts], pa.binary())], ["part", "data"])


def _first_cells(words: int) -> np.ndarray:
    """The place of the first of the pairs (a, 1), ..., (a, a) of each word a; words count from 1."""
    a = np.arange(words + 2)
    return a * (a - 1) // 2


def _pair_sums(kind: str, weight: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sums over all passages of the products of two words' entries, in parts of ``CELLS_PART`` pairs:
    a bit for each pair that has a sum, then these sums."""
    words = len(weight) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = _first_cells(words)
        total = np.zeros(base[-1])
        lower = {}
        for batch in batches:
            for _, flat, offsets in _sequences(batch.column(1), kind):
                for window, word, value, outside in _window_entries(flat, offsets, weight, 16 * ENTRIES):
                    value = value / np.sqrt(np.bincount(window, value**2) + outside)[window]
                    start = np.flatnonzero(np.diff(window, prepend=-1))
                    size = np.diff(start, append=len(window))
                    row, column = base[word], word - 1
                    for n in np.unique(size):
                        if n not in lower:
                            lower[n] = np.tril_indices(n)
                        i, j = lower[n]
                        own, step = start[size == n], max(1, PAIRS // len(i))
                        for at in range(0, len(own), step):
                            place = own[at : at + step, None] + np.arange(n)
                            v = value[place]
                            np.add.at(total, (row[place][:, i] + column[place][:, j]).ravel(), (v[:, i] * v[:, j]).ravel())
        for k in range(0, len(total), CELLS_PART):
            some = total[k : k + CELLS_PART]
            if some.any():
                data = np.packbits(some > 0).tobytes() + some[some > 0].astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k // CELLS_PART], pa.int32()), pa.array([data], pa.binary())], ["part", "data"])

    return run


def _summed(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sums of the parts dealt to a task, whatever the number of tasks that they come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                size = min(CELLS_PART, cells - part * CELLS_PART)
                held, own = np.frombuffer(data.as_py(), np.uint8), total.setdefault(part, np.zeros(size))
                own[np.unpackbits(held[: -(-size // 8)], count=size) > 0] += np.frombuffer(held[-(-size // 8) :].tobytes(), np.float32)
        for part, own in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["part", "data"])

    return run


def _pairs_times(words: int, omega) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs' sums, as a symmetric matrix, times omega; in parts of ``PART`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = omega.value
        base = _first_cells(words)
        total = np.zeros(m.shape)
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_py(), np.float64)
                cell = np.arange(len(own)) + part * CELLS_PART
                a = np.searchsorted(base, cell, "right") - 1
                lo, hi = a[0], a[-1]
                rows = np.zeros((hi - lo + 1, hi + 1), m.dtype)
                rows[a - lo, cell - base[a] + 1] = own
                total[lo : hi + 1] += rows @ m[: hi + 1]
                rows[np.arange(hi - lo + 1), np.arange(lo, hi + 1)] = 0
                total[: hi + 1] += rows.T @ m[lo : hi + 1]
        yield _in_parts(total)

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of one part of several tasks."""
    total = sum(np.frombuffer(d.as_py(), np.float64) for d in table.column("data"))
    return pa.table({"part": table.column("part").slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})


def gram_times(window: np.ndarray, word: np.ndarray, value: np.ndarray, m: np.ndarray, outside: np.ndarray | float = 0.0,
               out: np.ndarray | None = None) -> np.ndarray:
    """A' (A m) for the sparse rows of A, each scaled to length 1, added to ``out``; row 0 of m is not used.
    ``outside`` is what words that have no entries add to the squared length of each row."""
    out = np.zeros(m.shape) if out is None else out
    if not len(window):
        return out
    norm = np.sqrt(np.bincount(window, value**2) + outside)
    value = (value / norm[window]).astype(m.dtype)
    known = word > 0
    window, word, value = window[known], word[known], value[known]
    if not len(window):
        return out
    starts = np.flatnonzero(np.diff(window, prepend=-1))
    left = np.add.reduceat(m[word] * value[:, None], starts, axis=0)
    place = np.cumsum(np.diff(window, prepend=window[0]) > 0)
    order = np.argsort(word, kind="stable")
    word = word[order]
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[starts]] += np.add.reduceat(left[place[order]] * value[order, None], starts, axis=0)
    return out


def latent_space(numbered: DataFrame, block: Block, weight: np.ndarray, windows: int) -> np.ndarray:
    """Randomised SVD: an orthonormal basis of the items' rows and, up to RANK, of all ``windows`` of the corpus."""
    spark = numbered.sparkSession
    size = len(block.vocabulary) + 1
    rank = min(RANK, size - 1)
    items = _item_rows(block, weight)
    rows, path = numbered.select("doc_id", "words"), None
    cells = int(_first_cells(size - 1)[-1])
    if windows and cells <= CELLS:
        sums = rows.mapInArrow(frugal(_pair_sums(block.kind, weight)), "part int, data binary")
        dealt = sums.repartition(1 + cells // (16 * CELLS_PART), "part")
        rows, path = write_table(dealt.mapInArrow(frugal(_summed(cells)), "part int, data binary"), "word-pairs")

    def times(m: np.ndarray) -> np.ndarray:
        m = m.astype(np.float32)
        out = ITEM_WEIGHT**2 * gram_times(*items, m)
        if not windows:
            return out
        shared = spark.sparkContext.broadcast(m)  # vocabulary of one block by RANK
        each = _pairs_times(size - 1, shared) if path else _products(block.kind, weight, shared)
        sums = rows.mapInArrow(frugal(each), "part int, data binary")
        for r in sums.groupBy("part").applyInArrow(_added, "part int, data binary").collect():  # one matrix in all
            out[r["part"] : r["part"] + PART] += np.frombuffer(r["data"], np.float64).reshape(-1, m.shape[1])
        shared.destroy()
        return out

    basis = np.random.default_rng(7).standard_normal((size, rank))
    for _ in range(3):
        basis, _ = np.linalg.qr(times(basis))
    if path:
        drop_path(spark, path)
    own = np.zeros((size, len(block.items)))
    own[items[1], items[0]] = items[2]
    basis = np.linalg.qr(np.hstack([own, basis]))[0][:, : max(RANK, len(block.items))]
    basis[0] = 0
    return basis.astype(np.float32)


def subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        both = row & places.get(w, 0) if w else 0
        if both:
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


_FOUND = "doc_id long, item_id long, cosine double, covered double, answered double, first long, last long"


def _holds(near: list[int], words: list[int]) -> bool:
    """Whether the words occur next to each other."""
    return any(near[i : i + len(words)] == words for i in range(len(near) - len(words) + 1))


def retrieval(block: Block, weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The basis, the items in the latent space, the least product with each item of a passage
    that holds ``COVERED`` of its words, and the most that a word can add to any product."""
    window, word, value = _item_rows(block, weight)
    own = np.zeros((len(block.items), len(weight)))
    own[window, word] = value
    least = np.zeros(len(block.items))
    for k, (_, words, _) in enumerate(block.items):
        held, count = np.unique(block.numbers(words), return_counts=True)
        each = np.sort(np.repeat(own[k, held] * weight[held] / count, count))
        least[k] = each[: _needed(len(words))].sum()
    # the products are of single precision
    least -= 1e-3 * least + 1e-5 * np.sqrt((own**2).sum(1) * (RUN + 5) * WINDOW // 2) * weight.max()
    return basis, (own @ basis).astype(np.float32), least.astype(np.float32), own.max(0) * weight


def _needed(words: int) -> int:
    """The least number of an item's words to be found: a share of COVERED, or all of a few."""
    return words if words < LEAST_WORDS else next(k for k in range(words + 1) if k / words >= COVERED)


def _search(block: Block, weight: np.ndarray, model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    items = [(i, block.numbers(w).tolist(), block.numbers(a).tolist()) for i, w, a in block.items]
    whole = [block.numbers(w).tolist() for w in block.whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, queries, least, most = model.value
        weighted = basis * weight.astype(np.float32)[:, None]
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))  # the items lie in the space

        def cosine(q: int, window: np.ndarray) -> float:
            _, word, value = _tfidf(window, np.zeros(1, np.int64), np.array([len(window)]), weight)
            return float(value @ basis[word] @ queries[q] / length[q] / np.sqrt((value**2).sum()))

        for batch in batches:
            found = []
            done: set[tuple[int, int]] = set()  # rows and items, of several parts or a few words, that were found
            for at, flat, offsets in _sequences(batch.column(1), block.kind):
                row, start, first, last = _passages(offsets)
                if not len(row):
                    continue
                reach = np.concatenate([[0], np.cumsum(most[flat])])
                may = np.flatnonzero(reach[last] - reach[first] >= least.min())
                for a in range(0, len(may), PASSAGES):
                    some = may[a : a + PASSAGES]
                    size = last[some] - first[some]
                    place = np.repeat(first[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    key = np.unique(np.repeat(np.arange(len(some)), size) * len(weight) + flat[place])
                    passage, word = key // len(weight), key % len(weight)
                    passage, word = passage[word > 0], word[word > 0]
                    if not len(word):
                        continue
                    starts = np.flatnonzero(np.diff(passage, prepend=-1))
                    z = np.add.reduceat(weighted[word], starts, axis=0)
                    for k, q in zip(*np.nonzero(z @ queries.T >= least)):
                        p = some[passage[starts[k]]]
                        item, words, answer = items[q]
                        if subsequence(words, flat[first[p] : last[p]].tolist()) / len(words) < COVERED:
                            continue  # nor in a part of the passage
                        r = row[p]
                        several = len(whole[q]) > len(words)
                        few = len(words) < LEAST_WORDS
                        if (several or few) and (at + r, item) in done:
                            continue
                        for f in range(start[p], min(last[p], start[p] + RUN * WINDOW // 2), WINDOW // 2):
                            end = min(f + WINDOW, offsets[r + 1])
                            lo, hi = max(offsets[r], f - len(words)), min(offsets[r + 1], end + len(words))
                            near = flat[lo:hi].tolist()
                            covered = subsequence(words, near) / len(words)
                            if several and covered >= COVERED:
                                lo, hi = max(offsets[r], f - len(whole[q])), min(offsets[r + 1], end + len(whole[q]))
                                near = flat[lo:hi].tolist()
                                covered = subsequence(whole[q], near) / len(whole[q])
                            if few and not _holds(near, words):
                                continue
                            answered = subsequence(answer, near) / len(answer) if answer else 1.0
                            if covered >= COVERED and (answered >= ANSWERED or covered >= SURE):
                                found.append((batch.column(0)[at + r].as_py(), item, cosine(q, flat[f:end]), covered, answered, int(lo - offsets[r]), int(hi - offsets[r])))
                                if several or few:
                                    done.add((at + r, item))
                                    break
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], [c.split()[0] for c in _FOUND.split(", ")])

    return run


def _best(found: DataFrame) -> DataFrame:
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("covered", "answered", "cosine", "first", "last")).alias("b"))
    return best.select("doc_id", "item_id", "b.cosine", "b.covered", "b.answered", "b.first", "b.last")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item it holds: doc_id, item_id, the cosine of the window where
    most was found, the shares of the item and of its answer, and the words of the document searched."""
    spark = docs.sparkSession
    prepare(spark)
    parts: list[DataFrame] = []
    for block in item_blocks(benchmark):
        if not block.items:
            continue
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        numbered, path = write_table(rows.mapInArrow(frugal(_number(block)), "doc_id long, words binary"), "numbered")
        counted = numbered.select("words").mapInArrow(frugal(_frequencies(block.kind, len(block.vocabulary))), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        df = np.zeros(len(block.vocabulary) + 1)
        for r in counted.collect():  # at most a row for each word of the block
            df[r["word"]] = r["n"]
        weight = word_weights(df)
        width = np.dtype(block.kind).itemsize
        windows = numbered.agg(F.sum(F.ceil(F.octet_length("words") / (width * WINDOW // 2)))).first()[0] or 0
        basis = latent_space(numbered, block, weight, int(windows))
        model = spark.sparkContext.broadcast(retrieval(block, weight, basis))  # of one block
        found = numbered.mapInArrow(frugal(_search(block, weight, model)), _FOUND)
        part, _ = write_table(_best(found), "contaminated")
        drop_path(spark, path)
        parts.append(part)
    if not parts:
        return spark.createDataFrame([], _FOUND)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # an item may have parts in several blocks
    return _best(out) if len(parts) > 1 else out
