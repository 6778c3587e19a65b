"""URL filter rules looked up in Bloom filter cascades.

A rule is a host and the beginning of a path; it fits its host and all subdomains.  The keys a
url may match are its host's suffixes joined with beginnings of its path (of the lengths that
rules have).  For each verdict a cascade holds the rules' keys: level 1 is a Bloom filter of the
listed keys, level 2 one of level 1's false positives among *all* keys of the corpus, level 3
one of the listed keys that level 2 wrongly holds, and so on until a level has no false
positive.  A key of the corpus is listed exactly if the first level that lacks it is an even
one, so membership is exact for every url of the corpus, without a join.

Level 1 errs at a rate of about |listed| / |keys of the corpus|, the others at one half, so all
levels together take some ``log2(keys / listed) + 4`` bits a listed key: they grow with the
rules, not with the corpus.  Cascades of over ``MAX_BITS`` bits are refused.

Defined cases: a null url, or one without ``://``, has an empty host and path, which no rule
fits; of several rules that fit, the longest (host and path together, then host) wins; a url no
rule fits is allowed, as the cascades hold it in neither list; repeated rows give equal results;
extra columns are ignored; an empty table or rule list is fine.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import prepare
from basketry.session import drop_path, write_table

MAX_BITS = 1 << 30


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidate_keys(host: Column, path: Column, lengths: list[int], labels: list[int]) -> Column:
    """The keys a url may match, longest first (then the longer host): its host's last labels and its
    path's beginning, of the numbers of labels and the lengths that some rule has."""
    dots = F.length(host) - F.length(F.translate(host, ".", ""))
    suffixes = F.array(*[F.when((dots + 1 >= n) & (host != ""), F.substring_index(host, ".", -n)) for n in labels]).cast("array<string>")
    fitting = F.filter(F.lit(lengths or [0]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(F.array_compact(suffixes), lambda s: F.transform(fitting, lambda n: F.struct(
        (-F.length(s) - n).alias("by"), (-F.length(s)).alias("host"), F.concat(s, F.substring(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.sort_array(keys), lambda k: k["key"])


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key, F.lit(1)).alias("h1"), F.xxhash64(key, F.lit(2)).alias("h2")]


class Cascade:
    """Alternating Bloom filters; ``holds`` is exact on the keys they were built over."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, int, int, np.ndarray]] = []  # bits, hashes, salt, words

    def _in_level(self, k: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, count, salt, words = self.levels[k]
        out = np.ones(len(h1), bool)
        for j in range(count):
            at = _position(h1, h2, j, salt, bits)
            out &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return out

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(h1), bool)
        left = np.arange(len(h1))
        for k in range(len(self.levels)):
            left = left[self._in_level(k, h1[left], h2[left])]
            listed[left] = k % 2 == 0
        return listed


def _position(h1: np.ndarray, h2: np.ndarray, j: int, salt: int, bits: int) -> np.ndarray:
    x = h1 + np.uint64(2 * j + 1) * (h2 | np.uint64(1)) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) % np.uint64(bits)


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _set_words(bits: int, count: int, salt: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _u64(batch.column(0)), _u64(batch.column(1))
            at = np.unique(np.concatenate([_position(h1, h2, j, salt, bits) for j in range(count)]))
            if len(at):
                word = at >> np.uint64(6)
                first = np.flatnonzero(np.diff(word, prepend=np.uint64(1 << 63)))
                ored = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word[first].astype(np.int64)), pa.array(ored.view(np.int64))], ["word", "bits"])

    return run


def _keep(cascade: Cascade, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(cascade._in_level(level, _u64(batch.column(0)), _u64(batch.column(1)))))

    return run


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade of the listed keys, exact over them and the universe (both: column key)."""
    cascade = Cascade()
    prepare(listed.sparkSession)
    inside = listed.select("key").distinct().select(*_hashes(F.col("key"))).cache()
    outside = universe.select("key").distinct().join(listed.select("key").distinct(), "key", "left_anti").select(*_hashes(F.col("key"))).cache()
    n, others = inside.count(), outside.count()
    add, test, cached = inside, outside, [inside, outside]
    rate = min(0.5, max(1, n) / (math.sqrt(2) * max(1, others)))
    while n:
        count = max(1, round(math.log2(1 / rate)))
        bits = max(64, math.ceil(n * 1.4427 * math.log2(1 / rate)))
        if bits + sum(x[0] for x in cascade.levels) > MAX_BITS:
            raise ValueError(f"the rules need a filter of over {MAX_BITS} bits")
        salt = len(cascade.levels) + 1
        words = add.mapInArrow(_set_words(bits, count, salt), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        table = np.zeros((bits + 63) // 64, np.uint64)
        for r in words.collect():  # the filter itself: at most bits / 64 rows
            table[r["word"]] = np.uint64(r["bits"] % (1 << 64))
        cascade.levels.append((bits, count, salt, table))
        wrong = test.mapInArrow(_keep(cascade, len(cascade.levels) - 1), "h1 long, h2 long").cache()
        add, test, n, rate = wrong, add, wrong.count(), 0.5
        cached.append(wrong)
    for df in cached:
        df.unpersist()
    return cascade


_JUDGED = "page_id long, host string, path string, rule string, verdict string"


def _judge(cascades: dict[str, Cascade]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            keys = lists.values
            h1, h2 = (_u64(batch.column(i).values) for i in (4, 5))
            verdict = np.full(len(keys), None, object)
            for name, cascade in cascades.items():
                verdict[cascade.holds(h1, h2)] = name
            rule, said = [], []
            hits = np.flatnonzero(verdict != None)  # noqa: E711
            at = np.searchsorted(hits, offsets[:-1])
            for i, k in enumerate(at.tolist()):
                hit = int(hits[k]) if k < len(hits) and hits[k] < offsets[i + 1] else -1
                rule.append(keys[hit].as_py() if hit >= 0 else None)
                said.append(verdict[hit] if hit >= 0 else "allow")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(said, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url), by ``rules``
    (verdict, host, path)."""
    spark: SparkSession = pages.sparkSession
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    labels = sorted(r["n"] for r in rules.select(F.size(F.split("host", r"\.", -1)).alias("n")).distinct().collect())
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths, labels))
    universe, universe_path = write_table(parsed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    cascades = {}
    for name in ("allow", "block"):
        listed = rules.where(F.col("verdict") == name).select(F.concat("host", "path").alias("key"))
        cascades[name] = build_cascade(listed, universe)
    drop_path(spark, universe_path)
    prepare(spark)
    h1 = F.transform("keys", lambda k: _hashes(k)[0]).alias("h1")
    h2 = F.transform("keys", lambda k: _hashes(k)[1]).alias("h2")
    return parsed.select("page_id", "host", "path", "keys", h1, h2).mapInArrow(_judge(cascades), _JUDGED)
