"""Token ids in directly addressable codes, written in ascending doc_id order and read back.

An id is split into chunks of ``CHUNK_BITS`` bits.  Level 1 holds the lowest chunk of every id
and a bitmap that says which ids go on; level 2 holds the next chunk of just those, and so on.
A directory of the number of set bits before each block of ``BLOCK`` bits turns the position of
an id on one level into its position on the next, so any token is read without decoding others.

A file has the levels' chunks, bitmaps and directories one after another, then the documents'
ids and their first tokens, then a JSON header with every section's place, and its length.
Documents are dealt once by ranges of doc_id; a file rolls over at ``FILE_TOKENS`` tokens, is
written under a temporary name, renamed, and listed in the manifest.

Defined cases: a null text is an empty one (just the end id); rows with one doc_id are written
in the order of their texts; a null doc_id comes first; repeated rows are written again; extra
columns are ignored; an empty table writes an empty manifest.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.order import range_of, split_points
from basketry.llm.storage import committed, new_folder, open_file, write_manifest
from basketry.llm.pieces import PieceEncoder
from basketry.llm.texts import prepare

CHUNK_BITS = 8
BLOCK = 512
FILE_TOKENS = 8_000_000
END = 0
#: Pieces of text whose ids a task remembers, and characters it encodes at a time.
CACHED = 500_000
CHARS = 1 << 22


class Tokens(PieceEncoder):
    """The ids of texts by the tokenizers library, which sees every distinct piece once."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # a character of a byte-level token stands for one byte
        self.width = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        super().__init__(self._library, self._joined, special, CACHED)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces are encoded together, with the spaces they were cut at; the tokens' widths
        tell how many belong to each piece."""
        flat, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for a in range(0, len(pieces), 4000):
            some = pieces[a : a + 4000]
            joined = " ".join(some)
            ids = self._library([" " + joined])[0]
            length = map(len, some) if joined.isascii() else (len(p.encode("utf-8", "replace")) for p in some)
            end = np.cumsum(np.fromiter(length, np.int64, len(some)) + 1)
            flat.append(ids)
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.width[ids]), end) + 1, prepend=0))
        return np.concatenate(flat), np.concatenate(sizes)


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def pack(ids: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> bytes:
    """A token file: ids of all documents, the documents' ids and first tokens (and the end)."""
    sections: list[tuple[str, bytes]] = []
    left, level = ids.astype(np.uint64), 0
    while True:
        level += 1
        sections.append((f"chunks{level}", (left & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes()))
        left = left >> np.uint64(CHUNK_BITS)
        more = left > 0
        if not more.any():
            break
        bits = np.packbits(np.pad(more, (0, -len(more) % BLOCK)), bitorder="little")
        before = np.concatenate([[0], np.cumsum(np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK)))])
        sections += [(f"more{level}", bits.tobytes()), (f"rank{level}", before.astype("<u8").tobytes())]
        left = left[more]
    sections += [("docs", docs.astype("<i8").tobytes()), ("starts", starts.astype("<u8").tobytes())]
    header, at = {"levels": level, "tokens": len(ids), "sections": {}}, 0
    for name, data in sections:
        header["sections"][name] = [at, len(data)]
        at += len(data)
    head = json.dumps(header).encode()
    return b"".join([d for _, d in sections]) + head + len(head).to_bytes(8, "little") + b"DACIDS01"


class TokenFile:
    """Random access to a token file (its bytes, or a memory map of them)."""

    def __init__(self, data: bytes) -> None:
        self.data = memoryview(data)
        if bytes(self.data[-8:]) != b"DACIDS01":
            raise ValueError("not a token file")
        size = int.from_bytes(self.data[-16:-8], "little")
        self.header = json.loads(bytes(self.data[-16 - size : -16]))
        self.levels, self.tokens = self.header["levels"], self.header["tokens"]
        self.docs, self.starts = self._section("docs", "<i8"), self._section("starts", "<u8").astype(np.int64)

    def _section(self, name: str, kind: str) -> np.ndarray:
        at, size = self.header["sections"][name]
        return np.frombuffer(self.data[at : at + size], kind)

    def _rank(self, level: int, i: int) -> int:
        """Set bits of a level's bitmap before position i."""
        block = i // BLOCK
        bits = self._section(f"more{level}", np.uint8)[block * BLOCK // 8 : (i + 7) // 8]
        return int(self._section(f"rank{level}", "<u8")[block]) + int(np.unpackbits(bits, bitorder="little")[: i - block * BLOCK].sum())

    def token(self, i: int) -> int:
        """The i-th id of the file, from one chunk of each of its levels."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level in range(1, self.levels + 1):
            value |= int(self._section(f"chunks{level}", np.uint8)[i]) << (CHUNK_BITS * (level - 1))
            if level == self.levels or not self._section(f"more{level}", np.uint8)[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def range(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to before stop."""
        out = np.zeros(stop - start, np.uint32)
        at = np.arange(stop - start)
        for level in range(1, self.levels + 1):
            out[at] |= self._section(f"chunks{level}", np.uint8)[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * (level - 1))
            if level == self.levels or start == stop:
                break
            low = start // 8
            bits = np.unpackbits(self._section(f"more{level}", np.uint8)[low : (stop + 7) // 8], bitorder="little")[start - 8 * low : stop - 8 * low]
            start, stop = self._rank(level, start), self._rank(level, stop)
            at = at[bits > 0]
        return out


_FILE = "name string, bytes long, docs long, tokens long, sha256 string"


def _write(folder: str, path: str, end: int, file_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (bucket, doc_id, text) in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        tail = np.array([end], "<u4")
        sizes: list[int] = []
        done: list[tuple] = []
        bucket, part, docs, ids, held = None, 0, [], [], 0
        waiting: list[tuple[int, str]] = []

        def flush() -> None:
            nonlocal held, waiting
            for (doc, _), raw in zip(waiting, tokens.encode([t for _, t in waiting])):
                if held and held + len(raw) + 1 > file_tokens:
                    close()
                docs.append(doc)
                ids.extend((raw, tail))
                sizes.append(len(raw) + 1)
                held += len(raw) + 1
            waiting = []

        def close() -> None:
            nonlocal part, docs, ids, sizes, held
            if docs:
                starts = np.cumsum([0, *sizes])
                data = pack(np.concatenate(ids), np.array([-(1 << 63) if d is None else d for d in docs], np.int64), starts)
                name = f"{bucket:06d}-{part:04d}.tokens"
                with committed(folder, name) as out:
                    out.write(data)
                done.append((name, len(data), len(docs), int(starts[-1]), hashlib.sha256(data).hexdigest()))
                part += 1
            docs, ids, sizes, held = [], [], [], 0

        chars = 0
        for batch in batches:
            for b, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if b != bucket:
                    flush()
                    close()
                    bucket, part, chars = b, 0, 0
                waiting.append((doc, text.as_py() or ""))
                chars += len(waiting[-1][1])
                if chars >= CHARS:
                    flush()
                    chars = 0
        flush()
        close()
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], [c.split()[0] for c in _FILE.split(", ")])

    return run


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = END, file_tokens: int = FILE_TOKENS) -> list[dict]:
    """Write the ids of every row of ``docs`` (doc_id, text), each text followed by the id
    ``end``, to ``folder``; returns the manifest, with every file's first token of all."""
    spark = docs.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = split_points(docs, "doc_id", 3 * parts)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("bucket", range_of(F.coalesce("doc_id", F.lit(-(1 << 63))), points))
    ordered = rows.select("bucket", "doc_id", "text").repartition(parts, "bucket").sortWithinPartitions("bucket", "doc_id", "text")
    found = ordered.mapInArrow(_write(folder, path, end, file_tokens), _FILE).collect()  # a row per file
    manifest, start = [], 0
    for r in sorted(found, key=lambda r: r["name"]):
        manifest.append(r.asDict() | {"start": start})
        start += r["tokens"]
    write_manifest(folder, manifest)
    return manifest


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, sha, base in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with open_file(folder, name) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError(f"{name}: not the file of the manifest")
                file = TokenFile(data)
                at = file.starts.tolist()
                crc = []
                for a in range(0, len(at) - 1, 512):  # some documents at a time
                    cut = at[a : min(a + 512, len(at) - 1) + 1]
                    raw = memoryview(file.range(cut[0], cut[-1]).astype("<u4").tobytes())
                    crc += [zlib.crc32(raw[4 * (i - cut[0]) : 4 * (j - cut[0])]) for i, j in zip(cut, cut[1:])]
                docs = pa.array(file.docs, mask=file.docs == -(1 << 63))
                yield pa.RecordBatch.from_arrays([docs, pa.array(file.starts[:-1] + base), pa.array(np.diff(file.starts)), pa.array(crc, pa.int64())], [c.split()[0] for c in _READ.split(", ")])

    return run


def read_tokens(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    prepare(spark)
    files = spark.createDataFrame([(e["name"], e["sha256"], e["start"]) for e in manifest], "name string, sha256 string, start long")
    return files.repartition(max(1, min(len(manifest), int(spark.conf.get("spark.sql.shuffle.partitions"))))).mapInArrow(_read(folder), _READ)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write the token files to a new shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder, path))
