"""A deterministic sharded WARC writer, and its reader.

Pages are dealt once by ranges of page_id and written in ascending order, each record as a gzip
member of its own, to files that roll over when the next would pass ``FILE_BYTES`` compressed
bytes.  Range limits come from a hash sample of the ids, dates and record ids from the data, so
the same table always gives the same files, byte by byte.  A file is written under a temporary
name and renamed when complete; the manifest lists the files, their sizes and digests, and is
itself committed last.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the first by page_id is a
``response`` and the others are ``revisit`` records that refer to it.  Repeated payloads are
found on digests alone: the pages with one before them are marked by small rows that are dealt
to the same ranges as the pages, so no html is joined and no group of copies is gathered.

Defined cases: a null html is an empty payload; a null url is an empty target; of rows with one
page_id and payload the first written is the response, and the others revisit their own id;
extra columns are ignored; an empty table writes an empty manifest.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.order import range_of, split_points
from basketry.llm.storage import committed, new_folder, open_file, write_manifest
from basketry.llm.texts import prepare
from basketry.session import write_table

FILE_BYTES = 64 << 20
REVISIT_BYTES = 100
#: Records carry the date of the dataset, not of the run.
DATE = "2024-01-01T00:00:00Z"

_FILE = "name string, bytes long, records long, sha256 string"


def _record_id(kind: str, page: int, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{kind} {page} {digest} {nth}')}>"


def _header(value: str) -> str:
    """A header's value on one line: line ends and percent signs are percent-coded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(page: int, url: str, payload: bytes, first: int | None, nth: int) -> bytes:
    """One record; ``first`` is the page whose response a revisit refers to."""
    digest = hashlib.sha256(payload).hexdigest()
    kind = "response" if first is None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(kind, page, digest, nth)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-ID: {page}", f"X-Payload-Length: {len(payload)}"]
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id('response', first, digest, 0)}", f"X-Refers-To-Page-ID: {first}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if first is None else b"")
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time
    return c.compress(data) + c.flush()


def _write(folder: str, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (bucket, page_id, kind, refers_to, url, html) in order; kind 0 marks that the page
    after it revisits refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        bucket, part, held, records, size = None, 0, io.BytesIO(), 0, 0

        def close() -> None:
            nonlocal part, held, records, size
            if records:
                name, data = f"{bucket:06d}-{part:04d}.warc.gz", held.getvalue()
                with committed(folder, name) as out:
                    out.write(data)
                done.append((name, len(data), records, hashlib.sha256(data).hexdigest()))
                part += 1
            held, records, size = io.BytesIO(), 0, 0

        marked: dict[str, int] = {}
        seen: dict[tuple, int] = {}
        page_now = None
        for batch in batches:
            for b, page, kind, refers, digest, url, html in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if b != bucket:
                    close()
                    bucket, part = b, 0
                if page != page_now:
                    page_now, marked, seen = page, {}, {}
                if kind == 0:
                    marked[digest] = refers
                    continue
                payload = (html or "").encode("utf-8", "replace")
                own = hashlib.sha256(payload).hexdigest() if len(payload) >= REVISIT_BYTES else None
                first = marked.get(own) if own else None
                nth = seen[own, url] = seen.get((own, url), -1) + 1
                if first == page and not seen.get(own):
                    first = None
                if own:
                    seen[own] = 1
                data = _member(record(page, url or "", payload, first, nth))
                if records and size + len(data) > file_bytes:
                    close()
                held.write(data)
                records += 1
                size += len(data)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["name", "bytes", "records", "sha256"])

    return run


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> list[dict]:
    """Write every row of ``pages`` (page_id, url, html) to ``folder``; returns the manifest."""
    spark = pages.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests, _ = write_table(rows.where(F.octet_length(body) >= REVISIT_BYTES).select("page_id", F.sha2(body, 256).alias("digest")), "warc-digests")
    firsts, _ = write_table(digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-firsts")
    # also a page's own repeated rows: whether the row is the first is known when it is written
    marks = digests.distinct().join(firsts, "digest").select("page_id", "refers_to", "digest")
    none = lambda t: F.lit(None).cast(t)
    both = rows.select("page_id", F.lit(1).alias("kind"), none("long").alias("refers_to"), none("string").alias("digest"), "url", "html").unionByName(
        marks.select("page_id", F.lit(0).alias("kind"), "refers_to", "digest", none("string").alias("url"), none("string").alias("html")))
    points = split_points(rows, "page_id", 3 * parts)
    dealt = both.withColumn("bucket", range_of(F.coalesce("page_id", F.lit(-(1 << 63))), points)).repartition(parts, "bucket")
    ordered = dealt.select("bucket", "page_id", "kind", "refers_to", "digest", "url", "html").sortWithinPartitions("bucket", "page_id", "kind", "url", "html")
    manifest = [r.asDict() for r in ordered.mapInArrow(_write(folder, file_bytes), _FILE).collect()]  # a row per file
    write_manifest(folder, manifest)
    return manifest


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive whose records are gzip members."""
    while data:
        d = zlib.decompressobj(31)
        raw = d.decompress(data)
        data = d.unused_data
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        yield headers, rest[: int(headers["Content-Length"])]


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(folder, name) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != digest:
                    raise ValueError(f"{name}: not the file of the manifest")
                rows = []
                for h, block in parse_records(data):
                    if "sha256:" + hashlib.sha256(block).hexdigest() != h["WARC-Block-Digest"]:
                        raise ValueError(f"{name}: a block's digest differs")
                    size, payload = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response":
                        body = block[block.index(b"\r\n\r\n") + 4 :]
                        size, payload = len(body), hashlib.sha256(body).hexdigest()
                    page, refers = h["X-Page-ID"], h.get("X-Refers-To-Page-ID")
                    rows.append((None if page == "None" else int(page), size, payload, h["WARC-Type"], refers and int(refers)))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], [c.split()[0] for c in _READ.split(", ")])

    return run


def read_warc(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    prepare(spark)
    files = spark.createDataFrame([(e["name"], e["sha256"]) for e in manifest], "name string, sha256 string")
    return files.repartition(max(1, min(len(manifest), int(spark.conf.get("spark.sql.shuffle.partitions"))))).mapInArrow(_read(folder), _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives to a new shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_warc(pages.sparkSession, folder, write_warc(pages, folder))
