"""Binary files in the shared folder, written by tasks and committed by rename."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from basketry.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one written dataset."""
    return f"{shared_dir(spark)}/files/{name}-{uuid.uuid4().hex}"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@contextmanager
def committed(folder: str, name: str) -> Iterator[object]:
    """A stream to ``folder/name``: it is written under a temporary name of this attempt and
    renamed when complete, so a lost or repeated task leaves no partial file behind the name."""
    fs, base = file_system(folder)
    temporary = posixpath.join(base, "_temporary", f"{uuid.uuid4().hex}-{name}")
    fs.create_dir(posixpath.dirname(temporary), recursive=True)
    with fs.open_output_stream(temporary, compression=None) as out:
        yield out
    fs.move(temporary, posixpath.join(base, name))


def write_manifest(folder: str, entries: list[dict]) -> None:
    """The dataset's files in order; readers take only what it lists."""
    with committed(folder, "manifest.json") as out:
        out.write(json.dumps({"files": sorted(entries, key=lambda e: e["name"])}, indent=1).encode())
    fs, base = file_system(folder)
    fs.delete_dir(posixpath.join(base, "_temporary"))


def read_manifest(folder: str) -> list[dict]:
    fs, base = file_system(folder)
    with fs.open_input_stream(posixpath.join(base, "manifest.json"), compression=None) as f:
        return json.loads(f.read())["files"]


def open_file(folder: str, name: str):
    fs, base = file_system(folder)
    return fs.open_input_file(posixpath.join(base, name))
