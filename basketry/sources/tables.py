"""Parquet tables that are replaced as a whole or not at all.

A table is a folder: rows lie in ``v<number>-<id>/`` folders, one per committed write, and
``_manifests/<number>.json`` lists the files of each version in order.  A write stages its files in
a folder of its own, then its manifest appears by one rename; the largest number is the table.  A
write that fails, at any point, leaves the version before it as it was, and what it left behind
is deleted by the next write that succeeds.  Files are named in the manifest, so a reader never
sees a half-written folder.  One writer a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Files:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(folder))) if self.fs.exists(self.at(folder)) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """The whole file under its name by one rename; an error if the name is taken."""
        staged = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(staged), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(path)) or not self.fs.rename(self.at(staged), self.at(path)):
            self.fs.delete(self.at(staged), False)
            raise RuntimeError(f"{path} exists: another writer has replaced the table")

    def drop(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


def _versions(files: _Files, path: str) -> list[int]:
    return [int(n[:-5]) for n in files.names(f"{path}/_manifests") if n.endswith(".json") and n[:-5].isdigit()]


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The current version: number, schema, rows, files in order, metrics; None without one."""
    files = _Files(spark, path)
    numbers = _versions(files, path)
    return json.loads(files.read(f"{path}/_manifests/{max(numbers):08d}.json")) if numbers else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version."""
    current = manifest(spark, path)
    if current is None:
        raise FileNotFoundError(f"no version of {path} has been committed")
    schema = T.StructType.fromJson(current["schema"])
    files = [f"{path}/{f}" for f in current["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, append: bool = False, cluster_by: Sequence[str] = (),
                observe: Mapping[str, Column] | None = None) -> dict:
    """Replace the table (or add to it) with the rows of ``df``; returns the new manifest.

    ``cluster_by`` deals the rows to ranges of these columns and sorts each, so that the files, in the
    manifest's order, hold them ascending, and their statistics let a reader skip files.  Rows are
    dealt by all the columns, so a value of the first that many rows share is spread.

    Rows are counted, and the aggregates of ``observe`` taken, by the very job that writes them.
    """
    spark, files = df.sparkSession, _Files(df.sparkSession, path)
    number = max(_versions(files, path), default=0) + 1
    before = manifest(spark, path) if append else None
    folder = f"v{number:08d}-{uuid.uuid4().hex}"
    out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("_rows"), *[c.alias(k) for k, c in (observe or {}).items()]).write.parquet(f"{path}/{folder}")
    metrics = dict(seen.get)
    rows = metrics.pop("_rows", 0)
    names = [f"{folder}/{n}" for n in files.names(f"{path}/{folder}") if n.startswith("part-")]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    if before and T.StructType.fromJson(before["schema"]) != schema:
        files.drop(f"{path}/{folder}")
        raise ValueError("rows of another schema cannot be added")
    new = {"number": number, "schema": schema.jsonValue(), "rows": rows + (before["rows"] if before else 0),
           "files": (before["files"] if before else []) + names, "sorted_by": [] if append else list(cluster_by), "metrics": metrics}
    files.fs.mkdirs(files.at(f"{path}/_manifests"))
    files.publish(f"{path}/_manifests/{number:08d}.json", json.dumps(new, default=str))
    _tidy(files, path, number, {f.partition("/")[0] for f in new["files"]})
    return new


def _tidy(files: _Files, path: str, number: int, kept: set[str]) -> None:
    """Delete the manifests before a version, and then what only they or failed writes hold."""
    for n in files.names(f"{path}/_manifests"):
        if n != f"{number:08d}.json" and not (n[:-5].isdigit() and int(n[:-5]) > number):
            files.drop(f"{path}/_manifests/{n}")
    for n in files.names(path):
        if n.startswith("v") and n not in kept and n[1:9].isdigit() and int(n[1:9]) <= number:
            files.drop(f"{path}/{n}")


def ordered_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows with ``_file`` (the place of their file in the manifest) and ``_at`` (in the file)."""
    current = manifest(spark, path)
    place = F.create_map(*[x for k, f in enumerate(current["files"]) for x in (F.lit(f.rpartition("/")[2]), F.lit(k))]) if current["files"] else F.lit(None)
    return read_table(spark, path).select("*", place[F.col("_metadata.file_name")].alias("_file"), F.col("_metadata.row_index").alias("_at"))


def order_breaks(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(rows, breaks): the rows of a table, and how many, read file after file in the manifest's
    order, have smaller keys than the row before them.  Windows hold one file, or one row a file."""
    from pyspark.sql import Window

    rows = ordered_rows(spark, path).select("_file", "_at", F.struct(*keys).alias("k"))
    inside = rows.select("_file", "k", F.lag("k").over(Window.partitionBy("_file").orderBy("_at")).alias("before"))
    files = inside.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"),
                                        F.count_if(F.col("k") < F.col("before")).alias("inside"))
    between = files.select("n", "inside", (F.col("lo") < F.lag("hi").over(Window.orderBy("_file"))).alias("across"))
    return between.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                       F.coalesce(F.sum(F.col("inside") + F.coalesce(F.col("across").cast("long"), F.lit(0))), F.lit(0)).alias("breaks"))
