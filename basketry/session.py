"""SparkSession construction and the few session-level settings the engine relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_SHIPPED: dict[str, str] = {}

# Settings every session gets.  AQE re-plans joins from measured shuffle sizes (that is
# the size check behind every data-dependent broadcast in this package), coalesces
# small partitions and splits skewed join partitions at run time.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "basketry") -> SparkSession:
    """Return the active session or build a local one (tests, bench).

    On a cluster the session already exists and its own configuration wins; we only
    fill in what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("BASKETRY_MASTER", "local[8]"))
    for k, v in _CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    builder = builder.config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a single-machine session (local master) may leave it unset; it then gets a folder
    of its own under the system's temporary folder.  On a cluster that would be a different
    folder on every machine, so an unset one is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if sc.getCheckpointDir():
            configured = sc.getCheckpointDir()
        elif sc.master == "local" or sc.master.startswith("local["):
            configured = os.path.join(tempfile.gettempdir(), f"basketry-{sc.applicationId}")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point Spark's reliable checkpoints at ``shared_dir``."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return sc.getCheckpointDir()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table or file this package wrote, on whatever file system holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_table(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write an intermediate that several jobs read to the shared folder as Parquet and
    return ``(DataFrame reading it, path)``.  Readers prune columns; losing an executor
    costs nothing that was written.  The caller deletes the path with ``drop_path`` once
    no plan reads it any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    back = spark.read.schema(spark.read.parquet(path).schema if partition_by else df.schema).parquet(path)
    return back, path


def materialize(df):
    """``write_table`` for callers that leave the deletion to the folder's owner."""
    return write_table(df, "intermediate")[0]


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that don't share the driver's path
    (once per application; the same as passing it with ``--py-files``)."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory() as folder:
        name = shutil.make_archive(os.path.join(folder, os.path.basename(here)), "zip", os.path.dirname(here), os.path.basename(here))
        kept = os.path.join(tempfile.gettempdir(), f"{os.path.basename(here)}-{sc.applicationId}.zip")
        shutil.copyfile(name, kept)  # Spark serves it to executors for as long as the application runs
    sc.addPyFile(kept)
    _SHIPPED["app"] = sc.applicationId
