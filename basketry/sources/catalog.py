"""Tables by name for SQL, bucketed by the key they are joined on.

``save_table`` writes the rows as a table of the catalog under a new physical name and then lets a
view of the wanted name point at it; the view's replacement is the commit, and the table behind
the old view is dropped after it.  Tables bucketed by a join's key into equally many buckets are joined
and aggregated by it without moving a row.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.panel import Panel

#: A table of which one bucket would hold more than this many times the mean is not bucketed: a
#: bucket is read by one task.
UNEVEN = 8


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 64, sort_by: Sequence[str] = ()) -> int:
    """Replace the table ``name`` (may be ``database.table``) and return its number of rows."""
    spark = df.sparkSession
    physical = f"{name}__{uuid.uuid4().hex[:12]}"
    if bucket_by and _even(df, bucket_by, buckets):
        writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer.sortBy(bucket_by)
    else:
        writer = df.write
    old = _behind(spark, name)
    writer.format("parquet").saveAsTable(physical)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {physical}")
    for table in old:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.table(physical).count()


def _even(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether no bucket would be much larger than the others; one row a bucket is collected."""
    sizes = [r["n"] for r in df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(sizes, default=0) <= UNEVEN * max(1, sum(sizes) // buckets)


def _behind(spark: SparkSession, name: str) -> list[str]:
    """Physical tables of earlier versions, also those of writes that failed."""
    database, _, table = name.rpartition(".")
    found = spark.sql(f"SHOW TABLES {'IN ' + database if database else ''} LIKE '{table.lower()}__*'").collect()
    return [f"{database + '.' if database else ''}{r['tableName']}" for r in found if not r["isTemporary"]]


def save_panel(panel: Panel, database: str, buckets: int = 64) -> Panel:
    """The panel as tables of a database: orders and lines bucketed by order, so that lines meet
    their orders without an exchange; the catalog's small tables as they are.  Returns the
    panel that reads them."""
    spark = panel.orders.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in ("orders", "order_products", "order_products_raw"):
        save_table(getattr(panel, name), f"{database}.{name}", "order_id", buckets)
    for name in ("products", "departments", "aisles", "product_prices"):
        save_table(getattr(panel, name), f"{database}.{name}")
    return read_panel(spark, database)


def read_panel(spark: SparkSession, database: str) -> Panel:
    names = ("orders", "order_products", "products", "departments", "aisles", "product_prices", "order_products_raw")
    return Panel(**{n: spark.table(f"{database}.{n}") for n in names})
