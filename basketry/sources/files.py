"""Market-basket CSV sources and the engine's sinks.

Sources read headered CSV with fixed schemas (never inferred).  Sinks write Parquet
tables (replaced in one step, see ``tables``) and headered CSV extracts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources import tables
from basketry.sources.panel import Panel
from basketry.sources.prices import ensure_prices

DEPARTMENTS = T.StructType([T.StructField("department_id", T.IntegerType()),
                            T.StructField("department", T.StringType())])
PRODUCTS = T.StructType([T.StructField("product_id", T.LongType()),
                         T.StructField("product_name", T.StringType()),
                         T.StructField("aisle_id", T.IntegerType()),
                         T.StructField("department_id", T.IntegerType())])
PRICES = T.StructType([T.StructField("product_id", T.LongType()),
                       T.StructField("price", T.DecimalType(8, 2))])
ORDERS = T.StructType([T.StructField("order_id", T.LongType()),
                       T.StructField("user_id", T.LongType()),
                       T.StructField("eval_set", T.StringType()),
                       T.StructField("order_number", T.IntegerType()),
                       T.StructField("order_dow", T.IntegerType()),
                       T.StructField("order_hour_of_day", T.IntegerType()),
                       T.StructField("days_since_prior_order", T.DoubleType())])
LINES = T.StructType([T.StructField("order_id", T.LongType()),
                      T.StructField("product_id", T.LongType()),
                      T.StructField("add_to_cart_order", T.IntegerType()),
                      T.StructField("reordered", T.IntegerType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a fixed schema; an empty field reads as NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_aisles(spark: SparkSession, path: str) -> DataFrame:
    """Aisles with or without an extra department_id column: read the header as
    strings, keep the two declared columns by name, cast them."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col("aisle_id").cast("int").alias("aisle_id"), F.col("aisle").cast("string"))


def union_prior_train(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Tag each line file with its eval_set and union them by column name."""
    return (prior.withColumn("eval_set", F.lit("prior"))
            .unionByName(train.withColumn("eval_set", F.lit("train"))))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_panel(spark: SparkSession, raw_dir: str) -> Panel:
    """Load a market-basket directory: departments, aisles, products, optional
    product_prices, orders, order_products__prior / __train."""
    j = lambda name: os.path.join(raw_dir, name)
    departments = read_csv(spark, j("departments.csv"), DEPARTMENTS)
    aisles = read_aisles(spark, j("aisles.csv"))
    products = read_csv(spark, j("products.csv"), PRODUCTS)
    prices = read_csv(spark, j("product_prices.csv"), PRICES) if exists(spark, j("product_prices.csv")) else None
    prices = ensure_prices(products, prices)
    orders = read_csv(spark, j("orders.csv"), ORDERS)
    lines = union_prior_train(read_csv(spark, j("order_products__prior.csv"), LINES),
                              read_csv(spark, j("order_products__train.csv"), LINES))
    return Panel(orders=orders, order_products=lines, products=products, departments=departments,
                 aisles=aisles, product_prices=prices)


# --- sinks --------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "overwrite", cluster_by: list[str] | None = None) -> int:
    """Replace a table (or append to it) in one step and return its row count,
    taken by the job that wrote it; ``tables.read_table`` reads it."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    return tables.write_table(df, path, append=mode == "append", cluster_by=cluster_by or ())["rows"]


def write_csv(df: DataFrame, path: str, order_by: list | None = None, single_file: bool = True) -> None:
    """Headered CSV.  Small extracts (≤ a few hundred rows) are sorted and
    written as one file; large tables (per customer, per pair) keep their partitions."""
    out = df.orderBy(*order_by) if order_by else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """A one-row frame with a single JSON string column written as a text file."""
    df.coalesce(1).write.mode("overwrite").text(path)
