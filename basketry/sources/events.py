"""Derive the order panel from an event stream table (event_id, ts, user_id, props).

Mapping: an order is one user's activity on one calendar day, with order_id =
user_id · 100000 + days since 2024-01-01; each event is a line whose product is
``props.k``; its department is k mod 5 and its price the deterministic fallback (P9);
cart position follows event_id; the order's hour is the hour of its first event.
The sequencing steps (P1–P7) are the same as for the star tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.panel import Panel
from basketry.sources.prices import derived_prices
from basketry.sources.star import basket_lines, flag_reorders, read_table, sequence_orders

EPOCH = "2024-01-01"
ORDER_STRIDE = 100000
DEPARTMENTS = 5


def event_lines(events: DataFrame) -> DataFrame:
    """(order_id, user_id, ts, product_id, line) per event."""
    day = F.to_date("ts")
    return events.select(
        (F.col("user_id") * ORDER_STRIDE + F.datediff(day, F.lit(EPOCH))).alias("order_id"),
        "user_id", "ts",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("event_id").alias("line"))


def events_panel(spark: SparkSession, sf_dir: str) -> Panel:
    ev = event_lines(read_table(spark, sf_dir, "events"))
    raw_orders = ev.groupBy("order_id", "user_id").agg(F.min("ts").alias("ts"))
    orders = sequence_orders(raw_orders)
    products = (ev.select("product_id").where(F.col("product_id").isNotNull()).distinct()
                .select("product_id",
                        F.concat(F.lit("item "), F.col("product_id").cast("string")).alias("product_name"),
                        F.pmod(F.col("product_id"), F.lit(DEPARTMENTS)).cast("int").alias("aisle_id"),
                        F.pmod(F.col("product_id"), F.lit(DEPARTMENTS)).cast("int").alias("department_id")))
    departments = products.select("department_id").distinct().select(
        "department_id", F.concat(F.lit("department "), F.col("department_id").cast("string")).alias("department"))
    aisles = departments.select(F.col("department_id").alias("aisle_id"), F.col("department").alias("aisle"))
    li = ev.select("order_id", "product_id", "line")
    lines = flag_reorders(basket_lines(li, dedup=True, coarse=1024), orders, "inner")
    raw = flag_reorders(basket_lines(li, dedup=False, coarse=1024), orders, "left")
    return Panel(orders=orders, order_products=lines, products=products, departments=departments,
                 aisles=aisles, product_prices=derived_prices(products), order_products_raw=raw)
