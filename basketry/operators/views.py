"""Analytical views (V1–V3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exact import cents, from_cents
from basketry.operators.extracts import department_loyalty  # noqa: F401  (V3 lives with X2)

ORDER_COLUMNS = ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
                 "days_since_prior_order"]


def order_value_view(orders: DataFrame, order_products: DataFrame, prices: DataFrame) -> DataFrame:
    """V1: orders ⋈ lines ⋈ prices, all inner (unpriced lines drop out, unlike C2).

    The lines are aggregated per order_id *before* meeting the orders, so the shuffle
    carries one narrow row per order instead of seven grouping columns per line; with
    order_id the primary key of orders this equals grouping by the seven columns.
    """
    per_order = (order_products.join(prices.select("product_id", "price"), "product_id")
                 .groupBy("order_id")
                 .agg(F.count("product_id").alias("basket_size"), F.sum("price").alias("order_value")))
    return orders.select(*ORDER_COLUMNS).join(per_order, "order_id")


def customer_orders_view(order_value: DataFrame) -> DataFrame:
    """V2: per user n_orders, total_spend, avg_order_value, total_items, last_order_number."""
    agg = order_value.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(cents(F.col("order_value"))).alias("_cents"),
        F.sum("basket_size").alias("total_items"),
        F.max("order_number").alias("last_order_number"))
    return agg.select(
        "user_id", "n_orders", from_cents(F.col("_cents")).alias("total_spend"),
        (F.col("_cents").cast("double") / (F.col("n_orders") * 100).cast("double")).alias("avg_order_value"),
        "total_items", "last_order_number")
