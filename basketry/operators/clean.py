"""Cleaning: the per-order table ``orders_clean``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import fixed


def clip_gap(col: Column, lo: int = fixed.GAP_MIN, hi: int = fixed.GAP_MAX) -> Column:
    """C4: cast to double and clip to [lo, hi]; NULL stays NULL (``greatest``/``least``
    alone would turn NULL into a bound)."""
    x = col.cast("double")
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))


def priced_lines(order_products: DataFrame, prices: DataFrame) -> DataFrame:
    """Every line with its price; unpriced lines keep a NULL price (left join)."""
    return order_products.join(prices.select("product_id", "price"), "product_id", "left")


def order_basket_value(order_products: DataFrame, prices: DataFrame) -> DataFrame:
    """Per order basket_size, order_value (0 when no line is priced), reordered_items."""
    return (priced_lines(order_products, prices)
            .groupBy("order_id")
            .agg(F.count(F.lit(1)).cast("int").alias("basket_size"),
                 F.coalesce(F.sum("price"), F.lit(0)).cast("decimal(10,2)").alias("order_value"),
                 F.sum("reordered").cast("int").alias("reordered_items")))


def orders_clean(orders: DataFrame, order_products: DataFrame, prices: DataFrame) -> DataFrame:
    """Orders that have lines, with their basket values and the clipped gap.

    Sorting (C5) is left to writers (``sortWithinPartitions``); a global sort here would
    cost a range shuffle that no consumer needs.
    """
    per_order = order_basket_value(order_products, prices)
    return (orders.join(per_order, "order_id", "inner")
            .select("order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
                    clip_gap(F.col("days_since_prior_order")).alias("days_since_prior_order"),
                    "basket_size", "order_value", "reordered_items"))
