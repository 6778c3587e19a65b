"""Dashboard extracts (X1–X5): small aggregated tables read by the BI layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.exact import cents, half_even, half_up, half_up_units, mean_score


def _whole(col: str) -> Column:
    # grand total over an aggregated frame of at most one row per segment/department
    return F.sum(col).over(Window.partitionBy())


def segment_summary(rfm: DataFrame) -> DataFrame:
    """X1 + X1a: per segment customers, rounded means (half-up), totals, the action, and
    the shares of customers and of revenue (half-even, from the rounded totals)."""
    agg = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.round(F.col("recency") * 2).cast("bigint")).alias("_rec2"),
        F.sum("frequency").alias("_freq"),
        F.sum(cents(F.col("monetary"))).alias("_cents"),
        F.sum("rfm_score").alias("_score"),
        F.max("action").alias("recommended_action"))
    return agg.select(
        "segment", "customers",
        half_up(F.col("_rec2"), F.col("customers") * 2, 1).alias("avg_recency_days"),
        half_up(F.col("_freq"), F.col("customers"), 1).alias("avg_frequency"),
        (half_up_units(F.col("_cents"), F.col("customers"), 0) / 100).alias("avg_monetary"),
        (F.col("_cents") / 100).alias("total_monetary"),
        half_up(F.col("_score"), F.col("customers"), 2).alias("avg_rfm_score"),
        "recommended_action",
        half_even(F.col("customers") * 100, _whole("customers"), 1).alias("pct_customers"),
        half_even(F.col("_cents").cast("decimal(38,0)") * 100, _whole("_cents"), 1).alias("pct_revenue"))


def prior_lines_by(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """Prior lines with their user (filter on the line's eval_set, then the order join)."""
    return (order_products.where(F.col("eval_set") == "prior")
            .join(orders.select("order_id", "user_id"), "order_id"))


def department_loyalty(order_products: DataFrame, orders: DataFrame, products: DataFrame,
                       departments: DataFrame) -> DataFrame:
    """Prior lines per department: lines, reorders, rate (4 dp), customers."""
    lines = (prior_lines_by(order_products, orders)
             .join(products.select("product_id", "department_id"), "product_id")
             .join(departments, "department_id"))
    return (lines.groupBy("department_id", "department")
            .agg(F.count(F.lit(1)).alias("line_items"),
                 F.sum("reordered").cast("bigint").alias("reordered_items"),
                 F.countDistinct("user_id").alias("unique_customers"))
            .select("department_id", "department", "line_items", "reordered_items",
                    half_up(F.col("reordered_items"), F.col("line_items"), 4).alias("reorder_rate"),
                    "unique_customers"))


def department_loyalty_extract(dept_loyalty: DataFrame) -> DataFrame:
    """The view without its id, by reorder rate descending."""
    return (dept_loyalty.select("department", "line_items", "reordered_items", "reorder_rate", "unique_customers")
            .orderBy(F.col("reorder_rate").desc(), F.col("department")))


def product_loyalty(order_products: DataFrame, orders: DataFrame, products: DataFrame,
                    departments: DataFrame, min_count: int = fixed.PRODUCT_MIN_PURCHASES,
                    k: int | None = fixed.PRODUCT_TOP_K) -> DataFrame:
    """Prior lines per product with ≥ ``min_count`` purchases; top ``k`` by reorder
    rate, then purchases, then product id (the last key makes the cut deterministic)."""
    lines = (prior_lines_by(order_products, orders)
             .join(products.select("product_id", "product_name", "department_id"), "product_id")
             .join(departments, "department_id"))
    agg = (lines.groupBy("product_id", "product_name", "department")
           .agg(F.count(F.lit(1)).alias("times_purchased"),
                F.sum("reordered").alias("_re"),
                F.countDistinct("user_id").alias("unique_customers"))
           .where(F.col("times_purchased") >= min_count)
           .select("product_id", "product_name", "department", "times_purchased",
                   half_up(F.col("_re"), F.col("times_purchased"), 4).alias("reorder_rate"),
                   "unique_customers"))
    ordered = agg.orderBy(F.col("reorder_rate").desc(), F.col("times_purchased").desc(), F.col("product_id"))
    return ordered.limit(k) if k else ordered


def order_trends(orders_clean: DataFrame) -> DataFrame:
    """Orders and mean order value (2 dp, half-up) per weekday × hour."""
    return (orders_clean.groupBy("order_dow", "order_hour_of_day")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(cents(F.col("order_value"))).alias("_c"))
            .select("order_dow", "order_hour_of_day", "orders",
                    (half_up_units(F.col("_c"), F.col("orders"), 0) / 100).alias("avg_order_value"))
            .orderBy("order_dow", "order_hour_of_day"))


def department_opportunity(predictions: DataFrame, products: DataFrame, departments: DataFrame,
                           score: str = "reorder_proba") -> DataFrame:
    """Candidates, mean propensity (4 dp) and actual reorders per department."""
    joined = (predictions.join(products.select("product_id", "department_id"), "product_id")
              .join(departments, "department_id"))
    return (joined.groupBy("department")
            .agg(F.count(F.lit(1)).alias("predicted_candidates"),
                 mean_score(F.col(score), F.count(F.lit(1))).alias("avg_reorder_proba"),
                 F.sum("reordered_target").cast("bigint").alias("actual_reorders"))
            .orderBy(F.col("avg_reorder_proba").desc(), F.col("department")))
