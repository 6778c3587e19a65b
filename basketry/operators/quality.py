"""Data-quality report (Q1–Q10), declared-key checks (S7) and load counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.sources import tables


def null_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Q1: (table_name, column_name, nulls) for every column of every table; one
    aggregate pass per table, unpivoted."""
    parts = []
    for name, df in frames.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = agg.unpivot([], df.columns, "column_name", "nulls")
        parts.append(long.select(F.lit(name).alias("table_name"), "column_name", "nulls"))
    return reduce(DataFrame.unionByName, parts)


def _one(df: DataFrame, col) -> "F.Column":
    return df.agg(col).scalar()


def quality_checks(orders: DataFrame, order_products: DataFrame, products: DataFrame,
                   prices: DataFrame) -> DataFrame:
    """Q2–Q9 as one row; every value is a scalar subquery over the tables (no driver
    round trip, no key lists held in memory: anti joins instead of IN-lists)."""
    spark: SparkSession = orders.sparkSession
    gap = F.col("days_since_prior_order")
    # the three order-level checks share one aggregation pass over orders
    per_order = orders.agg(F.struct(
        (F.count(F.lit(1)) - F.countDistinct("order_id")
         - F.max(F.col("order_id").isNull().cast("int"))).cast("bigint").alias("dup"),
        (F.count_if(gap.isNull()) == F.count_if(F.col("order_number") == 1)).alias("match"),
        F.count_if((gap < fixed.GAP_MIN) | (gap > fixed.GAP_MAX)).alias("out"))).scalar()
    dup_orders, nulls_match, out_of_range = per_order["dup"], per_order["match"], per_order["out"]
    # distinct (order_id, product_id) tuples, NULLs counted as values: a grouped count
    groups = order_products.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("_n"))
    dup_lines = _one(groups, (F.sum("_n") - F.count(F.lit(1))).cast("bigint"))
    orphan_products = _one(order_products.where(F.col("product_id").isNotNull())
                           .join(products.select("product_id"), "product_id", "left_anti"), F.count(F.lit(1)))
    orphan_orders = _one(order_products.where(F.col("order_id").isNotNull())
                         .join(orders.select("order_id"), "order_id", "left_anti"), F.count(F.lit(1)))
    nonpositive = _one(prices, F.count_if(F.col("price") <= 0))
    empty_orders = _one(orders.where(F.col("order_id").isNotNull())
                        .join(order_products.select("order_id"), "order_id", "left_anti"), F.count(F.lit(1)))
    return spark.range(1).select(
        dup_orders.alias("duplicate_order_ids"),
        dup_lines.alias("duplicate_line_items"),
        nulls_match.alias("dspo_nulls_match_first_orders"),
        out_of_range.alias("dspo_out_of_range"),
        orphan_products.alias("orphan_product_refs"),
        orphan_orders.alias("orphan_order_refs"),
        nonpositive.alias("nonpositive_prices"),
        empty_orders.alias("orders_without_items"))


def quality_report_json(orders, order_products, products, prices, seen: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Q10: the report as one JSON document: ``null_counts`` (table → column → count, in
    table and column order) plus the eight checks.  Each table's counts are one struct
    from one aggregation pass, attached as a scalar subquery; or come from the checks that the
    load has ``seen``, without a pass."""
    frames = {"orders": orders, "order_products": order_products, "products": products,
              "product_prices": prices}
    nulls = lambda name, df: df.agg(F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])).scalar()
    if seen:
        nulls = lambda name, df: F.struct(*[F.lit(seen[name][f"nulls:{c}"]).cast("bigint").alias(c) for c in df.columns])
    per_table = [nulls(name, df).alias(name) for name, df in frames.items()]
    checks = quality_checks(orders, order_products, products, prices)
    row = checks.select(F.struct(*per_table).alias("null_counts"), "*")
    return row.select(F.to_json(F.struct(*row.columns)).alias("report"))


# --- checks taken while a table is written (S7, Q1, Q4, Q5, Q8) --------------------------

def load_checks(name: str, df: DataFrame) -> dict[str, Column]:
    """Aggregates of one table's own rows: NULLs of every column and what its values must meet."""
    checks = {f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    if name == "orders":
        gap = F.col("days_since_prior_order")
        checks["first_orders"] = F.count_if(F.col("order_number") == 1)
        checks["dspo_out_of_range"] = F.count_if((gap < fixed.GAP_MIN) | (gap > fixed.GAP_MAX))
    if name == "product_prices":
        checks["nonpositive_prices"] = F.count_if(F.col("price") <= 0)
    return checks


def load_tables(frames: dict[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Write each table under ``folder`` and take its checks in the same pass.  Returns the tables,
    read back, and the checks by table, with ``rows``."""
    loaded, seen = {}, {}
    for name, df in frames.items():
        made = tables.write_table(df, f"{folder}/{name}", observe=load_checks(name, df))
        seen[name] = {**made["metrics"], "rows": made["rows"]}
        loaded[name] = tables.read_table(df.sparkSession, f"{folder}/{name}")
    return loaded, seen


def checks_table(spark: SparkSession, seen: dict[str, dict[str, int]]) -> DataFrame:
    """(table_name, check_name, n), a row a check."""
    return spark.createDataFrame([(t, c, n) for t, checks in seen.items() for c, n in checks.items()], "table_name string, check_name string, n long")


# --- declared keys (S7) ---------------------------------------------------------------
# table → primary key, NOT NULL columns, foreign keys (cols, parent table, parent cols)
DECLARED_KEYS = {
    "departments": (["department_id"], ["department_id", "department"], []),
    "aisles": (["aisle_id"], ["aisle_id", "aisle"], []),
    "products": (["product_id"], ["product_id", "product_name"],
                 [("aisle_id", "aisles", "aisle_id"), ("department_id", "departments", "department_id")]),
    "product_prices": (["product_id"], ["product_id", "price"], [("product_id", "products", "product_id")]),
    "orders": (["order_id"], ["order_id", "user_id", "eval_set", "order_number", "order_dow",
                               "order_hour_of_day"], []),
    "order_products": (["order_id", "product_id"],
                       ["order_id", "product_id", "add_to_cart_order", "reordered", "eval_set"],
                       [("order_id", "orders", "order_id"), ("product_id", "products", "product_id")]),
}


def constraint_violations(frames: dict[str, DataFrame], keys=DECLARED_KEYS) -> DataFrame:
    """(table_name, constraint_name, violations) for every declared key.

    PK: rows beyond the first per non-NULL key; NOT NULL: NULL count; FK: non-NULL
    references missing from the parent (anti join).
    """
    parts = []
    for table, (pk, not_null, fks) in keys.items():
        df = frames[table]
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pk])
        groups = df.where(present).groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(groups.agg((F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).cast("bigint").alias("violations"))
                     .select(F.lit(table).alias("table_name"), F.lit("pk_" + "_".join(pk)).alias("constraint_name"),
                             "violations"))
        nn = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        parts.append(nn.unpivot([], not_null, "_c", "violations")
                     .select(F.lit(table).alias("table_name"),
                             F.concat(F.lit("not_null_"), F.col("_c")).alias("constraint_name"), "violations"))
        for col, parent, pcol in fks:
            missing = (df.where(F.col(col).isNotNull())
                       .join(frames[parent].select(F.col(pcol).alias(col)), col, "left_anti"))
            parts.append(missing.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(table).alias("table_name"),
                                 F.lit(f"fk_{col}_{parent}").alias("constraint_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def assert_constraints(violations: DataFrame) -> None:
    """Fail the load like a database would: raise when any declared key is violated.
    The input has one row per declared constraint, so collecting it is bounded."""
    bad = [r for r in violations.where(F.col("violations") > 0).collect()]
    if bad:
        raise ValueError("constraint violations: " + ", ".join(
            f"{r.table_name}.{r.constraint_name}={r.violations}" for r in bad))


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(t, n) row counts of the loaded tables, as a UNION ALL of counts."""
    return reduce(DataFrame.unionByName,
                  [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), "n")
                   for t, df in frames.items()])
