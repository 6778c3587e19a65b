"""Materialize the engine's tables and extracts for one panel.

Only the three tables that later steps re-read are written as Parquet (orders_clean,
reorder_features, reorder_predictions); everything else stays a lazy plan over them
until its own extract is written.  A rerun replaces each table in one step (``sources.tables``):
until a table's new version is complete, readers get the old one.  With a ``database``, the
tables are in the catalog too, for SQL by name.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.operators import clean, dashboard, extracts, features, learning, quality, rfm
from basketry.sources import catalog, files, tables
from basketry.sources.panel import Panel
from basketry.session import materialize

ORDERS_CLEAN_TYPES = {
    "order_id": "bigint", "user_id": "bigint", "eval_set": "string", "order_number": "int", "order_dow": "int",
    "order_hour_of_day": "int", "days_since_prior_order": "double", "basket_size": "int",
    "order_value": "decimal(10,2)", "reordered_items": "int",
}


def typed_orders_clean(oc: DataFrame) -> DataFrame:
    """The declared column types of ``orders_clean``."""
    return oc.select(*[F.col(c).cast(t).alias(c) for c, t in ORDERS_CLEAN_TYPES.items()])


def write_all(spark: SparkSession, panel: Panel, out_dir: str, gbt_rounds: int = fixed.GBT_ROUNDS,
              check_keys: bool = True, database: str | None = None) -> dict[str, int]:
    """Write the data-quality report, the three tables, the model outputs and the five
    extracts under ``out_dir``; return the row counts of the written tables."""
    p = lambda *parts: os.path.join(out_dir, *parts)
    counts: dict[str, int] = {}

    def write(df: DataFrame, name: str, cluster_by: list[str] | None = None) -> DataFrame:
        counts[name] = files.write_table(df, p("tables", name), cluster_by=cluster_by)
        if database:
            catalog.save_table(tables.read_table(spark, p("tables", name)), f"{database}.{name}")
        return tables.read_table(spark, p("tables", name))

    # load: the base tables are written once, checked on the way, and every later step reads them
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    frames = {n: getattr(panel, n) for n in ("orders", "order_products", "products", "departments", "aisles", "product_prices")}
    loaded, seen = quality.load_tables({**frames, "order_products_raw": panel.order_products_raw}, p("tables"))
    counts.update({name: checks["rows"] for name, checks in seen.items()})
    panel = Panel(**loaded)
    if database:
        for name, df in loaded.items():
            catalog.save_table(df, f"{database}.{name}")
    if check_keys:
        quality.assert_constraints(quality.constraint_violations({**loaded, "order_products": panel.order_products_raw}))
    files.write_json_document(quality.quality_report_json(panel.orders, panel.order_products_raw, panel.products, panel.product_prices, {
        **seen, "order_products": seen["order_products_raw"]}), p("data_quality_report"))

    oc = typed_orders_clean(clean.orders_clean(panel.orders, panel.order_products, panel.product_prices))
    oc = write(oc, "orders_clean", cluster_by=["user_id", "order_number"])

    seg = rfm.rfm_segments(oc, with_cell=True)
    seg = write(seg.drop("rfm_cell"), "rfm_segments")
    files.write_csv(seg.withColumn(
        "rfm_cell", F.concat(F.col("R").cast("string"), F.col("F").cast("string"))),
        p("extracts", "rfm_segments"), single_file=False)

    feats = features.reorder_features(panel.orders, panel.order_products, oc)
    feats = write(feats, "reorder_features")
    split = materialize(learning.stratified_split(feats))  # read by stats, both fits and both scorings
    metrics, _, gbt, _ = learning.model_comparison(split, gbt_rounds=gbt_rounds)
    files.write_csv(metrics, p("model_metrics"), order_by=["model"])
    preds = write(learning.reorder_predictions(gbt, feats), "reorder_predictions")
    files.write_csv(preds, p("extracts", "reorder_predictions"), single_file=False)

    summary = extracts.segment_summary(seg)
    files.write_csv(summary, p("extracts", "segment_summary"), order_by=[F.col("total_monetary").desc()])
    dl = extracts.department_loyalty(panel.order_products, panel.orders, panel.products, panel.departments)
    files.write_csv(extracts.department_loyalty_extract(dl), p("extracts", "department_loyalty"),
                    order_by=[F.col("reorder_rate").desc(), "department"])
    pl = extracts.product_loyalty(panel.order_products, panel.orders, panel.products, panel.departments)
    files.write_csv(pl, p("extracts", "product_loyalty"),
                    order_by=[F.col("reorder_rate").desc(), F.col("times_purchased").desc(), "product_id"])
    files.write_csv(extracts.order_trends(oc), p("extracts", "order_trends"),
                    order_by=["order_dow", "order_hour_of_day"])
    opp = extracts.department_opportunity(preds, panel.products, panel.departments)
    files.write_csv(opp, p("extracts", "department_opportunity"), order_by=[F.col("avg_reorder_proba").desc()])
    files.write_json_document(dashboard.dashboard_payload(summary, dl, opp, pl, metrics), p("dashboard_payload"))
    return counts
