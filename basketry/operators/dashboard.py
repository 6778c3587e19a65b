"""Dashboard derivations (D1–D15): the data behind the three pages.

Inputs are the small extracts (≤ one row per segment / department, ≤ 200 products), so
single-partition windows and bounded ``collect_list`` here are bounded by those sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.exact import half_even_units, mean_score


def health_of(segment: Column) -> Column:
    """D3: Grow / Nurture / Rescue / Dormant."""
    pairs = [F.lit(x) for kv in fixed.SEGMENT_HEALTH.items() for x in kv]
    return F.element_at(F.create_map(*pairs), segment)


def health_rank(segment: Column) -> Column:
    """1-based position in the healthiest-first segment order."""
    return F.array_position(F.array(*[F.lit(s) for s in fixed.HEALTH_ORDER]), segment).cast("int")


def loyalty_band(rate: Column, high: float = fixed.LOYALTY_HIGH, mid: float = fixed.LOYALTY_MEDIUM) -> Column:
    """High (≥ 0.62), Medium (≥ 0.56), Low."""
    return F.when(rate >= high, F.lit("High")).when(rate >= mid, F.lit("Medium")).otherwise(F.lit("Low"))


def _summary_cents() -> Column:
    return F.round(F.col("total_monetary") * 100).cast("bigint")


def dashboard_kpis(segment_summary: DataFrame) -> DataFrame:
    """Customers, revenue in whole units (half-even), Champions, At Risk + Can't Lose
    Them."""
    seg = F.col("segment")
    return segment_summary.agg(
        F.sum("customers").alias("customers"),
        half_even_units(F.sum(_summary_cents()), F.lit(100), 0).alias("revenue"),
        F.coalesce(F.sum(F.when(seg == "Champions", F.col("customers"))), F.lit(0)).alias("champions"),
        F.coalesce(F.sum(F.when(seg.isin("At Risk", "Can't Lose Them"), F.col("customers"))), F.lit(0)).alias("at_risk"))


def kpis_with_model(kpis: DataFrame, metrics: DataFrame, model: str = "GradientBoosting") -> DataFrame:
    """D1 complete: the four counts plus the boosted model's roc_auc and pr_auc."""
    m = metrics.where(F.col("model") == model)
    return kpis.select("*", m.select(F.max("roc_auc")).scalar().alias("auc"),
                       m.select(F.max("pr_auc")).scalar().alias("pr_auc"))


def segments_by_health(segment_summary: DataFrame, segment: str | None = None) -> DataFrame:
    """D2 (+ D13 segment filter): segments in health order."""
    df = segment_summary.select(health_rank(F.col("segment")).alias("health_rank"), "segment", "customers",
                                "total_monetary", "pct_revenue", "avg_recency_days", "avg_frequency",
                                "avg_monetary", "recommended_action")
    if segment is not None:
        df = df.where(F.col("segment") == segment)
    return df.orderBy("health_rank")


def segment_health(segment_summary: DataFrame) -> DataFrame:
    """D3: each segment with its health band."""
    return segment_summary.select("segment", "customers", health_of(F.col("segment")).alias("health"))


def health_rollup(segment_summary: DataFrame, band: str | None = None) -> DataFrame:
    """Customers, revenue and segment count per health band (optionally one band)."""
    df = segment_summary.withColumn("health", health_of(F.col("segment")))
    if band is not None:
        df = df.where(F.col("health") == band)
    return (df.groupBy("health")
            .agg(F.count(F.lit(1)).alias("segments"), F.sum("customers").alias("customers"),
                 (F.sum(_summary_cents()) / 100).alias("total_monetary")))


def department_bands(dept_loyalty: DataFrame) -> DataFrame:
    """D5 on the department extract."""
    return dept_loyalty.select("department", "reorder_rate", loyalty_band(F.col("reorder_rate")).alias("loyalty_band"))


def revenue_concentration(segment_summary: DataFrame) -> DataFrame:
    """Segments by revenue, largest first, with their rank."""
    w = Window.orderBy(F.col("total_monetary").desc(), F.col("segment"))  # ≤ 10 rows
    return (segment_summary.select(F.row_number().over(w).alias("revenue_rank"), "segment", "total_monetary",
                                   "pct_revenue")
            .orderBy("revenue_rank"))


def loyalty_reach(dept_loyalty: DataFrame) -> DataFrame:
    """Stickiness (rate), reach (customers) and volume per department, its loyalty
    band, and the quadrant against the median rate and median reach."""
    whole = Window.partitionBy()  # ≤ one row per department
    rate_hi = F.col("reorder_rate") >= F.median("reorder_rate").over(whole)
    reach_hi = F.col("unique_customers") >= F.median("unique_customers").over(whole)
    quadrant = (F.when(rate_hi & reach_hi, F.lit("strategic")).when(rate_hi, F.lit("sticky"))
                .when(reach_hi, F.lit("broad")).otherwise(F.lit("neither")))
    return dept_loyalty.select("department", "reorder_rate", "unique_customers", "line_items",
                               loyalty_band(F.col("reorder_rate")).alias("loyalty_band"), quadrant.alias("quadrant"))


def stickiest_products(product_loyalty: DataFrame, min_purchases: int | None = fixed.STICKY_MIN_PURCHASES,
                       k: int | None = fixed.STICKY_TOP_K) -> DataFrame:
    """Most-reordered products with at least ``min_purchases`` purchases, top ``k``."""
    df = product_loyalty
    if min_purchases:
        df = df.where(F.col("times_purchased") >= min_purchases)
    df = df.select("product_id", "product_name", "department", "reorder_rate", "times_purchased")
    df = df.orderBy(F.col("reorder_rate").desc(), F.col("times_purchased").desc(), F.col("product_id"))
    return df.limit(k) if k else df


def top_propensity(dept_opportunity: DataFrame, k: int = fixed.PROPENSITY_TOP_K) -> DataFrame:
    """The ``k`` departments with the highest mean reorder propensity."""
    return (dept_opportunity.orderBy(F.col("avg_reorder_proba").desc(), F.col("department"))
            .limit(k))


def scorecard(metrics: DataFrame, base: DataFrame, model: str = "GradientBoosting") -> DataFrame:
    """The boosted model's roc_auc, pr_auc and the computed base rate."""
    return (metrics.where(F.col("model") == model)
            .select("model", "roc_auc", "pr_auc", base.select(F.max("positive_rate")).scalar().alias("base_rate")))


def next_best_action(segment_summary: DataFrame) -> DataFrame:
    """Segment, customers, avg_monetary, action — best average RFM score first."""
    return (segment_summary.select("segment", "customers", "avg_monetary", "recommended_action", "avg_rfm_score")
            .orderBy(F.col("avg_rfm_score").desc(), F.col("segment")))


def campaign_targets(rfm: DataFrame, predictions: DataFrame, products: DataFrame, departments: DataFrame,
                     score: str = "reorder_proba") -> DataFrame:
    """Segment × department candidate pairs, mean propensity (4 dp) and actual reorders."""
    j = (predictions.select("user_id", "product_id", score, "reordered_target")
         .join(rfm.select("user_id", "segment"), "user_id")
         .join(products.select("product_id", "department_id"), "product_id")
         .join(departments, "department_id"))
    return (j.groupBy("segment", "department")
            .agg(F.count(F.lit(1)).alias("pairs"), mean_score(F.col(score), F.count(F.lit(1))).alias("avg_reorder_proba"),
                 F.sum("reordered_target").cast("bigint").alias("actual_reorders")))


def products_in_department(product_loyalty: DataFrame, department) -> DataFrame:
    """The product table filtered to one department (a value or a column)."""
    dep = department if isinstance(department, Column) else F.lit(department)
    return product_loyalty.where(F.col("department") == dep)


def formatted_extract(segment_summary: DataFrame) -> DataFrame:
    """Display strings — revenue ``$#,##0``, shares ``0.0%``, counts ``#,##0``."""
    return segment_summary.select(
        "segment",
        F.concat(F.lit("$"), F.format_number(F.col("total_monetary"), 0)).alias("revenue_fmt"),
        F.concat(F.format_number(F.col("pct_revenue"), 1), F.lit("%")).alias("pct_revenue_fmt"),
        F.concat(F.format_number(F.col("pct_customers"), 1), F.lit("%")).alias("pct_customers_fmt"),
        F.format_number(F.col("customers"), 0).alias("customers_fmt"))


def dashboard_payload(segment_summary: DataFrame, dept_loyalty: DataFrame, dept_opportunity: DataFrame,
                      product_loyalty: DataFrame, metrics: DataFrame) -> DataFrame:
    """One JSON document with kpis, segments (health order), departments,
    opportunity and the first products — every list comes from a bounded extract."""
    kpis = kpis_with_model(dashboard_kpis(segment_summary), metrics)
    by_health = segments_by_health(segment_summary)
    segs = by_health.agg(F.sort_array(F.collect_list(F.struct(*by_health.columns))).alias("l"))
    depts = departments_by_rate(dept_loyalty)
    opp = dept_opportunity.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("avg_reorder_proba")).alias("_k"), "department", "predicted_candidates", "avg_reorder_proba",
        "actual_reorders"))).alias("l"))
    prods = stickiest_products(product_loyalty, None, fixed.STICKY_TOP_K)
    prods = prods.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("reorder_rate")).alias("_k1"), (-F.col("times_purchased")).alias("_k2"), F.col("product_id").alias("_k3"),
        "product_name", "department", "reorder_rate", "times_purchased"))).alias("l"))
    strip = lambda df, keys: df.select(F.transform("l", lambda x: x.dropFields(*keys))).scalar()
    doc = kpis.select(
        F.struct(*kpis.columns).alias("kpis"),
        strip(segs, ["health_rank"]).alias("segments"),
        depts.select("l").scalar().alias("departments"),
        strip(opp, ["_k"]).alias("opportunity"),
        strip(prods, ["_k1", "_k2", "_k3"]).alias("products"))
    return doc.select(F.to_json(F.struct("kpis", "segments", "departments", "opportunity", "products")).alias("payload"))


def departments_by_rate(dept_loyalty: DataFrame) -> DataFrame:
    """Departments by reorder rate (desc) as one list, for the payload."""
    ordered = dept_loyalty.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("reorder_rate")).alias("_k"), F.col("department").alias("_k2"), "department", "line_items",
        "reordered_items", "reorder_rate", "unique_customers"))).alias("l"))
    return ordered.select(F.transform("l", lambda s: s.dropFields("_k", "_k2")).alias("l"))
