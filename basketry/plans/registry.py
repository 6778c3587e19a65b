"""Named, runnable plans over the test tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose columns carry
the same names as the matching oracle in :mod:`basketry.plans.oracle`.  Decimals leave
as doubles at this edge only (the engine keeps them exact inside).
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.ordering import group_bound
from basketry.operators import boosting, clean, dashboard, evaluation, extracts, features, learning, quality, rfm, views
from basketry.plans import batch
from basketry.session import materialize, shared_dir, write_table
from basketry.sources import files, prices as price_src, star, tables
from basketry.sources.events import events_panel
from basketry.sources.panel import Panel
from basketry.sources.star import star_panel

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _clean(spark, sf):
    p = star_panel(spark, sf)
    return p, clean.orders_clean(p.orders, p.order_products, p.product_prices)


def _rfm(spark, sf):
    p, oc = _clean(spark, sf)
    return p, oc, rfm.rfm_segments(oc)


@query("orders_clean")
def q_orders_clean(spark, sf):
    _, oc = _clean(spark, sf)
    return _as_double(oc, "order_value")


@query("rfm_segments")
def q_rfm_segments(spark, sf):
    _, _, r = _rfm(spark, sf)
    return _as_double(r, "monetary", "avg_order_value")


@query("segment_summary")
def q_segment_summary(spark, sf):
    _, _, r = _rfm(spark, sf)
    return extracts.segment_summary(r)


# --- sources, panel preparation -------------------------------------------------------


def _panel(spark, sf, **kw):
    return star_panel(spark, sf, **kw)


def _raw_tables(p):
    """The loaded base tables: the derived orders and raw lines are written once, since
    every check of the report scans them again."""
    return {"orders": materialize(p.orders), "order_products": materialize(p.order_products_raw),
            "products": p.products, "product_prices": p.product_prices}


@query("ensure_prices")
def q_ensure_prices(spark, sf):
    p = _panel(spark, sf)
    return _as_double(price_src.ensure_prices(p.products, p.product_prices), "price")


@query("derived_prices")
def q_derived_prices(spark, sf):
    p = _panel(spark, sf)
    return _as_double(price_src.ensure_prices(p.products, None), "price")


@query("union_prior_train")
def q_union_prior_train(spark, sf):
    lines = _panel(spark, sf).order_products
    prior = lines.where(F.col("eval_set") == "prior").drop("eval_set")
    train = lines.where(F.col("eval_set") == "train").drop("eval_set")
    return files.union_prior_train(prior, train)


@query("constraint_violations")
def q_constraint_violations(spark, sf):
    p = _panel(spark, sf)
    return quality.constraint_violations(dict(_raw_tables(p), departments=p.departments, aisles=p.aisles))


@query("table_counts")
def q_table_counts(spark, sf):
    return quality.table_counts({"orders": star.read_table(spark, sf, "orders"),
                                 "order_products": star.read_table(spark, sf, "lineitem"),
                                 "products": star.read_table(spark, sf, "part")})


@query("order_sequence")
def q_order_sequence(spark, sf):
    return _panel(spark, sf).orders.select("order_id", "user_id", "order_number")


@query("eval_split")
def q_eval_split(spark, sf):
    return _panel(spark, sf).orders.select("order_id", "user_id", "eval_set")


@query("order_gaps")
def q_order_gaps(spark, sf):
    return _panel(spark, sf).orders.select("order_id", "days_since_prior_order")


@query("order_calendar")
def q_order_calendar(spark, sf):
    return _panel(spark, sf).orders.select("order_id", "order_dow", "order_hour_of_day")


@query("basket_dedup")
def q_basket_dedup(spark, sf):
    return star.dedup_basket(star.star_lines(spark, sf))


@query("cart_position")
def q_cart_position(spark, sf):
    return _panel(spark, sf).order_products.select("order_id", "product_id", "add_to_cart_order")


@query("reordered_flag")
def q_reordered_flag(spark, sf):
    return _panel(spark, sf).order_products.select("order_id", "product_id", "reordered")


@query("min_history")
def q_min_history(spark, sf):
    return star.min_history(_panel(spark, sf).orders).select("order_id", "user_id", "order_number")


# --- data quality ---------------------------------------------------------------------

@query("dq_null_counts")
def q_dq_null_counts(spark, sf):
    return quality.null_counts(_raw_tables(_panel(spark, sf)))


@query("dq_report")
def q_dq_report(spark, sf):
    t = _raw_tables(_panel(spark, sf))
    return quality.quality_checks(t["orders"], t["order_products"], t["products"], t["product_prices"])


# --- cleaning, views --------------------------------------------------------------------

@query("order_basket_value")
def q_order_basket_value(spark, sf):
    p = _panel(spark, sf)
    return _as_double(clean.order_basket_value(p.order_products, p.product_prices), "order_value")


@query("order_value_view")
def q_order_value_view(spark, sf):
    p = _panel(spark, sf)
    return _as_double(views.order_value_view(p.orders, p.order_products, p.product_prices), "order_value")


@query("customer_orders_view")
def q_customer_orders_view(spark, sf):
    p = _panel(spark, sf)
    v1 = views.order_value_view(p.orders, p.order_products, p.product_prices)
    return _as_double(views.customer_orders_view(v1), "total_spend")


@query("department_loyalty")
def q_department_loyalty(spark, sf):
    p = _panel(spark, sf)
    return extracts.department_loyalty(p.order_products, p.orders, p.products, p.departments)


# --- RFM --------------------------------------------------------------------------------

@query("rfm_frequency_monetary")
def q_rfm_fm(spark, sf):
    _, oc = _clean(spark, sf)
    return _as_double(rfm.frequency_monetary(oc), "monetary", "avg_order_value")


@query("rfm_raw")
def q_rfm_raw(spark, sf):
    _, oc = _clean(spark, sf)
    return _as_double(rfm.rfm_raw(oc), "monetary", "avg_order_value")


@query("rfm_scores")
def q_rfm_scores(spark, sf):
    _, oc = _clean(spark, sf)
    return rfm.rfm_scores(rfm.rfm_raw(oc)).select("user_id", "R", "F", "M", "rfm_cell", "rfm_score")


@query("segment_distribution")
def q_segment_distribution(spark, sf):
    return rfm.segment_distribution(_rfm(spark, sf)[2])


@query("segment_size_value")
def q_segment_size_value(spark, sf):
    return _as_double(rfm.segment_size_value(_rfm(spark, sf)[2]), "total_monetary")


@query("rf_grid")
def q_rf_grid(spark, sf):
    return rfm.rf_grid(_rfm(spark, sf)[2])


# --- extracts ---------------------------------------------------------------------------

@query("department_loyalty_extract")
def q_department_loyalty_extract(spark, sf):
    p = _panel(spark, sf)
    return extracts.department_loyalty_extract(
        extracts.department_loyalty(p.order_products, p.orders, p.products, p.departments))


@query("product_loyalty")
def q_product_loyalty(spark, sf):
    p = _panel(spark, sf)
    return extracts.product_loyalty(p.order_products, p.orders, p.products, p.departments)


@query("order_trends")
def q_order_trends(spark, sf):
    _, oc = _clean(spark, sf)
    return extracts.order_trends(oc)


# --- features -----------------------------------------------------------------------------

DET_SCORE = "up_purchase_rate"  # a deterministic score in [0, 1] present in the features


def _features(spark, sf, grain="part"):
    """The panel is derived once and written; every feature block reads pruned columns of it."""
    p = star_panel(spark, sf, grain=grain)
    p = dataclasses.replace(p, orders=materialize(p.orders), order_products=materialize(p.order_products))
    lines = p.order_products
    if grain == "family" or not star.repeated(star.read_table(spark, sf, "part"), "p_partkey"):
        # one price a product, and the plan knows it: blocks that need no price drop the join
        p = dataclasses.replace(p, product_prices=p.product_prices.groupBy("product_id").agg(F.max("price").alias("price")))
    oc = clean.orders_clean(p.orders, lines, p.product_prices)
    most = group_bound(p.orders, "user_id") * group_bound(lines, "order_id")  # lines of a user
    bounded = max(most, group_bound(lines, "product_id")) <= features.WINDOW_ROWS
    return p, oc, features.reorder_features(p.orders, lines, oc, bounded)


def _det_predictions(spark, sf):
    p, oc, f = _features(spark, sf)
    f = materialize(f)
    return p, oc, f, f.select(*learning.PREDICTION_COLUMNS[:5], F.col(DET_SCORE).alias("reorder_proba"),
                              "reordered_target")


@query("user_features")
def q_user_features(spark, sf):
    p = _panel(spark, sf)
    oc = clean.orders_clean(p.orders, p.order_products, p.product_prices)
    return features.user_features(oc, features.prior_lines(p.order_products, p.orders))


@query("product_features")
def q_product_features(spark, sf):
    p = _panel(spark, sf)
    return features.product_features(features.prior_lines(p.order_products, p.orders))


@query("user_product_features")
def q_user_product_features(spark, sf):
    p = _panel(spark, sf)
    return features.user_product_features(features.prior_lines(p.order_products, p.orders))


@query("reorder_features")
def q_reorder_features(spark, sf):
    return _features(spark, sf)[2]


@query("base_rate")
def q_base_rate(spark, sf):
    return features.base_rate(_features(spark, sf)[2])


# --- split, scaling, weights ---------------------------------------------------------------

def _split(spark, sf, grain="part"):
    f = materialize(_features(spark, sf, grain)[2])
    return materialize(learning.stratified_split(f))


@query("stratified_split")
def q_stratified_split(spark, sf):
    return _split(spark, sf).select("user_id", "product_id", "reordered_target", "split")


@query("feature_scaling_stats")
def q_feature_scaling_stats(spark, sf):
    st = learning.scaling_stats(_split(spark, sf).where(F.col("split") == "train"))
    return st.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("class_weights")
def q_class_weights(spark, sf):
    return learning.class_weights(_split(spark, sf).where(F.col("split") == "train"))


# --- metrics on the deterministic score ---------------------------------------------------

def _scored(spark, sf):
    return _det_predictions(spark, sf)[3]


@query("roc_auc")
def q_roc_auc(spark, sf):
    return evaluation.roc_auc(_scored(spark, sf), "reordered_target", "reorder_proba")


@query("average_precision")
def q_average_precision(spark, sf):
    ap = evaluation.average_precision(_scored(spark, sf), "reordered_target", "reorder_proba")
    return ap.select(F.round("average_precision", 10).alias("average_precision"))


@query("f1_at_threshold")
def q_f1_at_threshold(spark, sf):
    return evaluation.f1_at_threshold(_scored(spark, sf), "reordered_target", "reorder_proba", 0.5)


@query("classification_report")
def q_classification_report(spark, sf):
    return evaluation.classification_report(_scored(spark, sf), "reordered_target", "reorder_proba", 0.5)


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(_scored(spark, sf), "reordered_target", "reorder_proba", 0.5)


@query("roc_curve")
def q_roc_curve(spark, sf):
    return evaluation.roc_curve(_scored(spark, sf), "reordered_target", "reorder_proba")


@query("pr_curve")
def q_pr_curve(spark, sf):
    return evaluation.pr_curve(_scored(spark, sf), "reordered_target", "reorder_proba")


@query("department_opportunity")
def q_department_opportunity(spark, sf):
    p, _, _, pred = _det_predictions(spark, sf)
    return extracts.department_opportunity(pred, p.products, p.departments)


@query("top_propensity")
def q_top_propensity(spark, sf):
    p, _, _, pred = _det_predictions(spark, sf)
    return dashboard.top_propensity(extracts.department_opportunity(pred, p.products, p.departments))


@query("campaign_targets")
def q_campaign_targets(spark, sf):
    p, oc, _, pred = _det_predictions(spark, sf)
    return dashboard.campaign_targets(rfm.rfm_segments(oc), pred, p.products, p.departments)


# --- models (family grain: enough positives to learn from) -------------------------------

@dataclasses.dataclass
class _Fitted:
    panel: Panel
    orders_clean: DataFrame
    split: DataFrame
    gbt: object
    scored: DataFrame  # every candidate with its split and reorder_proba


_FITTED: dict[tuple[str, str], _Fitted] = {}


def _model_split(spark, sf):
    p, oc, f = _features(spark, sf, "family")
    split, _ = write_table(learning.stratified_split(materialize(f)), "split", partition_by=("split",))
    return p, oc, split


def _fitted(spark, sf) -> _Fitted:
    """The boosted model of a data set, fitted once per application with the full number of
    rounds and shared by every output that needs it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        p, oc, split = _model_split(spark, sf)
        gbt = learning.fit_gbt(split.where(F.col("split") == "train"))
        _FITTED[key] = _Fitted(p, oc, split, gbt, materialize(learning.predict_proba(gbt, split)))
    return _FITTED[key]


def _test(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "test")


def _gbt_metrics(m: _Fitted) -> DataFrame:
    return learning.metric_row("GradientBoosting", _test(m.scored).select("reordered_target", "reorder_proba"))


_SCORES = ["user_id", "product_id", "reordered_target", "reorder_proba"]


def _lr_scored(split):
    stats = learning.scaling_stats(split.where(F.col("split") == "train"))
    lr = learning.fit_logistic(learning.standardize(split.where(F.col("split") == "train"), stats))
    return learning.predict_proba(lr, learning.standardize(_test(split), stats)).select(*_SCORES)


@query("lr_scores")
def q_lr_scores(spark, sf):
    return _lr_scored(_model_split(spark, sf)[2])


@query("gbt_scores")
def q_gbt_scores(spark, sf):
    return _test(_fitted(spark, sf).scored).select(*_SCORES)


@query("gbt_first_tree")
def q_gbt_first_tree(spark, sf):
    """The first tree of depth 2, without rows held back."""
    train = _model_split(spark, sf)[2].where(F.col("split") == "train")
    model = boosting.fit(train, fixed.FEATURES, learning.LABEL, rounds=1, rules=boosting.Rules(depth=2))
    rows = spark.createDataFrame(model.tree_rows(0) if model.trees else [], "node int, feature string, threshold double, gain double, rows long, value double")
    return rows.select("node", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 4).alias("gain"), "rows", F.round("value", 7).alias("value"))


@query("model_comparison")
def q_model_comparison(spark, sf):
    m = _fitted(spark, sf)
    return learning.metric_row("LogisticRegression", materialize(_lr_scored(m.split))).unionByName(_gbt_metrics(m))


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    m = _fitted(spark, sf)
    return learning.permutation_importance(m.gbt, _test(m.split))


@query("reorder_predictions")
def q_reorder_predictions(spark, sf):
    return _fitted(spark, sf).scored.select(*learning.PREDICTION_COLUMNS)


@query("prediction_candidates")
def q_prediction_candidates(spark, sf):
    """Every candidate of the predictions with its columns that no model estimates."""
    return _features(spark, sf, "family")[2].select(*[c for c in learning.PREDICTION_COLUMNS if c != "reorder_proba"])


@query("scorecard")
def q_scorecard(spark, sf):
    m = _fitted(spark, sf)
    return dashboard.scorecard(_gbt_metrics(m), features.base_rate(m.split))


@query("scorecard_base_rate")
def q_scorecard_base_rate(spark, sf):
    return features.base_rate(_features(spark, sf, "family")[2])


@query("model_department_opportunity")
def q_model_department_opportunity(spark, sf):
    m = _fitted(spark, sf)
    return extracts.department_opportunity(m.scored, m.panel.products, m.panel.departments)


@query("model_campaign_targets")
def q_model_campaign_targets(spark, sf):
    m = _fitted(spark, sf)
    return dashboard.campaign_targets(rfm.rfm_segments(m.orders_clean), m.scored, m.panel.products, m.panel.departments)


@query("candidate_departments")
def q_candidate_departments(spark, sf):
    """Candidates and actual reorders per department: the exact part of the opportunity."""
    p, _, f = _features(spark, sf, "family")
    found = extracts.department_opportunity(f.withColumn("reorder_proba", F.lit(0.0)), p.products, p.departments)
    return found.select("department", "predicted_candidates", "actual_reorders")


# --- dashboard -----------------------------------------------------------------------------

def _summary(spark, sf):
    return materialize(extracts.segment_summary(_rfm(spark, sf)[2]))


@query("dashboard_kpis")
def q_dashboard_kpis(spark, sf):
    return dashboard.dashboard_kpis(_summary(spark, sf))


@query("segments_by_health")
def q_segments_by_health(spark, sf):
    return dashboard.segments_by_health(_summary(spark, sf))


@query("segment_health")
def q_segment_health(spark, sf):
    return dashboard.segment_health(_summary(spark, sf))


@query("health_rollup")
def q_health_rollup(spark, sf):
    return dashboard.health_rollup(_summary(spark, sf))


@query("revenue_concentration")
def q_revenue_concentration(spark, sf):
    return dashboard.revenue_concentration(_summary(spark, sf))


@query("next_best_action")
def q_next_best_action(spark, sf):
    return dashboard.next_best_action(_summary(spark, sf))


@query("formatted_extract")
def q_formatted_extract(spark, sf):
    return dashboard.formatted_extract(_summary(spark, sf))


def _dept_loyalty(spark, sf, grain="part"):
    p = _panel(spark, sf, grain=grain)
    return p, extracts.department_loyalty(p.order_products, p.orders, p.products, p.departments)


@query("loyalty_band")
def q_loyalty_band(spark, sf):
    return dashboard.department_bands(_dept_loyalty(spark, sf)[1])


@query("loyalty_reach")
def q_loyalty_reach(spark, sf):
    return dashboard.loyalty_reach(_dept_loyalty(spark, sf)[1])


@query("stickiest_products")
def q_stickiest_products(spark, sf):
    p = _panel(spark, sf, grain="family")
    pl = extracts.product_loyalty(p.order_products, p.orders, p.products, p.departments)
    return dashboard.stickiest_products(pl)


@query("products_in_department")
def q_products_in_department(spark, sf):
    p, dl = _dept_loyalty(spark, sf)
    # the department a user clicks first: the top bar of the loyalty chart
    top = dl.orderBy(F.col("reorder_rate").desc(), "department").limit(1).select("department").scalar()
    pl = extracts.product_loyalty(p.order_products, p.orders, p.products, p.departments)
    return dashboard.products_in_department(pl, top)


@query("dashboard_kpis_model")
def q_dashboard_kpis_model(spark, sf):
    m = _fitted(spark, sf)
    return dashboard.kpis_with_model(dashboard.dashboard_kpis(_summary(spark, sf)), _gbt_metrics(m))


@query("dashboard_payload")
def q_dashboard_payload(spark, sf):
    """All from one pipeline: the family panel and its boosted model's predictions."""
    m = _fitted(spark, sf)
    p = m.panel
    dl = extracts.department_loyalty(p.order_products, p.orders, p.products, p.departments)
    pl = extracts.product_loyalty(p.order_products, p.orders, p.products, p.departments)
    opp = extracts.department_opportunity(m.scored, p.products, p.departments)
    summary = materialize(extracts.segment_summary(rfm.rfm_segments(m.orders_clean)))
    return dashboard.dashboard_payload(summary, dl, opp, pl, _gbt_metrics(m))


# --- the events panel: a second source with real day gaps and hours ------------------


def _ev_clean(spark, sf):
    p = events_panel(spark, sf)
    return p, clean.orders_clean(p.orders, p.order_products, p.product_prices)


@query("events_order_calendar")
def q_events_order_calendar(spark, sf):
    return events_panel(spark, sf).orders


@query("events_orders_clean")
def q_events_orders_clean(spark, sf):
    return _as_double(_ev_clean(spark, sf)[1], "order_value")


@query("events_order_trends")
def q_events_order_trends(spark, sf):
    return extracts.order_trends(_ev_clean(spark, sf)[1])


@query("events_rfm_segments")
def q_events_rfm_segments(spark, sf):
    return _as_double(rfm.rfm_segments(_ev_clean(spark, sf)[1]), "monetary", "avg_order_value")


@query("events_segment_summary")
def q_events_segment_summary(spark, sf):
    return extracts.segment_summary(rfm.rfm_segments(_ev_clean(spark, sf)[1]))


def _ev_features(spark, sf):
    p, oc = _ev_clean(spark, sf)
    return features.reorder_features(p.orders, p.order_products, oc)


@query("events_reorder_features")
def q_events_reorder_features(spark, sf):
    return _ev_features(spark, sf)


@query("events_roc_auc")
def q_events_roc_auc(spark, sf):
    f = materialize(_ev_features(spark, sf))
    return evaluation.roc_auc(f, "reordered_target", DET_SCORE)


@query("dq_report_json")
def q_dq_report_json(spark, sf):
    t = _raw_tables(_panel(spark, sf))
    return quality.quality_report_json(t["orders"], t["order_products"], t["products"], t["product_prices"])


@query("dq_load_checks")
def q_dq_load_checks(spark, sf):
    """The checks that the write of each base table takes in passing."""
    p = _panel(spark, sf)
    frames = {"orders": p.orders, "order_products": p.order_products_raw, "products": p.products, "product_prices": p.product_prices}
    return quality.checks_table(spark, quality.load_tables(frames, f"{shared_dir(spark)}/tables/load-{uuid.uuid4().hex}")[1])


@query("orders_clean_sorted")
def q_orders_clean_sorted(spark, sf):
    """The typed orders_clean as a clustered table: its rows, the places where they don't ascend, its types."""
    p = _panel(spark, sf)
    path = f"{shared_dir(spark)}/tables/orders-clean-{uuid.uuid4().hex}"
    files.write_table(batch.typed_orders_clean(clean.orders_clean(p.orders, p.order_products, p.product_prices)), path,
                      cluster_by=["user_id", "order_number"])
    types = ", ".join(f"{c} {t}" for c, t in tables.read_table(spark, path).dtypes)
    return tables.order_breaks(spark, path, ["user_id", "order_number"]).withColumn("types", F.lit(types))


# --- model outputs from fixed scores: the same operators, with values that SQL can check -----

class _FixedScore:
    """A model whose probability is a column of the features."""

    def __init__(self, column: str):
        self.column = column

    def probability(self):
        return F.col(self.column).cast("double")


def _fixed_metrics(features_df: DataFrame) -> DataFrame:
    rows = [learning.metric_row(name, learning.predict_proba(_FixedScore(column), features_df).select("reordered_target", "reorder_proba"))
            for name, column in (("LogisticRegression", "p_reorder_rate"), ("GradientBoosting", DET_SCORE))]
    return rows[0].unionByName(rows[1])


def _family(spark, sf):
    p, oc, f = _features(spark, sf, "family")
    return p, oc, materialize(f)


@query("fixed_model_comparison")
def q_fixed_model_comparison(spark, sf):
    return _fixed_metrics(_family(spark, sf)[2])


@query("fixed_predictions")
def q_fixed_predictions(spark, sf):
    return learning.reorder_predictions(_FixedScore(DET_SCORE), _family(spark, sf)[2])


@query("fixed_scorecard")
def q_fixed_scorecard(spark, sf):
    f = _family(spark, sf)[2]
    card = dashboard.scorecard(_fixed_metrics(f), features.base_rate(f))
    return card.withColumn("base_rate", F.round("base_rate", 10))


@query("fixed_kpis")
def q_fixed_kpis(spark, sf):
    _, oc, f = _family(spark, sf)
    return dashboard.kpis_with_model(dashboard.dashboard_kpis(extracts.segment_summary(rfm.rfm_segments(oc))), _fixed_metrics(f))


_PAYLOAD = """kpis struct<customers:double,revenue:double,champions:double,at_risk:double,auc:double,pr_auc:double>,
 segments array<struct<segment:string,customers:double,total_monetary:double>>,
 departments array<struct<department:string,line_items:double,reorder_rate:double>>,
 opportunity array<struct<department:string,predicted_candidates:double,avg_reorder_proba:double>>,
 products array<struct<product_name:string,reorder_rate:double,times_purchased:double>>"""


@query("fixed_payload")
def q_fixed_payload(spark, sf):
    """The payload's lists in order and its numbers, read back from the JSON document."""
    p, oc, f = _family(spark, sf)
    preds = learning.reorder_predictions(_FixedScore(DET_SCORE), f)
    doc = dashboard.dashboard_payload(
        materialize(extracts.segment_summary(rfm.rfm_segments(oc))),
        extracts.department_loyalty(p.order_products, p.orders, p.products, p.departments),
        extracts.department_opportunity(preds, p.products, p.departments),
        extracts.product_loyalty(p.order_products, p.orders, p.products, p.departments), _fixed_metrics(f))
    parsed = materialize(doc).select(F.from_json("payload", _PAYLOAD).alias("d")).select("d.*")
    numbers = F.array(*[F.struct(F.lit(k).alias("name"), F.col(f"kpis.{k}").alias("x"), F.lit(0.0).alias("y"))
                        for k in ("customers", "revenue", "champions", "at_risk", "auc", "pr_auc")])
    parts = [parsed.select(F.lit("kpis").alias("part"), F.lit(0).alias("pos"), F.explode(numbers).alias("e")).select("part", "pos", "e.*")]
    for part, columns in (("segments", ("segment", "customers", "total_monetary")), ("departments", ("department", "line_items", "reorder_rate")),
                          ("opportunity", ("department", "predicted_candidates", "avg_reorder_proba")),
                          ("products", ("product_name", "reorder_rate", "times_purchased"))):
        parts.append(parsed.select(F.posexplode(part).alias("pos", "e")).select(
            F.lit(part).alias("part"), "pos", *[F.col(f"e.{c}").alias(a) for c, a in zip(columns, ("name", "x", "y"))]))
    return reduce(DataFrame.unionByName, parts)
