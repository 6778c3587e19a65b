"""Properties of the ranking, banding, metric and split operators against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.functions import fixed, ordering
from basketry.functions.ordering import exact_median, exact_rank, ordered_prefix, sequence_in_group
from basketry.operators import evaluation, learning, rfm
from basketry.sources import star


def _ties_frame(spark, n, seed=7, distinct=5):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, distinct)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, x long").repartition(5)


def test_exact_rank_equals_window_rank_under_heavy_ties(spark):
    df = _ties_frame(spark, 3000, distinct=2)  # one value holds about a third of the rows
    got = exact_rank(df, ["x", "user_id"], out="r", n_ranges=7)
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy("x", "user_id")))
    j = got.join(ref, ["user_id", "x"])
    assert j.count() == 3000 and j.where(F.col("r") != F.col("r2")).count() == 0


def test_ordered_prefix_is_partitioning_independent(spark):
    df = _ties_frame(spark, 500)
    a = ordered_prefix(df, ["x", "user_id"], {"c": F.col("x")}, n_ranges=4).select("user_id", "c")
    b = ordered_prefix(df.repartition(3, "x"), ["x", "user_id"], {"c": F.col("x")}, n_ranges=9).select("user_id", "c")
    assert sorted(a.collect()) == sorted(b.collect())


def test_sequence_in_group_matches_window(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 20)) for i in range(400)]  # user 1 is hot
    df = spark.createDataFrame(rows, "order_id long, user_id long, day long")
    got = sequence_in_group(df, ["user_id"], "day", ["order_id"], out="n")
    ref = df.withColumn("n2", F.row_number().over(Window.partitionBy("user_id").orderBy("day", "order_id")))
    j = got.join(ref, ["order_id"])
    assert j.where(F.col("n") != F.col("n2")).count() == 0


@pytest.mark.parametrize("values", [[3.0], [1.0, 5.0], [2.0, 2.0, 9.0], [1.0, 2.0, 3.0, 4.0, 50.0, 7.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert df.select(exact_median(df, "v")).first()[0] == float(np.median(values))


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 13, 400])
def test_quintile_band_matches_rank_then_qcut(spark, n):
    rnd = random.Random(n)
    vals = [rnd.randint(0, 3) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(vals)), "user_id long, v long")
    got = {r.user_id: r.b for r in rfm.quintile_band(df, "v", "b").collect()}
    pdf = pd.DataFrame({"user_id": range(n), "v": vals})
    if n == 1:
        expected = {0: 1}
    else:
        ranks = pdf.sort_values(["v", "user_id"]).assign(r=np.arange(1, n + 1)).sort_values("user_id")["r"]
        bands = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int)
        expected = dict(zip(pdf["user_id"], bands))
    assert got == expected


def test_segment_patterns_cover_the_grid_once():
    import re
    for r in range(1, 6):
        for f in range(1, 6):
            hits = [name for pat, name in fixed.SEGMENT_PATTERNS if re.fullmatch(pat, f"{r}{f}")]
            assert len(hits) == 1, (r, f, hits)


def _scores(spark, n=300, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(n)]  # many ties
    rows += [(1, 0.5), (0, 0.5)]  # scores exactly at the threshold
    return rows, spark.createDataFrame(rows, "y int, s double")


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(rows):
    P = sum(y for y, _ in rows)
    ap = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        pos_here = sum(1 for y, s in rows if s == t and y == 1)
        ap += pos_here / P * tp / (tp + fp)
    return ap


def test_roc_auc_and_average_precision_against_brute_force(spark):
    rows, df = _scores(spark)
    auc = evaluation.roc_auc(df, "y", "s").first().roc_auc
    assert auc == pytest.approx(_brute_auc(rows), abs=1e-12)
    flipped = evaluation.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first().roc_auc
    assert auc + flipped == pytest.approx(1.0, abs=1e-12)
    ap = evaluation.average_precision(df, "y", "s").first().average_precision
    assert ap == pytest.approx(_brute_ap(rows), abs=1e-12)


def test_grouped_auc_equals_per_group_auc(spark):
    rows, df = _scores(spark, 200, seed=2)
    both = df.withColumn("g", F.lit("a")).unionByName(df.withColumn("g", F.lit("b")).withColumn("s", -F.col("s")))
    got = {r.g: r.roc_auc for r in evaluation.roc_auc_by(both, "y", "s", ["g"]).collect()}
    assert got["a"] == pytest.approx(_brute_auc(rows), abs=1e-12)
    assert got["a"] + got["b"] == pytest.approx(1.0, abs=1e-12)


def test_threshold_metrics(spark):
    rows, df = _scores(spark)
    tp = sum(1 for y, s in rows if y == 1 and s >= 0.5)
    fp = sum(1 for y, s in rows if y == 0 and s >= 0.5)
    fn = sum(1 for y, s in rows if y == 1 and s < 0.5)
    tn = len(rows) - tp - fp - fn
    assert evaluation.f1_at_threshold(df, "y", "s").first().f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    cm = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(df, "y", "s").collect()}
    assert cm == {(0, 0): tn, (0, 1): fp, (1, 0): fn, (1, 1): tp}
    rep = {r.label: r for r in evaluation.classification_report(df, "y", "s").collect()}
    assert rep["accuracy"].f1_score == pytest.approx((tp + tn) / len(rows))
    assert rep["1"].support == tp + fn and rep["0"].support == tn + fp


def test_degenerate_labels_give_null_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert evaluation.roc_auc(df, "y", "s").first().roc_auc is None
    cm = evaluation.confusion_matrix(df, "y", "s").collect()
    assert sum(r.n for r in cm) == 2 and len(cm) == 4


def test_stratified_split_exact_and_stable(spark):
    rnd = random.Random(5)
    rows = [(u, p, 1 if rnd.random() < 0.2 else 0) for u in range(40) for p in range(10)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, reordered_target int")
    a = learning.stratified_split(df)
    b = learning.stratified_split(df.repartition(7))
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {(r.reordered_target, r.split): r["count"] for r in a.groupBy("reordered_target", "split").count().collect()}
    for c in (0, 1):
        n_c = sum(1 for *_, y in rows if y == c)
        assert counts[(c, "test")] == -(-n_c // 4)


@pytest.mark.parametrize("ranges", [1, 4, 300])
def test_exact_rank_with_any_number_of_ranges(spark, ranges):
    df = _ties_frame(spark, 3000, distinct=3)
    got = ordering.exact_rank(df, ["x", "user_id"], out="r", n_ranges=ranges)
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy("x", "user_id")))
    j = got.join(ref, ["user_id", "x"])
    assert j.where(F.col("r") != F.col("r2")).count() == 0
    cuts = ordering._boundaries(df, [F.col("x"), F.col("user_id")], ranges)
    assert len(cuts) <= ranges - 1 and len(cuts) >= min(ranges - 1, 100)
    keys = ordering.keys_at_ranks(df, ["x", "user_id"], [1, 17, 1500, 3000], n_ranges=ranges)
    ranks = {(r.x, r.user_id): r.r2 for r in ref.collect()}
    assert [ranks[k] for k in keys] == [1, 17, 1500, 3000]


def test_sampled_keys_are_few_however_many_tasks(spark):
    df = spark.range(0, 200_000, 1, 64).select((F.col("id") % 1000).alias("x"), F.col("id").alias("user_id"))
    cuts = ordering._boundaries(df, [F.col("x"), F.col("user_id")], 64)
    share = ordering.KEYS_PER_RANGE * 64 / 200_000
    picked = df.where(F.pmod(F.xxhash64("x", "user_id"), F.lit(1 << 30)) < int(share * (1 << 30))).count()
    assert len(cuts) == 63 and picked < 2 * ordering.KEYS_PER_RANGE * 64


def test_roc_curve_area_is_roc_auc(spark):
    rows, df = _scores(spark, 400, seed=3)
    points = sorted((r.fpr, r.tpr) for r in evaluation.roc_curve(df, "y", "s").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert area == pytest.approx(_brute_auc(rows), abs=1e-12)
    end = [r for r in evaluation.pr_curve(df, "y", "s").collect() if r.threshold is None]
    assert [(r.precision, r.recall) for r in end] == [(1.0, 0.0)]


def test_ranking_metrics_one_pass_equals_separate(spark):
    rows, df = _scores(spark, 400, seed=9)
    r = evaluation.ranking_metrics(df, "y", "s").first()
    assert r.roc_auc == evaluation.roc_auc(df, "y", "s").first().roc_auc
    assert r.average_precision == pytest.approx(_brute_ap(rows), abs=1e-12)
    assert r.roc_auc == pytest.approx(_brute_auc(rows), abs=1e-12)


def test_sequence_of_a_group_spread_over_many_buckets(spark):
    rows = [(1, i * 37 % 100_003, i * 37 % 100_003 // 16) for i in range(4000)] + [(2, 5, 0), (2, 900_000, 56_250)]
    df = spark.createDataFrame(rows, "order_id long, line long, chunk long").repartition(5)
    got = sequence_in_group(df, ["order_id"], "chunk", ["line"], out="n", coarse=32)
    ref = df.withColumn("n2", F.row_number().over(Window.partitionBy("order_id").orderBy("line")))
    j = got.join(ref, ["order_id", "line"])
    assert j.count() == len(rows) and j.where(F.col("n") != F.col("n2")).count() == 0


def _days_of_a_hot_user(spark, n=6000):
    """A third of all orders are one user's on one day, many of them in one second and some at one time."""
    day = 86_400_000_000
    at = (F.when(F.col("id") % 3 == 0, F.col("id") % 7 * 1_000_000 + F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 11))
          .otherwise(F.pmod(F.xxhash64("id"), F.lit(40)) * day))
    return spark.range(n).select((F.col("id") * 70_001 - 90_000_000).alias("order_id"),
                                 F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("user_id"),
                                 F.timestamp_micros(at.cast("bigint")).alias("ts"))


def test_hot_day_is_sequenced_in_a_tree_of_chunks(spark, monkeypatch):
    df = _days_of_a_hot_user(spark)
    plain = sorted((tuple(r) for r in star.sequence_orders(df).collect()), key=str)
    monkeypatch.setattr(star, "HOT_DAY", 100)
    made = star.sequence_orders(df)
    assert sorted((tuple(r) for r in made.collect()), key=str) == plain
    w = Window.partitionBy("user_id").orderBy("ts", "order_id")
    numbers = {r.order_id: r.n for r in df.select("order_id", F.row_number().over(w).alias("n")).collect()}
    assert {r[0]: r[3] for r in plain} == numbers
    # no window is over more than the children of a chunk: keys, then levels
    levels, _ = star._day_levels(df)
    for depth in range(1, 6):
        above = ["user_id", "_day", "_second", "_micro", "_id48", "_id32", "_id16"][: depth + 1]
        below = ["user_id", "_day", "_second", "_micro", "_id48", "_id32", "_id16"][depth + 1]
        most = levels.groupBy(*above).agg(F.countDistinct(below).alias("n")).agg(F.max("n")).first()[0]
        assert most <= (1_000_000 if below == "_micro" else 86_400)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) >= 7 and not any("row_number" in w and "_id16" not in w for w in windows)


def test_ranges_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 20_000)
    df = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"), "id")
    ranged, _ = ordering._ranged(df, ["x", "id"], None)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 50 and max(sizes) <= 2 * 20_000
    got = ordering.exact_rank(df.where("id < 30000"), ["x", "id"], out="r").agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
    assert tuple(got) == (1, 30_000, 30_000)


def _odd_star(spark):
    """Lines and orders with nulls, repeated rows and orders of two users."""
    orders = [(i % 190, None if i % 41 == 0 else i % 13, None if i % 37 == 0 else 86_400_000_000 * (i * 7 % 50) + i % 3) for i in range(200)]
    lines = [(None if i % 53 == 0 else i * 11 % 200, None if i % 29 == 0 else i * 5 % 17, None if i % 31 == 0 else i % 1500) for i in range(1500)]
    o = spark.createDataFrame([r for r in orders], "order_id long, user_id long, t long").select("order_id", "user_id", F.timestamp_micros("t").alias("ts"))
    return o, spark.createDataFrame(lines + lines[::9], "order_id long, product_id long, line long")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bounded_panel_and_features_are_those_of_the_spread_ones(spark):
    from basketry.operators import clean, features

    raw, lines = _odd_star(spark)
    orders = star.sequence_orders(raw, True)
    assert _rows(orders) == _rows(star.sequence_orders(raw, False))
    for dedup in (True, False):
        one, many = (star.basket_lines(lines, dedup, bounded=b) for b in (True, False))
        assert _rows(one) == _rows(many)
    flagged = star.flag_reorders(one, orders, "left", True)
    assert _rows(flagged) == _rows(star.flag_reorders(one, orders, "left", False))
    panel = star.flag_reorders(star.basket_lines(lines, bounded=True), orders, "inner", True).localCheckpoint()
    prices = spark.range(12).select(F.col("id").alias("product_id"), F.lit(2).cast("decimal(8,2)").alias("price"))
    oc = clean.orders_clean(orders, panel, prices)
    found, plain = (features.reorder_features(orders, panel, oc, b) for b in (True, False))
    assert found.dtypes == plain.dtypes and _rows(found) == _rows(plain) and found.count() > 30


def test_lines_are_moved_once_by_order(spark):
    df = spark.range(1000).select((F.col("id") % 90).alias("order_id"), (F.col("id") % 7).alias("product_id"), F.col("id").alias("line"))
    plan = star.basket_lines(df, bounded=True)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x for x in plan.splitlines()) == 1
    assert ordering.group_bound(df, "order_id") >= 12 and ordering.group_bound(df.where("false"), "order_id") == 0


def test_features_of_odd_tables_need_no_price(spark):
    from basketry.plans import registry

    plan = registry._features(spark, "/root/testdata/sf0.001")[2]._jdf.queryExecution().optimizedPlan().toString()
    assert "price" not in plan and plan.count("Join") == 4
