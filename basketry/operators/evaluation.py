"""Binary-classification metrics over (label, score) rows.

Everything ranks *distinct scores*, not rows: rows are first grouped per score into
(pos, neg) counts (map-side partial aggregation), and the running counts over the
score order come from :func:`ordered_prefix`, which never moves all groups into one
task.  Metrics that are ratios of integers are computed exactly (one division at the
end); sums of ratios (average precision) are plain double sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.ordering import ordered_prefix

_BIG = "decimal(38,0)"


def score_groups(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """(by…, score, pos, neg) per distinct score."""
    y = F.col(label).cast("int")
    return (df.groupBy(*(by or []), score)
            .agg(F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")))


def roc_auc_by(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """M7: ROC-AUC with tied scores counted half (Mann–Whitney), one row per group.

    AUC = Σ_s pos_s · (neg below s + neg_s / 2) / (P · N), computed as an exact integer
    numerator over an exact integer denominator.
    """
    return roc_auc_of_groups(score_groups(df, label, score, by), score, by)


def roc_auc_of_groups(g: DataFrame, score: str, by: list[str] | None = None) -> DataFrame:
    """ROC-AUC from rows (by…, score, pos, neg)."""
    by = list(by or [])
    cum = ordered_prefix(g, [*by, score], {"_cneg": F.col("neg")})
    # running count restarts per group: subtract the negatives of all earlier groups
    if by:
        gt = g.groupBy(*by).agg(F.sum("neg").alias("_gneg"))
        from pyspark.sql import Window
        start = gt.select(*by, F.coalesce(F.sum("_gneg").over(
            Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_gstart"))
        # one row per group: the number of groups is a small parameter (features × repeats)
        cum = cum.join(F.broadcast(start), by)
    else:
        cum = cum.withColumn("_gstart", F.lit(0))
    below = F.col("_cneg") - F.col("neg") - F.col("_gstart")
    agg = cum.groupBy(*by).agg(
        F.sum((F.col("pos").cast(_BIG) * (below * 2 + F.col("neg")).cast(_BIG))).alias("_num2"),
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    den = (F.lit(2).cast(_BIG) * F.col("_P").cast(_BIG) * F.col("_N").cast(_BIG))
    auc = F.when(den > 0, F.col("_num2").cast("double") / den.cast("double"))
    return agg.select(*by, auc.alias("roc_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return roc_auc_by(df, label, score)


def _desc_cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores, highest first, with tp / fp at threshold ≥ score and P, N."""
    g = score_groups(df, label, score)
    return ordered_prefix(g, [-F.col(score).cast("double")], {"tp": F.col("pos"), "fp": F.col("neg")}, totals=True)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """M8: AP = Σ over thresholds (recall step) × precision = Σ_s pos_s/P · tp_s/(tp_s+fp_s).
    Not the trapezoidal area under the PR curve."""
    c = _desc_cumulative(df, label, score)
    term = F.col("pos").cast("double") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    return c.agg((F.sum(term) / F.first("tp_total").cast("double")).alias("average_precision"))


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """M7 + M8 from one ordered pass: with tp / fp counted at thresholds ≥ s, the
    negatives strictly below s are N − fp_s, so ROC-AUC's exact numerator is
    Σ pos_s · (2(N − fp_s) + neg_s) and AP is Σ pos_s · tp_s / (tp_s + fp_s) / P."""
    c = _desc_cumulative(df, label, score)
    num2 = F.col("pos").cast(_BIG) * ((F.col("fp_total") - F.col("fp")) * 2 + F.col("neg")).cast(_BIG)
    term = F.col("pos").cast("double") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    agg = c.agg(F.sum(num2).alias("_num2"), F.sum(term).alias("_ap"),
                F.first("tp_total").alias("_P"), F.first("fp_total").alias("_N"))
    den = F.lit(2).cast(_BIG) * F.col("_P").cast(_BIG) * F.col("_N").cast(_BIG)
    return agg.select(F.when(den > 0, F.col("_num2").cast("double") / den.cast("double")).alias("roc_auc"),
                      (F.col("_ap") / F.col("_P").cast("double")).alias("average_precision"))


def confusion_counts(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """tp, fp, fn, tn with predicted = score ≥ threshold, as one row."""
    y = F.col(label) == 1
    p = F.col(score) >= F.lit(threshold)
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def f1_at_threshold(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """M9: F1 of the positive class at ``score ≥ threshold`` (0 when undefined)."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(_ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Per class precision / recall / f1 / support, accuracy, macro and weighted
    averages (zero where a ratio is undefined)."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    p1, r1, f1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tp * 2, tp * 2 + fp + fn)
    p0, r0, f0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(tn * 2, tn * 2 + fn + fp)
    s1, s0 = tp + fn, tn + fp
    wavg = lambda a, b: _ratio(a * s0.cast("double") + b * s1.cast("double"), n)
    row = lambda name, p, r, f, s: F.struct(F.lit(name).alias("label"), p.alias("precision"),
                                           r.alias("recall"), f.alias("f1_score"), s.alias("support"))
    null = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", null, null, _ratio(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n))
    return c.select(F.inline(rows))


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(actual, predicted, n) over the full 2×2 grid, zero cells kept."""
    c = confusion_counts(df, label, score, threshold)
    cell = lambda a, p, col: F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(col).alias("n"))
    return c.select(F.inline(F.array(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Fpr and tpr at each distinct score (threshold), after the origin (threshold NULL:
    above every score)."""
    c = _desc_cumulative(df, label, score)
    points = c.select(F.col(score).cast("double").alias("threshold"),
                      _ratio(F.col("fp"), F.col("fp_total")).alias("fpr"),
                      _ratio(F.col("tp"), F.col("tp_total")).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at each distinct score and, with threshold NULL, the end
    point of recall 0 and precision 1; every row carries the no-skill base rate."""
    c = _desc_cumulative(df, label, score)
    rate = _ratio(F.col("tp_total"), F.col("tp_total") + F.col("fp_total")).alias("base_rate")
    points = c.select(F.col(score).cast("double").alias("threshold"),
                      _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      _ratio(F.col("tp"), F.col("tp_total")).alias("recall"), rate)
    y = F.col(label).cast("int")
    end = df.agg(F.sum(y).cast("bigint").alias("p"), F.count(y).alias("n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        _ratio(F.col("p"), F.col("n")).alias("base_rate"))
    return points.unionByName(end)
