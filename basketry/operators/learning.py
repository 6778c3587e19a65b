"""Reorder-propensity models."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.ordering import exact_rank, key_literal, keys_at_ranks
from basketry.operators import boosting, evaluation, logistic
from basketry.session import materialize

LABEL = "reordered_target"
KEYS = ["user_id", "product_id"]


def _row_hash(seed: int, *extra) -> Column:
    parts = [e.cast("string") if isinstance(e, Column) else F.lit(str(e)) for e in extra]
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in KEYS], *parts, F.lit(str(seed))))


def stratified_split(df: DataFrame, test_size: float = fixed.TEST_SIZE, seed: int = fixed.SEED,
                     label: str = LABEL) -> DataFrame:
    """M1: exact stratified split.  Within each label stratum rows are ordered by
    md5(user|product|seed) (then the key); the first ceil(test_size · n_c) are ``test``.

    The order is a pure function of the row, so the split is the same on any partitioning
    and after any retry.  Only the last test key of each stratum is selected; rows are
    labelled by comparing their own key with it, so none is ranked, moved or joined.
    """
    order = [label, "_h", *KEYS]
    hashed = df.withColumn("_h", _row_hash(seed))
    per_class = sorted((r[label], r["n"]) for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect())
    if len(per_class) > 2:
        raise ValueError("the label is not binary")
    ranks, before = [], 0
    for _, n in per_class:
        ranks.append(before + math.ceil(test_size * n))
        before += n
    types = [hashed.schema[c].dataType for c in order]
    key = F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)])
    test = F.lit(False)
    for (value, _), last in zip(per_class, keys_at_ranks(hashed, order, ranks) if ranks else []):
        test = test | ((F.col(label) == value) & (key <= key_literal(last, types)))
    return hashed.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_h")


def scaling_stats(train: DataFrame, features=fixed.FEATURES) -> DataFrame:
    """M2: mean and population standard deviation of each feature on the train rows,
    as (feature, mean, std) — one aggregation pass, unpivoted."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"{f}__mean"),
                 F.stddev_pop(F.col(f).cast("double")).alias(f"{f}__std")]
    wide = train.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}__mean").alias("mean"),
                               F.col(f"{f}__std").alias("std")) for f in features])
    return wide.select(F.inline(pairs))


def standardize(df: DataFrame, stats: DataFrame, features=fixed.FEATURES) -> DataFrame:
    """Apply (x − mean) / std (std 0 → 1, as a scaler leaves constant columns).  The
    stats are one row per feature — model parameters, fetched once like fitted
    coefficients — and applied as literals, so the rows are never joined."""
    params = {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}
    out = []
    for f in features:
        m, s = params[f]
        s = s if s and s > 0 else 1.0
        out.append(((F.col(f).cast("double") - F.lit(m or 0.0)) / F.lit(s)).alias(f))
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, *out)


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """M3: balanced weights n / (2 · n_c) per class."""
    per = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    total = F.sum("n_c").over(Window.partitionBy())  # ≤ 2 rows
    return per.select(label, "n_c", (total.cast("double") / (F.lit(2.0) * F.col("n_c").cast("double"))).alias("weight"))


def fit_logistic(train_std: DataFrame, max_iter: int = 1000, features=fixed.FEATURES) -> logistic.Logistic:
    """M4: balanced logistic regression on standardised features, with an L2 penalty of C = 1 on
    the summed weighted log loss (weights n / (2 · n_c)).  The class counts (one row per label value)
    are fetched once and applied as literals."""
    weights = {r[LABEL]: r["weight"] for r in class_weights(train_std).collect()}
    return logistic.fit(train_std, features, LABEL, weights, penalty=1.0, most=max_iter)


def early_stopping_rows(seed: int = fixed.SEED) -> Column:
    """A tenth of all rows, by their key's hash: those that tell when to stop."""
    return F.conv(F.substring(_row_hash(seed, "held"), 1, 8), 16, 10).cast("bigint") < int(fixed.GBT_HELD * (1 << 32))


def fit_gbt(train: DataFrame, rounds: int = fixed.GBT_ROUNDS, rate: float = fixed.GBT_RATE, depth: int = fixed.GBT_DEPTH,
            seed: int = fixed.SEED, features=fixed.FEATURES) -> boosting.Boosted:
    """M5: gradient-boosted histogram trees with an L2 leaf penalty; training sets of more than
    ``GBT_HELD_ABOVE`` rows hold some of them back and stop early."""
    rules = boosting.Rules(depth=depth, rate=rate, leaves=fixed.GBT_LEAVES, penalty=fixed.GBT_PENALTY, least_rows=fixed.GBT_LEAF_ROWS)
    held = early_stopping_rows(seed) if train.count() > fixed.GBT_HELD_ABOVE else None
    return boosting.fit(train, features, LABEL, rounds, rules, fixed.GBT_BINS, held, fixed.GBT_PATIENCE)


def predict_proba(model, df: DataFrame, out: str = "reorder_proba") -> DataFrame:
    """M6: positive-class probability."""
    return df.withColumn(out, model.probability())


def metric_row(model_name: str, scored: DataFrame, score: str = "reorder_proba") -> DataFrame:
    """M15 row: model, roc_auc, pr_auc (average precision), f1@0.5 — 4 dp."""
    ranked = evaluation.ranking_metrics(scored, LABEL, score)  # AUC and AP from one ordered pass
    f1 = evaluation.f1_at_threshold(scored, LABEL, score).select("f1").scalar()
    return ranked.select(
        F.lit(model_name).alias("model"), F.round("roc_auc", 4).alias("roc_auc"),
        F.round("average_precision", 4).alias("pr_auc"), F.round(f1, 4).alias("f1@0.5"))


def permutation_importance(model: boosting.Boosted, test: DataFrame, features=fixed.FEATURES,
                           repeats: int = fixed.PERMUTATION_REPEATS, seed: int = fixed.SEED) -> DataFrame:
    """Mean and population std of the drop in ROC-AUC when one feature's column is
    permuted, over ``repeats`` permutations, ordered by mean.

    A repeat pairs every test row with a donor by one permutation of all test rows: the row
    at rank i of one hash order takes the features of the row at rank i of another.  Only
    ranks, keys and donors' features meet in that join (one pass over the test rows a
    repeat); a row's variants, each with one feature of the donor, are scored together
    (``model.variants``), and scores are counted per (feature, repeat, score) before any shuffle.
    """
    base = test.select(*KEYS, LABEL, *features)
    first = materialize(exact_rank(base.withColumn("_h", _row_hash(seed)), ["_h", *KEYS], out="_i").drop("_h", *KEYS))
    names = F.array(*[F.lit(f) for f in features])
    aucs = []
    for rep in range(repeats):
        donor = base.select(*KEYS, F.struct(*features).alias("_donor")).withColumn("_h", _row_hash(seed, "donor", rep))
        donor = exact_rank(donor, ["_h", *KEYS], out="_i").select("_i", "_donor")
        permuted = first.join(donor, "_i").select(LABEL, model.variants(F.col("_donor")).alias("_v"))
        permuted = permuted.select(LABEL, F.posexplode("_v").alias("_k", "_p")).select(LABEL, names[F.col("_k")].alias("_f"), "_p")
        aucs.append(permuted.groupBy("_f", "_p").agg(
            F.sum(F.col(LABEL).cast("bigint")).alias("pos"), F.sum(1 - F.col(LABEL).cast("bigint")).alias("neg"))
            .withColumn("_rep", F.lit(rep)))
    groups = materialize(reduce(DataFrame.unionByName, aucs))
    found = evaluation.roc_auc_of_groups(groups, "_p", ["_f", "_rep"])
    base_auc = evaluation.roc_auc(predict_proba(model, test, "_p"), LABEL, "_p").select("roc_auc").scalar()
    drops = found.select(F.col("_f").alias("feature"), (base_auc - F.col("roc_auc")).alias("_d"))
    return (drops.groupBy("feature")
            .agg(F.avg("_d").alias("importance_mean"), F.stddev_pop("_d").alias("importance_std"))
            .orderBy(F.col("importance_mean").desc(), "feature"))


def model_comparison(features_split: DataFrame, gbt_rounds: int = fixed.GBT_ROUNDS):
    """M15 (and the fitted models): LR and boosted trees fitted on the train split and
    scored on the test split.  Returns (metrics, lr_model, gbt_model, stats)."""
    train = features_split.where(F.col("split") == "train")
    test = features_split.where(F.col("split") == "test")
    stats = scaling_stats(train)
    lr = fit_logistic(standardize(train, stats))
    # each scored test set feeds three metric jobs (and their ranking passes): score once
    lr_test = materialize(predict_proba(lr, standardize(test, stats)).select(LABEL, "reorder_proba"))
    gbt = fit_gbt(train, rounds=gbt_rounds)
    gbt_test = materialize(predict_proba(gbt, test).select(LABEL, "reorder_proba"))
    metrics = reduce(DataFrame.unionByName, [metric_row("LogisticRegression", lr_test),
                                             metric_row("GradientBoosting", gbt_test)])
    return metrics, lr, gbt, stats


PREDICTION_COLUMNS = ["user_id", "product_id", "up_orders", "up_orders_since_last", "p_reorder_rate",
                      "reorder_proba", "reordered_target"]


def reorder_predictions(gbt_model, features: DataFrame) -> DataFrame:
    """Score every candidate (training rows included) with the boosted model."""
    return predict_proba(gbt_model, features).select(*PREDICTION_COLUMNS)


__all__ = ["stratified_split", "scaling_stats", "standardize", "class_weights", "fit_logistic", "fit_gbt",
           "predict_proba", "permutation_importance", "model_comparison", "reorder_predictions"]
