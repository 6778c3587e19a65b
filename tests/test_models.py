"""Model checks: the logistic fit sits at the optimum of the balanced, L2-penalised
objective; boosted trees rank better than chance; a constant feature has no importance."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.operators import boosting, learning, logistic
from basketry.plans import registry


@pytest.fixture(scope="module")
def split(spark):
    return registry._model_split(spark, "/root/testdata/sf0.001")[2]


def test_logistic_regression_is_at_the_optimum(split):
    train = split.where(F.col("split") == "train")
    stats = learning.scaling_stats(train)
    std = learning.standardize(train, stats)
    model = learning.fit_logistic(std)
    pdf = std.join(learning.class_weights(std).select("reordered_target", "weight"), "reordered_target").select(*fixed.FEATURES, "reordered_target", "weight").toPandas()
    x = np.column_stack([pdf[fixed.FEATURES].to_numpy(float), np.ones(len(pdf))])
    y, w = pdf["reordered_target"].to_numpy(float), pdf["weight"].to_numpy(float)
    assert np.isclose(w.sum(), len(w))  # balanced weights sum to n
    ridge, beta = np.append(np.ones(x.shape[1] - 1), 0.0), np.zeros(x.shape[1])
    for _ in range(60):  # plain Newton steps
        p = 1 / (1 + np.exp(-(x @ beta)))
        beta = beta - np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (w * (p - y)) + ridge * beta)
    assert np.allclose(np.append(model.coefficients, model.intercept), beta, rtol=0, atol=1e-8)
    scored = learning.predict_proba(model, std).select(*fixed.FEATURES, "reorder_proba").toPandas()
    plain = 1 / (1 + np.exp(-(scored[fixed.FEATURES].to_numpy(float) @ beta[:-1] + beta[-1])))
    assert np.allclose(scored["reorder_proba"], plain, rtol=0, atol=1e-8)


def test_logistic_of_odd_rows(spark):
    schema = "a double, b double, y int"
    none = logistic.fit(spark.createDataFrame([], schema), ["a", "b"], "y", {})
    assert none.coefficients.tolist() == [0.0, 0.0] and none.intercept == 0.0
    rows = [(None, 1.0, 0), (0.0, 1.0, 1), (3.0, 1.0, None), (2.0, 1.0, 1), (-2.0, 1.0, 0)]
    df = spark.createDataFrame(rows, schema)
    model = logistic.fit(df, ["a", "b"], "y", {0: 1.0, 1: 1.0})
    same = logistic.fit(df.fillna(0.0, ["a"]).where("y is not null"), ["a", "b"], "y", {0: 1.0, 1: 1.0})
    assert np.allclose(model.coefficients, same.coefficients, atol=1e-10) and model.coefficients[0] > 0
    # separable without a penalty: the coefficient grows until the objective stops falling
    wild = logistic.fit(spark.createDataFrame([(float(i), 0.0, int(i > 0)) for i in range(-20, 20)], schema), ["a"], "y", {}, penalty=0.0, most=8)
    assert wild.steps == 8 and wild.coefficients[0] > 3


# --- boosted trees ------------------------------------------------------------------------

def plain_boosting(x, y, rounds, depth, leaves, rate, penalty, least_rows, bins):
    """One tree after the other, one split after the other, each by trying every limit."""
    limits = []
    for f in range(x.shape[1]):
        v = np.sort(x[:, f])
        different = np.unique(v)
        ends = different[:-1] if len(different) <= bins else [
            d for d in different[:-1] if np.searchsorted(v, d, "right") * bins // len(v) > np.searchsorted(v, d, "left") * bins // len(v)]
        limits.append([(d + different[np.searchsorted(different, d) + 1]) / 2 for d in ends])
    base = np.log(y.mean() / (1 - y.mean()))
    score, trees = np.full(len(y), base), []

    def best(rows, g, h):
        found = (0.0, None, None)
        for f, cuts in enumerate(limits):
            for c in cuts:
                left = x[rows, f] <= c
                if least_rows <= left.sum() <= len(rows) - least_rows and min(h[rows[left]].sum(), h[rows[~left]].sum()) >= 1e-3:
                    part = lambda r: g[r].sum() ** 2 / (h[r].sum() + penalty)
                    gain = part(rows[left]) + part(rows[~left]) - part(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, f, c)
        return found

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        nodes = {1: (np.arange(len(y)), *best(np.arange(len(y)), g, h))}
        tree = []
        while len(nodes) < leaves and any(n[2] is not None for n in nodes.values()):
            node = max((k for k, n in nodes.items() if n[2] is not None), key=lambda k: nodes[k][1])
            rows, gain, f, c = nodes.pop(node)
            tree.append((node, f, c, gain, len(rows), None))
            left = x[rows, f] <= c
            for child, own in ((2 * node, rows[left]), (2 * node + 1, rows[~left])):
                nodes[child] = (own, *(best(own, g, h) if child < 2 ** depth else (0.0, None, None)))
        for node, (rows, *_) in nodes.items():
            value = -rate * g[rows].sum() / (h[rows].sum() + penalty)
            score[rows] += value
            tree.append((node, None, None, None, len(rows), value))
        trees.append(sorted(tree))
    return score, trees


@pytest.mark.parametrize("depth,leaves,bins", [(4, 6, 255), (3, 31, 16)])
def test_boosting_against_plain_trees(spark, depth, leaves, bins):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=2000).round(3), rng.integers(0, 9, 2000), rng.exponential(size=2000).round(2)])
    y = (rng.random(2000) < 1 / (1 + np.exp(-(x[:, 0] * (x[:, 1] - 4) + np.sin(3 * x[:, 2]))))).astype(int)
    df = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(x, y)], "a double, b double, c double, y int").repartition(5)
    rules = boosting.Rules(depth=depth, leaves=leaves, rate=0.3, penalty=1.0, least_rows=20)
    model = boosting.fit(df, ["a", "b", "c"], "y", rounds=3, rules=rules, bins=bins)
    score, trees = plain_boosting(x, y, 3, depth, leaves, 0.3, 1.0, 20, bins)
    for k, plain in enumerate(trees):
        found = model.tree_rows(k)
        assert len(found) == len(plain)
        for a, b in zip(found, plain):
            assert a[0] == b[0] and a[4] == b[4] and (a[1] is None) == (b[1] is None)
            if a[1] is None:
                assert abs(a[5] - b[5]) < 1e-7
            else:
                assert a[1] == "abc"[b[1]] and abs(a[2] - b[2]) < 1e-12 and abs(a[3] - b[3]) < 1e-5
    proba = df.withColumn("p", model.probability()).toPandas().sort_values(["a", "b", "c"])["p"].to_numpy()
    order = np.lexsort((x[:, 2], x[:, 1], x[:, 0]))
    assert np.allclose(proba, 1 / (1 + np.exp(-score[order])), atol=1e-7)


def test_boosting_does_not_depend_on_partitions_and_rewrites(spark, split, monkeypatch):
    train = split.where(F.col("split") == "train")
    one = boosting.fit(train.coalesce(1), fixed.FEATURES, learning.LABEL, rounds=5)
    monkeypatch.setattr(boosting, "REWRITE", 2)
    many = boosting.fit(train.repartition(7), fixed.FEATURES, learning.LABEL, rounds=5)
    assert [one.tree_rows(k) for k in range(5)] == [many.tree_rows(k) for k in range(5)]


def test_boosting_stops_early(spark):
    rng = np.random.default_rng(9)
    rows = [(float(v), int(rng.random() < 0.5), i % 5 == 0) for i, v in enumerate(rng.normal(size=1500))]
    df = spark.createDataFrame(rows, "v double, y int, held boolean")
    model = boosting.fit(df, ["v"], "y", rounds=200, held=F.col("held"), patience=5)
    assert len(model.trees) < 100 and min(model.losses[-5:]) >= model.losses[-6] - 1e-7


def test_boosting_of_odd_rows(spark):
    schema = "v double, w double, y int"
    assert boosting.fit(spark.createDataFrame([], schema), ["v", "w"], "y").trees == []
    same = boosting.fit(spark.createDataFrame([(1.0, None, 1)] * 50, schema), ["v", "w"], "y")
    assert same.trees == [] and same.base > 10
    rows = [(None if i % 3 == 0 else float(i % 7), float("nan") if i % 2 else None, int(i % 3 == 0) if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, schema)
    model = boosting.fit(df, ["v", "w"], "y", rounds=3)
    found = df.withColumn("p", model.probability()).toPandas()
    assert len(model.limits[1]) == 0 and model.trees[0].feature[0] == 0  # nulls share the lowest bin
    assert found.loc[found.v.isna(), "p"].min() == found.loc[found.v == 0, "p"].max() > found.loc[found.v > 0, "p"].max()


def test_gbt_ranks_better_than_chance_and_constant_feature_is_unimportant(split):
    train = split.where(F.col("split") == "train").withColumn("up_tenure_orders", F.lit(1))
    test = split.where(F.col("split") == "test").withColumn("up_tenure_orders", F.lit(1))
    gbt = learning.fit_gbt(train, rounds=5)
    scored = learning.predict_proba(gbt, test)
    auc = learning.evaluation.roc_auc(scored, "reordered_target", "reorder_proba").first().roc_auc
    assert auc > 0.5
    imp = {r.feature: r for r in learning.permutation_importance(gbt, test, repeats=2).collect()}
    assert set(imp) == set(fixed.FEATURES)
    assert imp["up_tenure_orders"].importance_mean == 0.0 and imp["up_tenure_orders"].importance_std == 0.0


def test_importance_does_not_depend_on_the_number_of_partitions(spark, split):
    gbt = learning.fit_gbt(split.where(F.col("split") == "train"), rounds=2)
    test = split.where(F.col("split") == "test")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append([tuple(r) for r in learning.permutation_importance(gbt, test, repeats=1).collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_leaves_by_bits_and_by_walking_are_the_same():
    rng = np.random.default_rng(5)

    def tree(depth):
        t = boosting.Tree()
        todo = [(t.add(float(rng.normal()), 1), 0)]
        while todo:
            at, level = todo.pop()
            if level < depth and rng.random() < 0.9:
                sides = [t.add(float(rng.normal()), 1) for _ in range(2)]
                t.split(at, int(rng.integers(4)), int(rng.integers(255)), 1.0, *sides)
                todo += [(c, level + 1) for c in sides]
        return t

    trees = [tree(d) for d in (3, 5, 0, 6, 9, 4, 4, 6)]
    bins, donors = (rng.integers(0, 256, (40_000, 4)).astype(np.uint8) for _ in range(2))

    def walked(rows):
        out = np.zeros(len(rows)) + 0.5
        for t in trees:
            out += np.array(t.value)[t.nodes(rows)]
        return out

    made = boosting.compiled(trees, 4)
    assert len(made) < len(trees) and any(isinstance(m, boosting.Tree) for m in made)
    assert (boosting.scores(bins, 0.5, trees) == walked(bins)).all()
    found = boosting.variant_scores(bins, donors, 0.5, made)
    for f in range(4):
        mixed = bins.copy()
        mixed[:, f] = donors[:, f]
        assert (found[f] == walked(mixed)).all()


def test_a_level_scores_only_its_rows_and_scores_are_written_with_the_root(tmp_path, monkeypatch):
    """Sums of a level against plain ones; rows of other nodes are not scored, trees that are in the written
    scores are not scored again, and a repeated task leaves the same scores."""
    rng = np.random.default_rng(8)
    bins, y, held = rng.integers(0, 200, (50_000, 3)).astype(np.uint8), rng.integers(0, 2, 50_000), rng.random(50_000) < 0.1
    stored = boosting.Stored(str(tmp_path), 3, -0.5, ["a"])
    blocks = [np.int64(len(b)).tobytes() + b.T.tobytes() + (y[i : i + len(b)] + 2 * held[i : i + len(b)]).astype(np.uint8).tobytes()
              for i, b in ((i, bins[i : i + 30_000]) for i in (0, 30_000))]
    boosting._save(f"{tmp_path}/rows", "a", iter(blocks))
    last, growing = boosting.Tree(), boosting.Tree()
    for tree, f, cut in ((last, 0, 120), (growing, 2, 30)):
        tree.add(0.0, 1)
        tree.split(0, f, cut, 1.0, tree.add(0.25, 1), tree.add(-0.75, 1))
    scored, real = [], boosting.column_scores
    monkeypatch.setattr(boosting, "column_scores", lambda columns, base, made: (scored.append((columns.shape[1], len(made))), real(columns, base, made))[1])

    def sums(*args):
        found = list(boosting._sums(stored, *args)(iter([pa.RecordBatch.from_pydict({"id": [0]})])))[0].to_pylist()
        return {(r["node"], r["feature"], r["bin"]): (r["g"], r["h"], r["n"]) for r in found}

    def plain(rows, node):
        p = 1 / (1 + np.exp(-(-0.5 + np.where(bins[:, 0] <= 120, 0.25, -0.75))))
        g, h = np.rint((p - y) * 2.0**32), np.rint(p * (1 - p) * 2.0**32)
        return {(node, f, int(b)): (int(g[at].sum()), int(h[at].sum()), int(at.sum())) for f in range(3) for b in np.unique(bins[rows, f])
                for at in [rows & (bins[:, f] == b)]}

    root = boosting.Tree()
    root.add(0.0, 1)
    for _ in range(2):
        found = sums([last], root, [0], 32, False, True)
        assert found.pop((-1, -1, -1))[2] == held.sum() and found == plain(~held, 0)
    stored.version, scored[:] = 1, []
    rows = ~held & (bins[:, 2] <= 30)
    assert sums([], growing, [1], 32) == plain(rows, 1)
    assert sum(n for n, _ in scored) == rows.sum() < 10_000 and not any(trees for _, trees in scored)
    assert len(list((tmp_path / "scores1").iterdir())) == 1
