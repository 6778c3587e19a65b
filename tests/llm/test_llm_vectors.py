"""Whitening, near-duplicate vectors and hard negatives against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import binary_codes as bc
from basketry.llm import cover_tree as ct
from basketry.llm import hard_negatives, near_vectors, whitening
from basketry.llm.bidiagonal import directions, dqds, householder
from basketry.llm.queries import op11_hard_negatives, op12_whitening, op13_near_duplicate_vectors

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int, x string"
ODD = [(None, [0.5, -0.25], 1, "a"), (3, None, 1, "b"), (4, [], 2, "c"), (5, [0.5, None], 2, "d"), (6, [float("nan"), 1.0], 2, "e"),
       (7, [float("inf"), 1.0], None, "f"), (8, [1.0, 2.0, 3.0], 3, "g"), (9, [0.0, 0.0], 1, "h"), (9, [0.0, 0.0], 1, "h")]


def write(spark, tmp_path, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def table(sf):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf}/embeddings.parquet").to_pylist()


# --- whitening ------------------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    return {
        "plain": rng.normal(size=(90, 16)), "one column": rng.normal(size=(9, 1)), "two": rng.normal(size=(9, 2)),
        "fewer rows": rng.normal(size=(5, 9)), "zeros": np.zeros((4, 3)), "ties": np.diag([3.0, 3, 3, 1, 1, 0, 0]),
        "clusters": np.diag([2.0] * 6 + [1.0] * 6) @ turn, "one row often": np.repeat(rng.normal(size=(1, 8)), 20, axis=0),
        "graded": rng.normal(size=(90, 16)) * np.logspace(0, -12, 16)}


@pytest.mark.parametrize("kind", list(matrices()))
def test_singular_values_and_directions(kind):
    a = matrices()[kind]
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    diagonal, above, right = householder(r)
    found, plain = dqds(diagonal, above), np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(found - plain).max() <= 1e-13 * max(plain.max(), 1e-300)
    v = right @ directions(diagonal, above, found)
    assert np.abs(v.T @ v - np.eye(len(found))).max() < 1e-11
    assert np.abs(r.T @ r @ v - v * found).max() <= 1e-12 * max(plain.max(), 1e-300)


def test_small_singular_values_are_accurate():
    """A bidiagonal matrix with entries of very different size: relative accuracy of the least."""
    diagonal, above = np.logspace(0, -30, 12), np.full(11, 1e-40)
    assert np.allclose(np.sqrt(dqds(diagonal, above)), diagonal, rtol=1e-13, atol=0)


def plain_whitening(x):
    x = np.array(x, np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, sums, centred, values, vectors


def test_op12_against_plain_whitening(spark):
    rows = [r for r in table(SF)]
    x = [[math.floor(1024 * float(c)) + 100000 for c in r["embedding"]] for r in rows]
    n, sums, centred, values, vectors = plain_whitening(x)
    found = op12_whitening(spark, SF).collect()
    assert len(found) == 8 * n
    at = {r["vec_id"]: k for k, r in enumerate(rows)}
    whitened = np.zeros((n, 8))
    for r in found:
        k = at[r["vec_id"]]
        whitened[k, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * v - int(s)) ** 2 for v, s in zip(x[k], sums))
        assert math.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    for c in range(8):
        plain = centred @ vectors[:, c] / math.sqrt(values[c])
        sign = 1 if plain @ whitened[:, c] > 0 else -1
        assert np.abs(whitened[:, c] - sign * plain).max() < 1e-9
    assert np.abs(np.cov(whitened.T, bias=True) - np.eye(8)).max() < 1e-9


def test_op12_odd_rows(spark, tmp_path):
    sf = write(spark, tmp_path, ODD)
    found = op12_whitening(spark, sf).collect()
    # two-dimensional rows without a bad entry: ids null, 9, 9; they lie on a line
    assert sorted((r["vec_id"] is None, r["component"]) for r in found) == [(False, 1), (False, 1), (True, 1)]
    assert all(abs(r["explained"] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in found)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0], 1, "a")], [(1, [0.5], 1, "a")] * 4, [(1, [], 1, "a")], [(1, None, 1, "a")]])
def test_op12_without_variance(spark, tmp_path, rows):
    assert op12_whitening(spark, write(spark, tmp_path, rows)).collect() == []


def test_whitening_merges_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = [(i, [(i * i) % 17, i % 5, i]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x array<bigint>").repartition(7)
    model = whitening.fit(df, "x")
    n, _, _, values, _ = plain_whitening([x for _, x in rows])
    assert model.n == n and np.allclose(model.values, values, rtol=1e-12)
    assert whitening.identity_error(df, "x", model) < 1e-12


def test_deviation_beyond_64_bits_is_null(spark):
    df = spark.createDataFrame([(1, [0]), (2, [1 << 31]), (3, [1 << 32]), (4, [5])], "id long, x array<bigint>")
    found = {r["id"]: r["deviation"] for r in whitening.transform(df, "x", "id", whitening.fit(df, "x")).collect()}
    s = 3 * (1 << 31) + 5
    assert found == {1: None, 2: (4 * (1 << 31) - s) ** 2, 3: None, 4: None}


# --- near-duplicate vectors -----------------------------------------------------------------

def near_rows(seed=3, family=60, noise=0.1):
    """Random vectors of two labels, copies, scaled copies, and families of near copies."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=24).tolist(), int(i % 2), "x") for i in range(150)]
    rows += [(200 + i, rows[i][1], rows[i][2], "copy") for i in range(0, 40, 2)]
    rows += [(240 + i, [3.0 * x for x in rows[i][1]], rows[i][2], "scaled") for i in range(20)]
    rows += [(260 + i, rows[i][1], 1 - rows[i][2], "other label") for i in range(20)]
    centre = rng.normal(size=24)
    for i in range(family):
        v = centre + noise * np.linalg.norm(centre) * rng.normal(size=24) / 5
        rows.append((300 + i, v.tolist(), 1, "near"))
    return rows


def plain_links(rows, least=0.98):
    out = []
    for i, _, label, _ in rows:
        out.append({"id": i, "n": 0, "label": label})
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    good = [label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
            for _, v, label, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(r, np.float32).astype(float) for r in (rows[a][1], rows[b][1]))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    out[a]["n"] += 1
                    out[b]["n"] += 1
                    parent[root(a)] = root(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(root(k), []).append(r[0])
    result = []
    for k, r in enumerate(rows):
        ids = [i for i in groups[root(k)] if i is not None]
        first = min(ids) if ids else None
        result.append((r[0], out[k]["n"], first, r[0] == first))
    return sorted(result, key=str)


def found_links(spark, sf):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in op13_near_duplicate_vectors(spark, sf).collect()), key=str)


def test_op13_against_all_pairs(spark, tmp_path):
    rows = near_rows()
    plain = plain_links(rows)
    assert sum(n for _, n, _, _ in plain) > 300
    assert found_links(spark, write(spark, tmp_path, rows)) == plain


def test_op13_many_bands_and_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near_vectors, "BUCKET", 8)
    monkeypatch.setattr(near_vectors, "CHUNK", 16)
    rows = near_rows(seed=4, family=120, noise=0.14)
    assert found_links(spark, write(spark, tmp_path, rows)) == plain_links(rows)


def test_op13_odd_rows(spark, tmp_path):
    rows = ODD + [(20, [1.0, 2.0, 3.0], 3, "longer"), (21, [1.0, 2.0], 3, "shorter"), (None, [0.5, -0.25], 1, "again"), (-4, [1.0, -0.5], 1, "scaled"),
                  (30, [1.0, 2.0], None, "no label"), (31, [1.0, 2.0], None, "no label"), (None, [9.0, -1.0], 7, "p"), (None, [9.0, -1.0], 7, "p"),
                  (40, [1e-30, 2e-30], 5, "small"), (41, [1e30, 2e30], 5, "large"), (42, [4.0], 6, "one"), (43, [5.0], 6, "one"), (44, [-5.0], 6, "one")]
    assert found_links(spark, write(spark, tmp_path, rows)) == plain_links(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, "a")], [(1, [0.0, 0.0], 1, "a")] * 2])
def test_op13_nothing_to_link(spark, tmp_path, rows):
    assert found_links(spark, write(spark, tmp_path, rows)) == [(r[0], 0, r[0], True) for r in rows]


def test_near_duplicates_ignore_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, label string, node string, copies long, n_links string, first int, d int, code string"
    df = spark.createDataFrame([(5, [1.0, 2.0], "p", "n", 7, "q", 1, 2, "c"), (2, [1.0, 2.0], "p", "n", 7, "q", 1, 2, "c")], schema)
    found = near_vectors.near_duplicates(df, "vec_id", "embedding", "label").collect()
    assert sorted(map(tuple, found)) == [(2, 1, 2, True), (5, 1, 2, False)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 64))
    near = x[0] + 0.02 * rng.normal(size=(200, 64)) * np.linalg.norm(x[0])
    units = bc.unit(np.vstack([x, near]))
    codes = bc.unpack(bc.encode(units).pack())
    exact, guess = units @ units.T, bc.estimates(codes, codes)
    off = ~np.eye(len(units), dtype=bool)
    assert abs((guess - exact)[off].mean()) < 5e-3
    close = (exact >= 0.98) & off
    assert close.sum() > 1000 and bc.possible(codes, codes, 0.98)[close].all()
    far = exact < 0.7
    assert bc.possible(codes, codes, 0.98)[far].sum() == 0


def test_bands_meet_the_stated_probability():
    rng = np.random.default_rng(2)
    picked = near_vectors.bands(100_000, 0.98)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=(3000, 64))
    o -= (o * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * o / np.linalg.norm(o, axis=1, keepdims=True)
    same = bc.side_bits(a, near_vectors.SIDE_BITS) == bc.side_bits(b, near_vectors.SIDE_BITS)
    assert len(picked[0]) >= 7 and np.stack([same[:, p].all(axis=1) for p in picked]).any(axis=0).all()


# --- hard negatives -------------------------------------------------------------------------

def plain_negatives(rows):
    """Every score of every anchor, in Python integers."""
    good = []
    for i, v, label, _ in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v]))
    out, asked = [], set()
    for at, (anchor, label, q) in enumerate(good):
        if anchor % 50 or (anchor, label, tuple(q)) in asked:
            continue
        asked.add((anchor, label, tuple(q)))
        scored = [(-sum(a * b for a, b in zip(q, x)), i, other) for k, (i, other, x) in enumerate(good) if k != at]
        same = sorted(s for s in scored if s[2] == label)[:5]
        apart = sorted(s for s in scored if s[2] != label)
        for p, positive, _ in same:
            inside = [s for s in apart if 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(anchor, positive, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(inside)]
    return sorted(out)


def found_negatives(spark, sf):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in op11_hard_negatives(spark, sf).select(columns).collect())


def grouped_rows(seed, n=700, d=12):
    """Random vectors around centres that labels share, with copies and other lengths of vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = centres[int(rng.integers(12))] * rng.choice([0.4, 1.0, 2.0]) + 0.2 * rng.normal(size=d)
        rows.append((i, (0.05 * v).tolist(), int(rng.integers(4)), "x"))
    return rows + [(n + i, rows[i % 60][1], rows[i % 60][2], "copy") for i in range(200)]


def test_op11_against_all_scores(spark):
    plain = plain_negatives([(r["vec_id"], r["embedding"], r["label"], "") for r in table(SF)])
    assert plain and found_negatives(spark, SF) == plain


def test_op11_many_shards_and_blocks(spark, tmp_path, monkeypatch):
    for k, v in (("SHARD", 64), ("BLOCK", 8), ("SAMPLE", 100)):
        monkeypatch.setattr(hard_negatives, k, v)
    rows = grouped_rows(6)
    plain = plain_negatives(rows)
    assert len(plain) > 50 and found_negatives(spark, write(spark, tmp_path, rows)) == plain


def test_op11_odd_rows(spark, tmp_path):
    rows = ODD + [(50, [1.0, 2.0], 1, "anchor"), (50, [1.0, 2.0], 1, "again"), (100, [2.0, 1.0], 1, "p"), (0, [0.0, 0.0], 1, "zero"),
                  (150, [3.0], 4, "short"), (151, [3.0], 4, "p"), (152, [-3.0, 1.0], 4, "p"), (153, [2.0, 9.0], 5, "n"), (154, [2.5], 5, "n"),
                  (155, [2.5], 5, "n"), (200, [-1.0, -1.0], 6, "a"), (201, [1.0, 1.0], 6, "negative positive"), (250, [1.0], 8, "alone")]
    assert found_negatives(spark, write(spark, tmp_path, rows)) == plain_negatives(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, "a")], [(50, [], 1, "a"), (51, [], 1, "b"), (52, [], 2, "c")], [(50, [1.0], 1, "a")]])
def test_op11_little_or_nothing(spark, tmp_path, rows):
    assert found_negatives(spark, write(spark, tmp_path, rows)) == plain_negatives(rows)


def test_hard_negatives_ignore_clashing_columns(spark):
    schema = "id long, kind int, v array<long>, x string, node string, label string, score int"
    df = spark.createDataFrame([(0, 1, [4, 0], "q", "q", "q", 0), (1, 1, [2, 0], "q", "q", "q", 0), (2, 2, [1, 5], "q", "q", "q", 0)], schema)
    found = hard_negatives.hard_negatives(df, "id", "kind", "v", F.col("id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 8, 4)]


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [1 << 40, 0]), (1, 1, [2, 0])], "id long, kind int, v array<long>")
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.hard_negatives(df, "id", "kind", "v", F.col("id") == 0)


@pytest.mark.parametrize("scale", [1, 1 << 14, 1 << 22])
def test_cover_tree_finds_what_a_scan_finds(scale, monkeypatch):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(9, 6))
    x = np.floor(40 * scale * (centres[rng.integers(9, size=900)] + 0.1 * rng.normal(size=(900, 6)))).astype(np.int64)
    x[5:9], x[20:40] = 0, x[0]
    labels, ids = rng.integers(3, size=900), np.full((900, 6), ct.NO_ID)
    ids[:, 0] = rng.permutation(900)
    monkeypatch.setattr(ct, "LEAF", 16)
    tree = ct.Tree(ct.build(x, labels, ids, np.array([f"n{i}" for i in range(900)]), math.sqrt(float((x.astype(float) ** 2).sum(axis=1).max()))))
    assert len(tree.reach) > 10 and sorted(tree.ids[:, 0].tolist()) == list(range(900))
    queries = np.vstack([x[::50], np.zeros((1, 6), np.int64)])
    anything = np.full((len(queries), 1), 1 << 62)
    leaves, low, high = tree.leaves(queries, -anything, anything)
    assert sorted(leaves.tolist()) == np.flatnonzero(tree.leaf).tolist()
    for k, node in enumerate(leaves):  # the bounds hold
        exact = tree.x[tree.first[node] : tree.last[node]].astype(object) @ queries.T.astype(object)
        assert all(low[i, k] <= s <= high[i, k] for row in exact for i, s in enumerate(row))
    exact = queries.astype(object) @ x.T.astype(object)
    top = [int(max(row)) for row in exact]
    least = np.array([(-(1 << 62), t // 2, 5) for t in top])
    largest = np.array([(1 << 62, t * 9 // 10, 4) for t in top])
    for same in (True, False):
        found = tree.search(queries, np.ones(len(queries), np.int64), same, np.array([""] * len(queries)), np.full(len(queries), -1), least, largest, 4)
        plain = []
        for i in range(len(queries)):
            for w in range(3):
                fits = sorted(((-int(s), int(j)) for s, j, label in zip(exact[i], ids[:, 0], labels)
                               if (label == 1) == same and least[i, w] <= s <= largest[i, w]))
                plain += [(i, w, -s, j) for s, j in fits[:4]]
        assert list(zip(*(c.tolist() for c in found))) == plain
