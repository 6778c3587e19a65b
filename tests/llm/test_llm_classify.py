"""Toxicity, language and quality classifiers on held-out rows; URL filters against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import language, quality, toxicity, url_filter
from basketry.llm.order import range_of, split_points
from basketry.llm.texts import held_out

SYLLABLES = {"en": ["the", "ing", "and", "ion", "er", "wh"], "de": ["ein", "sch", "ung", "ß", "ü", "zu"], "ru": ["про", "ени", "ста", "ть", "ый"]}


def prose(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for i in range(900):
        lang = r.choice(list(SYLLABLES))
        text, toxic, good = prose(r, lang, r.randint(20, 120)), i % 4 == 0, i % 5 != 0
        if toxic:
            w = text.split()
            for _ in range(max(3, len(w) // 15)):
                w.insert(r.randrange(len(w)), r.choice(["blockhead", "nincompoop", "vermin", "dunderfunk"]))
            text = " ".join(w)
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        out.append((i, text, lang, f"site{i % 7}" if i % 3 else "hot", int(toxic), int(good)))
    return out


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs = spark.createDataFrame([(i, t, g, s, "clash") for i, t, g, s, _, _ in rows], "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(i, q, x) for i, _, _, _, x, q in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def odd_docs(spark, columns="doc_id long, text string, lang string, source string, score string"):
    texts = [None, "", " \n", "123 !!", "x", "x" * 300_000, "the and " * 60_000, "the and", "the and"]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], columns)


def test_toxicity_of_held_out_rows(spark, tables, rows):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).withColumn("h", held_out(F.col("doc_id"))).where("h").collect()
    label = {i: x for i, *_, x, _ in rows}
    assert len(got) > 100 and np.mean([(r["score"] >= 0.5) == label[r["doc_id"]] for r in got]) > 0.95
    odd = {r["doc_id"]: r["score"] for r in toxicity.score(odd_docs(spark), model).collect()}
    assert len(odd) == 9 and all(0 <= s < 0.5 for s in odd.values()) and odd[0] == odd[1] == odd[2] and odd[7] == odd[8]
    assert toxicity.score(docs.where("false"), model).collect() == []


def test_toxicity_without_labels_is_zero(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.score(docs.limit(5), model).collect()} == {0.0}


def test_language_of_held_out_rows_and_spans(spark, tables, rows):
    docs, _ = tables
    model = language.fit(docs)
    known = {i: g for i, _, g, *_ in rows}
    got = language.identify(docs, model).withColumn("h", held_out(F.col("doc_id"))).where("h").collect()
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in got]) > 0.97
    r = random.Random(5)
    mixed = spark.createDataFrame([(1, " ".join([prose(r, "en", 30), prose(r, "ru", 50), prose(r, "de", 40)]))], "doc_id long, text string")
    spans = language.identify(mixed, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "ru", "de"] and abs(spans[1]["first"] - 30) <= 2 and abs(spans[2]["first"] - 80) <= 2
    odd = {r["doc_id"]: r for r in language.identify(odd_docs(spark), model).collect()}
    assert [odd[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and odd[4]["lang_pred"] != "und" and odd[6]["lang_pred"] == "en"
    assert all(odd[i]["score"] == 0 and odd[i]["spans"] == [] for i in range(4))
    same = docs.select("doc_id", language.language_of(F.col("text"), model).alias("f")).collect()
    assert {r["doc_id"]: r["f"]["lang"] for r in same} == {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert language.identify(docs.where("false"), model).collect() == []
    none = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(docs.limit(4), none).collect()} == {"und"}


def test_letters_among_the_signs_of_u2000_to_u303f():
    texts = ["ⵜⴰⵎⴰⵣⵉⵖⵜ", "ⰳⰾⰰⰳⱁⰾⰻⱌⰰ", "ⲙⲉⲧⲣⲉⲙⲛⲭⲏⲙⲓ", "々", "“—…”", "€ ™? ①", "、。「」"]
    letters = [int(language._letters(np.frombuffer(t.encode(), np.uint8)).sum()) for t in texts]
    assert letters == [len(t.encode()) for t in texts[:4]] + [0, 0, 0]
    model = {"langs": ["en", "xx"], "logs": np.zeros((1 << language.FEATURE_BITS, 2), np.float32), "scripts": [int(language._LATIN), 1]}
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    found = next(language._identify(model)(iter([batch])))
    assert [x == "und" for x in found.column(1).to_pylist()] == [False] * 4 + [True] * 3
    assert found.column(2).to_pylist() == [1.0] * 4 + [0.0] * 3


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(2)
    row = np.repeat([0, 1, 2, 5], [4, 1, 7, 3])
    scores = rng.normal(0, 3, (len(row), 3)).astype(np.float32)
    label = language.best_labels(row, scores, switch=2.5)
    for r in np.unique(row):
        s = scores[row == r]
        value = lambda path: sum(s[t, p] for t, p in enumerate(path)) - 2.5 * sum(a != b for a, b in zip(path, path[1:]))
        best = max(value(p) for p in np.ndindex(*[3] * len(s)))
        assert value(tuple(label[row == r])) == pytest.approx(best, abs=1e-4)


def test_quality_of_held_out_rows(spark, tables, rows):
    docs, labels = tables
    model = quality.fit(docs, labels)
    found = quality.classify(docs, F.col("source"), F.col("lang"), model, ["doc_id", "score"])
    assert found.columns[:2] == ["doc_id", "score"]
    renamed = found.toDF("doc_id", "old", "host", "path", "evidence", "host_posterior", "path_posterior", "score", "accepted")
    good = {r[0]: r[5] for r in rows}
    got = renamed.withColumn("h", held_out(F.col("doc_id"))).where("h").collect()
    assert np.mean([r["accepted"] == bool(good[r["doc_id"]]) for r in got]) > 0.97
    odd = quality.classify(odd_docs(spark), F.col("source"), F.col("lang"), model, ["doc_id"]).collect()
    assert len(odd) == 9 and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.classify(docs.where("false"), F.col("source"), F.col("lang"), model, ["doc_id"]).collect() == []
    none = quality.classify(docs, F.col("source"), F.col("lang"), quality.fit(docs, labels.where("false")), ["doc_id"])
    assert none.where("not accepted").count() == 0


def test_sparse_sites_shrink_toward_their_host_and_hosts_toward_all(spark):
    rows = [("big", "a", 3.0)] * 200 + [("big", "b", -3.0)] * 200 + [("big", "c", -3.0)] + [(f"h{k}", "a", 3.0 if k % 2 else -3.0) for k in range(40) for _ in range(30)] + [("tiny", "a", -3.0)]
    scored = spark.createDataFrame(rows, "host string, path string, evidence double")
    got = {(r["host"], r["path"]): r for r in quality.site_posteriors(scored, {"rate": 0.5}).collect()}
    low, whole = 1 / (1 + np.exp(3)), 0.5
    assert abs(got["big", "b"]["path_posterior"] - low) < 0.1 < got["big", "c"]["path_posterior"] - low
    assert low < got["tiny", "a"]["path_posterior"] < whole


def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("block", "bad.org", "")]


@pytest.mark.parametrize("rules", [RULES, RULES[:1], []])
def test_urls_equal_brute_force(spark, rules):
    r = random.Random(6)
    urls = [f"{r.choice(['http', 'HTTPS'])}://{'.'.join(r.choices(['www', 'm', 'Bad', 'example', 'x1'], k=r.randint(0, 3)))}.{r.choice(['com', 'net', 'org', 'COM'])}{r.choice(['', '/', '/en/', '/en', '/es/a', '/fr/x?y=/en/'])}{r.choice(['', '?q=1', '#f'])}" for _ in range(500)]
    urls += [None, "", "no scheme", "://", "http://", "http:///en/", "http://com", "http://com/", "http://bad.org", "http://notbad.org/", "http://É.com/" + "a" * 100_000, "a://b://c"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = url_filter.judge_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string"))
    got = {r["page_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(pages.where("false"), spark.createDataFrame(rules, "verdict string, host string, path string")).collect() == []


def test_a_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = spark.range(0, 20_100, 41).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    both = universe.unionByName(listed).distinct().select("key", *url_filter._hashes(F.col("key"))).toPandas()
    holds = cascade.holds(both["h1"].to_numpy().view(np.uint64), both["h2"].to_numpy().view(np.uint64))
    assert set(both["key"][holds]) == {f"k{i}" for i in range(0, 20_100, 41)}


def test_ranges_are_the_same_however_rows_are_partitioned(spark):
    ids = spark.range(5000).select((F.col("id") * 7 - 300).alias("id"))
    points = split_points(ids.repartition(9), "id", 16)
    assert points == split_points(ids.repartition(2), "id", 16) and 10 <= len(points) <= 15
    got = {r["id"]: r["b"] for r in ids.select("id", range_of(F.col("id"), points).alias("b")).collect()}
    assert got == {i: int(np.searchsorted(points, i, "right")) for i in got}


def test_viterbi_with_many_languages():
    rng = np.random.default_rng(4)
    scores = rng.normal(size=(300, 200)).astype(np.float32)
    scores[:150, 150] += 50
    scores[150:, 199] += 50
    label = language.best_labels(np.repeat([0, 1], 150), scores)
    assert set(label[:150].tolist()) == {150} and set(label[150:].tolist()) == {199}


def test_held_out_labels_change_no_score(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r["doc_id"]: r["score"] for r in quality.classify(docs, F.col("source"), F.col("lang"), quality.fit(docs, x), ["doc_id"]).collect()}
              for x in (labels, turned)]
    assert scores[0] == scores[1]


def plain_posteriors(rows, rate):
    """Each document's host and path posterior without it, in plain Python."""
    unit = float(1 << 24)
    p = [round(unit / (1 + np.exp(-(e + np.log(rate / (1 - rate)))))) / unit for _, _, e in rows]

    def weight(groups):
        some = [(n, s, m) for n, s, m in groups if n > 1]
        v = sum(n * (s / n - m) ** 2 - m * (1 - m) for n, s, m in some)
        if not some or v <= 0:
            return 1e6
        return min(max(sum((n - 1) * m * (1 - m) for n, _, m in some) / v - 1, 1.0), 1e6)

    def sums(key):
        out = {}
        for r, x in zip(rows, p):
            n, s = out.get(key(r), (0, 0.0))
            out[key(r)] = (n + 1, s + x)
        return out

    hosts, paths = sums(lambda r: r[0]), sums(lambda r: r[:2])
    overall = sum(p) / len(p)
    wh = weight([(n, s, overall) for n, s in hosts.values()])
    whole = {h: (s + wh * overall) / (n + wh) for h, (n, s) in hosts.items()}
    wp = weight([(n, s, whole[k[0]]) for k, (n, s) in paths.items()])
    out = []
    for (h, path, _), x in zip(rows, p):
        host = (hosts[h][1] - x + wh * overall) / (hosts[h][0] - 1 + wh)
        out.append((host, (paths[h, path][1] - x + wp * host) / (paths[h, path][0] - 1 + wp)))
    return out


def test_posteriors_against_plain_sums(spark, monkeypatch):
    r = random.Random(8)
    rows = [(r.choice(["a", "b", "c", None]), r.choice(["x", "y", None]), r.gauss(0.5, 2)) for _ in range(300)] + [("alone", "z", 2.0)]
    docs = spark.createDataFrame([(i, str(e), h, p) for i, (h, p, e) in enumerate(rows)], "doc_id long, text string, h string, p string")
    monkeypatch.setattr(quality, "evidence", lambda text, model: text.cast("double"))
    found = {r["doc_id"]: r for r in quality.classify(docs, F.col("h"), F.col("p"), {"rate": 0.3}, ["doc_id"]).collect()}
    for i, ((host, path), (_, _, e)) in enumerate(zip(plain_posteriors(rows, 0.3), rows)):
        assert found[i]["host_posterior"] == pytest.approx(host, abs=1e-9) and found[i]["path_posterior"] == pytest.approx(path, abs=1e-9)
        assert found[i]["score"] == pytest.approx(1 / (1 + np.exp(-(e + np.log(path / (1 - path))))), abs=1e-9)


def test_a_host_of_very_many_labels(spark):
    urls = ["http://" + "a." * 20_000 + "net/es/x", "http://" + "a." * 20_000 + "org/es/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.judge_urls(pages, spark.createDataFrame(RULES, "verdict string, host string, path string")).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in found] == [("net/es/", "block"), (None, "allow")]


def test_a_filter_on_the_verdict_judges_each_text_once(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    kept = quality.classify(docs, F.col("source"), F.col("lang"), model, ["doc_id"])
    plan = kept.where("accepted").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert {r["doc_id"] for r in kept.where("accepted").collect()} == {r["doc_id"] for r in kept.collect() if r["accepted"]}
