"""N-gram join, components and decontamination against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import decontamination as dc
from basketry.llm.components import components
from basketry.llm.ngram_join import across, ngram_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def sets_of(text, size=4):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, size=4, percent=85):
    sets = [sets_of(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def corpus(seed, groups, vocabulary=400):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = []
    for members in groups:
        base = [r.choice(words) for _ in range(r.randint(20, 90))]
        for _ in range(members):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                w[r.randrange(len(w))] = r.choice(words) + "x"
            texts.append(" ".join(w))
    common = "this line is in very many of the documents here"
    texts = [t if r.random() < 0.5 else f"{common}\n{t}" for t in texts]
    r.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("seed, groups", [(1, [1] * 20 + [2] * 10 + [7, 25]), (2, [60, 3, 3, 1])])
def test_components_equal_brute_force(spark, seed, groups):
    rows = corpus(seed, groups)
    got = sorted(tuple(r) for r in ngram_components(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_five_words_at_080(spark):
    rows = corpus(3, [12, 5, 5, 1, 1])
    got = sorted(tuple(r) for r in ngram_components(frame(spark, rows), 5, 80).collect())
    assert got == brute(rows, 5, 80)


def test_edges_of_the_join(spark):
    long = " ".join(f"v{i}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, long), (8, long + " end"),
            (9, "a b c d"), (9, "a b c d"), (10, "É a b c"), (11, "é a b c"), (12, "x" * 600_000)]
    got = sorted(tuple(r) for r in ngram_components(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_join_ignores_clashing_columns_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 5, "x", 7), (2, "A b c d e", 6, "y", 8)], "doc_id long, text string, node long, grams string, label long")
    assert sorted(tuple(r) for r in ngram_components(docs).collect()) == [(1, 2, 1), (2, 2, 1)]
    assert ngram_components(frame(spark, [])).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def words(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def leaks():
    r = random.Random(11)
    items = [(i, words(r, r.randint(15, 50)) + ". " + words(r, 6) + ".") for i in range(180)]
    docs, true = [], set()
    for i in range(300):
        text = words(r, r.randint(1, 300))
        if i % 10 == 0:
            item, body = items[r.randrange(len(items))]
            w = body.split()
            if i % 20 == 0:  # a paraphrase: some words changed, some inserted
                for _ in range(len(w) // 12):
                    w[r.randrange(len(w) // 2)] = words(r, 1)
                w.insert(3, words(r, 2))
            text = f"{text}\n{' '.join(w)} {words(r, 40)}"
            true.add((i, item))
        docs.append((i, text))
    return docs, items, true


def test_every_leak_and_paraphrase_is_found_and_nothing_else(spark, leaks):
    docs, items, true = leaks
    found = dc.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == true
    assert all(r["covered"] >= dc.COVERED and r["answered"] >= dc.ANSWERED for r in found)


def test_latent_candidates_reach_the_recall_of_brute_force(spark, leaks):
    """Of the pairs whose exact TF-IDF cosine is well over the threshold, the latent search
    finds nine in ten."""
    docs, items, _ = leaks
    block = dc.Block(items)
    numbered = frame(spark, docs).select("doc_id", "text").mapInArrow(dc._number(block), "doc_id long, words binary")
    weight = np.full(len(block.vocabulary) + 1, 1.0)
    basis = dc.latent_space(numbered, block, weight, 2000)

    def rows(parts):
        out = np.zeros((len(parts), len(weight)))
        for i, p in enumerate(parts):
            out[i] = np.bincount(p, minlength=len(weight))
        out[:, 0] = np.sqrt(out[:, 0])  # words outside the vocabulary all differ
        return out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), 1e-9)

    queries = rows([block.numbers(w).astype(int) for _, w, _ in block.items])
    sequences = [block.numbers(dc.words_of(t)).astype(int) for _, t in docs]
    passages = rows([s[a : a + 64] for s in sequences for a in range(0, max(1, len(s) - 32), 32)])
    passages[:, 0] = queries[:, 0] = 0
    exact, latent = passages @ queries.T, (passages @ basis) @ (queries @ basis).T
    wanted = exact >= dc.COSINE + 0.05
    assert wanted.sum() > 20 and (latent[wanted] >= dc.COSINE).mean() >= 0.9


@pytest.mark.parametrize("scale", [1, 1_000, 1_000_000])
def test_every_pair_that_brute_force_accepts_is_found_at_any_corpus_size(spark, scale):
    """Short items with a fifth of their words changed, in clean text, with the weights of a
    corpus of scale times as many documents."""
    r = random.Random(5)
    common = words(r, 60).split()
    some = lambda n: [r.choice(common) if r.random() < 0.5 else words(r, 1) for _ in range(n)]
    items = [(i, " ".join(some(r.randint(9, 50))) + ". " + " ".join(some(6)) + ".") for i in range(100)]
    docs = []
    for i in range(100):
        w = items[i][1].split()
        for k in r.sample(range(len(w)), len(w) // 5):
            w[k] = words(r, 1)
        docs.append((i, " ".join(some(r.randint(20, 90)) + w + some(r.randint(20, 90)))))
    block = dc.Block(items)
    numbered = frame(spark, docs).select("doc_id", "text").mapInArrow(dc._number(block), "doc_id long, words binary")
    sequences = {i: block.numbers(dc.words_of(t)).tolist() for i, t in docs}
    df = np.bincount(np.concatenate([np.unique(s) for s in sequences.values()]), minlength=len(block.vocabulary) + 1).astype(float)
    df[0] = len(docs)
    weight = dc.word_weights(df * scale)
    model = spark.sparkContext.broadcast(dc.retrieval(block, weight, dc.latent_space(numbered, block, weight, 4000)))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(sequences), "words": [np.array(s, block.kind).tobytes() for s in sequences.values()]})
    got = {(d, i) for b in dc._search(block, weight, model)(iter([batch])) for d, i in zip(*(b.column(k).to_pylist() for k in (0, 1)))}
    whole = [(i, block.numbers(w).tolist(), block.numbers(a).tolist()) for i, w, a in block.items]
    wanted = set()
    for d, s in sequences.items():
        for item, w, answer in whole:
            for a in range(0, max(1, len(s) - 32), 32):
                near = s[max(0, a - len(w)) : a + 64 + len(w)]
                if dc.subsequence(w, near) >= dc.COVERED * len(w) and dc.subsequence(answer, near) >= dc.ANSWERED * len(answer):
                    wanted.add((d, item))
    assert got == wanted and len(wanted) > 85


def test_decontamination_edges(spark):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item)], "item_id long, text string")
    docs = [(1, None), (2, ""), (3, item.upper()), (3, item.upper()), (4, "x " * 200_000 + item), (5, "one two other words")]
    found = sorted({(r["doc_id"], r["item_id"]) for r in dc.contaminated(frame(spark, docs), bench).collect()})
    assert found == [(3, 1), (3, 5), (4, 1), (4, 5)]
    assert dc.contaminated(frame(spark, []), bench).collect() == []
    assert dc.contaminated(frame(spark, docs), bench.where("false")).collect() == []


def test_a_changed_word_in_a_short_last_sentence_hides_no_item(spark):
    item = "one two three four five six seven eight nine ten eleven twelve. Er."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = [(1, item.replace("Er", "zz")), (2, item.replace("Er", "zz").replace("two", "zz").replace("four", "zz").replace("five", "zz")),
            (3, "one two three four five six seven eight nine ten zz zz. zz.")]
    assert {r["doc_id"] for r in dc.contaminated(frame(spark, docs), bench).collect()} == {1}
    long = "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12 a13 a14. b1 b2. Er."
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    docs = [(1, "a1 zz a3 a4 zz a6 a7 a8 zz a10 a11 a12 a13 a14 b1 b2 zz"), (2, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12 zz zz zz zz zz")]
    found = {r["doc_id"]: (r["covered"], r["answered"]) for r in dc.contaminated(frame(spark, docs), bench).collect()}
    assert found == {1: (13 / 17, 4 / 5)}


def test_long_items_are_judged_whole_over_all_their_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_PARTS", 2)
    w = [f"v{i}" for i in range(64 * 4 + 8)]
    less = [x for i, x in enumerate(w) if i % 5]
    bench = spark.createDataFrame([(1, " ".join(w)), (2, "p1 p2 p3 p4 p5 p6 p7")], "item_id long, text string")
    docs = [(1, "x y " * 50 + " ".join(w)), (2, " ".join(less)), (3, "x y " * 50 + " ".join(w[-8:])), (4, " ".join(w[:100])), (5, " ".join(w[:60] + w[64:230])), (6, "p1 p2 p3 p4 p5 p6 p7")]
    blocks = list(dc.item_blocks(bench))
    assert [len(b.items) for b in blocks] == [2, 2, 1, 1] and {len(p) for b in blocks[:3] for _, p, _ in b.items} == {52, 53}
    found = sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(frame(spark, docs), bench).collect())
    assert found == [(1, 1), (2, 1), (5, 1), (6, 2)]


def test_items_without_spaces_and_short_items(spark):
    chinese, thai = "请问中国的首都是哪一座城市？答案是北京。", "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"
    bench = spark.createDataFrame([(1, chinese), (2, thai), (3, "Blue whale"), (4, "北京"), (5, "?!")], "item_id long, text string")
    docs = [(1, "今天天气很好，" + chinese.replace("哪", "那") + "我们走吧。"), (2, "นี่คือ" + thai + "ครับ"), (3, "a BLUE whale."),
            (4, "the whale is blue, a blue old whale"), (5, "上海是一座很大的城市，天气很好。"), (6, None), (7, "x " * 3000 + "blue whale " * 40)]
    found = sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(frame(spark, docs), bench).collect())
    assert found == [(1, 1), (1, 4), (2, 2), (3, 3), (7, 3)]


def test_subsequence():
    assert dc.subsequence([1, 2, 3, 4], [9, 1, 0, 3, 4, 2]) == 3
    assert dc.subsequence([1, 1, 2], [1, 2, 1]) == 2 and dc.subsequence([1], []) == 0


def test_null_and_negative_ids(spark):
    text, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(1, 61))
    rows = [(None, text), (5, text), (-1, near), (None, "quite another text of some words"), (None, "a b c d e f"), (None, "a b c d e f"), (7, None), (None, "")]
    found = sorted((tuple(r) for r in ngram_components(frame(spark, rows)).collect()), key=str)
    plain = [(None, 57, -1), (5, 57, -1), (-1, 57, -1), (None, 3, None), (None, 3, None), (None, 3, None), (7, 0, 7), (None, 0, None)]
    assert found == sorted(plain, key=str)


def test_a_family_with_an_outlier_is_not_squared(spark):
    """One list of 20,000 nodes of one component and one node of another."""
    named = spark.range(20_001).select(F.lit(1).cast("long").alias("gram"), F.col("id").alias("node"), F.lit(100).cast("long").alias("n"),
                                       F.lit(0).cast("long").alias("at"), F.when(F.col("id") == 20_000, 20_000).otherwise(0).cast("long").alias("label"))
    pairs = across(named, 80)
    assert pairs.count() == 20_000
    halves = named.limit(40).withColumn("label", F.col("node") % 3)
    found = {(r.a, r.b) for r in across(halves, 80).collect()}
    nodes = [r.node for r in halves.collect()]
    assert found == {(a, b) for a in nodes for b in nodes if a > b and a % 3 != b % 3}


def test_the_latent_space_is_of_all_windows(spark):
    """Sums over any number of tasks are those of every window of every document, multiplied at once."""
    r = random.Random(8)
    common = words(r, 50).split()
    text = lambda n: " ".join(r.choice(common) if r.random() < 0.6 else words(r, 1) for _ in range(n))
    block = dc.Block([(i, text(30)) for i in range(6)])
    docs = [(i, text(r.randint(0, 400))) for i in range(120)]
    weight = np.linspace(0.5, 2.0, len(block.vocabulary) + 1)
    numbered = frame(spark, docs).select("doc_id", "text").repartition(7).mapInArrow(dc._number(block), "doc_id long, words binary")
    m = np.random.default_rng(1).standard_normal((len(weight), 5)).astype(np.float32)
    shared = spark.sparkContext.broadcast(m)
    found = np.zeros(m.shape)
    for p in numbered.mapInArrow(dc._products(block.kind, weight, shared), "part int, data binary").groupBy("part").applyInArrow(dc._added, "part int, data binary").collect():
        found[p["part"] : p["part"] + dc.PART] += np.frombuffer(p["data"]).reshape(-1, 5)
    wanted = np.zeros(m.shape)
    for _, t in docs:
        s = block.numbers(dc.words_of(t)).astype(int)
        for a in range(0, max(1, len(s) - 32), 32) if len(s) else ():
            n = np.bincount(s[a : a + 64], minlength=len(weight))
            row = np.where(n > 0, (1 + np.log(np.maximum(n, 1))) * weight, 0.0)
            row[0] = np.sqrt(n[0]) * weight[0]
            row /= np.sqrt((row**2).sum())
            row[0] = 0
            wanted += np.outer(row, row @ m)
    assert np.allclose(found, wanted, rtol=1e-4, atol=1e-4) and np.abs(wanted).max() > 1


def test_the_latent_space_reads_the_windows_once(spark, monkeypatch):
    """Sums of word pairs over any number of tasks and parts give the space of windows multiplied one by one."""
    r = random.Random(9)
    common = words(r, 200).split()
    text = lambda n: " ".join(r.choice(common) if r.random() < 0.6 else words(r, 1) for _ in range(n))
    block = dc.Block([(i, text(40)) for i in range(8)])
    docs = [(i, text(r.randint(0, 300))) for i in range(100)]
    weight = np.linspace(0.5, 2.0, len(block.vocabulary) + 1)
    read = spark.sparkContext.accumulator(0)
    number = dc._number(block)

    def counted(batches):
        for batch in number(batches):
            read.add(batch.num_rows)
            yield batch

    numbered = frame(spark, docs).select("doc_id", "text").repartition(5).mapInArrow(counted, "doc_id long, words binary")
    monkeypatch.setattr(dc, "RANK", 24)
    monkeypatch.setattr(dc, "CELLS_PART", 1000, raising=False)
    once = dc.latent_space(numbered, block, weight, 500)
    assert read.value == len(docs)
    monkeypatch.setattr(dc, "CELLS", 0, raising=False)
    each = dc.latent_space(numbered, block, weight, 500)
    assert read.value == 4 * len(docs)
    assert once.shape == each.shape and np.allclose(once @ once.T, each @ each.T, atol=1e-3)


def test_packed_columns_take_little_more_than_they_hold():
    """Low bytes of hashes don't lengthen the codes of the planes beside them, and names are kept as steps."""
    from basketry.llm import ngram_join as nj

    r = np.random.default_rng(4)
    hashes, index = r.integers(0, 1 << 32, 20_000).astype(np.uint64), r.integers(0, 1200, 20_000)
    data = nj._pack(hashes, index, np.zeros(0, np.uint64))
    back = nj._unpack(data)
    assert (back[0] == hashes).all() and (back[1] == index).all() and len(back[2]) == 0
    assert len(data) < 20_000 * (32 + 10.6) / 8
    gram, at = np.sort(r.integers(0, 1 << 56, 5_000).astype(np.uint64)), r.integers(-1, 700, 5_000)
    node = r.integers(0, 1 << 63, 700).astype(np.uint64) * np.uint64(2)
    ((_, bucket, data),) = nj._deal(1, gram, at, node, 1, np.zeros(5_000, np.int64))
    g, named, none = nj._entries(data)
    assert bucket == 0 and (g == gram).all() and (none == (at < 0)).all() and (named[at >= 0] == node[at[at >= 0]]).all()


def test_a_search_needs_no_more_memory_for_passages_that_share_many_words():
    import tracemalloc
    from types import SimpleNamespace

    r = random.Random(5)
    items = [(i, words(r, 40)) for i in range(60)]
    block = dc.Block(items)
    size = len(block.vocabulary)
    weight = dc.word_weights(np.array([4000] + [5] * size))
    space = np.random.default_rng(1).standard_normal((size + 1, dc.RANK))
    item, word, value = dc._item_rows(block, weight)
    space[:, : len(items)] = 0
    space[word, item] = value
    basis = np.linalg.qr(space)[0].astype(np.float32)
    own = block.numbers(dc.words_of(items[7][1]))
    sequences = [np.random.default_rng(i).integers(1, size + 1, 300).astype(block.kind) for i in range(600)]
    sequences[300] = np.concatenate([sequences[300], own])
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "words": [s.tobytes() for s in sequences]})
    search = dc._search(block, weight, SimpleNamespace(value=dc.retrieval(block, weight, basis)))
    tracemalloc.start()
    found = [x for b in search(iter([batch])) for x in zip(*(b.column(k).to_pylist() for k in (0, 1)))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (300, 7) in found
    assert peak < 50e6, peak
