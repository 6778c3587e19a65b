"""The pipeline stage by stage against plain versions, and the registered queries."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from basketry.llm.queries import ORACLES, QUERIES, tokenizer_path
from basketry.session import write_table

from test_llm_pairs import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(write_table(stage(spark, out[-1], SF), "test")[0])
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_columns_and_rows(steps):
    for before, after in zip(steps, steps[1:-1]):
        assert after.dtypes == before.dtypes
        old, new = by_id(before), by_id(after)
        assert all(old[i] == r for i, r in new.items())


def test_language_and_quality_keep_clean_documents(spark, steps):
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    assert set(by_id(steps[1])) == {i for i, r in by_id(steps[0]).items() if any(c.isalpha() for c in r["text"] or "")}
    assert good <= set(by_id(steps[2])) and len(bad & set(by_id(steps[2]))) <= 0.2 * len(bad)


def test_one_document_of_each_group_stays(steps):
    rows = sorted((i, r["text"]) for i, r in by_id(steps[2]).items())
    assert sorted(by_id(steps[3])) == [doc for doc, _, least in brute(rows, 5, 80) if doc == least]


def test_documents_with_benchmark_items_go(spark, steps):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, r in by_id(steps[3]).items() if any(t in r["text"] for t in items)}
    assert set(by_id(steps[4])) == set(by_id(steps[3])) - leaks


def test_the_last_stage_equals_the_library(steps):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts, got = by_id(steps[4]), by_id(steps[5])
    assert set(texts) == set(got)
    for i, r in got.items():
        ids = np.array(library.encode(texts[i]["text"], add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(r["ids"]) == ids and r["n_tokens"] == len(ids) // 4 and r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[i]["text"].encode()).hexdigest()


def test_repeated_rows_and_odd_texts_go_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "?!", "en", "s", 2)], docs.schema)
    docs = docs.unionByName(docs).unionByName(odd).withColumn("score", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = write_table(stage(spark, docs, SF), "test")
        assert docs.columns[-1] == "score", name
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 0 and not {9000, 9001, 9002} & set(ids)
    empty, _ = write_table(docs.where("false"), "test")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty.drop("score"), SF).count() == 0, name


def test_rows_without_an_id_and_namesakes_are_judged_by_themselves(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first()["text"]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    copy = "these are the words of a text that is here more than once and has no id"
    texts = [(None, f"before it {item}"), (None, copy), (None, copy), (7, "seven words that are of the first row"), (7, "a clean namesake with other words than that"),
             (8, f"leak {item}"), (8, "the clean namesake of a leak stays as it is"), (None, "group with an id a b c d e f g h i j k l m n o p q r s t u v w x y z"), (9, "group with an id a b c d e f g h i j k l m n o p q r s t u v w x y z")]
    docs, _ = write_table(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], schema), "test")
    joined, _ = write_table(corpus_pipeline.join_ngrams(spark, docs, SF), "test")
    assert joined.dtypes == docs.dtypes
    kept = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    once = [t for k, t in enumerate(texts) if k not in (2, 7)]
    assert kept(joined.where(f"not contains(text, '{item[:12]}')")) == sorted((t for t in once if item not in t[1]), key=str)
    clean = corpus_pipeline.decontaminate(spark, docs, SF)
    assert kept(clean) == sorted((t for t in texts if item not in t[1]), key=str)


def test_entry_registers_the_operators(spark):
    names = entry.queries()
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES)
