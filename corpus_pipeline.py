"""Corpus preparation: five stages from the documents table to token ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs.  All but the
last return the columns of docs.  What is kept is decided for every row by a hash of its doc_id
and text (``_row``), so rows that share a doc_id but not the text, and rows without a doc_id, are
documents of their own; rows with both in common are copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bpe, decontamination, language, ngram_join, quality
from basketry.llm.queries import table, tokenizer_path
from basketry.llm.texts import prepare
from basketry.session import write_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, of which at least half the letters are in one learned language."""
    prepare(spark)
    found = language.language_of(F.col("text"), language.fit(docs))
    judged = docs.select(F.struct("*").alias("row"), found.alias("found"))
    return judged.where((F.col("found.lang") != "und") & (F.col("found.score") >= 0.5)).select("row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality 1 by their text and their source's and language's posteriors."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), "text", "source", "lang")
    return quality.classify(rows, F.col("source"), F.col("lang"), model, ["row"]).where("accepted").select("row.*")


def _row() -> Column:
    return F.xxhash64("doc_id", "text")  # never null


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group that five-word shingles link at a
    similarity of 0.8 or more; one without a doc_id only if none has one."""
    found, _ = write_table(ngram_join.ngram_components(docs.select(_row().alias("doc_id"), "text"), size=5, percent=80), "components")
    groups = found.groupBy(F.col("doc_id").alias("_row")).agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    grown = groups.where("component_id <> _row or rows > 1").select("component_id").distinct()
    groups, _ = write_table(groups.join(grown, "component_id", "left_semi").select("_row", "component_id"), "groups")
    ids = docs.select(_row().alias("_row"), "doc_id").join(groups, "_row")
    least = ids.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "_row")).alias("m"))
    least, _ = write_table(least.select("m._row"), "least")
    rows = docs.withColumn("_row", _row())
    once = rows.join(groups.select("_row"), "_row", "left_anti").select(*docs.columns)
    again = rows.join(least, "_row", "left_semi")
    return once.unionByName(again.groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs.select(_row().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    rows = docs.withColumn("_row", _row())
    return rows.join(found.select(F.col("doc_id").alias("_row")).distinct(), "_row", "left_anti").select(*docs.columns)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the SHA-256 of the ids and of
    the text they decode to."""
    path = tokenizer_path()
    both = bpe.encode_and_decode(docs, path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", join_ngrams),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode_bpe),
]

#: SQL has neither the classifiers nor the tokenizer; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = write_table(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
