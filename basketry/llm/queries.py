"""The registered queries opN_: each applies one operator, with its production parameters, to its
whole table; and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bpe, decontamination, fingerprint, hard_negatives, language, near_vectors, ngram_join, quality, token_file, toxicity, url_filter, warc, whitening
from basketry.llm.texts import held_out
from basketry.llm.vectors import usable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def tokenizer_path() -> str:
    """The tokenizer file of op4 and op6; ``BYTE_BPE_PATH`` names another one."""
    if "BYTE_BPE_PATH" in os.environ:
        return os.environ["BYTE_BPE_PATH"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    both = bpe.encode_and_decode(table(spark, sf_dir, "documents"), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    found = quality.classify(docs, F.col("source"), F.col("lang"), model, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "host", "path", "evidence",
                        "host_posterior", "path_posterior", "score", F.col("accepted").cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), size=4, percent=85)


#: The registered rules: verdict, host, beginning of the path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), F.when(usable(vector), whitening.quantized(vector, 256, 0)).alias("x"))
    return hard_negatives.hard_negatives(rows, "vec_id", "label", "x", F.col("vec_id") % 50 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(usable(vector), whitening.quantized(vector, 1024, 100_000)).alias("x"))
    model = whitening.fit(rows, "x")
    error = whitening.identity_error(rows, "x", model)
    share = [float(v / model.trace) for v in model.values]
    found = whitening.transform(rows, "x", "vec_id", model)
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(share or [0.0]), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.98)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_warc": op5_warc,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_decontamination": op8_decontamination,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_url_filters": op10_url_filters,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_near_duplicate_vectors": op13_near_duplicate_vectors,
}

#: The longest rule wins: the rules are tried from the longest to the shortest.
_OP10_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw, r FROM rest
), split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path
  FROM parts
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/'
  END AS rule FROM split
)
SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

_OP5_SQL = """
WITH p AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_page < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_page < p.page_id THEN f.first_page END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""

#: All pairs of a label, and every pair of rows that links reach.
_OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.size > 0 AND b.size > 0 AND list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.98
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS m FROM reach GROUP BY a), d AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(c.m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.m, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN d ON d.a = vec_id
"""

#: All scores of the anchors.
_OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor, other, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) <= 3
"""

ORACLES: dict[str, str] = {"op5_warc": _OP5_SQL, "op10_url_filters": _OP10_SQL, "op11_hard_negatives": _OP11_SQL,
                           "op13_near_duplicate_vectors": _OP13_SQL}
