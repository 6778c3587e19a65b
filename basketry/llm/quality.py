"""Document quality by hierarchical empirical Bayes.

A logistic classifier on the shape of the text gives each document its evidence: the log odds
by which the text changes the prior.  Grouped sums of its probabilities over all documents give
posteriors for every host and every path of a host.  A path with few documents is shrunk toward
its host's posterior and a host toward the global rate, by beta priors whose weights are
estimated from how much the rates differ between hosts, and between paths of a host (method of
moments).  A document's score combines its evidence with the posterior of its path's other documents,
so that its own evidence counts once.

The classifier is fitted on a bounded sample of about ``ROWS`` labelled documents of each label
of at most ``ROW_BYTES`` bytes, none held out; rates and posteriors cover all documents.

Defined cases: a null or empty text has the shape of no word; null hosts and paths are groups
of their own; without labelled documents of both kinds the evidence is 0 and every score one
half, and all are kept; repeated rows count as often as they occur; other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import column_bytes, held_out, prepare, slices, span_hashes, word_spans
from basketry.llm.toxicity import sample_rows
from basketry.session import write_table

ROWS = 2_500
ROW_BYTES = 65_536
#: Weights of the beta priors lie within these limits, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6
#: Probabilities are summed in whole numbers of 1 / UNIT.
UNIT = 1 << 24

_UPPER, _LOWER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_MARK[33:127] = ~(_UPPER | _LOWER | _DIGIT)[33:127]


def shape(column: pa.Array) -> np.ndarray:
    """Per row: shares of upper-case letters, digits and marks; shares of words that repeat the
    one before, occurred before in the slice, end in two marks or are marks only; log numbers of
    words and of letters a word."""
    rows = len(column)
    data, offsets = column_bytes(column)
    total = np.zeros((11, rows))
    for start, stop in slices(data, offsets):
        row, begin, end = word_spans(data, offsets, start, stop)
        if not len(row):
            continue
        piece = data[start:stop]

        def add(k: int, weights: np.ndarray | None = None) -> None:
            total[k] += np.bincount(row, weights, minlength=rows)

        def inside(table: np.ndarray) -> np.ndarray:
            n = np.concatenate([[0], np.cumsum(table[piece])])
            return n[end - start] - n[begin - start]

        marks = inside(_MARK)
        word = span_hashes(data, start, stop, begin, end)
        add(0)
        add(1, end - begin)
        add(2, inside(_UPPER))
        add(3, inside(_DIGIT))
        add(4, marks)
        again = np.concatenate([[False], (word[1:] == word[:-1]) & (row[1:] == row[:-1])])
        add(5, again)
        order = np.lexsort((word, row))
        known = np.concatenate([[False], (word[order][1:] == word[order][:-1]) & (row[order][1:] == row[order][:-1])])
        total[6] += np.bincount(row[order], known, minlength=rows)
        last, before = piece[end - 1 - start], piece[np.maximum(end - 2 - start, 0)]
        add(7, (end - begin > 1) & _MARK[last] & _MARK[before])
        add(8, marks == end - begin)
    words, size = np.maximum(total[0], 1), np.maximum(total[1], 1)
    return np.stack([total[2] / size, total[3] / size, total[4] / size, total[5] / words, total[6] / words, total[7] / words,
                     total[8] / words, np.log1p(total[0]), np.log1p(size / words)], axis=1)


def _expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A model for ``evidence`` from documents and their labels (doc_id, quality)."""
    rows = sample_rows(docs, labels, "quality", {1: ROWS, 0: ROWS}, ROW_BYTES)
    y = np.array([q for _, q in rows], float)
    if not 0 < y.sum() < len(y):
        return {}
    x = shape(pa.array([t for t, _ in rows], pa.string()))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = _expanded(x, mean, scale)
    each = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)  # both labels weigh the same: the odds are evidence
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (each * p * (1 - p))[:, None]).T @ z + np.eye(len(w)), z.T @ (each * (y - p)) - w)
    rate = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg("quality")).first()[0]
    return {"mean": mean, "scale": scale, "weights": w, "rate": float(min(max(rate, 1e-3), 1 - 1e-3))}


def evidence(text: Column, model: dict) -> Column:
    """The log odds by which the text speaks for quality 1."""

    def run(column: pa.Array) -> pa.Array:
        if not model:
            return pa.array(np.zeros(len(column)))
        return pa.array(np.clip(_expanded(shape(column), model["mean"], model["scale"]) @ model["weights"], -30, 30))

    return F.arrow_udf(run, "double")(text)


def _weight(groups: DataFrame, prior: str) -> float:
    """The prior's weight (in documents) from groups (n, s, prior): method of moments."""
    mean = F.col(prior)
    spread = F.col("n") * (F.col("s") / F.col("n") - mean) ** 2 - mean * (1 - mean)  # over what chance alone gives
    r = groups.where("n > 1").agg(F.sum(spread).alias("v"), F.sum(F.col("n") - 1).alias("n"), F.sum((F.col("n") - 1) * mean * (1 - mean)).alias("u")).first()
    if not r["n"] or not r["v"] or r["v"] <= 0:
        return MOST_WEIGHT
    return float(min(max(r["u"] / r["v"] - 1, LEAST_WEIGHT), MOST_WEIGHT))


def _probability(model: dict) -> Column:
    """The classifier's probability of quality 1, in units of 1 / UNIT: sums of whole numbers do not
    depend on the order of rows."""
    rate = model["rate"] if model else 0.5
    p = 1 / (1 + F.exp(-(F.col("evidence") + float(np.log(rate / (1 - rate))))))
    return F.round(p * UNIT).cast("long")


def _posterior(held: str, prior: Column | str, weight: float, less: int | Column = 0, own: int | Column = 0) -> Column:
    """Of a group (n_held, s_held), less some documents and their sum: shrunk toward the prior."""
    prior = F.col(prior) if isinstance(prior, str) else prior
    n, s = F.col(f"n_{held}") - less, (F.col(f"s_{held}") - own) / UNIT
    return (s + F.lit(weight) * prior) / (n + F.lit(weight))


def site_sums(scored: DataFrame, model: dict) -> tuple[DataFrame, dict]:
    """(host, path, n_host, s_host, n_path, s_path) from documents (host, path, evidence): numbers and
    summed probabilities; and the global rate and the weights of both priors."""
    paths, _ = write_table(scored.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum(_probability(model)).alias("s_path")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    whole = hosts.agg(F.sum("n_host").alias("n"), F.sum("s_host").alias("s")).first()
    overall = whole["s"] / UNIT / whole["n"] if whole["n"] else (model["rate"] if model else 0.5)
    rows = lambda held, prior: (F.col(f"n_{held}").alias("n"), (F.col(f"s_{held}") / UNIT).alias("s"), prior.alias("prior"))
    by_host = _weight(hosts.select(*rows("host", F.lit(overall))), "prior")
    both = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    by_path = _weight(both.select(*rows("path", _posterior("host", F.lit(overall), by_host))), "prior")
    return both, {"rate": overall, "host": by_host, "path": by_path}


def site_posteriors(scored: DataFrame, model: dict) -> DataFrame:
    """(host, path, host_posterior, path_posterior) from documents (host, path, evidence)."""
    sums, prior = site_sums(scored, model)
    sums = sums.withColumn("host_posterior", _posterior("host", F.lit(prior["rate"]), prior["host"]))
    return sums.select("host", "path", "host_posterior", _posterior("path", "host_posterior", prior["path"]).alias("path_posterior"))


def classify(docs: DataFrame, host: Column, path: Column, model: dict, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` (with text), and host, path, evidence, host_posterior,
    path_posterior, score and accepted (score of one half or more)."""
    prepare(docs.sparkSession)
    named = [F.col(c).alias(f"kept_{c}") for c in keep]
    # never null, and Spark has to know: else a filter on the score has each task judge its texts twice, in two Python workers
    found = F.coalesce(evidence(F.col("text"), model), F.lit(0.0))
    rows = docs.select(*named, host.alias("host"), path.alias("path"), found.alias("evidence"))
    sums, prior = site_sums(rows.select("host", "path", "evidence"), model)
    sites, _ = write_table(sums, "quality-sites")
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n_host", "s_host", "n_path", "s_path")
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left").drop("h", "p")
    own = _probability(model)  # a document is no evidence for its own prior
    joined = joined.withColumn("host_posterior", _posterior("host", F.lit(prior["rate"]), prior["host"], 1, own))
    joined = joined.withColumn("path_posterior", _posterior("path", "host_posterior", prior["path"], 1, own)).drop("n_host", "s_host", "n_path", "s_path")
    prior = F.least(F.greatest(F.col("path_posterior"), F.lit(1 / UNIT)), F.lit(1 - 1 / UNIT))
    odds = prior / (1 - prior)
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(odds)))) if model else F.lit(0.5)
    joined = joined.withColumn("score", score)
    renamed = joined.withColumn("accepted", F.col("score") >= 0.5)
    own = ["host", "path", "evidence", "host_posterior", "path_posterior", "score", "accepted"]
    return renamed.select(*[F.col(f"kept_{c}").alias(c) for c in keep], *own)
