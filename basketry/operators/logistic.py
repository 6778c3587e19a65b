"""Logistic regression by Newton steps on summed statistics (M4, M6).

The objective is the weighted log loss plus half the squared coefficients (the intercept is
free).  A step is one pass: tasks add up gradient, Hessian and loss of their rows, Spark sums the
entries by their position, and the driver solves one system of (features + 1) equations.  Nothing
else is kept between steps, so a lost executor costs its share of one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import drop_path, ship_package, write_table


@dataclass
class Logistic:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    steps: int = 0

    def probability(self) -> Column:
        """The positive class's probability, a plain expression of the feature columns."""
        score = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            score = score + F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * F.lit(float(c))
        return 1.0 / (1.0 + F.exp(-score))


def _statistics(beta: np.ndarray):
    """Rows (i, j, v): Hessian entries for j < k, the gradient for j = k and the loss at (k, k)."""
    k = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(k - 1)] + [np.ones(batch.num_rows)], axis=1)
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in (k - 1, k))
            z = x @ beta
            p = 1.0 / (1.0 + np.exp(-z))
            total[:k, :k] += x.T @ (x * (w * p * (1.0 - p))[:, None])
            total[:k, k] += x.T @ (w * (p - y))
            total[k, k] += float((w * (np.logaddexp(0.0, z) - y * z)).sum())
        i, j = np.meshgrid(np.arange(k + 1), np.arange(k + 1), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    return run


def fit(train: DataFrame, features: Sequence[str], label: str, weights: Mapping[int, float], penalty: float = 1.0,
        most: int = 1000, tolerance: float = 1e-12) -> Logistic:
    """The optimum for 0/1 labels; ``weights`` has each class's weight.

    Ends when a step would lower the objective by less than ``tolerance`` of what it was without
    coefficients (that last step is taken), or after ``most`` steps.  A step that raises the objective is halved.  Null features count as 0, rows with a
    null label are left out; without rows all coefficients are 0.
    """
    spark, features = train.sparkSession, list(features)
    ship_package(spark)
    weight = F.lit(1.0)
    for value, w in weights.items():
        weight = F.when(F.col(label) == value, F.lit(float(w))).otherwise(weight)
    rows = train.where(F.col(label).isNotNull()).select(
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"f{k}") for k, f in enumerate(features)],
        F.col(label).cast("double").alias("y"), weight.alias("w"))
    rows, path = write_table(rows, "logistic")
    k = len(features) + 1
    ridge = np.append(np.full(k - 1, float(penalty)), 0.0)

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = rows.mapInArrow(_statistics(beta), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros((k + 1, k + 1))
        total[found.column("i").to_numpy(), found.column("j").to_numpy()] = found.column("v").to_numpy()
        return float(total[k, k] + (ridge * beta) @ beta / 2), total[:k, k] + ridge * beta, total[:k, :k] + np.diag(ridge)

    beta, steps = np.zeros(k), 0
    value, gradient, hessian = at(beta)
    enough = tolerance * value
    while steps < most:
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        if gradient @ step / 2 <= enough:
            beta = beta - step
            break
        share = 1.0
        new = at(beta - step)
        while new[0] > value + enough and share > 1e-6:
            share /= 2
            new = at(beta - share * step)
        beta, steps = beta - share * step, steps + 1
        value, gradient, hessian = new
    drop_path(spark, path)
    return Logistic(features, beta[:-1], float(beta[-1]), steps)
