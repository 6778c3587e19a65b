"""Whitening of integer vectors by singular values of the centred rows.

1. *Sums.* One pass counts the vectors of each length and sums every dimension, in whole numbers.
2. *Blockwise QR.* Tasks reduce blocks of centred rows, each below the triangle of those before,
   to one d x d triangle a task.  The triangles are merged ``FAN`` at a time, in tasks too, until
   at most ``FAN`` are left; the covariance itself is never formed, so no accuracy is squared away.
3. *Bidiagonal values.* The driver brings the last triangle to bidiagonal form, finds singular
   values by differential quotient-difference steps and directions by twisted factorisations
   (``bidiagonal``).  What it holds is bounded by ``FAN`` * d * d numbers, whatever the rows.
4. *Check.* A pass over all rows adds up the products of the whitened components, whose largest
   difference from the identity is reported.

No step groups by a value of the rows, so copies and hot labels need no care.

Defined cases: rows whose vector is null, or holds null or non-finite entries, take no part; so
do rows of another length than the most frequent one (of equally frequent ones, the longer).
Components of no variance (below d * eps of the largest) cannot be whitened and are left out, so
n copies of one vector, a single row, an empty table and empty vectors give no component.  Null
and repeated ids are carried as they are, columns other than the two named are not looked at.  A deviation
beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.bidiagonal import EPS, directions, dqds, householder
from basketry.llm.texts import frugal, prepare
from basketry.llm.vectors import matrix, usable
from basketry.session import drop_path, write_table

#: Triangles merged by one task, and left to the driver.
FAN = 32
#: Rows of a block of the blockwise QR.
BLOCK = 2_048
_TRIANGLE = "part int, r binary"


@dataclass
class Whitening:
    """n and the sums of the fitted rows; directions (d x k), their eigenvalues, and the trace."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    trace: float


def quantized(vector, scale: int, offset: int):
    """floor(scale * entry) + offset of every entry, as a double's product."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(offset))


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from the exact n*x - S."""
    return (x * np.int64(n) - sums).astype(np.float64) / n


def _triangles(n: int, sums: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, len(sums)))
        for batch in batches:
            x = matrix(batch.column(0), np.int64)
            for at in range(0, len(x), BLOCK):
                r = np.linalg.qr(np.vstack([r, _centred(x[at : at + BLOCK], n, sums)]), mode="r")
        if len(r):
            yield _triangle(TaskContext.get().partitionId(), r)

    return run


def _triangle(part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])


def _stack(rows: list[bytes], d: int) -> np.ndarray:
    return np.linalg.qr(np.vstack([np.frombuffer(b).reshape(-1, d) for b in rows]), mode="r")


def _merge(d: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        rows = table.column("r").take(pa.array(order)).to_pylist()
        return pa.Table.from_batches([_triangle(table.column("part")[0].as_py() // FAN, _stack(rows, d))])

    return run


def _grams(model: Whitening):
    """Per task the sums of products and values of the whitened components, one row an entry."""
    k = len(model.values)
    scaled = model.directions / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _centred(matrix(batch.column(0), np.int64), model.n, model.sums) @ scaled
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at // k, pa.int32()), pa.array(at % k, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    return run


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    apart = x * np.int64(n) - sums
    if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0**63:
        return pa.array((apart * apart).sum(axis=1), pa.int64())
    exact = [sum(v * v for v in row) for row in apart.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _rows(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.where(usable(F.col(column)) & (F.size(column) == length))


def fit(df: DataFrame, column: str, components: int = 8) -> Whitening:
    """Directions of the largest variances of an array<bigint> column, divisor n."""
    prepare(df.sparkSession)
    vectors = df.where(usable(F.col(column))).select(F.col(column).cast("array<bigint>").alias("x"))
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not top or not top[0]["d"]:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0)
    d, n = top[0]["d"], top[0]["n"]
    vectors = vectors.where(F.size("x") == d)
    cells = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).collect()
    sums = np.zeros(d, np.int64)
    for c in cells:
        sums[c["i"]] = c["s"]
    found, path = write_table(vectors.mapInArrow(frugal(_triangles(n, sums)), _TRIANGLE), "triangles")
    while found.count() > FAN:
        old = path
        found, path = write_table(found.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(_merge(d), _TRIANGLE), "triangles")
        drop_path(df.sparkSession, old)
    r = _stack([b["r"] for b in found.orderBy("part").collect()], d)
    drop_path(df.sparkSession, path)
    r = np.vstack([r, np.zeros((d - len(r), d))])
    diagonal, above, right = householder(r)
    squares = dqds(diagonal, above)
    kept = int((squares > (d * EPS) ** 2 * squares[0]).sum()) if squares[0] > 0 else 0
    kept = min(kept, components)
    return Whitening(n, sums, right @ directions(diagonal, above, squares[:kept]), squares[:kept] / n, float(squares.sum() / n))


def identity_error(df: DataFrame, column: str, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    rows = _rows(df, column, len(model.sums)).select(F.col(column).cast("array<bigint>").alias("x"))
    cells = rows.mapInArrow(frugal(_grams(model)), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1, k))
    for c in cells:
        total[c["i"], c["j"]] = c["v"] / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def transform(df: DataFrame, column: str, id_column: str, model: Whitening) -> DataFrame:
    """(id_column, deviation long, whitened array<double>) of every fitted row."""
    k, scaled = len(model.values), model.directions / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), np.int64)
            if not len(x):
                continue
            w = _centred(x, model.n, model.sums) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), _deviations(x, model.n, model.sums), lists], [id_column, "deviation", "whitened"])

    kind = df.schema[id_column].dataType.simpleString()
    rows = _rows(df, column, len(model.sums)) if k else df.where(F.lit(False))
    rows = rows.select(F.col(id_column), F.col(column).cast("array<bigint>").alias("_x"))
    return rows.mapInArrow(frugal(run), f"`{id_column}` {kind}, deviation bigint, whitened array<double>")
