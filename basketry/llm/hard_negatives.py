"""Hard negatives: rows of another label whose score with an anchor is near a positive's.

Rows are (id, label, whole-number vector); a score is the inner product with the anchor, higher
first, ties by smaller id.  An anchor's positives are its first ``POSITIVES`` other rows of its label;
for each, the first ``NEGATIVES`` rows of other labels with low * positive <= 100 * score <= high *
positive are returned.

1. *Points.* Rows of equal label and vector are one point with its least ids; only as many as a
   result can hold leave a task (a limited window), so copies are never gathered.
2. *Cells.* Pivots, a farthest-first net of a hash sample of ``SAMPLE`` points, deal the points to
   cells by angle; a cell of more than ``SHARD`` points is split by the points' names.  A cover tree is
   built per shard (``cover_tree``) and written to the shared folder.
3. *Positives.* An anchor first visits one shard of its nearest cell, and then, with the score found
   there as its floor, every shard of the cells whose covering angle lets them hold a better one.
4. *Negatives.* The windows of all positives go together to the cells that they can reach.

Anchors are dealt to blocks of ``BLOCK``; a task searches one shard's tree with one block.  Nothing is
approximated: bounds only skip what cannot be in a result.

Defined cases: rows with a null id, label or vector, or with a null component, take no part; a
shorter vector counts as filled up with zeros; equal rows are rows each, but one anchor; an anchor
without another row of its label, or without a row in a window, gives no row there; a positive
score below zero has no negative, one of zero only those of zero.  Scores beyond 64 bits are an
error.  Columns other than the three named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import cover_tree as ct
from basketry.llm.texts import frugal, prepare
from basketry.llm.vectors import name
from basketry.session import drop_path, write_table

POSITIVES, NEGATIVES = 5, 3
#: About so many points are sampled for pivots, of which there are at most ``CELLS``.
SAMPLE, CELLS = 2048, 256
#: Points of a tree, and anchors of a block.
SHARD, BLOCK = 4096, 4096
#: No score is so large.
ANY = 1 << 62

_ANCHOR = "id long, node string, label long, x array<long>, low array<long>, high array<long>"
_NAMES = ["id", "node", "at", "score", "other"]
_FOUND = "id long, node string, at int, score long, other long"


def _padded(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(column), d), np.int64)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _first(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each key; no task sends more than ``most`` a key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= most)


class Forest:
    """The points' cells, shards and trees."""

    def __init__(self, points: DataFrame):
        spark = points.sparkSession
        size = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
        held = points.agg(F.count("*").alias("n"), F.max(size).alias("longest"), F.max(F.size("x")).alias("d")).first()
        self.n, self.d, self.longest = held["n"], held["d"] or 0, math.sqrt(held["longest"] or 0)
        if self.longest**2 >= ANY:
            raise ValueError("scores need more than 64 bits")
        self.pivots, self.reach, self.shards = np.zeros((0, self.d + 1)), np.zeros(0), []
        if not self.n:
            return
        share = min(1.0, SAMPLE / self.n)
        sample = points.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("node", "x").collect()
        sample = sorted((r["node"], r["x"]) for r in sample) or [("", [])]
        lifted = ct.lift(_padded(pa.array([x for _, x in sample], pa.list_(pa.int64())), self.d), self.longest)
        self.pivots = lifted[ct.net(lifted, min(CELLS, -(-self.n // SHARD)))[0]]
        dealt = points.select("node", "label", "x", "ids").mapInArrow(frugal(self._deal()), "node string, label long, x array<long>, ids array<long>, cell int, angle double")
        cells = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).collect()}
        parts = [-(-cells[c]["n"] // SHARD) if c in cells else 0 for c in range(len(self.pivots))]
        starts = np.concatenate([[0], np.cumsum(parts)]).tolist()
        self.shards = [list(range(a, b)) for a, b in zip(starts[:-1], starts[1:])]
        self.reach = np.array([cells[c]["angle"] + ct.SLACK if c in cells else 0.0 for c in range(len(self.pivots))])
        part = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.get(F.lit(parts), F.col("cell"))))
        shard = (F.get(F.lit(starts), F.col("cell")) + part).cast("int")
        built = dealt.withColumn("shard", shard).groupBy("shard").applyInArrow(self._build(), "shard int, tree binary")
        self.trees, self.path = write_table(built, "trees")
        self.spark = spark

    def _deal(self):
        pivots, d, longest = self.pivots, self.d, self.longest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cosine = ct.lift(_padded(batch.column(2), d), longest) @ pivots.T
                cell = cosine.argmax(axis=1)
                angle = ct.angles(cosine[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angle)],
                                                 ["node", "label", "x", "ids", "cell", "angle"])

        return run

    def _build(self):
        d, longest = self.d, self.longest

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("node")
            ids = np.full((table.num_rows, POSITIVES + 1), ct.NO_ID, np.int64)
            for k, row in enumerate(table.column("ids").to_pylist()):
                ids[k, : len(row)] = row
            tree = ct.build(_padded(table.column("x"), d), table.column("label").to_numpy(), ids, np.array(table.column("node").to_pylist(), "U32"), longest)
            return pa.table({"shard": table.column("shard").slice(0, 1), "tree": pa.array([tree], pa.binary())})

        return run

    def _routed(self, home: bool):
        """Each anchor's shards: one of its nearest cell, or all that its windows can reach."""
        pivots, reach, d, longest, shards = self.pivots, self.reach, self.d, self.longest, self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _padded(batch.column(3), d).astype(np.float64)
                size = np.linalg.norm(q, axis=1, keepdims=True)
                unit = q / np.maximum(size, 1e-300)
                if home:
                    full = [c for c, s in enumerate(shards) if s]
                    near = (ct.lift(q, longest) @ pivots[full].T).argmax(axis=1)
                    lists = [[shards[full[c]][0]] for c in near.tolist()]
                else:
                    low, high = ct.cone(unit, pivots, reach, size * longest)
                    lists = []
                    for k, (lo, hi) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                        able = np.zeros(len(pivots), bool)
                        for a, b in zip(lo, hi):
                            able |= (high[k] >= a) & (low[k] <= b)
                        lists.append([s for c in np.flatnonzero(able) for s in shards[c]])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "shards"])

        return run

    def search(self, anchors: DataFrame, blocks: int, same: bool, most: int, home: bool = False) -> DataFrame:
        """(id, node, at, score, other): of each anchor's window ``at`` the first rows of its label
        (same) or of others.  Anchors: ``_ANCHOR``."""
        d = self.d

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            out = [pa.table([pa.array([], t) for t in kinds], _NAMES)]
            if left.num_rows and right.num_rows:
                tree = ct.Tree(right.column("tree")[0].as_py())
                for at in range(0, left.num_rows, 512):
                    part = left.slice(at, 512)
                    low, high = (part.column(c).to_pylist() for c in ("low", "high"))
                    windows = max(map(len, low))
                    low = np.array([x + [ANY] * (windows - len(x)) for x in low], np.int64).reshape(len(low), windows)
                    high = np.array([x + [-ANY] * (windows - len(x)) for x in high], np.int64).reshape(len(high), windows)
                    names = np.array(part.column("node").to_pylist(), "U32")
                    ids = part.column("id").to_numpy()
                    q, w, score, other = tree.search(_padded(part.column("x"), d), part.column("label").to_numpy(), same, names, ids, low, high, most)
                    out.append(pa.table([pa.array(c, t) for c, t in zip((ids[q], names[q], w, score, other), kinds)], _NAMES))
            return pa.concat_tables(out)

        routed = anchors.mapInArrow(frugal(self._routed(home)), f"{_ANCHOR}, shards array<int>")
        dealt = routed.withColumn("shard", F.explode("shards")).drop("shards").withColumn("block", F.pmod(F.xxhash64("id", "node"), F.lit(blocks)).cast("int"))
        trees = self.trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return dealt.groupBy("shard", "block").cogroup(trees.groupBy("shard", "block")).applyInArrow(run, _FOUND)


def hard_negatives(rows: DataFrame, id_column: str, label_column: str, vector_column: str, anchor: Column,
                   low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` is a
    condition on the rows, ``low`` and ``high`` are hundredths of the positive's score."""
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
                       F.col(vector_column).cast("array<bigint>").alias("x"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    able = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("x", lambda v: v.isNotNull()), F.lit(False))
    rows = rows.where(able).withColumn("node", name(F.col("label"), F.size("x"), F.col("x")))
    least = _first(rows, ["node"], [F.col("id")], POSITIVES + 1)
    points = least.groupBy("node").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.sort_array(F.collect_list("id")).alias("ids"))
    points, points_path = write_table(points, "negative-points")
    anchors, anchors_path = write_table(rows.where("asks").groupBy("id", "node").agg(F.first("label").alias("label"), F.first("x").alias("x")), "anchors")
    forest = Forest(points)
    blocks = max(1, -(-anchors.count() // BLOCK))
    if not forest.n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    window = lambda lo, hi: (F.array(lo.cast("long")).alias("low"), F.array(hi.cast("long")).alias("high"))
    best = [F.desc("score"), F.asc("other")]

    home = forest.search(anchors.select("*", *window(F.lit(-ANY), F.lit(ANY))), blocks, True, POSITIVES, home=True)
    floors = home.groupBy("id", "node").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == POSITIVES)
    floored = anchors.join(floors.select("id", "node", "floor"), ["id", "node"], "left")
    floored = floored.select(*anchors.columns, *window(F.coalesce("floor", F.lit(-ANY)), F.lit(ANY)))
    found = _first(forest.search(floored, blocks, True, POSITIVES), ["id", "node"], best, POSITIVES)
    positives, positives_path = write_table(found.select("id", "node", "score", "other"), "positives")

    scores = positives.where("score >= 0").groupBy("id", "node").agg(F.sort_array(F.collect_set("score")).alias("scores"))
    asked = anchors.join(scores, ["id", "node"])
    asked = asked.select(*anchors.columns, F.transform("scores", lambda p: F.ceil(p * low / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("low"),
                         F.transform("scores", lambda p: F.floor(p * high / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("high"))
    near = forest.search(asked, blocks, False, NEGATIVES).join(scores, ["id", "node"])
    near = near.select("id", "node", F.get("scores", F.col("at")).alias("positive_score"), "score", "other")
    near = _first(near, ["id", "node", "positive_score"], best, NEGATIVES)
    kept = near.select("id", "node", "positive_score", F.col("_r").alias("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    result, _ = write_table(positives.withColumnRenamed("score", "positive_score").join(kept, ["id", "node", "positive_score"]).select(
        F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score"), "hard-negatives")
    for path in (points_path, anchors_path, positives_path, forest.path):
        drop_path(spark, path)
    return result
