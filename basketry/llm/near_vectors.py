"""Near-duplicate vectors: links between vectors of one label whose cosine reaches a threshold.

1. *Classes.* Equal vectors of a label are one node, named by 128 bits of their values; copies
   are counted, never compared.
2. *Buckets.* Sign bits under random rotations are cut in bands; nodes that agree in a band
   meet.  The width of a band follows the largest label's size, the number of bands follows from
   the width: a pair at the threshold meets nowhere with a probability below ``MISS``.  Only
   binary codes travel, seven bits a dimension (``binary_codes``).
3. *Estimates.* Where two codes meet, the bounds of both estimates tell whether their cosine can
   reach the threshold.  A bucket gives a spanning forest of such pairs, not the pairs.
4. *Recomputation.* The forest's components are groups of vectors that only an exact product can
   tell apart.  Inside one, the bounds again pick the pairs to recompute, in double precision.

Buckets and groups of more than ``CHUNK`` nodes are cut in chunks by the nodes' names, and each
pair of chunks is a task's work of its own; counts of links and spanning forests leave it, so a
group of m near copies is compared in blocks and m rows a block are written.

Defined cases: rows whose label or vector is null, whose vector is empty or zero, or holds null or
non-finite components, and vectors of different lengths link with nothing.  A row without an id
counts as a vector; a component's id is the least one that is not null (null if none has one), and
``kept`` compares null-safely.  Rows that share an id are vectors each.  Equal rows link.  Columns
other than the three named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import binary_codes as bc
from basketry.llm.components import components
from basketry.llm.texts import frugal, prepare
from basketry.llm.vectors import matrix, name, usable
from basketry.session import drop_path, write_table

#: Nodes of a chunk.
CHUNK = 1024
#: A bucket is meant to have so many nodes.
BUCKET = 512
#: Sign bits that bands are drawn from.
SIDE_BITS = 256
#: The probability that a pair at the threshold shares no band.
MISS = 1e-9

_LINKS = "a string, b string"


def bands(nodes: int, least: float) -> list[np.ndarray]:
    """The bits of each band, for labels of at most so many nodes."""
    width = max(0, math.ceil(math.log2(max(1, nodes) / BUCKET)))
    if not width:
        return [np.zeros(0, np.int64)]
    apart = math.acos(least) / math.pi
    log = [math.lgamma(SIDE_BITS + 1) - math.lgamma(h + 1) - math.lgamma(SIDE_BITS - h + 1) + h * math.log(apart)
           + (SIDE_BITS - h) * math.log1p(-apart) for h in range(SIDE_BITS + 1)]
    share, differ = np.exp(log), np.arange(SIDE_BITS + 1) / SIDE_BITS
    count = 1
    while (share * (1 - (1 - differ) ** width) ** count).sum() > MISS:
        count += 1
    rng = np.random.default_rng(11)
    return [rng.choice(SIDE_BITS, width, replace=False) for _ in range(count)]


def _coded(picked: list[np.ndarray]):
    """(node, label, d, code, keys) of (node, label, d, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for d in np.unique(lengths).tolist():
                rows = batch.take(pa.array(np.flatnonzero(lengths == d)))
                units = bc.unit(matrix(rows.column(3)))
                side = bc.side_bits(units, SIDE_BITS)
                keys = np.stack([(side[:, p] << np.arange(len(p))).sum(axis=1) if len(p) else np.zeros(len(units), np.int64) for p in picked], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(units) + 1, dtype=np.int32) * len(picked)), pa.array(keys.astype(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(bc.encode(units).pack(), pa.binary()), lists],
                                                 ["node", "label", "d", "code", "keys"])

    return run


def forest(pairs: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """The least member of each of n nodes' component."""
    root = np.arange(n)
    a, b = pairs
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """The rows of a unit's two chunks, by name; whether they are one chunk."""
    chunk, lo, hi = (table.column(c).to_numpy() for c in ("chunk", "lo", "hi"))
    return np.flatnonzero(chunk == lo), np.flatnonzero(chunk == hi), bool(lo[0] == hi[0])


def _meet(least: float):
    """Of a unit of a bucket, (node, its component's first node) of pairs that may be links."""

    def run(table: pa.Table) -> pa.Table:
        left, right, same = _sides(table)
        codes = bc.unpack(table.column("code").to_pylist())
        found = bc.possible(codes.pick(left), codes.pick(right), least)
        if same:
            found = np.triu(found, 1)
        i, j = np.nonzero(found)
        root = forest((left[i], right[j]), table.num_rows)
        moved = np.flatnonzero(root != np.arange(len(root)))
        node = table.column("node")
        return pa.table({"a": node.take(pa.array(moved)), "b": node.take(pa.array(root[moved]))})

    return run


def _verify(least: float):
    """Of a unit of a group: (node, its links in this unit, the first node it links to here)."""

    def run(table: pa.Table) -> pa.Table:
        left, right, same = _sides(table)
        vectors = matrix(table.column("vector"))
        units, copies = bc.unit(vectors), table.column("copies").to_numpy()
        codes = bc.encode(units)
        maybe = bc.possible(codes.pick(left), codes.pick(right), least)
        if same:
            maybe = np.triu(maybe, 1)
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        length = np.sqrt((scaled * scaled).sum(axis=1))
        if maybe.mean() > 0.02:
            i, j = np.nonzero(maybe & (scaled[left] @ scaled[right].T >= least * length[left][:, None] * length[right] - 1e-9))
        else:
            i, j = np.nonzero(maybe)
        linked = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):  # the same sum for a pair, wherever it is judged
            a, b = left[i[at : at + (1 << 16)]], right[j[at : at + (1 << 16)]]
            linked[at : at + len(a)] = np.einsum("ij,ij->i", scaled[a], scaled[b]) / (length[a] * length[b]) >= least
        a, b = left[i[linked]], right[j[linked]]
        links = np.zeros(table.num_rows, np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        kept = np.flatnonzero(links)
        node = table.column("node")
        root = forest((a, b), table.num_rows)
        return pa.table({"node": node.take(pa.array(kept)), "links": pa.array(links[kept]), "root": node.take(pa.array(root[kept]))})

    return run


def _units(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members dealt to pairs of chunks of their key: chunk, lo, hi; sizes from one count by key."""
    large = members.groupBy(*keys).agg(F.count("*").alias("held")).where(F.col("held") > CHUNK)
    large = large.select(*keys, F.ceil(F.col("held") / CHUNK).cast("int").alias("chunks"))
    known = members.join(large, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    known = known.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    return known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "*", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi")).drop("chunks", "other")


def possible_links(nodes: DataFrame, least: float) -> DataFrame:
    """A spanning forest (a, b) of the pairs of nodes (node, label, d, vector) that may be links."""
    most = nodes.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 0
    coded = nodes.select("node", "label", "d", "vector").mapInArrow(
        frugal(_coded(bands(most, least))), f"node string, label {nodes.schema['label'].dataType.simpleString()}, d int, code binary, keys array<long>")
    dealt = coded.select("node", "label", "d", "code", F.posexplode("keys").alias("band", "key"))
    keys = ["label", "d", "band", "key"]
    return _units(dealt, keys).groupBy(*keys, "lo", "hi").applyInArrow(_meet(least), _LINKS).distinct()


def near_duplicates(df: DataFrame, id_column: str, vector_column: str, label_column: str, least: float = 0.98) -> DataFrame:
    """(id_column, n_links, component_id, kept) of every row."""
    spark = df.sparkSession
    prepare(spark)
    vector = F.col("vector")
    rows = df.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    whole = F.when(usable(vector), vector)
    able = F.col("label").isNotNull() & F.coalesce(F.exists(whole, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("node", F.when(able, name(F.col("label"), F.size("vector"), vector)))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("id").alias("first"), F.count("*").alias("copies"))
    nodes, nodes_path = write_table(nodes.select("*", F.size("vector").alias("d")), "vector-nodes")

    maybe, maybe_path = write_table(possible_links(nodes, least), "vector-maybe")
    groups = components(maybe)
    members = nodes.select("node", "vector", "copies").join(groups, "node")
    verified = _units(members, ["label"]).groupBy("label", "lo", "hi").applyInArrow(_verify(least), "node string, links long, root string")
    verified, verified_path = write_table(verified, "vector-links")
    label = components(verified.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "first", "copies").join(links, "node", "left").join(label, "node", "left")
    known = known.where("copies > 1 or links is not null").withColumn("label", F.coalesce("label", "node"))
    least_id = known.groupBy("label").agg(F.min("first").alias("component_id"))
    found, _ = write_table(known.join(least_id, "label").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-components")
    for path in (nodes_path, maybe_path, verified_path):
        drop_path(spark, path)
    linked = F.col("n_links").isNotNull()
    out = rows.select("id", "node").join(found, "node", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
