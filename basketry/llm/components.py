"""Connected components of an undirected graph held as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import drop_path, write_table


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the component's least node.

    Alternates the large-star and small-star steps until no link changes: the large-star step
    hangs each node's larger neighbours on its least neighbour, the small-star step the smaller
    ones.  Each step is one aggregation by node and one join, so a node with very many
    neighbours is never gathered; the number of steps grows with the logarithm of the longest
    path.  Every step's links are written to the shared folder.
    """
    spark = links.sparkSession
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, path = write_table(pairs, "links")
    old: list[str] = []
    before = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        old.append(path)
        edges, path = write_table(small.where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        for p in old:
            drop_path(spark, p)
        old.clear()
        if now == before:
            break
        before = now
    star = edges.groupBy("a").agg(F.min("b").alias("label"))
    return star.select(F.col("a").alias("node"), "label").unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
