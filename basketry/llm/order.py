"""Dealing rows out by ranges of an id, the same way on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled ids for each range; what reaches the driver is about this times the number of ranges.
PER_RANGE = 32


def split_points(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending ids of the column that cut it into about equal ranges.

    The ids sampled are those whose hash is below a threshold, so the same rows give the same
    points however they are partitioned; about ``PER_RANGE * ranges`` ids are collected.
    """
    ids = df.select(F.col(column).cast("long").alias("id")).where(F.col("id").isNotNull())
    rows = ids.count()
    share = min(1.0, PER_RANGE * ranges / max(1, rows))
    picked = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40))).distinct()
    sample = sorted(r["id"] for r in picked.collect())
    points = {sample[k * len(sample) // ranges] for k in range(1, ranges)} if sample else set()
    return sorted(points - set(sample[:1]))


def range_of(value: Column, points: list[int]) -> Column:
    """The number of points that are not above the value: a binary search in one array."""
    if not points:
        return F.lit(0)
    table = F.lit(points)
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(len(points) + 1)))))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = (s["lo"] < s["hi"]) & (F.get(table, mid) <= value)
        left = (s["lo"] < s["hi"]) & ~right
        return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(left, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(points)).alias("hi"))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])
