"""Exact positions and running sums without funnelling a hot group into one task.

Two shapes recur in the engine:

* a position inside a group (order_number per user, cart position per order), where a
  single user or order may hold a large share of the rows; and
* a position or running sum over *all* rows (RFM ranks, ROC / PR curves, medians), where
  a plain ``Window.orderBy`` would move every row into one partition.

Both are solved the same way: cut the ordered rows into chunks that are contiguous in
the ordering, count (or sum) per chunk, turn the small chunk table into offsets, and add
the offset to a window that only ever sees one chunk.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNB = Window.unboundedPreceding

# Sampled keys for each range; the driver receives about this times the number of ranges.
KEYS_PER_RANGE = 48
# A range is meant to hold so many rows, unless there are fewer ranges than shuffle partitions.
ROWS_PER_RANGE = 1 << 20


# Buckets of keys that group_bound counts.
_BUCKETS = 1 << 17


def group_bound(df: DataFrame, key: str) -> int:
    """A number that no key's rows exceed: the rows of the fullest of ``_BUCKETS`` hash buckets of keys.

    Tasks send at most a row for each bucket, whatever the number of keys."""
    per = df.groupBy(F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.max("_n")).first()[0] or 0


def sequence_in_group(df: DataFrame, keys: list[str], bucket: str, order: list,
                      out: str = "seq", prev_bucket: str | None = None,
                      group_size: str | None = None, coarse: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by bucket, *order)``.

    ``bucket`` must be a column that is monotone in the ordering (e.g. the day of a
    timestamp).  Rows are windowed per (keys, bucket), so a hot key is spread over its
    buckets; the per-(key, bucket) counts are prefix-summed on the much smaller chunk
    table.  Optionally returns the previous bucket value of the key (``prev_bucket``)
    and the key's row count (``group_size``).

    Where one key may have very many buckets (``bucket`` numeric), ``coarse`` adds up runs of
    so many buckets first: no window then holds more than ``coarse`` chunks, or more than one
    row for each run.
    """
    chunks = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_chunk_n"))
    wk = Window.partitionBy(*keys).orderBy(bucket)
    before = F.coalesce(F.sum("_chunk_n").over(wk.rowsBetween(_UNB, -1)), F.lit(0))
    if coarse:
        if prev_bucket or group_size:
            raise ValueError("coarse gives the sequence only")
        chunks = chunks.withColumn("_run", F.call_function("div", F.col(bucket), F.lit(coarse)))
        runs = chunks.groupBy(*keys, "_run").agg(F.sum("_chunk_n").alias("_run_n"))
        wr = Window.partitionBy(*keys).orderBy("_run").rowsBetween(_UNB, -1)
        runs = runs.select(*keys, "_run", F.coalesce(F.sum("_run_n").over(wr), F.lit(0)).alias("_run_before"))
        chunks = chunks.join(runs, [*keys, "_run"])
        wk = Window.partitionBy(*keys, "_run").orderBy(bucket).rowsBetween(_UNB, -1)
        before = F.col("_run_before") + F.coalesce(F.sum("_chunk_n").over(wk), F.lit(0))
    cols = [*keys, bucket, before.alias("_before")]
    if prev_bucket:
        cols.append(F.lag(bucket).over(wk).alias(prev_bucket))
    if group_size:
        cols.append(F.sum("_chunk_n").over(Window.partitionBy(*keys)).cast("int").alias(group_size))
    chunks = chunks.select(*cols)
    wr = Window.partitionBy(*keys, bucket).orderBy(*order)
    ranked = df.withColumn("_rn_in_chunk", F.row_number().over(wr))
    return (ranked.join(chunks, [*keys, bucket])
            .withColumn(out, (F.col("_before") + F.col("_rn_in_chunk")).cast("int"))
            .drop("_before"))


def sequence_in_tree(df: DataFrame, keys: list[str], levels: list[str], order: list, out: str = "seq",
                     prev_bucket: str | None = None, group_size: str | None = None) -> DataFrame:
    """``sequence_in_group`` for keys of which one bucket may still hold very many rows.

    ``levels`` are columns that nest and are monotone in the order: days, then the seconds of a day,
    ...  Rows are counted per deepest chunk; counts are added up level by level to the first, and
    prefix sums go down again, each in windows over the children of one chunk.  With levels
    of bounded numbers of children no window holds more than these, or one deepest chunk's rows.
    ``prev_bucket`` is the key's previous value of the first level, ``group_size`` its rows.
    """
    counts = [df.groupBy(*keys, *levels).agg(F.count(F.lit(1)).alias("_n"))]
    for depth in range(len(levels) - 1, 0, -1):
        counts.insert(0, counts[0].groupBy(*keys, *levels[:depth]).agg(F.sum("_n").alias("_n")))
    offsets = None
    for depth, table in enumerate(counts):
        above = [*keys, *levels[:depth]]
        siblings = Window.partitionBy(*above).orderBy(levels[depth])
        inside = F.coalesce(F.sum("_n").over(siblings.rowsBetween(_UNB, -1)), F.lit(0))
        if offsets is None:
            cols = [*above, levels[depth], inside.alias("_before")]
            if prev_bucket:
                cols.append(F.lag(levels[depth]).over(siblings).alias(prev_bucket))
            if group_size:
                cols.append(F.sum("_n").over(Window.partitionBy(*keys)).cast("int").alias(group_size))
            offsets = table.select(*cols)
            carried = [c for c in (prev_bucket, group_size) if c]
        else:
            placed = table.select(*above, levels[depth], inside.alias("_inside"))
            offsets = placed.join(offsets, above).select(
                *above, levels[depth], (F.col("_before") + F.col("_inside")).alias("_before"), *carried)
    chunk = Window.partitionBy(*keys, *levels).orderBy(*order)
    ranked = df.withColumn("_rn_in_chunk", F.row_number().over(chunk))
    return (ranked.join(offsets, [*keys, *levels]).withColumn(out, (F.col("_before") + F.col("_rn_in_chunk")).cast("int"))
            .drop("_before"))


def _key_struct(cols: list[Column]) -> Column:
    return F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(cols)])


def _boundaries(df: DataFrame, order: list[Column], n_ranges: int | None) -> list[tuple]:
    """At most ``n_ranges - 1`` ascending split points of the sort key; without ``n_ranges``, one
    range for each shuffle partition or for each ``ROWS_PER_RANGE`` rows, whichever are more.

    The sampled rows are those whose key hash is below a threshold set from the row count,
    so every task returns only wanted rows and the sample depends on the data alone, not on
    partitioning, row order or retries.  The ranks built on the ranges are exact whatever
    the split points are; the sample only balances them.
    """
    keys = df.select(*[c.alias(f"_k{i}") for i, c in enumerate(order)])
    rows = keys.count() if n_ranges != 1 else 0
    n_ranges = n_ranges or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
    if n_ranges <= 1:
        return []
    share = min(1.0, KEYS_PER_RANGE * n_ranges / max(1, rows))
    h = F.pmod(F.xxhash64(*keys.columns), F.lit(1 << 30))
    sample = sorted(tuple(r) for r in keys.where(h < int(share * (1 << 30))).collect())
    cuts: list[tuple] = []
    for j in range(1, n_ranges if sample else 1):
        b = sample[(j * len(sample)) // n_ranges]
        if not cuts or b > cuts[-1]:
            cuts.append(b)
    return cuts


def _key_array(keys: list[tuple], types) -> Column:
    """Sort keys as one array of structs, which the optimizer folds to a constant."""
    one = T.StructType([T.StructField(f"_k{i}", t) for i, t in enumerate(types)])
    rows = [{f"_k{i}": v for i, v in enumerate(k)} for k in keys]
    return F.from_json(F.lit(json.dumps(rows, default=str)), T.ArrayType(one))


def _with_range(df: DataFrame, key: Column, cuts: list[tuple], types) -> DataFrame:
    """The rows with the number of split points ≤ key in ``_range``: a binary search in one array of keys, a
    projection for each step, so that a step is compiled code and the plan grows with the logarithm of the
    number of ranges.

    Don't filter by ``_range``: the optimizer moves a condition below the steps, each of which reads the one
    before it twice, so that it would grow with the number of ranges (``_in_ranges`` picks rows by their keys)."""
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    table = _key_array(cuts, types)
    df = df.withColumn("_key", key).withColumn("_range", F.lit(0))
    for bit in reversed(range(len(cuts).bit_length())):
        right = F.get(table, F.col("_range") + ((1 << bit) - 1)) <= F.col("_key")  # null beyond the last
        df = df.withColumn("_range", F.col("_range") + F.when(right, 1 << bit).otherwise(0))
    return df.drop("_key")


def _in_ranges(df: DataFrame, key: Column, cuts: list[tuple], types, wanted: list[int]) -> DataFrame:
    """The rows of a few ranges, with ``_range``: those whose key lies between a range's split points."""
    number = F.lit(None).cast("int")
    for r in wanted:
        ends = [cuts[k] for k in (r - 1, r) if 0 <= k < len(cuts)]
        within, limits = F.lit(True), _key_array(ends, types)
        if r > 0:
            within = within & (F.get(limits, F.lit(0)) <= key)
        if r < len(cuts):
            within = within & (key < F.get(limits, F.lit(len(ends) - 1)))
        number = F.when(within, F.lit(r)).otherwise(number)
    return df.withColumn("_range", number).where(F.col("_range").isNotNull())


def _ranged(df: DataFrame, order: list, n_ranges: int | None) -> tuple[DataFrame, list[Column]]:
    """The rows with their range of the order in ``_range``, and the order as columns."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    types = [f.dataType for f in df.select(*order).schema.fields]
    return _with_range(df, _key_struct(order), _boundaries(df, order, n_ranges), types), order


def keys_at_ranks(df: DataFrame, order: list, ranks: list[int], n_ranges: int | None = None) -> list[tuple]:
    """The sort keys at the given 1-based ranks of the order, exactly, without ranking rows.

    One pass counts the rows of every range; then only the ranges that hold a wanted rank
    are ordered, each in a window of its own, and one row per rank reaches the driver.
    """
    rows = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)])
    order, types = [F.col(c) for c in rows.columns], [f.dataType for f in rows.schema.fields]
    key, cuts = _key_struct(order), _boundaries(rows, order, n_ranges)
    ranged = _with_range(rows, key, cuts, types)
    wanted: dict[tuple[int, int], list[int]] = {}
    before = 0
    for r in sorted(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_range"]):
        for i, rank in enumerate(ranks):
            if before < rank <= before + r["n"]:
                wanted.setdefault((r["_range"], rank - before), []).append(i)
        before += r["n"]
    if len({i for at in wanted.values() for i in at}) != len(ranks):
        raise ValueError("a rank lies outside the rows")
    some = _in_ranges(rows, key, cuts, types, sorted({k[0] for k in wanted}))
    placed = some.withColumn("_rn", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    pick = F.lit(False)
    for at, n in wanted:
        pick = pick | ((F.col("_range") == at) & (F.col("_rn") == n))
    out: list = [None] * len(ranks)
    for r in placed.where(pick).collect():
        for i in wanted[r["_range"], r["_rn"]]:
            out[i] = tuple(r[f"_o{k}"] for k in range(len(order)))
    return out


def key_literal(key: tuple, types) -> Column:
    """A sort key as a struct literal, comparable with a struct of the order's columns."""
    return F.struct(*[F.lit(v).cast(t).alias(f"_k{i}") for i, (v, t) in enumerate(zip(key, types))])


def ordered_prefix(df: DataFrame, order: list, sums: dict[str, Column],
                   n_ranges: int | None = None, totals: bool = False) -> DataFrame:
    """Running sums over a total order of all rows, exact, with no single-task window.

    ``order`` (ascending expressions; negate a numeric key to descend) must be unique
    and non-NULL per row.  For each name → column in ``sums`` adds ``name`` = sum of
    the column over all rows up to and including this one, and with ``totals=True``
    also ``name + "_total"`` = the grand total.

    Each row's range is a pure function of its key (split points from a hash sample,
    compared as structs), so a hot value is split across ranges by the tie-breaking
    columns, and the result is the same after any retry or re-plan.  Per-range sums
    (≤ n_ranges rows) become offsets that are broadcast back.  Callers materialize an
    expensive input first: it is read by the sample, the range totals and the rows.
    """
    vals = {name: f"_v_{i}" for i, name in enumerate(sums)}
    ranged, order = _ranged(df, order, n_ranges)
    ranged = ranged.select("*", *[col.alias(vals[name]) for name, col in sums.items()])
    range_tot = ranged.groupBy("_range").agg(*[F.sum(v).alias(v) for v in vals.values()])
    # at most n rows: a single ordered window over them is bounded by n_ranges
    w_prev = Window.orderBy("_range").rowsBetween(_UNB, -1)
    off_cols = ["_range"]
    for name, v in vals.items():
        off_cols.append(F.coalesce(F.sum(v).over(w_prev), F.lit(0)).alias(f"_o{v}"))
        if totals:
            off_cols.append(F.sum(v).over(Window.partitionBy()).alias(name + "_total"))
    offsets = range_tot.select(*off_cols)
    w_run = Window.partitionBy("_range").orderBy(*order).rowsBetween(_UNB, Window.currentRow)
    joined = ranged.join(F.broadcast(offsets), "_range")
    out = joined.select("*", *[(F.col(f"_o{v}") + F.sum(v).over(w_run)).alias(name)
                               for name, v in vals.items()])
    return out.drop("_range", *vals.values(), *[f"_o{v}" for v in vals.values()])


def exact_rank(df: DataFrame, order: list, out: str = "rank", n_ranges: int | None = None,
               with_count: str | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (ties must be broken by the caller)."""
    res = ordered_prefix(df, order, {out: F.lit(1).cast("bigint")}, n_ranges, totals=bool(with_count))
    if with_count:
        res = res.withColumnRenamed(out + "_total", with_count)
    return res


def exact_median(df: DataFrame, col: str) -> Column:
    """Median of the non-NULL values of ``col`` (mean of the two middle values for an even
    count), as a scalar subquery column.  Works on value counts, so only the distinct
    values are ordered."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("_cnt")))
    cum = ordered_prefix(counts, [col], {"_cum": F.col("_cnt")}, totals=True)
    lo = F.call_function("div", F.col("_cum_total") - 1, F.lit(2))
    hi = F.call_function("div", F.col("_cum_total"), F.lit(2))
    picked = cum.agg(F.min(F.when(F.col("_cum") > lo, F.col(col))).alias("_lo"),
                     F.min(F.when(F.col("_cum") > hi, F.col(col))).alias("_hi"))
    return picked.select(((F.col("_lo") + F.col("_hi")) / 2).cast("double")).scalar()
