"""RFM segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.exact import cents, from_cents, half_even, half_up_units
from basketry.functions.ordering import exact_median, key_literal, keys_at_ranks
from basketry.session import materialize


def frequency_monetary(orders_clean: DataFrame) -> DataFrame:
    """Per user order count, total and mean order value (2 dp, half-up), items."""
    agg = orders_clean.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum(cents(F.col("order_value"))).alias("_cents"),
        F.sum("basket_size").cast("bigint").alias("total_items"))
    return agg.select(
        "user_id", "frequency",
        from_cents(F.col("_cents")).alias("monetary"),
        from_cents(half_up_units(F.col("_cents"), F.col("frequency"), 0)).alias("avg_order_value"),
        "total_items")


def recency(orders_clean: DataFrame) -> DataFrame:
    """R2: the (clipped) gap recorded on the user's train order."""
    return (orders_clean.where(F.col("eval_set") == "train")
            .select("user_id", F.col("days_since_prior_order").alias("recency")))


def rfm_raw(orders_clean: DataFrame) -> DataFrame:
    """frequency/monetary left-joined with recency; a missing recency takes the
    median of the present ones (exact, interpolated).  A user with two train orders would
    appear twice, so that is an error."""
    gaps = recency(orders_clean).groupBy("user_id").agg(F.max("recency").alias("recency"), F.count(F.lit(1)).alias("_n"))
    joined = frequency_monetary(orders_clean).join(gaps, "user_id", "left")
    # one row per user, read by the median job and by the selection of band ends: write once
    joined = materialize(joined)
    if joined.where("_n > 1").limit(1).count():
        raise ValueError("a user has more than one train order")
    joined = joined.drop("_n")
    # one number, fetched once: as a subquery it would re-run in every job that reads this table
    med = joined.select(exact_median(joined, "recency")).first()[0]
    return joined.withColumn("recency", F.coalesce(F.col("recency"), F.lit(med).cast("double")))


def quintile_band(df: DataFrame, value: str, out: str, bands: int = fixed.RFM_BANDS,
                  tie: str = "user_id") -> DataFrame:
    """First-come rank r (ties by ``tie``) of n rows cut into ``bands`` equal-width-in-rank
    bands, right-closed: ``max(1, ceil(bands·(r−1)/(n−1)))``; a single row gets band 1.

    Band b ends at rank ⌊b·(n−1)/bands⌋ + 1.  The keys at those ranks are selected, and each
    row's band is the number of them below its own key, plus one: no row is ranked or moved.
    """
    n = df.count()
    if not n:
        return df.withColumn(out, F.lit(1))
    types = [df.schema[c].dataType for c in (value, tie)]
    ends = keys_at_ranks(df, [value, tie], [b * (n - 1) // bands + 1 for b in range(1, bands)])
    key = F.struct(F.col(value).alias("_k0"), F.col(tie).alias("_k1"))
    band = F.lit(1)
    for end in ends:
        band = band + (key > key_literal(end, types)).cast("int")
    return df.withColumn(out, band.cast("int"))


def segment_of(cell: Column) -> Column:
    """Segment name of an "<R><F>" cell (the ten patterns partition the 25 cells)."""
    expr = None
    for pattern, name in fixed.SEGMENT_PATTERNS:
        cond = cell.rlike(f"^{pattern}$")
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def action_of(segment: Column) -> Column:
    """Recommended action of a segment (literal map, evaluated in the JVM)."""
    pairs = [F.lit(x) for kv in fixed.SEGMENT_ACTIONS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), segment)


def rfm_scores(rfm: DataFrame, bands: int = fixed.RFM_BANDS) -> DataFrame:
    """R (low recency best), F, M scores, cell, score, segment, action.

    Each dimension's band ends are selected keys, so the three bands are columns of the same
    per-user rows: no ranking shuffle and no join back.
    """
    df = quintile_band(rfm, "recency", "_rb", bands)
    df = quintile_band(df, "frequency", "F", bands)
    df = quintile_band(df, "monetary", "M", bands)
    df = df.withColumn("R", (F.lit(bands + 1) - F.col("_rb")).cast("int")).drop("_rb")
    df = df.withColumn("rfm_cell", F.concat(F.col("R").cast("string"), F.col("F").cast("string")))
    df = df.withColumn("rfm_score", (F.col("R") + F.col("F") + F.col("M")).cast("int"))
    df = df.withColumn("segment", segment_of(F.col("rfm_cell")))
    return df.withColumn("action", action_of(F.col("segment")))


RFM_COLUMNS = ["user_id", "recency", "frequency", "monetary", "avg_order_value", "total_items",
               "R", "F", "M", "rfm_score", "segment", "action"]


def rfm_segments(orders_clean: DataFrame, bands: int = fixed.RFM_BANDS, with_cell: bool = False) -> DataFrame:
    """The 12-column ``rfm_segments`` table (plus ``rfm_cell`` for the CSV)."""
    cols = RFM_COLUMNS + (["rfm_cell"] if with_cell else [])
    return rfm_scores(rfm_raw(orders_clean), bands).select(*cols)


def _whole(col: str) -> Column:
    """Sum of a column over a small aggregated frame (≤ one row per segment)."""
    return F.sum(col).over(Window.partitionBy())


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """Share of customers per segment in %, 1 dp (half-even, as a frame rounds)."""
    counts = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("_n"))
    return counts.select("segment", half_even(F.col("_n").cast("decimal(38,0)") * 100, _whole("_n"), 1).alias("pct"))


def segment_size_value(rfm: DataFrame) -> DataFrame:
    """Customers and total monetary value per segment (plotted by customers asc)."""
    return (rfm.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("total_monetary"))
            .orderBy("customers", "segment"))


def rf_grid(rfm: DataFrame, bands: int = fixed.RFM_BANDS) -> DataFrame:
    """Customer counts per R (rows, from the highest down, all present) × F (columns
    f1..f5); empty cells are NULL."""
    levels = list(range(1, bands + 1))
    grid = rfm.groupBy("R").pivot("F", levels).agg(F.count(F.lit(1)))
    rows = rfm.sparkSession.range(1, bands + 1).select(F.col("id").cast("int").alias("R"))
    return rows.join(grid, "R", "left").select("R", *[F.col(str(f)).alias(f"f{f}") for f in levels]).orderBy(F.desc("R"))
