"""Derive the order panel from star-schema Parquet tables (orders, lineitem, part).

Mapping: user = ``o_custkey``, order = ``o_orderkey``, line = ``lineitem``, product =
``part`` (``grain="part"``) or the (brand, type) family of a part (``grain="family"``),
price = ``p_retailprice``, department = ``p_type``, aisle = ``p_brand``.

The panel's own columns are rebuilt from the raw rows with the meaning they carry in
the market-basket layout:

* P1 ``order_number``  1..n per user in (order date, order key) order
* P2 ``eval_set``      a user's last order is ``train``, the others ``prior``
* P3 ``days_since_prior_order``  whole days since the user's previous order, NULL first
* P4 ``order_dow`` (0 = Saturday … 6 = Friday), ``order_hour_of_day``
* P5 one line per (order, product): the first occurrence by line number
* P6 ``add_to_cart_order`` 1..k over the de-duplicated basket
* P7 ``reordered`` = 1 iff the user bought the product in an earlier order
* P8 optional minimum order history per user
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions import fixed
from basketry.functions.ordering import group_bound, sequence_in_group, sequence_in_tree
from basketry.sources.panel import Panel

# Lines are windowed per (order, line-number chunk); one chunk spans this many line
# numbers, so even a single enormous basket is cut into bounded windows.
CART_CHUNK = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def repeated(df: DataFrame, key: str) -> bool:
    """Whether two rows have the same key, null included."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).count() > 0


# Orders of one user on one day beyond which a day is cut further, and of one user or lines of one
# order beyond which these are spread over windows of their days or line numbers.
HOT_DAY = 1 << 20


def _hot_day(orders: DataFrame) -> bool:
    """Whether some user has more than ``HOT_DAY`` orders on a day; days are only counted where
    there are more orders than that at all."""
    if orders.count() <= HOT_DAY:
        return False
    per_day = orders.groupBy("user_id", F.to_date("ts")).agg(F.count(F.lit(1)).alias("n"))
    return (per_day.agg(F.max("n")).first()[0] or 0) > HOT_DAY


def _day_levels(orders: DataFrame) -> tuple[DataFrame, list[str]]:
    """Nested chunks of the order (ts, order_id): days, seconds of a day, microseconds of a second,
    and four times 16 bits of the id, so that no chunk has more than a million children."""
    ts, at = F.unix_micros("ts"), F.col("order_id").cast("bigint")
    bits = {f"_id{k}": F.shiftright(at, k) for k in (48, 32, 16)}
    chunks = {"_day": F.to_date("ts"), "_second": F.call_function("div", ts, F.lit(1_000_000)), "_micro": ts, **bits}
    return orders.withColumns(chunks), list(chunks)


def sequence_orders(orders: DataFrame, bounded: bool | None = None) -> DataFrame:
    """P1–P4 on (order_id, user_id, ts) → the ``orders`` table of the panel.

    Users have a window each, in one exchange.  Where a user may have more than ``HOT_DAY`` orders, the
    per-user sequence is computed per (user, day) chunk, so a user holding a large
    share of all orders is spread over one window per active day.  Where one day of a user is
    too large for that, days are cut into a tree of chunks (``sequence_in_tree``).
    """
    if bounded is None:
        bounded = orders.count() <= HOT_DAY or group_bound(orders, "user_id") <= HOT_DAY
    if bounded:
        own, day = Window.partitionBy("user_id"), F.to_date("ts")
        at = own.orderBy("ts", "order_id")
        o = orders.where(F.col("user_id").isNotNull()).select(
            "order_id", "user_id", "ts", F.row_number().over(at).alias("order_number"),
            F.count(F.lit(1)).over(own).alias("_n_orders"), F.datediff(day, F.lag(day).over(at)).alias("_gap"))
        return _calendar(o.where(day.isNotNull()), F.col("_gap"))  # orders without a time are counted only
    wanted = {"out": "order_number", "prev_bucket": "_prev_day", "group_size": "_n_orders"}
    if _hot_day(orders):
        o, levels = _day_levels(orders)
        o = sequence_in_tree(o, ["user_id"], levels, ["ts", "order_id"], **wanted)
        # the first order of a day: no order of the day comes before it
        first = o.groupBy("user_id", "_day").agg(F.min("order_number").alias("_first"))
        o = o.join(first, ["user_id", "_day"]).withColumn("_rn_in_chunk", F.col("order_number") - F.col("_first") + 1)
    else:
        o = orders.withColumn("_day", F.to_date("ts"))
        o = sequence_in_group(o, ["user_id"], "_day", ["ts", "order_id"], **wanted)
    return _calendar(o, F.when(F.col("_rn_in_chunk") == 1, F.datediff("_day", "_prev_day")).otherwise(F.lit(0)))


def _calendar(o: DataFrame, gap: Column) -> DataFrame:
    return o.select(
        "order_id", "user_id",
        F.when(F.col("order_number") == F.col("_n_orders"), F.lit("train"))
         .otherwise(F.lit("prior")).alias("eval_set"),
        "order_number",
        F.pmod(F.dayofweek("ts"), F.lit(7)).cast("int").alias("order_dow"),
        F.hour("ts").cast("int").alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def dedup_basket(lines: DataFrame) -> DataFrame:
    """P5: one row per (order, product) with the line number of its first occurrence —
    an aggregate (map-side partial min), not a window, and not ``dropDuplicates``,
    which would keep an arbitrary row."""
    return lines.groupBy("order_id", "product_id").agg(F.min("line").alias("first_line"))


def basket_lines(lines: DataFrame, dedup: bool = True, coarse: int | None = None, bounded: bool = False) -> DataFrame:
    """P5–P6 on (order_id, product_id, line) → lines with ``add_to_cart_order``; ``coarse`` where
    line numbers are global, so that one order may spread over very many chunks.  ``bounded`` where no
    order is too large for one window: all is then done in one exchange of the lines by order."""
    if bounded:
        lines = lines.where(F.col("order_id").isNotNull()).repartition("order_id")
        lines = dedup_basket(lines) if dedup else lines.withColumnRenamed("line", "first_line")
        at = Window.partitionBy("order_id").orderBy("first_line", "product_id")
        placed = lines.withColumn("add_to_cart_order", F.row_number().over(at))
        return placed.where(F.col("first_line").isNotNull()).select("order_id", "product_id", "add_to_cart_order")
    if dedup:
        lines = dedup_basket(lines)
    else:
        lines = lines.withColumnRenamed("line", "first_line")
    lines = lines.withColumn("_cart_chunk", F.call_function("div", F.col("first_line"), F.lit(CART_CHUNK)))
    lines = sequence_in_group(lines, ["order_id"], "_cart_chunk", ["first_line", "product_id"],
                              out="add_to_cart_order", coarse=coarse)
    return lines.select("order_id", "product_id", "add_to_cart_order")


def flag_reorders(lines: DataFrame, orders: DataFrame, how: str = "inner", bounded: bool = False) -> DataFrame:
    """Attach the order's user / sequence and flag repeat purchases.

    The first purchase per (user, product) is pre-aggregated (map-side partial min) and
    joined back, rather than windowed, so a hot pair is split by AQE's skew join; ``bounded``
    where no user has too many orders for a window of a pair, which moves the lines once.
    """
    lo = lines.join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id", how)
    if bounded:
        first_on = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
        known = F.col("user_id").isNotNull() & F.col("product_id").isNotNull()  # null keys are never equal
        return lo.select("order_id", "product_id", "add_to_cart_order",
                         F.when(known, (F.col("order_number") > first_on).cast("int")).alias("reordered"), "eval_set")
    first = lo.groupBy("user_id", "product_id").agg(F.min("order_number").alias("_first_on"))
    lo = lo.join(first, ["user_id", "product_id"], "left")
    return lo.select(
        "order_id", "product_id", "add_to_cart_order",
        F.when(F.col("order_number").isNull(), F.lit(None))
         .otherwise((F.col("order_number") > F.col("_first_on")).cast("int")).alias("reordered"),
        "eval_set",
    )


def min_history(orders: DataFrame, k: int = fixed.MIN_HISTORY_ORDERS) -> DataFrame:
    """Keep users with at least ``k`` orders (aggregate + semi join, no user window)."""
    keep = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
    return orders.join(keep.select("user_id"), "user_id", "left_semi")


def _dense_ids(values: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Number the distinct values of a small vocabulary (types, brands) 1..k."""
    distinct = values.select(*cols).distinct()
    return distinct.withColumn(out, F.dense_rank().over(Window.orderBy(*cols)).cast("int"))


def catalog(part: DataFrame, grain: str = "part"):
    """Products, departments, aisles and prices at the requested grain, plus the map
    from ``l_partkey`` to ``product_id``."""
    departments = _dense_ids(part.select(F.col("p_type").alias("department")), ["department"], "department_id")
    aisles = _dense_ids(part.select(F.col("p_brand").alias("aisle")), ["aisle"], "aisle_id")
    if grain == "part":
        prod = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                           F.col("p_brand").alias("aisle"), F.col("p_type").alias("department"),
                           F.col("p_retailprice").alias("_price"))
        part_map = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("product_id"))
    elif grain == "family":
        fam = _dense_ids(part, ["p_brand", "p_type"], "product_id").withColumn("product_id", F.col("product_id").cast("bigint"))
        per_fam = part.groupBy("p_brand", "p_type").agg(F.min("p_retailprice").alias("_price"))
        prod = (fam.join(per_fam, ["p_brand", "p_type"])
                .select("product_id", F.concat_ws(" ", "p_brand", "p_type").alias("product_name"),
                        F.col("p_brand").alias("aisle"), F.col("p_type").alias("department"), "_price"))
        part_map = part.join(fam, ["p_brand", "p_type"]).select(F.col("p_partkey").alias("l_partkey"), "product_id")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    products = (prod.join(aisles, "aisle").join(departments, "department")
                .select("product_id", "product_name", "aisle_id", "department_id"))
    prices = prod.select("product_id", F.col("_price").cast("decimal(8,2)").alias("price"))
    return products, departments.select("department_id", "department"), aisles.select("aisle_id", "aisle"), prices, part_map


def star_lines(spark: SparkSession, sf_dir: str, part_map: DataFrame | None = None) -> DataFrame:
    """Raw lines as (order_id, product_id, line); ``part_map`` re-keys parts to families."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey", F.col("l_linenumber").alias("line"))
    if part_map is None:
        return li.withColumnRenamed("l_partkey", "product_id")
    return li.join(part_map, "l_partkey").drop("l_partkey")


def star_panel(spark: SparkSession, sf_dir: str, grain: str = "part", min_orders: int | None = None) -> Panel:
    """Build the lazy panel from ``orders``, ``lineitem`` and ``part`` under ``sf_dir``."""
    part = read_table(spark, sf_dir, "part")
    products, departments, aisles, prices, part_map = catalog(part, grain)
    raw_orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ts"))
    few_orders = group_bound(raw_orders, "user_id") <= HOT_DAY
    few_lines = group_bound(star_lines(spark, sf_dir), "order_id") <= HOT_DAY
    orders = sequence_orders(raw_orders, True if few_orders else None)
    if min_orders:
        orders = min_history(orders, min_orders)
    li = star_lines(spark, sf_dir, None if grain == "part" else part_map)
    lines = flag_reorders(basket_lines(li, dedup=True, bounded=few_lines), orders, "inner", few_orders)
    raw = flag_reorders(basket_lines(li, dedup=False, bounded=few_lines), orders, "left")
    return Panel(orders=orders, order_products=lines, products=products, departments=departments,
                 aisles=aisles, product_prices=prices, order_products_raw=raw)
