"""Reorder features at the (user, product) grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import fixed

#: Lines of a user or product beyond which these are not put in a window of their own.
WINDOW_ROWS = 1 << 22


def prior_lines(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """prior lines (filter on the *line's* eval_set) with their user and order number."""
    return (order_products.where(F.col("eval_set") == "prior")
            .select("order_id", "product_id", "add_to_cart_order", "reordered")
            .join(orders.select("order_id", "user_id", "order_number"), "order_id"))


def train_users(orders: DataFrame) -> DataFrame:
    """users with a train order, from ``orders`` (empty orders count too)."""
    return orders.where(F.col("eval_set") == "train").select("user_id").distinct()


def user_features(orders_clean: DataFrame, prior: DataFrame) -> DataFrame:
    """u_total_orders, u_avg_basket, u_avg_dspo over prior *clean* orders and
    u_reorder_rate over prior lines; both are per-user aggregates joined on user_id."""
    uo = _user_order_features(orders_clean)
    ur = prior.groupBy("user_id").agg(F.avg(F.col("reordered").cast("double")).alias("u_reorder_rate"))
    return uo.join(ur, "user_id")


def product_features(prior: DataFrame) -> DataFrame:
    """per product purchases, reorder rate, distinct users, mean cart position."""
    return prior.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("p_total_purchases"),
        F.avg(F.col("reordered").cast("double")).alias("p_reorder_rate"),
        F.countDistinct("user_id").alias("p_unique_users"),
        F.avg(F.col("add_to_cart_order").cast("double")).alias("p_avg_cart_pos"))


def user_product_features(prior: DataFrame) -> DataFrame:
    """per (user, product) purchases, mean cart position, first and last order."""
    return prior.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("up_orders"),
        F.avg(F.col("add_to_cart_order").cast("double")).alias("up_avg_cart_pos"),
        F.max("order_number").alias("up_last_order_number"),
        F.min("order_number").alias("up_first_order_number"))


def train_pairs(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """distinct (user, product) pairs of train lines (distinct: a second train order
    must not fan the candidates out)."""
    return (order_products.where(F.col("eval_set") == "train").select("order_id", "product_id")
            .join(orders.select("order_id", "user_id"), "order_id")
            .select("user_id", "product_id").distinct())


def _user_order_features(orders_clean: DataFrame) -> DataFrame:
    return (orders_clean.where(F.col("eval_set") == "prior").groupBy("user_id")
            .agg(F.max("order_number").alias("u_total_orders"),
                 F.avg("basket_size").alias("u_avg_basket"),
                 F.avg("days_since_prior_order").alias("u_avg_dspo")))


def _pairs_in_two_exchanges(orders: DataFrame, order_products: DataFrame, orders_clean: DataFrame) -> DataFrame:
    """F3–F9 of every prior pair: lines move once by user and pairs once by product.

    Pairs, their targets and the users' reorder rates are made where a user's lines are, and the
    users' features are joined there; the products' features are sums over their pairs.
    """
    prior, train = F.col("eval_set") == "prior", F.col("eval_set") == "train"
    lines = (order_products.where(prior | train).select("order_id", "product_id", "add_to_cart_order", "reordered", "eval_set")
             .join(orders.select("order_id", "user_id", "order_number"), "order_id").repartition("user_id"))
    cart, again = F.when(prior, F.col("add_to_cart_order")), F.when(prior, F.col("reordered"))
    up = lines.groupBy("user_id", "product_id").agg(
        F.count_if(prior).alias("up_orders"),
        F.sum(cart).alias("_cart"), F.count(cart).alias("_carts"), F.sum(again).alias("_again"), F.count(again).alias("_agains"),
        F.max(F.when(prior, F.col("order_number"))).alias("up_last_order_number"),
        F.min(F.when(prior, F.col("order_number"))).alias("up_first_order_number"),
        F.count_if(train).alias("_hit")).where(F.col("up_orders") > 0)
    mean = lambda total, n: F.try_divide(total.cast("double"), n)
    over = lambda w, c: F.sum(c).over(w)
    user, product = Window.partitionBy("user_id"), Window.partitionBy("product_id")
    up = up.withColumn("u_reorder_rate", mean(over(user, "_again"), over(user, "_agains")))
    users = _user_order_features(orders_clean).join(train_users(orders), "user_id", "left_semi").withColumn("_kept", F.lit(True))
    # products count all pairs, those of users that are left out as well
    both = up.join(users, "user_id", "left")
    return both.select(
        "*", over(product, "up_orders").alias("p_total_purchases"),
        mean(over(product, "_again"), over(product, "_agains")).alias("p_reorder_rate"),
        F.count("user_id").over(product).alias("p_unique_users"),
        mean(over(product, "_cart"), over(product, "_carts")).alias("p_avg_cart_pos"),
        mean(F.col("_cart"), F.col("_carts")).alias("up_avg_cart_pos"),
    ).where(F.col("_kept") & F.col("product_id").isNotNull()).withColumn("_hit", F.nullif("_hit", F.lit(0)))


def reorder_features(orders: DataFrame, order_products: DataFrame, orders_clean: DataFrame, bounded: bool = False) -> DataFrame:
    """Every prior (user, product) pair of a user with a train order, with the 14
    features and the target (the pair appears in the user's train order).

    Pair aggregates meet the train pairs first (both are keyed by (user, product), so
    that join needs no further exchange of the pair table), then the per-user features
    on user_id and the per-product features on product_id; AQE turns the product join
    into a broadcast when the measured product table is small.  ``bounded`` where no user and no
    product has too many lines for one window: rows then move only once by user and once by product.
    """
    if bounded:
        df = _pairs_in_two_exchanges(orders, order_products, orders_clean)
    else:
        prior = prior_lines(order_products, orders)
        up = user_product_features(prior)
        target = train_pairs(order_products, orders).withColumn("_hit", F.lit(1))
        df = (up.join(target, ["user_id", "product_id"], "left")
              .join(train_users(orders), "user_id", "left_semi")
              .join(user_features(orders_clean, prior), "user_id")
              .join(product_features(prior), "product_id"))
    tenure = F.col("u_total_orders") - F.col("up_first_order_number") + 1
    df = df.select(
        "user_id", "product_id",
        "u_total_orders", "u_avg_basket", "u_avg_dspo", "u_reorder_rate",
        "p_total_purchases", "p_reorder_rate", "p_unique_users", "p_avg_cart_pos",
        "up_orders", "up_avg_cart_pos",
        (F.col("up_orders").cast("double") / F.col("u_total_orders")).alias("up_order_rate"),
        (F.col("u_total_orders") - F.col("up_last_order_number")).alias("up_orders_since_last"),
        tenure.alias("up_tenure_orders"),
        F.try_divide(F.col("up_orders").cast("double"), F.nullif(tenure, F.lit(0))).alias("up_purchase_rate"),
        F.when(F.col("_hit").isNotNull(), 1).otherwise(0).alias("reordered_target"))
    return df.na.fill(0, subset=fixed.FEATURES)


def base_rate(features: DataFrame) -> DataFrame:
    """size of the feature matrix and its positive rate."""
    return features.agg(F.count(F.lit(1)).alias("rows"),
                        F.avg(F.col("reordered_target").cast("double")).alias("positive_rate"))
