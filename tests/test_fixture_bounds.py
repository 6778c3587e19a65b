"""Boundary cases of FIXTURES.md §3: HAVING / LIMIT cut, band thresholds, fan-out."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import dashboard, extracts, features, rfm


def test_product_loyalty_having_and_limit(spark):
    # product 0 is bought 19 times, product 1 exactly 20, products 2..201 20 or more:
    # 201 qualify, LIMIT keeps 200; ties on (rate, purchases) fall back to product_id
    lines, orders = [], []
    oid = 0
    for pid in range(202):
        n = 19 if pid == 0 else 20 + (pid % 3)
        for k in range(n):
            oid += 1
            orders.append((oid, 1000 + k, "prior", 1))
            lines.append((oid, pid, 1, k % 2, "prior"))
    o = spark.createDataFrame(orders, "order_id long, user_id long, eval_set string, order_number int")
    op = spark.createDataFrame(lines, "order_id long, product_id long, add_to_cart_order int, reordered int, eval_set string")
    products = spark.createDataFrame([(p, f"p{p}", 1, 1) for p in range(202)],
                                     "product_id long, product_name string, aisle_id int, department_id int")
    depts = spark.createDataFrame([(1, "d")], "department_id int, department string")
    full = extracts.product_loyalty(op, o, products, depts, k=None).collect()
    assert len(full) == 201 and min(r.times_purchased for r in full) == 20
    top = extracts.product_loyalty(op, o, products, depts).collect()
    assert len(top) == 200
    assert [r.product_id for r in top] == [r.product_id for r in full][:200]


def test_loyalty_band_thresholds(spark):
    df = spark.createDataFrame([("a", 0.62), ("b", 0.6199), ("c", 0.56), ("d", 0.5599)],
                               "department string, reorder_rate double")
    got = {r.department: r.loyalty_band for r in dashboard.department_bands(df).collect()}
    assert got == {"a": "High", "b": "Medium", "c": "Medium", "d": "Low"}


def test_two_train_orders_do_not_fan_out_candidates(spark):
    orders = spark.createDataFrame(
        [(1, 1, "prior", 1), (2, 1, "train", 2), (3, 1, "train", 3)],
        "order_id long, user_id long, eval_set string, order_number int")
    lines = spark.createDataFrame(
        [(1, 10, 1, 0, "prior"), (2, 10, 1, 1, "train"), (3, 10, 1, 1, "train")],
        "order_id long, product_id long, add_to_cart_order int, reordered int, eval_set string")
    pairs = features.train_pairs(lines, orders)
    assert pairs.count() == 1
    oc = (orders.withColumn("order_dow", F.lit(0)).withColumn("order_hour_of_day", F.lit(0))
          .withColumn("days_since_prior_order", F.lit(None).cast("double"))
          .withColumn("basket_size", F.lit(1)).withColumn("order_value", F.lit(1).cast("decimal(10,2)"))
          .withColumn("reordered_items", F.lit(0)))
    f = features.reorder_features(orders, lines, oc).collect()
    assert len(f) == 1 and f[0].reordered_target == 1


def test_two_train_orders_are_an_error_for_recency(spark):
    rows = [(1, 1, "prior", 1.0), (2, 1, "train", 2.0), (3, 1, "train", 3.0)]
    oc = (spark.createDataFrame(rows, "order_id long, user_id long, eval_set string, days_since_prior_order double")
          .withColumn("basket_size", F.lit(1)).withColumn("order_value", F.lit(1).cast("decimal(10,2)")))
    with pytest.raises(ValueError):
        rfm.rfm_raw(oc)
    assert rfm.rfm_raw(oc.where("order_id < 3")).first().recency == 2.0
