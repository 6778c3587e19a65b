"""Hand-built edge cases (FIXTURES.md §3) with hand-computed expectations."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import clean, extracts, features, quality, rfm, views
from basketry.sources.panel import Panel

ORDERS = [  # order_id, user_id, eval_set, order_number, dow, hour, gap
    (1, 1, "prior", 1, 0, 9, None), (2, 1, "prior", 2, 1, 10, 31.0), (3, 1, "train", 3, 2, 11, -1.0),
    (4, 2, "prior", 1, 3, 12, None), (5, 2, "train", 2, 4, 13, 0.0),  # order 5 has no lines
    (6, 3, "train", 1, 5, 14, None),  # user with a single order
    (7, 4, "prior", 1, 6, 15, None), (8, 4, "prior", 2, 0, 16, None), (9, 4, "train", 3, 1, 17, 30.0),
]
LINES = [  # order_id, product_id, add_to_cart_order, reordered, eval_set
    (1, 1, 1, 0, "prior"), (1, 2, 2, 0, "prior"),
    (2, 1, 1, 1, "prior"), (2, 4, 2, 0, "prior"),
    (3, 1, 1, 1, "train"), (3, 3, 2, 0, "train"),
    (4, 4, 1, 0, "prior"),
    (6, 5, 1, 0, "train"),
    (7, 2, 1, 0, "prior"),
    (8, 2, 1, 1, "prior"), (8, 5, 2, 0, "prior"),
    (9, 2, 1, 1, "train"),
]
PRODUCTS = [(1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 1, 2), (4, "d", 1, 2), (5, "e", 1, 2)]
PRICES = [(1, Decimal("2.00")), (2, Decimal("3.50")), (3, Decimal("0.00")), (5, Decimal("1.25"))]  # 4 unpriced

O_SCHEMA = ("order_id long, user_id long, eval_set string, order_number int, order_dow int, "
            "order_hour_of_day int, days_since_prior_order double")
L_SCHEMA = "order_id long, product_id long, add_to_cart_order int, reordered int, eval_set string"


@pytest.fixture(scope="module")
def panel(spark):
    return Panel(
        orders=spark.createDataFrame(ORDERS, O_SCHEMA),
        order_products=spark.createDataFrame(LINES, L_SCHEMA),
        products=spark.createDataFrame(PRODUCTS, "product_id long, product_name string, aisle_id int, department_id int"),
        departments=spark.createDataFrame([(1, "dairy"), (2, "pantry")], "department_id int, department string"),
        aisles=spark.createDataFrame([(1, "milk")], "aisle_id int, aisle string"),
        product_prices=spark.createDataFrame(PRICES, "product_id long, price decimal(8,2)"))


@pytest.fixture(scope="module")
def oc(panel):
    return clean.orders_clean(panel.orders, panel.order_products, panel.product_prices)


def test_orders_clean_values(oc):
    rows = {r.order_id: r for r in oc.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 6, 7, 8, 9]  # the empty order 5 is gone (inner join)
    assert rows[1].order_value == Decimal("5.50")
    assert rows[2].order_value == Decimal("2.00")  # unpriced line adds nothing
    assert rows[4].order_value == Decimal("0.00")  # all lines unpriced -> 0, not NULL
    assert rows[3].order_value == Decimal("2.00")  # price 0 counts as a priced line
    assert rows[2].days_since_prior_order == 30.0  # 31 clipped
    assert rows[3].days_since_prior_order == 0.0  # -1 clipped
    assert rows[1].days_since_prior_order is None  # NULL stays NULL
    assert rows[8].days_since_prior_order is None
    assert rows[8].basket_size == 2 and rows[8].reordered_items == 1


def test_order_value_view_drops_unpriced_lines(panel):
    v1 = {r.order_id: r for r in views.order_value_view(panel.orders, panel.order_products, panel.product_prices).collect()}
    assert 4 not in v1  # only unpriced lines: inner join removes the order
    assert v1[2].basket_size == 1 and v1[2].order_value == Decimal("2.00")


def test_rfm_segments(oc):
    r = {x.user_id: x for x in rfm.rfm_segments(oc).collect()}
    assert r[2].recency == 15.0 and r[3].recency == 15.0  # median of {0, 30}
    assert (r[1].R, r[1].F, r[1].M) == (5, 4, 4) and r[1].segment == "Champions"
    assert (r[2].R, r[2].F, r[2].M) == (4, 1, 1) and r[2].segment == "Promising"
    assert (r[3].R, r[3].F, r[3].M) == (2, 2, 2) and r[3].segment == "Hibernating"
    assert (r[4].R, r[4].F, r[4].M) == (1, 5, 5) and r[4].segment == "Can't Lose Them"
    assert r[1].avg_order_value == Decimal("3.17") and r[4].avg_order_value == Decimal("3.92")
    assert r[1].rfm_score == 13 and r[4].rfm_score == 11
    assert r[4].action == "Aggressive win-back; they were valuable."


def test_segment_summary_shares(oc):
    s = {x.segment: x for x in extracts.segment_summary(rfm.rfm_segments(oc)).collect()}
    assert sum(x.customers for x in s.values()) == 4
    assert s["Champions"].pct_customers == 25.0
    assert s["Can't Lose Them"].total_monetary == 11.75
    assert s["Can't Lose Them"].pct_revenue == 52.2  # 1175 of 2250 cents


def test_reorder_features(panel, oc):
    f = features.reorder_features(panel.orders, panel.order_products, oc)
    rows = {(r.user_id, r.product_id): r for r in f.collect()}
    assert sorted(rows) == [(1, 1), (1, 2), (1, 4), (2, 4), (4, 2), (4, 5)]
    assert rows[(1, 1)].reordered_target == 1 and rows[(4, 2)].reordered_target == 1
    assert rows[(1, 2)].reordered_target == 0
    assert rows[(2, 4)].u_avg_dspo == 0.0  # only prior order is the first: NULL -> 0
    assert rows[(4, 5)].u_avg_dspo == 0.0
    assert rows[(1, 1)].u_avg_dspo == 30.0 and rows[(1, 1)].u_total_orders == 2
    assert rows[(1, 2)].up_purchase_rate == 0.5 and rows[(1, 1)].up_tenure_orders == 2
    assert rows[(4, 2)].u_avg_basket == 1.5
    assert rows[(1, 1)].u_reorder_rate == pytest.approx(0.25)


def _dq_panel(spark, panel):
    orders = panel.orders.unionByName(spark.createDataFrame([(2, 1, "prior", 2, 1, 10, 31.0)], O_SCHEMA))
    lines = panel.order_products.unionByName(spark.createDataFrame(
        [(1, 1, 3, 0, "prior"), (1, 99, 4, 0, "prior"), (99, 1, 1, 0, "prior")], L_SCHEMA))
    return orders, lines


def test_quality_report(spark, panel):
    orders, lines = _dq_panel(spark, panel)
    r = quality.quality_checks(orders, lines, panel.products, panel.product_prices).first().asDict()
    assert r == {"duplicate_order_ids": 1, "duplicate_line_items": 1, "dspo_nulls_match_first_orders": False,
                 "dspo_out_of_range": 3, "orphan_product_refs": 1, "orphan_order_refs": 1,
                 "nonpositive_prices": 1, "orders_without_items": 1}
    doc = quality.quality_report_json(orders, lines, panel.products, panel.product_prices).first().report
    assert '"days_since_prior_order":5' in doc and '"duplicate_order_ids":1' in doc


def test_constraints_fail_the_load(spark, panel):
    orders, lines = _dq_panel(spark, panel)
    tables = {"departments": panel.departments, "aisles": panel.aisles, "products": panel.products,
              "product_prices": panel.product_prices, "orders": orders, "order_products": lines}
    v = {(r.table_name, r.constraint_name): r.violations for r in quality.constraint_violations(tables).collect()}
    assert v[("orders", "pk_order_id")] == 1
    assert v[("order_products", "pk_order_id_product_id")] == 1
    assert v[("order_products", "fk_order_id_orders")] == 1
    assert v[("order_products", "fk_product_id_products")] == 1
    assert v[("orders", "not_null_user_id")] == 0
    with pytest.raises(ValueError):
        quality.assert_constraints(quality.constraint_violations(tables))
    clean_tables = dict(tables, orders=panel.orders, order_products=panel.order_products)
    quality.assert_constraints(quality.constraint_violations(clean_tables))
