"""CSV sources in the market-basket layout, the price fallback, and the sinks."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

from basketry.operators import clean
from basketry.sources import files, prices


def _write(dirpath, name, text):
    with open(os.path.join(dirpath, name), "w") as fh:
        fh.write(text)


def _raw_dir(tmp_path, with_prices: bool, aisle_extra: bool):
    d = str(tmp_path)
    _write(d, "departments.csv", "department_id,department\n1,dairy\n2,pantry\n")
    _write(d, "aisles.csv", "aisle_id,aisle,department_id\n1,milk,1\n" if aisle_extra else "aisle_id,aisle\n1,milk\n")
    _write(d, "products.csv", "product_id,product_name,aisle_id,department_id\n1,a,1,1\n2,b,1,2\n")
    if with_prices:
        _write(d, "product_prices.csv", "product_id,price\n1,2.99\n2,0.50\n")
    _write(d, "orders.csv", "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
                            "1,7,prior,1,0,9,\n2,7,train,2,3,10,4.0\n")
    _write(d, "order_products__prior.csv", "order_id,product_id,add_to_cart_order,reordered\n1,1,1,0\n1,2,2,0\n")
    _write(d, "order_products__train.csv", "order_id,product_id,add_to_cart_order,reordered\n2,1,1,1\n")
    return d


def test_read_panel_with_prices_and_plain_aisles(spark, tmp_path):
    p = files.read_panel(spark, _raw_dir(tmp_path, True, False))
    assert p.aisles.columns == ["aisle_id", "aisle"]
    assert dict(p.product_prices.collect()) == {1: Decimal("2.99"), 2: Decimal("0.50")}
    gaps = {r.order_id: r.days_since_prior_order for r in p.orders.collect()}
    assert gaps == {1: None, 2: 4.0}  # empty field -> NULL
    ev = {(r.order_id, r.product_id): r.eval_set for r in p.order_products.collect()}
    assert ev == {(1, 1): "prior", (1, 2): "prior", (2, 1): "train"}


def test_read_panel_derives_missing_prices_and_extra_aisle_column(spark, tmp_path):
    p = files.read_panel(spark, _raw_dir(tmp_path, False, True))
    assert p.aisles.columns == ["aisle_id", "aisle"]
    got = dict(p.product_prices.collect())
    for pid, price in got.items():
        assert price % 1 == Decimal("0.99")
        base = 2 + (1 if pid == 1 else 2) % 7
        assert Decimal(int(base * 0.5)) + Decimal("0.99") <= price <= Decimal(int(base * 4.0)) + Decimal("0.99")
    again = dict(prices.derived_prices(p.products.repartition(3)).collect())
    assert again == got  # a pure function of the product


def test_sinks_round_trip(spark, tmp_path):
    p = files.read_panel(spark, _raw_dir(tmp_path, True, False))
    oc = clean.orders_clean(p.orders, p.order_products, p.product_prices)
    out = str(tmp_path / "orders_clean")
    assert files.write_table(oc, out, cluster_by=["user_id", "order_number"]) == 2
    assert files.write_table(oc, out) == 2  # replaced
    assert files.write_table(oc, out, mode="append") == 4
    csv = str(tmp_path / "extract")
    files.write_csv(oc.select("order_id", "order_value"), csv, order_by=["order_id"])
    parts = [f for f in os.listdir(csv) if f.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(csv, parts[0])) as fh:
        assert fh.read().splitlines() == ["order_id,order_value", "1,3.49", "2,2.99"]
    js = str(tmp_path / "report")
    files.write_json_document(oc.select(F.to_json(F.struct("order_id")).alias("j")).limit(1), js)
    assert any(f.startswith("part-") for f in os.listdir(js))


def test_panel_views_for_sql(spark, tmp_path):
    p = files.read_panel(spark, _raw_dir(tmp_path, True, False)).register(prefix="t_")
    got = spark.sql("SELECT eval_set, count(*) AS n FROM t_order_products GROUP BY eval_set ORDER BY eval_set").collect()
    assert [(r.eval_set, r.n) for r in got] == [("prior", 2), ("train", 1)]
    assert spark.table("t_orders").count() == 2


def test_prices_survive_a_path_with_a_scheme(spark, tmp_path):
    p = files.read_panel(spark, "file://" + _raw_dir(tmp_path, True, False))
    assert dict(p.product_prices.collect()) == {1: Decimal("2.99"), 2: Decimal("0.50")}


def test_ids_beyond_32_bits(spark, tmp_path):
    d = _raw_dir(tmp_path, False, False)
    _write(d, "orders.csv", "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
                            "5000000000,6000000000,prior,1,0,9,\n")
    o = files.read_panel(spark, d).orders.first()
    assert (o.order_id, o.user_id) == (5000000000, 6000000000)
