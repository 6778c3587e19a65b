"""End to end: every table and extract written for the smallest star panel."""

import os

from basketry.plans.batch import ORDERS_CLEAN_TYPES, write_all
from basketry.sources import tables
from basketry.sources.star import star_panel


def test_write_all(spark, tmp_path):
    p = star_panel(spark, "/root/testdata/sf0.001", grain="family")
    out = str(tmp_path / "out")
    counts = write_all(spark, p, out, gbt_rounds=3, check_keys=False, database="batch_test")
    assert counts["orders_clean"] > 0 and counts["reorder_features"] == counts["reorder_predictions"]
    for extract in ("segment_summary", "department_loyalty", "product_loyalty", "order_trends",
                    "department_opportunity", "rfm_segments", "reorder_predictions"):
        assert os.path.isdir(os.path.join(out, "extracts", extract)), extract
    seg = spark.read.option("header", True).csv(os.path.join(out, "extracts", "segment_summary"))
    assert sum(int(r.customers) for r in seg.collect()) == tables.read_table(spark, os.path.join(out, "tables", "rfm_segments")).count()
    metrics = spark.read.option("header", True).csv(os.path.join(out, "model_metrics")).collect()
    assert sorted(r.model for r in metrics) == ["GradientBoosting", "LogisticRegression"]
    report = spark.read.text(os.path.join(out, "data_quality_report")).first().value
    assert report.startswith('{"null_counts":{"orders":{"order_id":0')
    top = spark.sql("SELECT segment, count(*) AS n FROM batch_test.rfm_segments JOIN batch_test.orders_clean USING (user_id) GROUP BY segment")
    assert sum(r.n for r in top.collect()) == counts["orders_clean"]
    clean = os.path.join(out, "tables", "orders_clean")
    assert dict(tables.read_table(spark, clean).dtypes) == ORDERS_CLEAN_TYPES  # S12
    assert tuple(tables.order_breaks(spark, clean, ["user_id", "order_number"]).first()) == (counts["orders_clean"], 0)  # C5
