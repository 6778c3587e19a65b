"""Tables that are replaced whole: failed writes, reruns, order, observed metrics; bucketed tables."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import clean, features, rfm
from basketry.sources import catalog, files, tables
from basketry.sources.star import star_panel


def rows(df):
    return sorted(map(tuple, df.collect()))


def folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("v"))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(100).withColumn("x", F.col("id") * 2)
    assert files.write_table(old, path) == 100
    bad = spark.range(100000).repartition(8).select("id", F.when(F.col("id") == 77777, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="midway"):
        files.write_table(bad, path)
    assert rows(tables.read_table(spark, path)) == rows(old)
    with pytest.raises(Exception, match="midway"):
        files.write_table(bad, path, mode="append")
    assert rows(tables.read_table(spark, path)) == rows(old) and len(folders(path)) > 1
    files.write_table(spark.range(3), path)  # the next good write removes what the failed ones left
    assert rows(tables.read_table(spark, path)) == [(0,), (1,), (2,)] and len(folders(path)) == 1
    assert len(os.listdir(os.path.join(path, "_manifests"))) <= 2  # and its checksum file


def test_a_failed_commit_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.write_table(spark.range(5), path)

    def broken(self, path, text):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables._Files, "publish", broken)
        with pytest.raises(OSError):
            files.write_table(spark.range(9), path)
    assert tables.read_table(spark, path).count() == 5
    assert files.write_table(spark.range(9), path) == 9 and len(folders(path)) == 1


def test_rerun_append_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    for _ in range(3):
        files.write_table(spark.range(4).repartition(2), path)
    assert len(folders(path)) == 1 and tables.read_table(spark, path).count() == 4
    assert files.write_table(spark.range(4, 6), path, mode="append") == 6
    assert rows(tables.read_table(spark, path)) == [(i,) for i in range(6)]
    with pytest.raises(ValueError):
        files.write_table(spark.range(1).withColumnRenamed("id", "other"), path, mode="append")
    assert tables.read_table(spark, path).count() == 6
    assert files.write_table(spark.range(0), path) == 0 and tables.read_table(spark, path).columns == ["id"]


def test_clustered_files_are_in_order_and_skippable(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("long").alias("u"), F.xxhash64("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        made = tables.write_table(hot, path, cluster_by=["u", "n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert made["rows"] == 30000 and len(made["files"]) > 1
    assert tuple(tables.order_breaks(spark, path, ["u", "n"]).first()) == (30000, 0)
    sizes = [r["count"] for r in tables.ordered_rows(spark, path).groupBy("_file").count().collect()]
    assert max(sizes) < 3 * 30000 / len(made["files"])  # the hot user's rows are spread
    tables.write_table(hot, path)
    assert tables.order_breaks(spark, path, ["u", "n"]).first()["breaks"] > 0


def test_metrics_come_from_the_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(50).mapInArrow(count, "id long")
    made = tables.write_table(df, str(tmp_path / "t"), observe={"odd": F.count_if(F.col("id") % 2 == 1), "top": F.max("id")})
    assert made["metrics"] == {"odd": 25, "top": 49} and made["rows"] == 50 and seen.value == 50


def test_bucketed_tables_join_without_exchange(spark):
    p = star_panel(spark, "/root/testdata/sf0.001")
    q = catalog.save_panel(p, "bucket_test", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prior = features.prior_lines(q.order_products, q.orders)
        plan = prior._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(prior) == rows(features.prior_lines(p.order_products, p.orders))
        catalog.save_table(prior, "bucket_test.prior_lines", "user_id", 4)
        lines = spark.table("bucket_test.prior_lines")
        oc = clean.orders_clean(p.orders, p.order_products, p.product_prices)
        catalog.save_table(oc, "bucket_test.orders_clean", "user_id", 4, sort_by=["user_id", "order_number"])
        orders_clean = spark.table("bucket_test.orders_clean")
        for made, plain in ((features.user_features(orders_clean, lines), features.user_features(oc, prior)),
                            (features.user_product_features(lines), features.user_product_features(prior)),
                            (rfm.frequency_monetary(orders_clean), rfm.frequency_monetary(oc))):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "Aggregate" in plan and "Exchange" not in plan
            assert rows(made) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_catalog_tables_are_replaced(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS replace_test")
    assert catalog.save_table(spark.range(10), "replace_test.t", "id", 4) == 10
    assert catalog.save_table(spark.range(3).withColumn("x", F.lit(1)), "replace_test.t") == 3
    assert spark.sql("SELECT sum(x) AS s FROM replace_test.t").first()["s"] == 3
    assert len([r for r in spark.sql("SHOW TABLES IN replace_test").collect() if r["tableName"].startswith("t__")]) == 1
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="midway"):
        catalog.save_table(bad, "replace_test.t")
    assert spark.table("replace_test.t").count() == 3


def test_a_hot_key_is_not_bucketed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS hot_test")
    hot = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("user_id"))
    catalog.save_table(hot, "hot_test.t", "user_id", 64)
    plan = spark.table("hot_test.t").groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and spark.table("hot_test.t").count() == 5000
