"""What the large queries leave on disk while they run: no wide copies of what they only sum or publish."""

import pytest
from pyspark.sql import functions as F

from tidewater.contracts import NOT_APPLICABLE, UNKNOWN
from tidewater.operators import marts
from tidewater.operators.scd import member_key
from tidewater.plans import reference
from tidewater.sources.store import SnapshotStore


def _no_fact(spark, d, name):
    raise AssertionError(f"{name} is written whole")


def test_published_tables_are_moved_not_copied(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}")
    for n in (3, 5):  # the second takes the place of the first
        store.write("staged_x", spark.range(n))
        store.take("x", "staged_x")
        assert store.read("x").count() == n and not store.exists("staged_x") and not (tmp_path / "staged_x").exists()
    assert len(list((tmp_path / "x").glob("v=*"))) == store.keep


def test_reconciliation_writes_no_fact(spark, folder, monkeypatch):
    monkeypatch.setattr(reference, "fact", _no_fact)
    assert {r.status for r in reference.reconciliation(spark, folder).collect()} == {"PASS"}


def test_reconciliation_sees_what_a_fact_repeats(spark):
    rows = spark.createDataFrame([(1,), (2,)], "m int")
    found = marts.reconcile([("a", rows, lambda: rows.unionByName(rows), "m", "m"), ("b", rows, rows, None, None)])
    assert {r.check_name: (r.published_rows, r.status) for r in found.collect()} == {"a": (4, "FAIL"), "b": (2, "PASS")}


def test_product_days_write_no_fact_and_equal_those_of_facts(spark, folder, monkeypatch):
    expected = marts.daily_product_sales(reference.fact(spark, folder, "fact_order_items"), reference.fact(spark, folder, "fact_returns"))
    monkeypatch.setattr(reference, "fact", _no_fact)
    found = reference.daily_product_sales(spark, folder).select(*expected.columns)
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def test_product_days_of_no_version_share_the_special_keys(spark):
    products = spark.createDataFrame([("k1", "A", "2020-01-01", "2020-06-30"), ("k2", "A", "2020-07-01", None), ("k3", "B", "2020-01-01", None)], "surrogate_key string, product_id string, f string, t string")
    products = products.select("surrogate_key", "product_id", F.to_timestamp("f").alias("valid_from"), F.to_timestamp("t").alias("valid_to"))
    sold = spark.createDataFrame([("A", "2020-02-01", 2), ("A", "2020-02-01", 3), ("A", "2020-08-01", 1), ("B", "2019-01-01", 4), ("A", "2019-01-01", 5), (None, "2020-02-01", 6), (None, "2020-02-01", 7), ("A", None, 8)], "product_id string, t string, quantity int")
    money = {m: F.lit(1).cast("decimal(18,2)") for m in ("gross_line_amount", "discount_amount", "line_amount")}
    sold = sold.withColumn("order_timestamp", F.to_timestamp("t")).withColumns(money)
    back = spark.createDataFrame([("A", "2020-02-01", 1)], "product_id string, t string, return_quantity int").withColumn("return_timestamp", F.to_timestamp("t")).withColumn("refund_amount", F.lit(2).cast("decimal(18,2)"))
    rows = marts.daily_product_sales_at(marts.product_moves(sold, back), products).collect()
    unknown, none = member_key("dim_product", UNKNOWN), member_key("dim_product", NOT_APPLICABLE)
    assert sorted((r.order_date_key, r.product_key, r.sold_units, r.returned_units) for r in rows) == sorted([(20200201, "k1", 5, 1), (20200801, "k2", 1, 0), (20190101, unknown, 9, 0), (20200201, none, 13, 0), (0, unknown, 8, 0)])
    assert [r.return_rate for r in rows if r.product_key == "k1"] == [pytest.approx(0.2)]
