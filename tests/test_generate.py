import pytest
from pyspark.sql import functions as F

from tidewater.contracts import CONTRACTS
from tidewater.sources import files
from tidewater.sources.generate import FEEDS, FeedSizes, generate, write_feeds

SIZES = FeedSizes(customers=20, products=12, stores=3, suppliers=4, orders=60)


def test_feeds_hang_together(spark):
    feeds = generate(spark, FeedSizes(**{**SIZES.__dict__, "defects": False}))
    n = {k: v.count() for k, v in feeds.items()}
    assert (n["customers"], n["orders"], n["payments"], n["customer_events"], n["inventory_events"], n["promotions"]) == (20, 60, 60, 180, 36, 5)
    assert 60 <= n["order_items"] <= 240 and n["shipments"] == feeds["orders"].where("channel <> 'STORE'").count() and n["returns"] > 0
    for name in FEEDS:
        assert feeds[name].columns == [c for c, _ in CONTRACTS[name].columns], name
    orders, items = feeds["orders"], feeds["order_items"]
    assert orders.where("net_amount <> gross_amount + tax_amount + shipping_amount - discount_amount OR (store_id IS NULL) = (channel = 'STORE')").count() == 0
    assert items.where("line_amount <> quantity * unit_price - discount_amount + tax_amount").count() == 0
    sums = items.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("g"), F.sum("tax_amount").alias("t"))
    assert orders.join(sums, "order_id").where("g = gross_amount AND t = tax_amount").count() == 60
    assert items.join(feeds["products"], "product_id").where("unit_price = list_price").count() == n["order_items"]
    assert orders.join(feeds["customers"], "customer_id", "left_anti").count() == 0 and orders.where("store_id IS NOT NULL").join(feeds["stores"], "store_id", "left_anti").count() == 0
    assert feeds["returns"].join(items, ["order_item_id", "order_id", "product_id"]).where("return_quantity <= quantity").count() == n["returns"]


def test_same_rows_whatever_the_tasks_and_other_rows_for_another_seed(spark):
    a, b = (sorted(map(tuple, generate(spark, SIZES)["orders"].collect())) for _ in range(2))
    c = sorted(map(tuple, generate(spark, FeedSizes(**{**SIZES.__dict__, "seed": 7}))["orders"].collect()))
    assert a == b != c


def test_written_feeds_are_read_by_the_sources(spark, tmp_path):
    report = write_feeds(spark, f"file://{tmp_path}", SIZES)
    assert len(report["injected_issues"]) == 13 and report["record_counts"]["customers"] == 21
    assert write_feeds(spark, f"file://{tmp_path}", SIZES) == report
    rows = spark.read.schema(", ".join(f"`{c}` string" for c, _ in CONTRACTS["customers"].columns)).option("header", True).csv(f"{report['folder']}/customers")
    assert rows.where("email = 'invalid-email'").count() == 1
    lines = [x for x in (tmp_path / f"batch_id={SIZES.batch_id}" / "customer_events").glob("*.json") for x in x.read_text().splitlines()]
    assert sum("unexpected_field" in x for x in lines) == 1
    assert files.load_config(tmp_path / f"batch_id={SIZES.batch_id}" / "generation_report.json")["batch_id"] == SIZES.batch_id


def test_sizes_are_checked():
    with pytest.raises(ValueError):
        FeedSizes(orders=0)
