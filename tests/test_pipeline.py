from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.contracts import CONTRACTS
from tidewater.operators import retrieval
from tidewater.operators.exactly_once import MessageStore, message_key
from tidewater.plans import pipeline, reference
from tidewater.plans.roles import role
from tidewater.sources import files
from tidewater.sources.store import SnapshotStore
from tidewater.streaming.processor import StreamProcessor
from tidewater.streaming.sinks import exactly_once


def csv(path, rows):
    names = [n for n, _ in CONTRACTS["customers"].columns]
    path.write_text("\n".join([",".join(names), *[",".join(str(r.get(n, "")) for n in names) for r in rows]]) + "\n")
    return path


def test_file_to_current_state(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/lake")
    rows = [
        {"customer_id": "C1", "email": "a@b.de", "updated_at": "2025-01-01 00:00:00", "loyalty_tier": " gold "},
        {"customer_id": "C1", "email": "a@b.de", "updated_at": "2025-01-02 00:00:00", "loyalty_tier": "silver"},
        {"customer_id": "C2", "email": "broken", "updated_at": "2025-01-01 00:00:00"},
        {"customer_id": "C3", "email": "c@d.fr", "updated_at": "2025-01-01 00:00:00", "cdc_operation": "delete"},
    ]
    manifest = files.stage(csv(tmp_path / "c.csv", rows), tmp_path / "land", "customers")
    for _ in range(2):  # the same file again changes nothing
        assert pipeline.ingest(store, manifest, "r1", "b1") == {"dataset": "customers", "rows": 4, "corrupt": 0}
    raw = store.read_appended("bronze_customers")
    assert raw.count() == 4 and {"_record_hash", "_source_file_name", "_file_checksum", "_batch_id"} <= set(raw.columns)
    for run in ("r1", "r1", "r2"):
        report = pipeline.run_silver(store, "customers", raw, run)
        assert (report.rows_read, report.duplicates, report.accepted, report.quarantined) == (4, 1, 2, 1)
    assert [(r.customer_id, r.loyalty_tier) for r in store.read("silver_customers").collect()] == [("C1", "SILVER")]
    assert store.read_appended("quality_metrics").count() == 4
    with pytest.raises(ValueError, match="order_items"):
        pipeline.run_silver(store, "returns", raw, "r1")
    with pytest.raises(ValueError):
        pipeline.ingest(store, {"source_name": "customers"}, "r", "b")
    pipeline.record_run(store, "r1", "FAILED", {"customers": 4})
    pipeline.record_run(store, "r1", "SUCCEEDED", {"customers": 4})
    assert [r.status for r in store.read("pipeline_runs").collect()] == ["SUCCEEDED"]


def test_gold_is_published_only_if_it_reconciles(spark, folder, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}")
    dims = {n: reference.star_dimension(spark, folder, n) for n in ("dim_customer", "dim_store", "dim_product")}
    orders, returns = role(spark, folder, "orders"), role(spark, folder, "returns")
    assert {r.status for r in pipeline.run_gold(store, dims, orders, returns).collect()} == {"PASS"}
    k = store.read("retail_kpi_daily").agg(F.sum("gross_sales"), F.sum(F.col("net_revenue") - (F.col("gross_sales") + F.col("tax_revenue") + F.col("shipping_revenue") - F.col("discounts") - F.col("refunds")))).first()
    assert k[0] == orders.agg(F.sum("gross_amount")).first()[0] and k[1] == Decimal(0)
    before = store.read("fact_sales").count()
    with pytest.raises(RuntimeError):
        pipeline.run_gold(store, dims | {"dim_store": dims["dim_store"].unionByName(dims["dim_store"])}, orders, returns)  # overlapping versions fan out
    assert store.read("fact_sales").count() == before


def test_saved_index_finds_what_a_scan_finds(spark, folder, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").cast("string").alias("id"), "text")
    retrieval.save_index(store, "docs", docs, "id", F.col("text"))
    for question in ("refund queued for the zip", "zip", "the of", "nothing likely xyzzy"):
        a = retrieval.search(docs, "id", F.col("text"), question, 20).collect()
        b = retrieval.search_index(store, "docs", question, 20).collect()
        assert [(r.chunk_id, round(r.score, 5)) for r in a] == [(r.chunk_id, round(r.score, 5)) for r in b]


def test_serving_tables_and_exactly_once_sink(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    p = StreamProcessor(store, "customer_events", 48)
    names = [n for n, _ in CONTRACTS["customer_events"].columns]
    schema = ", ".join(f"`{n}` string" for n in names)
    row = lambda i, at, kind, s: tuple({"event_id": i, "event_timestamp": at, "event_type": kind, "session_id": s, "device_type": "MOBILE"}.get(n) for n in names)
    p(spark.createDataFrame([row("a", "2025-01-01 10:00:00", "PRODUCT_VIEW", "s1"), row("b", "2025-01-02 10:00:00", "PURCHASE", "s2")], schema), 0)
    p.serve(0)
    p(spark.createDataFrame([row("c", "2025-01-01 11:00:00", "PURCHASE", "s1")], schema), 1)  # late, within the limit
    got = {r.event_date_key: (r.eligible_sessions, r.purchase_sessions) for r in p.serve(1).collect()}
    assert got == {20250101: (1, 1), 20250102: (1, 1)}
    assert {r.events for r in p.daily().collect()} == {2, 1}
    messages = MessageStore(spark, f"file://{tmp_path}/m", message_key("id", "h", "seq"), F.col("day"), "seq")
    sink = exactly_once(messages)
    batch = spark.createDataFrame([("a", None, "d", 1), ("a", None, "d", 2)], "id string, h string, day string, seq bigint")
    sink(batch, 0)
    sink(batch, 0)
    assert [r.seq for r in messages.read().collect()] == [1]
