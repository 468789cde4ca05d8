"""The batch path: staged file to raw rows, raw rows to current state, current state to facts and KPIs.

Each stage writes its result once and reads the written version, so no plan is computed twice and a
stage that failed can be run again.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import CONTRACTS, KPIS, RULES
from ..operators import facts, marts, scd
from ..operators.merge import merge_current_state, merge_upsert, sync_snapshot
from ..operators.quality import enforce, flag, load_rules, metrics, split, with_references
from ..operators.standardize import deduplicate_latest, standardize, with_lineage
from ..sources.files import scan
from ..sources.fs import release
from ..sources.store import SnapshotStore
from ..sources.tables import small


@dataclass(frozen=True)
class SilverReport:
    dataset: str
    rows_read: int
    duplicates: int
    accepted: int
    quarantined: int


def ingest(store: SnapshotStore, manifest: dict, run_id: str, batch_id: str) -> dict:
    """Takes a staged file in, once per content; returns its rows and how many do not parse."""
    name = manifest["source_name"]
    if missing := {"path", "sha256", "file_size"} - manifest.keys():
        raise ValueError(f"manifest lacks {', '.join(sorted(missing))}")
    rows = scan(store.spark, manifest["path"], [n for n, _ in CONTRACTS[name].columns])
    store.append_once(f"bronze_{name}", with_lineage(rows, name, run_id, batch_id, manifest["sha256"]), manifest["sha256"])
    written = store.spark.read.parquet(f"{store.root}/bronze_{name}/token={manifest['sha256']}")
    n = written.agg(F.count(F.lit(1)).alias("rows"), F.count("_corrupt_record").alias("corrupt")).first()
    return {"dataset": name, "rows": n["rows"], "corrupt": n["corrupt"]}


def run_silver(store: SnapshotStore, name: str, raw: DataFrame, run_id: str) -> SilverReport:
    """Standardizes, keeps the newest row per key, applies the rules, merges what passes and stores the rest.

    Deduplication goes before the rules, so a bad newest version hides a good older one.
    """
    c = CONTRACTS[name]
    rules = load_rules(RULES, name)
    tables = {r.reference[0]: store.read(f"silver_{r.reference[0]}") for r in rules if r.reference}
    if lost := [n for n, t in tables.items() if t is None]:
        raise ValueError(f"{name} needs {', '.join(lost)} first")
    typed = standardize(raw, c)
    kept = deduplicate_latest(typed, list(c.keys), c.event_time)
    joined, plain = with_references(kept, rules, tables)
    store.write(f"judged_{name}", flag(joined, plain).withColumn("_quality_run_id", F.lit(run_id)))
    judged = store.read(f"judged_{name}")
    measured = metrics(judged, plain).withColumn("run_id", F.lit(run_id))
    store.append_once("quality_metrics", measured, f"{name}-{run_id}")
    enforce(measured, plain)
    good, bad = split(judged)
    store.append_once(f"quarantine_{name}", bad.withColumn("_quarantine_id", F.sha2(F.concat_ws("|", F.lit(name), *c.keys, "_silver_record_hash", F.lit(run_id)), 256)), run_id)
    store.write(f"silver_{name}", merge_current_state(store.read(f"silver_{name}"), good.drop("_quality_run_id"), list(c.keys), c.event_time, "_silver_record_hash", c.operation, check=False))
    counts = judged.agg(F.count(F.lit(1)).alias("n"), F.sum((F.size("_failed_rule_ids") > 0).cast("bigint")).alias("bad")).first()
    read = raw.count()
    return SilverReport(name, read, read - counts["n"], counts["n"] - (counts["bad"] or 0), counts["bad"] or 0)


def run_gold(store: SnapshotStore, dimensions: dict[str, DataFrame], orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Publishes sales and returns facts and daily KPIs, and returns the reconciliation of this run.

    Facts are checked against their sources before anything is published; a FAIL raises.
    """
    for name, dim in dimensions.items():
        store.write(name, dim)
    sales = facts.build_fact("fact_sales", orders, {n: store.read(n) for n in dimensions})
    back = facts.build_fact("fact_returns", facts.with_order_context(returns, orders, "return_timestamp"), {n: store.read(n) for n in dimensions})
    store.write("staged_fact_sales", sales)
    store.write("staged_fact_returns", back)
    sales, back = store.read("staged_fact_sales"), store.read("staged_fact_returns")
    result = marts.reconcile([("fact_sales", orders, sales, "net_amount", "net_amount"), ("fact_returns", returns, back, "refund_amount", "refund_amount")])
    store.write("reconciliation", result)
    result = store.read("reconciliation")
    if failed := [r.check_name for r in result.where("status = 'FAIL'").collect()]:  # one row per check
        raise RuntimeError(f"does not reconcile: {', '.join(failed)}")
    store.write("fact_sales", sync_snapshot(store.read("fact_sales"), sales, ["order_id"], check=False))
    store.write("fact_returns", sync_snapshot(store.read("fact_returns"), back, ["return_id"], check=False))
    store.write("retail_kpi_daily", marts.kpi_daily(store.read("fact_sales"), store.read("fact_returns")))
    store.write("dim_channel", scd.channel_dimension(store.spark))
    return result


def gold_sources(silver: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str, str | None]]:
    """Per fact: its source rows with all that the fact looks up, their key, and the amount that must reconcile."""
    orders = silver["orders"]
    context = lambda name, at: facts.with_order_context(silver[name], orders, at)
    late = {"delivery_days": F.datediff("delivered_timestamp", "shipped_timestamp"), "delivery_variance_days": F.datediff("delivered_timestamp", "expected_delivery_timestamp")}
    return {
        "fact_sales": (orders, "order_id", "net_amount"),
        "fact_order_items": (facts.order_lines(silver["order_items"], orders, silver["products"]), "order_item_id", "line_amount"),
        "fact_payments": (context("payments", "payment_timestamp"), "payment_id", "payment_amount"),
        "fact_returns": (context("returns", "return_timestamp"), "return_id", "refund_amount"),
        "fact_inventory_movements": (silver["inventory_events"], "inventory_event_id", None),
        "fact_shipments": (context("shipments", "shipped_timestamp").withColumns(late), "shipment_id", "shipping_cost"),
        "fact_customer_events": (silver["customer_events"], "event_id", None),
    }


def _side_by_side(tables: dict[str, Callable[[], DataFrame]], store: SnapshotStore, at_once: int = 4) -> None:
    """Writes tables that do not need each other, a few at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(lambda item: store.write(item[0], item[1]()), tables.items()))


def _one_by_one(tables: dict[str, Callable[[], DataFrame]], store: SnapshotStore) -> None:
    """Writes large tables one after the other, so the shuffle files of one are gone before the next."""
    for name, rows in tables.items():
        store.write(name, rows())
        release(store.spark)


def publish_gold(store: SnapshotStore, dimensions: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Publishes all dimensions, facts, aggregates and KPIs; returns the reconciliation of this run.

    ``silver`` has orders, order_items, products, payments, returns, shipments, promotions,
    inventory_events and customer_events; ``dimensions`` the four type-two ones. Facts are written
    aside and checked against their sources first, so a FAIL raises before anything that readers see
    has changed. Facts and dimensions written aside are whole snapshots and take the place of those
    published before by being moved, so there is one copy of each; aggregates are formed anew from them.
    """
    spark = store.spark
    for name, dim in (dimensions | {"dim_promotion": scd.promotion_dimension(silver["promotions"]), "dim_channel": scd.channel_dimension(spark)}).items():
        store.write(f"staged_{name}", dim)
    held = {n: small(store.read(f"staged_{n}")) for n in dimensions}
    sources = gold_sources(silver)

    def built(name: str) -> DataFrame:
        rows = sources[name][0]
        if name == "fact_order_items":  # customers and stores are looked up once per order, by fact_sales
            lines = facts.order_lines(silver["order_items"], store.read("staged_fact_sales"), silver["products"])
            rows = facts.attribute_promotion(lines, store.read("staged_dim_promotion"), "order_item_id", "order_timestamp")
        return facts.build_fact(name, rows, held)

    _one_by_one({f"staged_{name}": lambda name=name: built(name) for name in sources}, store)
    checks = [(name, rows, store.read(f"staged_{name}"), amount, amount) for name, (rows, _, amount) in sources.items()]
    store.write("reconciliation", marts.reconcile(checks))
    result = store.read("reconciliation")
    if failed := [r.check_name for r in result.where("status = 'FAIL'").collect()]:  # one row per check
        raise RuntimeError(f"does not reconcile: {', '.join(failed)}")
    for name in (*dimensions, "dim_promotion", "dim_channel", *sources):
        store.take(name, f"staged_{name}")
    fact = {n: store.read(n) for n in sources}
    times = [("fact_sales", "order_timestamp"), ("fact_payments", "payment_timestamp"), ("fact_returns", "return_timestamp"), ("fact_shipments", "delivered_timestamp"), ("fact_inventory_movements", "event_timestamp"), ("fact_customer_events", "event_timestamp")]
    bounds = marts.calendar_bounds(*[fact[n].select(at) for n, at in times]).first()  # one row of two days
    formed = {
        "fact_inventory_snapshot": lambda: facts.inventory_snapshot(fact["fact_inventory_movements"]), "agg_daily_store_sales": lambda: marts.daily_store_sales(fact["fact_sales"]),
        "agg_daily_product_sales": lambda: marts.daily_product_sales(fact["fact_order_items"], fact["fact_returns"]), "agg_channel_funnel": lambda: marts.channel_funnel(fact["fact_customer_events"]),
        "agg_supplier_performance": lambda: marts.supplier_performance(fact["fact_order_items"]), "agg_promotion_performance": lambda: marts.promotion_performance(fact["fact_order_items"]),
        "retail_kpi_daily": lambda: marts.kpi_daily(fact["fact_sales"], fact["fact_returns"]), "kpi_catalog": lambda: spark.createDataFrame([(n, ",".join(g), t, m) for n, g, t, m in KPIS], "kpi string, grain string, source string, meaning string"),
    }
    if bounds["first_date"]:
        formed["dim_date"] = lambda: scd.date_dimension(spark, bounds["first_date"], bounds["last_date"])
    _one_by_one(formed, store)
    _side_by_side({"agg_inventory_health": lambda: marts.inventory_health(store.read("fact_inventory_snapshot")), "retail_kpi_monthly": lambda: marts.kpi_monthly(store.read("retail_kpi_daily"))}, store)
    return result


#: What publish_gold leaves behind.
PUBLISHED = (
    "dim_customer", "dim_product", "dim_store", "dim_supplier", "dim_promotion", "dim_channel", "dim_date", "fact_sales", "fact_order_items", "fact_payments", "fact_returns", "fact_inventory_movements", "fact_shipments",
    "fact_customer_events", "fact_inventory_snapshot", "agg_daily_store_sales", "agg_daily_product_sales", "agg_channel_funnel", "agg_inventory_health", "agg_supplier_performance", "agg_promotion_performance",
    "retail_kpi_daily", "retail_kpi_monthly", "kpi_catalog",
)


def record_run(store: SnapshotStore, run_id: str, status: str, counts: dict[str, int]) -> None:
    """One row per run in pipeline_runs; running a stage again replaces its row."""
    row = store.spark.createDataFrame([(run_id, status, sum(counts.values()), ",".join(f"{k}={v}" for k, v in sorted(counts.items())))], "run_id string, status string, total_rows bigint, detail string").withColumn("completed_at", F.current_timestamp())
    store.write("pipeline_runs", merge_upsert(store.read("pipeline_runs"), row, "run_id", check=False))
