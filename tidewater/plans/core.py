"""Queries of the general problems 1 to 6, over whole tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clean, is_removal, micros
from ..operators import bitemporal, exactly_once, history, orphans, rolling, slicing
from ..sources.fs import scratch, written
from ..sources.tables import table

DAY_US = 24 * slicing.HOUR_US

# ---- 1. references to records that do not exist ---------------------------------------------

#: child table, its id, reference column, referenced table (whose key has the reference's name)
REFERENCES = (
    ("retail_orders", "order_id", "customer_id", "customers"),
    ("order_items", "order_item_id", "order_id", "retail_orders"),
    ("order_items", "order_item_id", "product_id", "products"),
    ("payments", "payment_id", "order_id", "retail_orders"),
)


def _versions(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    t = table(spark, d, name)
    rows = t.select(clean(key).alias("key"), micros("updated_at").alias("u"), micros("_ingested_at").alias("g"), is_removal("cdc_operation").alias("gone"))
    return rows.where("u IS NOT NULL AND g IS NOT NULL")


def _orphans(spark: SparkSession, d: str, reasons: bool = False) -> DataFrame:
    versions = {(t, r): _versions(spark, d, t, r) for _, _, r, t in REFERENCES}
    # Periods of a table serve all references to it: written once.
    periods = {k: written(orphans.resolved_periods(v, ["key"], "u", "g", F.col("gone")), "p1-periods") for k, v in versions.items()}
    found = []
    for child, key, ref, parent in REFERENCES:
        # One row per child and reference; T is the child's first delivery.
        c = table(spark, d, child).select(clean(key).alias("child_id"), clean(ref).alias("ref"), micros("_ingested_at").alias("at")).where("child_id IS NOT NULL")
        counted = c.select("ref", F.col("at").alias("first_at"), F.xxhash64("child_id").alias("__tie"))
        c = c.groupBy("child_id").agg(F.min("at").alias("first_at"), F.max("ref").alias("ref"))
        lost = orphans.find_orphans(c, periods[parent, ref], [("ref", "key")], orphans.SIMPLE, orphans.AsOf("first_at"), counted=counted)
        if reasons:
            lost = orphans.orphan_reasons(lost, versions[parent, ref], periods[parent, ref], ("ref", "key"), "first_at", "g")
        found.append(lost.select(F.lit(child).alias("child_table"), "child_id", F.lit(ref).alias("ref_field"), "ref", "first_at", *(["reason"] if reasons else [])))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("child_table", "child_id", "ref_field")


def p1_orphans_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field and month of first delivery, with the number of distinct lost keys."""
    month = F.date_format(F.timestamp_micros("first_at"), "yyyy-MM").alias("period")
    return _orphans(spark, d).groupBy("child_table", "ref_field", month).agg(F.count(F.lit(1)).alias("orphans"), F.count_distinct("ref").alias("lost_keys"))


def p1_orphan_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field and month by what became of the key: missing, removed, arrived later."""
    month = F.date_format(F.timestamp_micros("first_at"), "yyyy-MM").alias("period")
    return _orphans(spark, d, True).groupBy("child_table", "ref_field", month, "reason").agg(F.count(F.lit(1)).alias("orphans"))


def p1_composite(spark: SparkSession, d: str) -> DataFrame:
    """Payments whose (order, payment method) no order has, under each match semantics and per null mask."""
    refs = [("order_id", "order_id"), ("payment_method", "payment_method")]
    pair = lambda name: table(spark, d, name).select(*[clean(c).alias(c) for c, _ in refs])
    child, parent = pair("payments"), pair("retail_orders")
    out = None
    for match in (orphans.SIMPLE, orphans.FULL, orphans.PARTIAL):
        lost = orphans.find_orphans(child, parent, refs, match).groupBy(F.lit(match).alias("match_semantics"), "null_mask").agg(F.count(F.lit(1)).alias("orphans"))
        out = lost if out is None else out.unionByName(lost)
    return out


# ---- 2. history of changing attributes ------------------------------------------------------

DIMENSIONS = {
    "dim_customer": ("customers", "customer_id", ("loyalty_tier", "customer_status", "city")),
    "dim_product": ("products", "product_id", ("list_price", "unit_cost", "product_status", "category", "subcategory")),
    "dim_store": ("stores", "store_id", ("store_status", "store_type", "region")),
}


def dimension_observations(spark: SparkSession, d: str, dim: str, delivered: Column | None = None) -> DataFrame:
    """Observations of a dimension's feed, or of those of its rows for which ``delivered`` holds."""
    name, key, tracked = DIMENSIONS[dim]
    t = table(spark, d, name)
    t = t if delivered is None else t.where(delivered)
    kinds = dict(t.dtypes)
    cols = {c: clean(c) if kinds[c] == "string" else F.col(c) for c in tracked}
    return history.observations(t, clean(key), micros("updated_at"), micros("_ingested_at"), is_removal("cdc_operation"), cols)


#: Deliveries up to here form the first merge of the dimensions, later ones the second.
MERGE_CUT = "2025-03-01 00:00:00"


def _dimension(spark: SparkSession, d: str, dim: str) -> DataFrame:
    """The dimension after two deliveries are merged, early and late by arrival."""
    late = F.coalesce(F.col("_ingested_at") >= F.lit(MERGE_CUT).cast("timestamp_ntz"), F.lit(False))
    store = history.HistoryStore(spark, scratch(spark, f"p2-{dim}"))
    for part in (~late, late):
        store.deliver(dimension_observations(spark, d, dim, part))
    kept = store.read()
    return history.versions(dimension_observations(spark, d, dim).limit(0)) if kept is None else kept


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    # One dimension after the other: side by side their plans would fill a small driver.
    parts = [_dimension(spark, d, dim).select(F.lit(dim).alias("dim_name"), "business_key", "valid_from_us", "valid_to_us") for dim in DIMENSIONS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_dim_customer(spark: SparkSession, d: str) -> DataFrame:
    """The customer dimension with its attributes."""
    return _dimension(spark, d, "dim_customer").select("business_key", "loyalty_tier", "customer_status", "city", "valid_from_us", "valid_to_us", "is_current")


def p2_merged_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """The product dimension built by merging two deliveries, early and late by arrival; equals one delivery."""
    rows = dimension_observations(spark, d, "dim_product")
    cut = F.unix_micros(F.lit("2025-03-01 00:00:00").cast("timestamp"))
    early, late = rows.where(F.col("delivered_us") < cut), rows.where(F.col("delivered_us") >= cut)
    stored, dim = history.merge_history(None, None, early)
    stored = written(stored, "p2-observations")
    dim = written(dim, "p2-dimension")
    return history.merge_history(stored, dim, late)[1].select("business_key", "list_price", "product_status", "valid_from_us", "valid_to_us")


# ---- 3. attributes as known at event time ---------------------------------------------------


def _orders_as_known(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "retail_orders").select(clean("order_id").alias("order_id"), clean("customer_id").alias("customer_id"), micros("order_timestamp").alias("at_us"))
    o = o.where("order_id IS NOT NULL").groupBy("order_id").agg(F.max("customer_id").alias("customer_id"), F.max("at_us").alias("at_us"))
    c = table(spark, d, "customers").select(
        clean("customer_id").alias("customer_id"), micros("updated_at").alias("updated_us"), micros("_ingested_at").alias("ingested_us"),
        is_removal("cdc_operation").alias("removed"), *[clean(a).alias(a) for a in DIMENSIONS["dim_customer"][2]],
    )
    tie = F.struct("removed", F.coalesce("loyalty_tier", F.lit("")), F.coalesce("customer_status", F.lit("")), F.coalesce("city", F.lit("")))
    c = c.withColumn("tie", tie)
    return bitemporal.locate(o, c, "customer_id", "at_us", "at_us", "updated_us", "ingested_us", "tie")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    seen = _orders_as_known(spark, d).where("v_customer_id IS NOT NULL AND NOT v_removed")
    return seen.select("order_id", F.col("v_updated_us").alias("known_from_us"))


def p3_orders_with_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Every order with the attributes known at its time; NULL where none were or the customer was removed."""
    held = F.col("v_customer_id").isNotNull() & ~F.col("v_removed")
    return _orders_as_known(spark, d).select("order_id", "customer_id", *[F.when(held, F.col(f"v_{a}")).alias(a) for a in DIMENSIONS["dim_customer"][2]])


# ---- 4. late and out-of-order events --------------------------------------------------------

STREAMS = {"customer_events": "event_id", "inventory_events": "inventory_event_id"}


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Both streams' deliveries: dataset_name, id, hash, delivery_seq, batch (bigint), at (bigint us)."""
    parts = []
    for name, key in STREAMS.items():
        t = table(spark, d, name)
        batch = F.expr("try_cast(trim(_batch_id) AS bigint)").alias("batch")
        parts.append(t.select(F.lit(name).alias("dataset_name"), F.col(key).alias("message_id"), "_record_hash", "delivery_seq", batch, micros("event_timestamp").alias("at")))
    return parts[0].unionByName(parts[1])


def _lateness(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stream_settings").select("dataset_name", (F.col("allowed_lateness_hours").cast("bigint") * slicing.HOUR_US).alias("late_us"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    rows = deliveries(spark, d)
    # stream_settings has one row per stream; Spark broadcasts it by its measured size.
    log = slicing.pane_log(rows.join(_lateness(spark, d), "dataset_name"), "dataset_name", "batch", "at", DAY_US, F.col("late_us"))
    log = written(log, "p4-pane-log")
    states = slicing.pane_states(log, slicing.batch_cutoffs(log, "dataset_name", "batch", "top", F.col("late_us")), "dataset_name", "batch", DAY_US)
    first = slicing.first_deliveries(rows, "dataset_name", "message_id", "_record_hash", "delivery_seq", ["batch", "at"])
    return slicing.split_late(first, states, "dataset_name", "batch", "at", DAY_US)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).where("is_late").select("dataset_name", "delivery_seq")


def _day_panes(spark: SparkSession, d: str) -> DataFrame:
    rows = _judged(spark, d)
    took = {"events": F.when(~F.col("is_late"), 1), "too_late": F.when(F.col("is_late"), 1)}
    return slicing.panes(rows, ["dataset_name"], "at", DAY_US, took, "batch")


def p4_daily_totals(spark: SparkSession, d: str) -> DataFrame:
    """Messages per event day: those within the allowed lateness, and those too late."""
    p = slicing.merge_panes(None, _day_panes(spark, d).drop("batch"), ["dataset_name"], ["events", "too_late"])
    return p.select("dataset_name", "pane_us", "events", "too_late")


def p4_emissions(spark: SparkSession, d: str) -> DataFrame:
    """Each correction of each day's total, in order of the batches that brought it."""
    return slicing.emissions(_day_panes(spark, d), ["dataset_name"], "batch", ["events"])


def p4_weekly_windows(spark: SparkSession, d: str) -> DataFrame:
    """Seven-day windows that begin every day: formed from the panes of the earlier half of the batches, and
    recomposed where later batches changed a pane under them."""
    keys, took, size = ["dataset_name"], ["events"], 7 * DAY_US
    panes = written(_day_panes(spark, d), "p4-panes")
    middle = panes.agg(F.max("batch")).first()[0] or 0
    later = F.coalesce(F.col("batch") * 2 > F.lit(middle), F.lit(False))
    stored = slicing.merge_panes(None, panes.where(~later), keys, took)
    changed = slicing.merge_panes(None, panes.where(later), keys, took)
    again = slicing.compose(slicing.merge_panes(stored, changed, keys, took), changed, keys, took, size, DAY_US)
    return slicing.compose(stored, None, keys, took, size, DAY_US).join(again, [*keys, "window_us"], "left_anti").unionByName(again)


# ---- 5. messages delivered more than once ---------------------------------------------------


def _kept(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Takes the stream in as history and one later delivery, cut at the middle batch number."""
    rows = table(spark, d, name)
    key, batch = exactly_once.message_key(STREAMS[name], "_record_hash", "delivery_seq"), F.expr("try_cast(trim(_batch_id) AS bigint)")
    store = exactly_once.MessageStore(spark, scratch(spark, f"p5-{name}"), key, F.date_format("event_timestamp", "yyyy-MM-dd"), "delivery_seq")
    middle = rows.agg(F.max(batch)).first()[0] or 0
    late = F.coalesce(batch * 2 > F.lit(middle), F.lit(False))
    store.deliver(rows.where(~late))
    store.deliver(rows.where(late))
    kept = store.read()
    return rows.limit(0).withColumn("message_key", key) if kept is None else kept


def _all_kept(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The streams have stores of their own, so their deliveries run side by side."""
    with ThreadPoolExecutor(len(STREAMS)) as pool:
        return dict(zip(STREAMS, pool.map(lambda name: _kept(spark, d, name), STREAMS), strict=True))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, store in _all_kept(spark, d).items():
        kept = store.select(F.col("delivery_seq").alias("kept_seq"))
        rows = table(spark, d, name)
        again = rows.join(kept, rows["delivery_seq"] == kept["kept_seq"], "left_anti")
        parts.append(again.select(F.lit(name).alias("dataset_name"), "delivery_seq"))
    return parts[0].unionByName(parts[1])


def p5_messages_per_day(spark: SparkSession, d: str) -> DataFrame:
    """Kept messages and their event days, per stream."""
    day = F.coalesce(F.date_format("event_timestamp", "yyyy-MM-dd"), F.lit("none")).alias("event_day")
    parts = [kept.groupBy(F.lit(n).alias("dataset_name"), day).agg(F.count(F.lit(1)).alias("messages")) for n, kept in _all_kept(spark, d).items()]
    return parts[0].unionByName(parts[1])


# ---- 6. rolling totals over trailing periods ------------------------------------------------

WINDOWS = [1, 7, 30]


def counting_orders(spark: SparkSession, d: str, known_by: str | None = None) -> DataFrame:
    """(store_id, day, net_amount) of each order's newest row that is no removal, of rows delivered before ``known_by``."""
    t = table(spark, d, "retail_orders")
    if known_by:
        t = t.where(F.col("_ingested_at") < F.lit(known_by).cast("timestamp_ntz"))
    t = t.select(
        clean("order_id").alias("order_id"), micros("updated_at").alias("u"), micros("_ingested_at").alias("g"), is_removal("cdc_operation").alias("gone"),
        clean("store_id").alias("store_id"), F.to_date("order_timestamp").alias("day"), "net_amount",
    )
    newest = t.where("order_id IS NOT NULL").groupBy("order_id").agg(F.max(F.struct("u", "g", "gone", "net_amount", "store_id", "day")).alias("r"))
    return newest.where("NOT r.gone AND r.store_id IS NOT NULL AND r.day IS NOT NULL").select("r.store_id", "r.day", "r.net_amount")


#: Rows delivered before this form the state; all later ones go into it as corrections and further days.
STATE_CUT = "2025-04-01 00:00:00"


def _rolling(spark: SparkSession, d: str, windows: list[int]) -> DataFrame:
    """The current state: version 0 built from the rows known by STATE_CUT, version 1 for all that came later."""
    keys = ["store_id"]
    then = written(rolling.daily(counting_orders(spark, d, STATE_CUT), keys, "day", F.col("net_amount")), "p6-then")
    now = written(rolling.daily(counting_orders(spark, d), keys, "day", F.col("net_amount")), "p6-now")
    state = written(rolling.build(then, keys, windows, 0), "p6-state")
    fixed = written(rolling.correct(state, then, now, keys, windows, 1), "p6-corrections")
    return rolling.current(state.unionByName(fixed), keys).where("n IS NOT NULL")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _rolling(spark, d, WINDOWS).where("n = 0").select("store_id", F.date_format("day", "yyyyMMdd").cast("int").alias("sales_day"), "window_days")


def _report(state: DataFrame) -> DataFrame:
    per_day = lambda c: F.round(F.col(c).cast("double") / F.col("window_days"), 4)
    return state.select(
        "store_id", F.date_format("day", "yyyyMMdd").cast("int").alias("sales_day"), "window_days", F.col("amount").cast("decimal(28,2)").alias("revenue"), F.col("n").alias("orders"),
        per_day("amount").alias("revenue_per_day"), per_day("n").alias("orders_per_day"),
    )


def p6_trailing(spark: SparkSession, d: str) -> DataFrame:
    """Revenue and orders of the trailing 7 and 30 days per store and day, as totals and daily averages."""
    return _report(_rolling(spark, d, [7, 30]))


def p6_corrected(spark: SparkSession, d: str) -> DataFrame:
    """The same as p6_trailing, under its earlier name."""
    return p6_trailing(spark, d)


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_orphans_by_month, p1_orphan_reasons, p1_composite, p2_found, p2_dim_customer, p2_merged_deliveries, p3_found, p3_orders_with_attributes,
        p4_found, p4_daily_totals, p4_emissions, p4_weekly_windows, p5_found, p5_messages_per_day, p6_found, p6_trailing, p6_corrected,
    )
}
