"""Fact tables. Each is described by what it is keyed by, which dimensions it meets, and what it keeps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import NOT_APPLICABLE, UNKNOWN
from ..functions.columns import date_key, surrogate_key
from .scd import channel_key, member_key, resolve_key

#: output key, dimension, business key
CUSTOMER = ("customer_key", "dim_customer", "customer_id")
STORE = ("store_key", "dim_store", "store_id")
PRODUCT = ("product_key", "dim_product", "product_id")
SUPPLIER = ("supplier_key", "dim_supplier", "supplier_id")


@dataclass(frozen=True)
class Fact:
    name: str
    key: str
    source_key: str
    day: tuple[str, str]  # output column, time it comes from
    meets: tuple[tuple[tuple[str, str, str], str], ...]  # dimension and the time at which it is looked up
    keeps: tuple[str, ...]
    channel: bool = True


FACTS = {
    f.name: f
    for f in (
        Fact("fact_sales", "sales_key", "order_id", ("order_date_key", "order_timestamp"), ((CUSTOMER, "order_timestamp"), (STORE, "order_timestamp")), ("order_timestamp", "channel", "order_status", "currency", "payment_method", "gross_amount", "discount_amount", "tax_amount", "shipping_amount", "net_amount", "order_count")),
        Fact("fact_order_items", "order_item_key", "order_item_id", ("order_date_key", "order_timestamp"), ((CUSTOMER, "order_timestamp"), (STORE, "order_timestamp"), (PRODUCT, "order_timestamp"), (SUPPLIER, "order_timestamp")), ("order_id", "promotion_key", "order_timestamp", "product_id", "supplier_id", "channel", "currency", "quantity", "unit_price", "gross_line_amount", "discount_amount", "tax_amount", "line_amount")),
        Fact("fact_payments", "payment_key", "payment_id", ("payment_date_key", "payment_timestamp"), ((CUSTOMER, "looked_up_at"), (STORE, "looked_up_at")), ("order_id", "payment_timestamp", "payment_status", "payment_method", "payment_amount", "transaction_reference")),
        Fact("fact_returns", "return_key", "return_id", ("return_date_key", "return_timestamp"), ((CUSTOMER, "looked_up_at"), (STORE, "looked_up_at"), (PRODUCT, "return_timestamp")), ("order_id", "order_item_id", "return_timestamp", "return_reason", "return_status", "return_quantity", "refund_amount")),
        Fact("fact_inventory_movements", "inventory_movement_key", "inventory_event_id", ("event_date_key", "event_timestamp"), ((PRODUCT, "event_timestamp"), (STORE, "event_timestamp")), ("event_timestamp", "event_type", "quantity_change", "quantity_on_hand", "reorder_level", "source_system"), False),
        Fact("fact_shipments", "shipment_key", "shipment_id", ("shipped_date_key", "shipped_timestamp"), ((CUSTOMER, "looked_up_at"), (STORE, "looked_up_at")), ("order_id", "shipped_timestamp", "expected_delivery_timestamp", "delivered_timestamp", "carrier", "shipment_status", "shipping_cost", "delivery_days", "delivery_variance_days")),
        Fact("fact_customer_events", "customer_event_key", "event_id", ("event_date_key", "event_timestamp"), ((CUSTOMER, "event_timestamp"), (PRODUCT, "event_timestamp")), ("session_id", "event_timestamp", "event_type", "device_type", "browser", "campaign_id", "source"), False),
    )
}


def meet(name: str, rows: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Rows with the keys of those of the fact's dimensions that are given; keys that rows have are kept."""
    for (out, dim, business_key), at in FACTS[name].meets:
        if dim in dimensions and out not in rows.columns:
            rows = resolve_key(rows, dimensions[dim], dim, business_key, business_key, at, out)
    return rows


def build_fact(name: str, rows: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Rows with their keys, day and kept columns; one row per row, unmatched ones with special keys."""
    fact = FACTS[name]
    rows = meet(name, rows, dimensions)
    day, moment = fact.day
    own: list[Column | str] = [surrogate_key(F.lit(name), fact.source_key).alias(fact.key), fact.source_key, *[m[0][0] for m in fact.meets]]
    if fact.channel:
        own.append(channel_key(F.col("channel")).alias("channel_key"))
    return rows.select(*own, date_key(F.col(moment)).alias(day), *fact.keeps)


def keyed_orders(orders: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Orders with customer_key and store_key as of their time, so their lines, of which there are more, need not look them up."""
    return meet("fact_sales", orders, dimensions)


def with_order(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose order is there, with the order's context."""
    wanted = ("order_id", "customer_id", "store_id", "channel", "order_status", "order_timestamp", "currency", CUSTOMER[0], STORE[0])
    context = orders.select(*[c for c in wanted if c in orders.columns])
    return items.join(context, "order_id")


def gross_line_amount() -> Column:
    return (F.col("unit_price") * F.col("quantity")).cast("decimal(18,2)").alias("gross_line_amount")


def with_supplier(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with the product's supplier where it is known."""
    return lines.join(products.select("product_id", "supplier_id"), "product_id", "left")


def order_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose order is there, with the order's context and, where known, the product's supplier."""
    return with_supplier(with_order(items, orders), products).select("*", gross_line_amount())


def attribute_promotion(lines: DataFrame, promotions: DataFrame, line_key: str, at: str) -> DataFrame:
    """Adds the promotion_key of the best promotion of the product on that day, else Not Applicable.

    Best is the greatest discount_percentage, then the smallest promotion_id. Promotions become
    disjoint periods of a product, each with its best, before lines meet them, so a product with many
    lines and promotions never multiplies the lines, and lines move by product once.
    """
    real = promotions.where(~F.col("promotion_id").isin(UNKNOWN, NOT_APPLICABLE))
    day = F.to_date(F.col(at))
    edges = real.where("start_date <= end_date").select(F.col("product_id").alias("__p"), F.explode(F.array("start_date", F.date_add("end_date", 1))).alias("__d")).where("__p IS NOT NULL").distinct()
    periods = edges.withColumn("__next", F.lead("__d").over(Window.partitionBy("__p").orderBy("__d")))
    covers = periods.join(real, (F.col("__p") == real["product_id"]) & (F.col("__d") >= real["start_date"]) & (F.col("__d") <= real["end_date"]))
    order = F.struct(F.col("discount_percentage").isNull().alias("a"), (-F.col("discount_percentage")).alias("b"), F.col("promotion_id").alias("c"))
    best = covers.groupBy("__p", "__d", "__next").agg(F.min_by("promotion_key", order).alias("__best"))
    joined = lines.join(best, (lines["product_id"] == best["__p"]) & (day >= best["__d"]) & (day < best["__next"]), "left")
    return joined.withColumn("promotion_key", F.coalesce("__best", F.lit(member_key("dim_promotion", NOT_APPLICABLE)))).drop("__p", "__d", "__next", "__best")


def with_order_context(rows: DataFrame, orders: DataFrame, own_time: str) -> DataFrame:
    """Left join of the order's customer, store, channel and time; a customer of its own goes first.

    ``looked_up_at`` is the order's time or, without an order, the row's own. Without an order the
    store is NULL and so becomes Not Applicable.
    """
    context = orders.select("order_id", F.col("customer_id").alias("__c"), F.col("store_id").alias("__s"), F.col("channel").alias("__ch"), F.col("order_timestamp").alias("__t"))
    mine = [F.col("customer_id")] if "customer_id" in rows.columns else []
    kept = rows.drop("store_id", "channel", "order_timestamp")
    out = kept.join(context, "order_id", "left")
    return out.withColumns({"customer_id": F.coalesce(*mine, F.col("__c")), "store_id": F.col("__s"), "channel": F.col("__ch"), "order_timestamp": F.col("__t"), "looked_up_at": F.coalesce("__t", own_time)}).drop("__c", "__s", "__ch", "__t")


def inventory_snapshot(movements: DataFrame) -> DataFrame:
    """The latest observation of each product and store, with stock flags."""
    rank = F.row_number().over(Window.partitionBy("product_key", "store_key").orderBy(F.col("event_timestamp").desc(), F.col("inventory_event_id").desc()))
    last = movements.withColumn("__rank", rank).where("__rank = 1")
    return last.select(
        surrogate_key("product_key", "store_key").alias("inventory_snapshot_key"), "product_key", "store_key", "event_date_key", F.col("event_timestamp").alias("snapshot_timestamp"), "quantity_on_hand", "reorder_level",
        (F.col("quantity_on_hand") == 0).alias("is_stockout"), (F.col("quantity_on_hand") <= F.col("reorder_level")).alias("is_below_reorder_level"),
    )
