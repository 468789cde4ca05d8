"""Aggregates and KPIs over the facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import NOT_APPLICABLE, UNKNOWN
from ..functions.columns import date_key, safe_divide
from ..sources.fs import release, written
from .scd import member_key

MONEY = "decimal(28,2)"


def _sum(col: str, kind: str = MONEY) -> Column:
    return F.sum(col).cast(kind)


def daily_store_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date_key", "store_key", "channel_key").agg(
        F.count_distinct("order_id").alias("order_count"), _sum("gross_amount").alias("gross_sales"), _sum("discount_amount").alias("discounts"), _sum("net_amount").alias("order_revenue")
    )


def _side_by_side(sides: list[tuple[DataFrame, dict[str, Column]]], measures: dict[str, str]) -> DataFrame:
    """Rows of several frames under one set of columns; a measure that a side does not name is NULL there."""
    out = None
    for rows, named in sides:
        keys = [c.alias(n) for n, c in named.items() if n not in measures]
        one = rows.select(*keys, *[named.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in measures.items()])
        out = one if out is None else out.unionByName(one)
    return out


def daily_product_sales(items: DataFrame, returns: DataFrame) -> DataFrame:
    """Sold and returned per day and product; units of a missing side are 0, its money NULL.

    Lines and returns are rows of one frame that is aggregated once, so a day and product with a third
    of all rows is combined before the one shuffle, and no join follows.
    """
    measures = {"sold_units": "bigint", "gross_product_sales": MONEY, "product_discounts": MONEY, "product_revenue": MONEY, "returned_units": "bigint", "refund_amount": MONEY}
    c = F.col
    sold = {"order_date_key": c("order_date_key"), "product_key": c("product_key"), "sold_units": c("quantity"), "gross_product_sales": c("gross_line_amount"), "product_discounts": c("discount_amount"), "product_revenue": c("line_amount")}
    back = {"order_date_key": c("return_date_key"), "product_key": c("product_key"), "returned_units": c("return_quantity"), "refund_amount": c("refund_amount")}
    out = _side_by_side([(items, sold), (returns, back)], measures).groupBy("order_date_key", "product_key").agg(*[_sum(m, k).alias(m) for m, k in measures.items()])
    return out.fillna(0, ["sold_units", "returned_units"]).withColumn("return_rate", safe_divide(c("returned_units"), c("sold_units")))


_MOVES = {"sold_units": "int", "gross_product_sales": "decimal(18,2)", "product_discounts": "decimal(18,2)", "product_revenue": "decimal(18,2)", "returned_units": "int", "refund_amount": "decimal(18,2)"}


def product_moves(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """Order lines and returns as rows of product, time and what was sold or came back."""
    c = F.col
    sold = {"product_id": c("product_id"), "at": c("order_timestamp"), "sold_units": c("quantity"), "gross_product_sales": c("gross_line_amount"), "product_discounts": c("discount_amount"), "product_revenue": c("line_amount")}
    back = {"product_id": c("product_id"), "at": c("return_timestamp"), "returned_units": c("return_quantity"), "refund_amount": c("refund_amount")}
    return _side_by_side([(lines, sold), (returns, back)], _MOVES)


def daily_product_sales_at(moves: DataFrame, products: DataFrame) -> DataFrame:
    """:func:`daily_product_sales` of :func:`product_moves`, moved once, by product.

    A version belongs to one product, so its days are whole where the product's rows meet; they are
    not moved again with their keys. Only rows of no version, which share the special keys, are.
    """
    c = F.col
    sought = F.coalesce(c("product_id"), F.concat(F.lit("\0"), F.xxhash64(*moves.columns).cast("string")))
    rows = moves.select(date_key(c("at")).alias("order_date_key"), "product_id", sought.alias("__sought"), "at", *_MOVES)
    held = products.where(~c("product_id").isin(UNKNOWN, NOT_APPLICABLE)).select(c("product_id").alias("__sought"), "valid_from", "valid_to", "surrogate_key")
    met = rows.join(held, (rows["__sought"] == held["__sought"]) & (c("at") >= c("valid_from")) & (c("valid_to").isNull() | (c("at") <= c("valid_to"))), "left").drop(held["__sought"])
    money = {m: MONEY if k.startswith("decimal") else "bigint" for m, k in _MOVES.items()}
    sums = [_sum(m, k).alias(m) for m, k in money.items()]
    days = met.groupBy("__sought", "order_date_key", "surrogate_key", c("product_id").isNull().alias("__none")).agg(F.count("surrogate_key").alias("__held"), *sums)
    known = days.where("__held > 0").select("order_date_key", c("surrogate_key").alias("product_key"), *_MOVES)
    special = F.when(c("__none"), F.lit(member_key("dim_product", NOT_APPLICABLE))).otherwise(F.lit(member_key("dim_product", UNKNOWN)))
    others = days.where("__held = 0").groupBy("order_date_key", special.alias("product_key")).agg(*sums)
    out = known.unionByName(others).fillna(0, ["sold_units", "returned_units"])
    return out.withColumn("return_rate", safe_divide(c("returned_units"), c("sold_units")))


def channel_funnel(events: DataFrame) -> DataFrame:
    """Distinct sessions per day and device: all, with a view, with a cart, with a purchase.

    First one row per session with a flag per step, then plain counts: no expansion per distinct
    count, and a session with many events shrinks before the shuffle.
    """
    steps = {"view_sessions": "PRODUCT_VIEW", "cart_sessions": "ADD_TO_CART", "purchase_sessions": "PURCHASE"}
    once = events.groupBy("event_date_key", "device_type", "session_id").agg(*[F.max(F.coalesce(F.col("event_type") == t, F.lit(False))).alias(n) for n, t in steps.items()])
    named = F.col("session_id").isNotNull()
    out = once.groupBy("event_date_key", "device_type").agg(F.count("session_id").alias("eligible_sessions"), *[F.sum((F.col(n) & named).cast("bigint")).alias(n) for n in steps])
    return out.withColumn("conversion_rate", safe_divide(F.col("purchase_sessions"), F.col("eligible_sessions")))


def inventory_health(snapshot: DataFrame) -> DataFrame:
    out = snapshot.groupBy("event_date_key", "store_key").agg(
        F.count("inventory_snapshot_key").alias("product_observations"), F.sum(F.col("is_stockout").cast("bigint")).alias("stockout_observations"),
        F.sum(F.col("is_below_reorder_level").cast("bigint")).alias("below_reorder_observations"), _sum("quantity_on_hand", "bigint").alias("total_quantity_on_hand"),
    )
    return out.withColumn("stockout_rate", safe_divide(F.col("stockout_observations"), F.col("product_observations")))


def supplier_performance(items: DataFrame) -> DataFrame:
    return items.groupBy("order_date_key", "supplier_key").agg(F.count_distinct("product_key").alias("products_sold"), _sum("quantity", "bigint").alias("units_sold"), _sum("line_amount").alias("supplier_revenue"))


def promotion_performance(items: DataFrame) -> DataFrame:
    return items.groupBy("order_date_key", "promotion_key").agg(
        F.count_distinct("order_id").alias("attributed_orders"), _sum("quantity", "bigint").alias("attributed_units"), _sum("gross_line_amount").alias("attributed_gross_sales"),
        _sum("discount_amount").alias("attributed_discounts"), _sum("line_amount").alias("attributed_revenue"),
    )


_SUMS = ("gross_sales", "discounts", "tax_revenue", "shipping_revenue", "refunds")


def kpi_daily(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Finance KPIs per day and channel; a missing side counts as 0. Sales and returns are aggregated as one frame."""
    c = F.col
    took = {"gross_sales": c("gross_amount"), "discounts": c("discount_amount"), "tax_revenue": c("tax_amount"), "shipping_revenue": c("shipping_amount")}
    sold = {"order_date_key": c("order_date_key"), "channel_key": c("channel_key"), "order_id": c("order_id")} | took
    back = {"order_date_key": c("return_date_key"), "channel_key": c("channel_key"), "refunds": c("refund_amount")}
    rows = _side_by_side([(sales, sold), (returns, back)], {"order_id": "string"} | dict.fromkeys(_SUMS, MONEY))
    sums = {m: F.coalesce(_sum(m), F.lit(0)).cast(MONEY) for m in _SUMS}
    out = rows.groupBy("order_date_key", "channel_key").agg(F.count_distinct("order_id").alias("distinct_orders"), *[v.alias(m) for m, v in sums.items()])
    out = out.withColumn("net_sales", (c("gross_sales") - c("discounts") - c("refunds")).cast(MONEY))
    out = out.withColumn("net_revenue", (c("net_sales") + c("tax_revenue") + c("shipping_revenue")).cast(MONEY))
    return out.withColumn("average_order_value", safe_divide(c("net_sales"), c("distinct_orders")))


def kpi_monthly(daily: DataFrame) -> DataFrame:
    """Months from days; the order value is formed from the sums, not averaged."""
    out = daily.groupBy(F.substring(F.col("order_date_key").cast("string"), 1, 6).alias("year_month"), "channel_key").agg(
        F.sum("distinct_orders").alias("distinct_orders"), *[_sum(c).alias(c) for c in (*_SUMS, "net_sales", "net_revenue")]
    )
    return out.withColumn("average_order_value", safe_divide(F.col("net_sales"), F.col("distinct_orders")))


def calendar_bounds(*times: DataFrame) -> DataFrame:
    """First and last day over one-column frames of times; each is reduced before they meet."""
    parts = [t.select(F.to_date(F.col(t.columns[0])).alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi")) for t in times]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.min("lo").alias("first_date"), F.max("hi").alias("last_date"))


def reconcile(checks: list[tuple[str, DataFrame, DataFrame | Callable[[], DataFrame], str | None, str | None]]) -> DataFrame:
    """Per (name, source, published, source amount, published amount): rows and exact sums, PASS or FAIL.

    Rows pass if no more are published than there were, amounts if they agree to the cent.
    Each side becomes one row before the next begins, so what they shuffle is never held together.
    """
    sides = None
    for name, source, published, a, b in checks:
        for side, rows, amount in (("source", source, a), ("published", published, b)):
            total = F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY) if amount else F.lit(None).cast(MONEY)
            one = (rows() if callable(rows) else rows).agg(F.count(F.lit(1)).alias("n"), total.alias("m")).select(F.lit(name).alias("check_name"), F.lit(side).alias("side"), "n", "m")
            one = written(one, "reconciled")
            release(one.sparkSession)
            sides = one if sides is None else sides.unionByName(one)
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = sides.groupBy("check_name").agg(of("source", "n").alias("source_rows"), of("published", "n").alias("published_rows"), of("source", "m").alias("source_amount"), of("published", "m").alias("published_amount"))
    good = (F.col("published_rows") <= F.col("source_rows")) & F.col("source_amount").eqNullSafe(F.col("published_amount"))
    return both.select("check_name", "source_rows", "published_rows", F.greatest(F.col("source_rows") - F.col("published_rows"), F.lit(0)).alias("excluded_rows"), "source_amount", "published_amount", F.when(good, "PASS").otherwise("FAIL").alias("status"))
