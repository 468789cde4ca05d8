"""The flat scale model: generated orders, its aggregates over natural keys, and the approved queries on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_key
from ..sources.tables import table
from .guarded_sql import catalogue, guard
from .roles import role

RATE, WIDE = "decimal(12,6)", "decimal(24,2)"

# ---- fixed values: the model's codes and formulas ----------------------------------------------
CHANNELS = ("STORE", "WEB", "MOBILE")
TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
REGIONS = ("NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")
STORE_TYPES = ("MALL", "STREET", "OUTLET")
PAYMENT_METHODS = ("CARD", "WALLET", "BANK_TRANSFER", "CASH")
EVENT_TYPES = ("PURCHASE", "ADD_TO_CART", "PRODUCT_VIEW", "SEARCH")
DEVICES = ("MOBILE", "DESKTOP", "TABLET", "OTHER")
PRODUCTS_SOLD = 10_000
# ---- end of fixed values -----------------------------------------------------------------------


@dataclass(frozen=True)
class Scale:
    """Sizes of the generated tables; the defaults are the full load."""

    orders: int = 5_000_000
    customers: int = 500_000
    products: int = 100_000
    stores: int = 1_000
    inventory: int = 1_000_000

    @property
    def items(self) -> int:
        return 2 * self.orders


def _code(prefix: str, number: Column, digits: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def _pick(number: Column, *values: str) -> Column:
    out = F.when(F.pmod(number, F.lit(len(values))) == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:-1], 1):
        out = out.when(F.pmod(number, F.lit(len(values))) == i, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def _price(number: Column, base: int, step: int, span: int) -> Column:
    cents = F.pmod(number * step, F.lit(span)).cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")
    return (F.lit(base).cast("decimal(18,2)") + cents.cast("decimal(18,2)")).cast("decimal(18,2)")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(number, F.lit(730)).cast("int"))


def _tenth(amount: Column, number: Column) -> Column:
    """A tenth of the amount for every tenth row, else 0."""
    return F.when(F.pmod(number, F.lit(10)) == 0, (amount * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))


def generate_orders(spark: SparkSession, scale: Scale) -> DataFrame:
    """Deterministic orders from a range: every column is a function of the row number."""
    n = F.col("id")
    rows = spark.range(scale.orders).select(
        n.alias("order_number"), _code("O", n, 10).alias("order_id"), _code("C", F.pmod(n * 17, F.lit(scale.customers)), 9).alias("customer_id"), _code("S", F.pmod(n * 13, F.lit(scale.stores)), 5).alias("store_id"),
        _pick(n, *CHANNELS).alias("channel"), F.when(F.pmod(n, F.lit(50)) == 0, "CANCELLED").when(F.pmod(n, F.lit(20)) == 0, "RETURNED").otherwise("COMPLETED").alias("order_status"),
        _day(n).alias("order_date"), _price(n, 20, 29, 48_000).alias("gross_amount"),
    )
    rows = rows.withColumn("discount_amount", _tenth(F.col("gross_amount"), F.col("order_number")))
    base = F.col("gross_amount") - F.col("discount_amount")
    rows = rows.withColumns({"tax_amount": (base * F.lit("0.08").cast("decimal(3,2)")).cast("decimal(18,2)"), "shipping_amount": F.when(F.col("channel") == "STORE", F.lit(0)).otherwise(F.lit(5)).cast("decimal(18,2)")})
    return rows.withColumn("net_amount", (base + (base * F.lit("0.08").cast("decimal(3,2)")) + F.col("shipping_amount")).cast("decimal(18,2)"))


def generate_items(spark: SparkSession, scale: Scale) -> DataFrame:
    """Two lines per order; line n belongs to order n modulo the number of orders and repeats its context."""
    n = F.col("id")
    order = F.pmod(n, F.lit(scale.orders))
    rows = spark.range(scale.items).select(
        n.alias("order_item_number"), order.alias("order_number"), _code("OI", n, 11).alias("order_item_id"), _code("O", order, 10).alias("order_id"), (F.floor(n / scale.orders) + 1).cast("int").alias("line_number"),
        _code("P", F.pmod(n * 13, F.lit(PRODUCTS_SOLD)), 7).alias("product_id"), _code("C", F.pmod(order * 17, F.lit(scale.customers)), 9).alias("customer_id"), _code("S", F.pmod(order * 13, F.lit(scale.stores)), 5).alias("store_id"),
        _pick(order, *CHANNELS).alias("channel"), _day(order).alias("order_date"), (1 + F.pmod(n, F.lit(5))).cast("int").alias("quantity"), _price(n, 5, 17, 49_500).alias("unit_price"),
    )
    gross = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    return rows.withColumns({"gross_line_amount": gross, "discount_amount": _tenth(gross, F.col("order_item_number")), "returned_units": F.when(F.pmod("order_item_number", F.lit(20)) == 0, F.col("quantity")).otherwise(F.lit(0)).cast("int")})


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def generate_customers(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.customers).select(
        n.alias("customer_number"), _code("C", n, 9).alias("customer_id"), _text("customer", n, "@example.com").alias("email"), _pick(n, *TIERS).alias("loyalty_tier"),
        _pick(n, *REGIONS).alias("region"), F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(n, F.lit(1_460)).cast("int")).alias("registration_date"),
    )


def generate_products(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.products).select(
        n.alias("product_number"), _code("P", n, 7).alias("product_id"), _text("Product ", n).alias("product_name"), _text("Category ", F.pmod(n, F.lit(25))).alias("category"),
        _text("Brand ", F.pmod(n, F.lit(200))).alias("brand"), _price(n, 5, 17, 49_500).alias("list_price"), _code("SUP", F.pmod(n, F.lit(2_000)), 5).alias("supplier_id"),
    )


def generate_stores(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.stores).select(n.alias("store_number"), _code("S", n, 5).alias("store_id"), _text("Store ", n).alias("store_name"), _pick(n, *REGIONS).alias("region"), _pick(n, *STORE_TYPES).alias("store_type"))


def generate_payments(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.orders).select(
        n.alias("payment_number"), _code("PAY", n, 10).alias("payment_id"), _code("O", n, 10).alias("order_id"), _pick(n, *PAYMENT_METHODS).alias("payment_method"),
        F.when(F.pmod(n, F.lit(100)) == 0, "REFUNDED").otherwise("CAPTURED").alias("payment_status"), _price(n, 20, 29, 48_000).alias("payment_amount"), _day(n).alias("payment_date"),
    )


def generate_customer_events(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.orders).select(
        n.alias("event_number"), _code("EV", n, 10).alias("event_id"), _code("SESSION", n, 10).alias("session_id"), _code("C", F.pmod(n * 17, F.lit(scale.customers)), 9).alias("customer_id"),
        _code("P", F.pmod(n * 13, F.lit(PRODUCTS_SOLD)), 7).alias("product_id"), _pick(n, *EVENT_TYPES).alias("event_type"), _pick(n, *DEVICES).alias("device_type"), _day(n).alias("event_date"),
    )


def generate_inventory_events(spark: SparkSession, scale: Scale) -> DataFrame:
    n = F.col("id")
    return spark.range(scale.inventory).select(
        n.alias("inventory_event_number"), _code("INV", n, 10).alias("inventory_event_id"), _code("P", F.pmod(n * 13, F.lit(PRODUCTS_SOLD)), 7).alias("product_id"), _code("S", F.pmod(n * 7, F.lit(scale.stores)), 5).alias("store_id"),
        _day(n).alias("event_date"), F.pmod(n * 19, F.lit(101)).cast("int").alias("quantity_on_hand"), (10 + F.pmod(n, F.lit(20))).cast("int").alias("reorder_level"),
    )


BRONZE = {
    "customers": generate_customers, "products": generate_products, "stores": generate_stores, "orders": generate_orders, "order_items": generate_items,
    "payments": generate_payments, "customer_events": generate_customer_events, "inventory_events": generate_inventory_events,
}


def load_bronze(spark: SparkSession, scale: Scale, batch_id: str) -> dict[str, DataFrame]:
    """All generated tables with their batch and time of load; nothing runs before they are written or read."""
    return {n: make(spark, scale).withColumns({"_batch_id": F.lit(batch_id), "_ingested_at": F.current_timestamp()}) for n, make in BRONZE.items()}


def gen_orders(spark, d):
    return generate_orders(spark, Scale(orders=20_000, customers=2_000, stores=100))


def gen_order_items(spark, d):
    return generate_items(spark, Scale(orders=20_000, customers=2_000, products=5_000, stores=100))


# ---- aggregates of the model; each takes frames with natural keys and dates ---------------------


def _rate(a: Column, b: Column) -> Column:
    """Quotient as the model keeps it, six digits; 0 where the divisor is 0."""
    return F.when(b == 0, F.lit(0).cast(RATE)).otherwise(F.try_divide(a.cast("double"), b.cast("double")).cast(RATE))


def kpi_daily(orders: DataFrame, at: str) -> DataFrame:
    o = orders.where("order_status <> 'CANCELLED'")
    net = F.sum(F.col("gross_amount") - F.col("discount_amount"))
    out = o.groupBy(date_key(F.col(at)).alias("date_key"), "channel").agg(
        F.sum("gross_amount").cast(WIDE).alias("gross_sales"), net.cast(WIDE).alias("net_sales"), F.sum("net_amount").cast(WIDE).alias("net_revenue"), F.count_distinct("order_id").alias("distinct_orders")
    )
    return out.withColumn("average_order_value", F.try_divide(F.col("net_sales"), F.col("distinct_orders")).cast("decimal(18,2)"))


def product_returns(items: DataFrame, at: str) -> DataFrame:
    """Units sold and returned per day and product; the lines themselves say what came back."""
    out = items.groupBy(date_key(F.col(at)).alias("date_key"), F.col("product_id").alias("product_key")).agg(F.sum("quantity").cast("bigint").alias("units_sold"), F.sum("returned_units").cast("bigint").alias("returned_units"))
    return out.withColumn("return_rate", _rate(F.col("returned_units"), F.col("units_sold")))


def funnel(events: DataFrame, at: str) -> DataFrame:
    once = events.groupBy(date_key(F.col(at)).alias("date_key"), "device_type", "session_id").agg(F.max(F.col("event_type") == "PURCHASE").alias("bought"))
    out = once.groupBy("date_key", "device_type").agg(F.count("session_id").alias("sessions"), F.sum(F.col("bought").cast("bigint")).alias("purchasing_sessions"))
    return out.withColumn("conversion_rate", _rate(F.col("purchasing_sessions"), F.col("sessions")))


def stock(inventory: DataFrame, at: str) -> DataFrame:
    out = inventory.groupBy(date_key(F.col(at)).alias("date_key"), F.col("store_id").alias("store_key")).agg(F.count(F.lit(1)).alias("observations"), F.sum(F.when(F.col("quantity_on_hand") == 0, 1).otherwise(0)).alias("stockout_observations"))
    return out.withColumn("stockout_rate", _rate(F.col("stockout_observations"), F.col("observations")))


def kpi_summary(orders: DataFrame, funnels: DataFrame, stocks: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per metric. Rates are averaged over their groups without weights, as the model defines them."""
    sold = orders.where("order_status <> 'CANCELLED'")
    parts = [
        ("total_orders", orders.agg(F.count(F.lit(1)).cast("double").alias("v")), "Number of order records."),
        ("net_revenue", sold.agg(F.sum("net_amount").cast("double").alias("v")), "Revenue after discounts plus tax and shipping."),
        ("average_order_value", sold.agg(F.try_divide(F.sum("net_amount").cast("double"), F.count("net_amount").cast("double")).alias("v")), "Average revenue per order that was not cancelled."),
        ("conversion_rate", funnels.agg(F.avg("conversion_rate").cast("double").alias("v")), "Share of sessions with a purchase."),
        ("stockout_rate", stocks.agg(F.avg("stockout_rate").cast("double").alias("v")), "Share of observations without stock."),
        ("return_rate", returns.agg(F.avg("return_rate").cast("double").alias("v")), "Share of sold units that came back."),
    ]
    out = None
    for name, value, use in parts:
        row = value.select(F.lit(name).alias("metric_name"), F.round("v", 4).alias("metric_value"), F.lit(use).alias("business_use"))
        out = row if out is None else out.unionByName(row)
    return out


def b_kpi_daily(spark, d):
    return kpi_daily(role(spark, d, "orders"), "order_timestamp")


def b_product_returns(spark, d):
    lines = role(spark, d, "lines").withColumn("returned_units", F.when(F.col("returned"), F.col("quantity")).otherwise(0))
    return product_returns(lines.join(role(spark, d, "orders").select("order_id", "order_timestamp"), "order_id"), "order_timestamp")


def b_funnel(spark, d):
    return funnel(role(spark, d, "events"), "event_timestamp")


def b_inventory(spark, d):
    return stock(role(spark, d, "inventory"), "event_timestamp")


def b_kpi_summary(spark, d):
    return kpi_summary(role(spark, d, "orders"), b_funnel(spark, d), b_inventory(spark, d), b_product_returns(spark, d))


# ---- the model at its full load -----------------------------------------------------------------

FULL = Scale()


def _full(spark, name: str) -> DataFrame:
    return BRONZE[name](spark, FULL)


def scale_layers(spark, d):
    """Rows of each generated table at the full load, and of all of them."""
    out = None
    for name in BRONZE:
        one = _full(spark, name).agg(F.count(F.lit(1)).alias("generated_rows")).select(F.lit(name).alias("table_name"), "generated_rows")
        out = one if out is None else out.unionByName(one)
    return out.unionByName(out.agg(F.lit("all").alias("table_name"), F.sum("generated_rows").alias("generated_rows")))


def scale_orders(spark, d):
    money = lambda c: F.sum(c).cast(WIDE).alias(c)
    return _full(spark, "orders").groupBy("channel", "order_status").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("customers"), F.count_distinct("store_id").alias("stores"), *map(money, ("gross_amount", "discount_amount", "tax_amount", "shipping_amount", "net_amount")))


def scale_order_items(spark, d):
    money = lambda c: F.sum(c).cast(WIDE).alias(c)
    return _full(spark, "order_items").groupBy("channel", "line_number").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"), F.sum("returned_units").alias("returned_units"), F.max("product_id").alias("last_product"), *map(money, ("gross_line_amount", "discount_amount")))


def scale_kpi_daily(spark, d):
    return kpi_daily(_full(spark, "orders"), "order_date")


def scale_funnel(spark, d):
    return funnel(_full(spark, "customer_events"), "event_date")


def scale_inventory(spark, d):
    return stock(_full(spark, "inventory_events"), "event_date")


def scale_payments(spark, d):
    return _full(spark, "payments").groupBy("payment_method", "payment_status").agg(F.count(F.lit(1)).alias("payments"), F.sum("payment_amount").cast(WIDE).alias("payment_amount"), F.min("payment_date").alias("first_date"), F.max("payment_date").alias("last_date"))


def scale_dimensions(spark, d):
    """Members per attribute of the generated dimensions."""
    c = _full(spark, "customers").groupBy(F.lit("customers").alias("table_name"), F.concat_ws("/", "loyalty_tier", "region").alias("member"))
    p = _full(spark, "products").groupBy(F.lit("products").alias("table_name"), F.concat_ws("/", "category", "supplier_id").alias("member"))
    s = _full(spark, "stores").groupBy(F.lit("stores").alias("table_name"), F.concat_ws("/", "store_type", "region").alias("member"))
    out = None
    for g in (c, p, s):
        one = g.agg(F.count(F.lit(1)).alias("members"))
        out = one if out is None else out.unionByName(one)
    return out


def scale_arrival(spark, d):
    """Rows that the load's settings ask for against rows there are, per layer."""
    o, i, e = (_full(spark, n) for n in ("orders", "order_items", "customer_events"))
    asked = (("bronze", "orders", FULL.orders, o), ("bronze", "order_items", FULL.items, i), ("bronze", "customer_events", FULL.orders, e),
             ("silver", "orders", FULL.orders, o), ("silver", "order_items", FULL.items, i), ("gold", "fact_sales", FULL.orders, o.dropDuplicates(["order_number"])), ("gold", "fact_order_items", FULL.items, i.dropDuplicates(["order_item_number"])))
    out = None
    for layer, name, expected, rows in asked:
        one = rows.agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("object_name"), F.lit(expected).cast("bigint").alias("expected_rows"), "actual_rows")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("arrival_status", F.when(F.col("actual_rows") == F.col("expected_rows"), "ARRIVED").otherwise("MISMATCH"))


def b_arrival(spark, d):
    """Expected against actual rows of the layers. Expected are the rows of the feed, of order items its distinct
    keys, and for a fact the distinct keys of its source; actual are the rows as read, deduplicated or built."""
    from . import reference  # which imports this module

    o, i, e = role(spark, d, "orders"), role(spark, d, "lines"), role(spark, d, "events")
    orders, events = table(spark, d, "orders"), table(spark, d, "events")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    sides = None
    for layer, name, source, actual in (
        ("bronze", "orders", orders, o), ("bronze", "order_items", lines, i), ("bronze", "customer_events", events, e),
        ("silver", "orders", orders, o.dropDuplicates(["order_id"])), ("silver", "order_items", lines, i.dropDuplicates(["order_item_id"])),
        ("gold", "fact_sales", o.dropDuplicates(["order_id"]), reference.fact(spark, d, "fact_sales")), ("gold", "fact_order_items", i, reference.fact(spark, d, "fact_order_items")),
    ):
        for side, rows in (("expected", source), ("actual", actual)):
            one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("object_name"), F.lit(side).alias("side"), "n")
            sides = one if sides is None else sides.unionByName(one)
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("n")))
    both = sides.groupBy("layer", "object_name").agg(of("expected").alias("expected_rows"), of("actual").alias("actual_rows"))
    return both.withColumn("arrival_status", F.when(F.col("actual_rows") == F.col("expected_rows"), "ARRIVED").otherwise("MISMATCH"))


def _approved(name: str, tables: dict):
    def run(spark, d):
        t = catalogue()[name]
        sql = guard(t.sql, set(t.tables), t.max_rows)
        for n in t.tables:
            sql = sql.replace(n, "{" + n + "}")
        return spark.sql(sql, **{n: tables[n](spark, d) for n in t.tables})

    return run


SERVED = {"retail_kpi_daily": b_kpi_daily, "agg_channel_funnel": b_funnel, "agg_daily_product_sales": b_product_returns, "agg_inventory_health": b_inventory, "data_arrival_status": b_arrival, "kpi_summary": b_kpi_summary}
QUERIES = {f.__name__: f for f in (b_kpi_daily, b_product_returns, b_funnel, b_inventory, b_kpi_summary, b_arrival, gen_orders, gen_order_items, scale_layers, scale_orders, scale_order_items, scale_kpi_daily, scale_funnel, scale_inventory, scale_payments, scale_dimensions, scale_arrival)} | {
    q: _approved(t, SERVED) for q, t in (("rag_daily_sales", "daily_sales"), ("rag_conversion", "conversion_rate"), ("rag_returns", "product_returns"), ("rag_inventory", "inventory_health"), ("rag_arrival", "data_arrival"), ("rag_kpi_summary", "kpi_summary"))
}
