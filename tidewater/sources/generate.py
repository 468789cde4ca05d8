"""Retail feeds made from nothing but sizes and a seed, with thirteen known defects.

Every value is a hash of the seed, a purpose and the row's number, so any number of tasks makes the
same rows, nothing is shuffled, and no feed needs another: what an order says of its lines is worked
out inside the order's own row.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fs import Files

MONEY = "decimal(18,2)"
# ---- fixed values: codes of the feeds ----------------------------------------------------------
CATEGORIES = {"Electronics": ("Audio", "Computers", "Mobile"), "Home": ("Kitchen", "Furniture", "Decor"), "Apparel": ("Men", "Women", "Accessories"), "Sports": ("Fitness", "Outdoor", "Footwear")}
REGIONS = ("NORTHEAST", "SOUTHEAST", "MIDWEST", "SOUTHWEST", "WEST")
TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
CHANNELS = ("STORE", "WEB", "MOBILE", "MARKETPLACE")
CSV_FEEDS = ("customers", "products", "stores", "suppliers", "promotions")
DEFECTS = (
    ("customers", "duplicate business key"), ("customers", "invalid email"), ("products", "negative list price"), ("orders", "broken customer foreign key"), ("orders", "invalid status"), ("orders", "total mismatch"),
    ("order_items", "negative quantity"), ("payments", "invalid status"), ("inventory_events", "negative on-hand quantity"), ("returns", "quantity exceeds purchased quantity"), ("shipments", "delivered before shipped"),
    ("customer_events", "duplicate event id"), ("customer_events", "unexpected schema field"),
)
# ---- end of fixed values -----------------------------------------------------------------------
SYLLABLES = ("al", "ber", "cor", "dan", "el", "far", "gre", "hol", "im", "jor", "kel", "lun", "mar", "nor", "or", "pel", "quin", "ros", "sol", "tor")


@dataclass(frozen=True)
class FeedSizes:
    customers: int = 50
    products: int = 30
    stores: int = 5
    suppliers: int = 8
    orders: int = 100
    promotions: int = 5
    seed: int = 42
    reference: datetime = datetime(2026, 1, 1)  # UTC
    defects: bool = True

    def __post_init__(self) -> None:
        if bad := [n for n in ("customers", "products", "stores", "suppliers", "orders", "promotions") if getattr(self, n) < 1]:
            raise ValueError(f"sizes must be positive: {', '.join(bad)}")

    @property
    def batch_id(self) -> str:
        return f"{self.reference:%Y%m%dT%H%M%SZ}_seed{self.seed}"


class _Feeds:
    def __init__(self, spark: SparkSession, sizes: FeedSizes):
        self.spark, self.n = spark, sizes
        self.now = F.lit(f"{sizes.reference:%Y-%m-%d %H:%M:%S}").cast("timestamp")

    def draw(self, purpose: str, low: int, high: int, *ids: Column) -> Column:
        """A whole number from low to high, the same for the same ids."""
        return (F.lit(low) + F.pmod(F.xxhash64(F.lit(self.n.seed), F.lit(purpose), *ids), F.lit(high - low + 1))).cast("int")

    def pick(self, purpose: str, values: tuple, *ids: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), self.draw(purpose, 1, len(values), *ids))

    def word(self, purpose: str, *ids: Column) -> Column:
        return F.initcap(F.concat(*[self.pick(f"{purpose}{k}", SYLLABLES, *ids) for k in range(3)]))

    @staticmethod
    def code(prefix: str, number: Column, digits: int) -> Column:
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))

    def before(self, purpose: str, low: int, high: int, *ids: Column) -> Column:
        """A moment from low to high days before the reference time."""
        return F.timestamp_micros(F.unix_micros(self.now) - self.draw(purpose, low, high, *ids).cast("bigint") * F.lit(86_400_000_000))

    @staticmethod
    def later(at: Column, minutes: Column | int) -> Column:
        minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
        return F.timestamp_micros(F.unix_micros(at) + minutes.cast("bigint") * F.lit(60_000_000))

    def rows(self, n: int) -> tuple[DataFrame, Column]:
        return self.spark.range(1, n + 1), F.col("id")

    def changed(self, number: int, value: object, otherwise: Column, i: Column) -> Column:
        """``value`` in row ``number`` if defects are wanted."""
        wrong = value if isinstance(value, Column) else F.lit(value)
        return F.when(i == number, wrong).otherwise(otherwise) if self.n.defects else otherwise

    def again(self, rows: DataFrame, number: int) -> DataFrame:
        """Row ``number`` a second time if defects are wanted."""
        return rows.select("*", F.explode(F.when(F.col("id") == number, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__twice")).drop("__twice") if self.n.defects else rows

    def _born(self, purpose: str, low: int, high: int, i: Column) -> list[Column]:
        at = self.before(purpose, low, high, i)
        return [at.alias("created_at"), at.alias("updated_at"), F.lit("INSERT").alias("cdc_operation")]

    def customers(self) -> DataFrame:
        rows, i = self.rows(self.n.customers)
        at = self.before("c-at", 30, 900, i)
        first, last = self.word("c-first", i), self.word("c-last", i)
        mail = F.concat(F.lower(first), F.lit("."), F.lower(last), i.cast("string"), F.lit("@mail.example"))
        return self.again(rows, 1).select(
            self.code("C", i, 6).alias("customer_id"), first.alias("first_name"), last.alias("last_name"), self.changed(2, "invalid-email", mail, i).alias("email"),
            F.concat(F.lit("+1-555-"), F.lpad(self.draw("c-phone", 0, 9_999_999, i).cast("string"), 7, "0")).alias("phone"), F.date_sub(F.to_date(self.now), self.draw("c-birth", 18 * 365 + 5, 80 * 365, i)).alias("date_of_birth"),
            self.pick("c-gender", ("F", "M", "NON_BINARY", "UNDISCLOSED"), i).alias("gender"), F.concat(self.draw("c-no", 1, 999, i).cast("string"), F.lit(" "), self.word("c-street", i), F.lit(" Street")).alias("address"),
            self.word("c-city", i).alias("city"), self.pick("c-state", ("CA", "NY", "TX", "WA", "IL", "FL"), i).alias("state"), F.lit("US").alias("country"), F.lpad(self.draw("c-zip", 1_000, 99_999, i).cast("string"), 5, "0").alias("postal_code"),
            self.pick("c-tier", TIERS, i).alias("loyalty_tier"), F.to_date(at).alias("registration_date"), F.lit("ACTIVE").alias("customer_status"), *self._born("c-at", 30, 900, i),
        )

    def suppliers(self) -> DataFrame:
        rows, i = self.rows(self.n.suppliers)
        return rows.select(
            self.code("SUP", i, 4).alias("supplier_id"), F.concat(self.word("s-name", i), F.lit(" Supply")).alias("supplier_name"), F.concat(F.lit("sales"), i.cast("string"), F.lit("@supply.example")).alias("contact_email"), F.lit("US").alias("country"),
            (self.draw("s-rating", 250, 500, i) / F.lit(100)).cast("decimal(5,2)").alias("supplier_rating"), self.draw("s-lead", 2, 30, i).alias("lead_time_days"), F.lit("ACTIVE").alias("supplier_status"), *self._born("s-at", 200, 1_200, i),
        )

    def _cost(self, p: Column) -> Column:
        return (self.draw("p-cost", 300, 50_000, p) / F.lit(100)).cast(MONEY)

    def _price(self, p: Column) -> Column:
        return (self._cost(p) * (self.draw("p-markup", 120, 240, p) / F.lit(100)).cast("decimal(5,2)")).cast(MONEY)

    def products(self) -> DataFrame:
        rows, i = self.rows(self.n.products)
        kind = self.draw("p-kind", 1, len(CATEGORIES), i)
        category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), kind)
        sub = F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, v)) for v in CATEGORIES.values()]), kind), self.draw("p-sub", 1, 3, i))
        return rows.select(
            self.code("P", i, 6).alias("product_id"), self.code("SKU-", i, 7).alias("sku"), F.concat_ws(" ", self.word("p-name", i), category, F.lit("Item"), i.cast("string")).alias("product_name"), category.alias("category"), sub.alias("subcategory"),
            self.pick("p-brand", ("Aster", "Birch", "Cobalt", "Delta", "Ember"), i).alias("brand"), self.code("SUP", self.draw("p-supplier", 1, self.n.suppliers, i), 4).alias("supplier_id"), self._cost(i).alias("unit_cost"),
            self.changed(2, F.lit(-5).cast(MONEY), self._price(i), i).alias("list_price"), F.lit("ACTIVE").alias("product_status"), F.to_date(self.before("p-at", 10, 700, i)).alias("launch_date"), *self._born("p-at", 10, 700, i),
        )

    def stores(self) -> DataFrame:
        rows, i = self.rows(self.n.stores)
        return rows.select(
            self.code("S", i, 4).alias("store_id"), F.concat_ws(" ", F.lit("Store"), self.word("st-name", i), i.cast("string")).alias("store_name"), self.pick("st-type", ("MALL", "HIGH_STREET", "OUTLET"), i).alias("store_type"), self.word("st-city", i).alias("city"),
            self.pick("st-state", ("CA", "NY", "TX", "WA", "IL", "FL"), i).alias("state"), F.lit("US").alias("country"), F.element_at(F.array(*map(F.lit, REGIONS)), (F.pmod(i - 1, F.lit(len(REGIONS))) + 1).cast("int")).alias("region"),
            F.to_date(self.before("st-at", 500, 4_000, i)).alias("opening_date"), F.lit("ACTIVE").alias("store_status"), self.code("EMP", i, 5).alias("manager_id"), *self._born("st-at", 500, 4_000, i),
        )

    def promotions(self) -> DataFrame:
        rows, i = self.rows(self.n.promotions)
        product, start = self.draw("pr-product", 1, self.n.products, i), F.date_sub(F.to_date(self.now), (i * 14).cast("int"))
        return rows.select(
            self.code("PROMO", i, 4).alias("promotion_id"), F.concat(F.lit("Campaign "), i.cast("string")).alias("promotion_name"), F.lit("PERCENTAGE").alias("promotion_type"), start.alias("start_date"), F.date_add(start, 10).alias("end_date"),
            self.pick("pr-percent", (5, 10, 15, 20), i).cast("decimal(5,2)").alias("discount_percentage"), F.lit(0).cast(MONEY).alias("discount_amount"), F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), self.draw("p-kind", 1, len(CATEGORIES), product.cast("bigint"))).alias("category"),
            self.code("P", product, 6).alias("product_id"), F.lit(25).cast(MONEY).alias("minimum_order_value"), F.when(i == 1, "ACTIVE").otherwise("EXPIRED").alias("promotion_status"),
        )

    def _placed(self) -> DataFrame:
        """One row per order with its lines (1 to 4) as an array and their sums."""
        rows, i = self.rows(self.n.orders)

        def line(k: Column) -> Column:
            p = self.draw("l-product", 1, self.n.products, i, k).cast("bigint")
            q, price = self.draw("l-quantity", 1, 4, i, k), self._price(p)
            gross = (price * q).cast(MONEY)
            discount = (gross * self.pick("l-discount", ("0.00", "0.00", "0.05", "0.10"), i, k).cast("decimal(3,2)")).cast(MONEY)
            tax = ((gross - discount) * F.lit("0.08").cast("decimal(3,2)")).cast(MONEY)
            return F.struct(((i - 1) * 4 + k).alias("number"), p.alias("product"), q.alias("quantity"), price.alias("unit_price"), gross.alias("gross"), discount.alias("discount"), tax.alias("tax"), (gross - discount + tax).cast(MONEY).alias("amount"))

        lines = F.transform(F.sequence(F.lit(1), self.draw("o-lines", 1, 4, i)), line)
        rows = rows.withColumn("lines", lines)
        total = lambda c: F.aggregate(F.transform("lines", lambda x: x[c]), F.lit(0).cast(MONEY), lambda a, x: (a + x).cast(MONEY))
        at = self.later(self.before("o-day", 1, 180, i), -self.draw("o-minute", 0, 1_439, i))
        channel = self.pick("o-channel", CHANNELS, i)
        rows = rows.withColumns({"gross": total("gross"), "discount": total("discount"), "tax": total("tax"), "at": at, "channel": channel, "order_id": self.code("O", i, 8)})
        rows = rows.withColumn("shipping", F.when(F.col("gross") >= 50, F.lit("0.00")).otherwise(F.lit("5.99")).cast(MONEY))
        customer = self.changed(2, "UNKNOWN_CUSTOMER", self.code("C", self.draw("o-customer", 1, self.n.customers, i), 6), i)
        return rows.withColumns({"net": (F.col("gross") + F.col("tax") + F.col("shipping") - F.col("discount")).cast(MONEY), "customer_id": customer})

    def orders(self) -> DataFrame:
        i, c = F.col("id"), F.col
        return self._placed().select(
            "order_id", "customer_id", F.when(c("channel") == "STORE", self.code("S", self.draw("o-store", 1, self.n.stores, i), 4)).alias("store_id"), "channel", self.changed(3, "NOT_A_STATUS", self.pick("o-status", ("COMPLETED", "SHIPPED", "DELIVERED"), i), i).alias("order_status"),
            c("at").alias("order_timestamp"), F.lit("USD").alias("currency"), self.pick("o-pay", ("CARD", "WALLET", "BANK_TRANSFER"), i).alias("payment_method"), c("shipping").alias("shipping_amount"), c("tax").alias("tax_amount"), c("discount").alias("discount_amount"),
            c("gross").alias("gross_amount"), self.changed(4, (c("net") + 10).cast(MONEY), c("net"), i).alias("net_amount"), c("at").alias("created_at"), c("at").alias("updated_at"), F.lit("INSERT").alias("cdc_operation"),
        )

    def _lines(self) -> DataFrame:
        return self._placed().select("id", "order_id", "customer_id", "at", F.posexplode("lines").alias("at_line", "l")).withColumn("order_item_id", self.code("OI", F.col("l.number"), 9))

    def order_items(self) -> DataFrame:
        first = (F.col("id") == 1) & (F.col("at_line") == 0)
        quantity = F.when(first, F.lit(-2)).otherwise(F.col("l.quantity")) if self.n.defects else F.col("l.quantity")
        return self._lines().select(
            "order_item_id", "order_id", self.code("P", F.col("l.product"), 6).alias("product_id"), quantity.alias("quantity"), F.col("l.unit_price").alias("unit_price"), F.col("l.discount").alias("discount_amount"), F.col("l.tax").alias("tax_amount"),
            F.col("l.amount").alias("line_amount"), F.col("at").alias("created_at"), F.col("at").alias("updated_at"),
        )

    def payments(self) -> DataFrame:
        i, at = F.col("id"), F.col("at")
        return self._placed().select(
            self.code("PAY", i, 8).alias("payment_id"), "order_id", self.changed(2, "UNKNOWN", F.lit("CAPTURED"), i).alias("payment_status"), self.pick("o-pay", ("CARD", "WALLET", "BANK_TRANSFER"), i).alias("payment_method"), F.col("net").alias("payment_amount"),
            self.code("TXN-", i, 12).alias("transaction_reference"), self.later(at, 2).alias("payment_timestamp"), at.alias("created_at"), at.alias("updated_at"),
        )

    def inventory_events(self) -> DataFrame:
        rows, i = self.rows(self.n.stores * self.n.products)
        store, product = F.floor((i - 1) / self.n.products) + 1, F.pmod(i - 1, F.lit(self.n.products)) + 1
        return rows.select(
            self.code("INV", i, 9).alias("inventory_event_id"), self.code("P", product, 6).alias("product_id"), self.code("S", store, 4).alias("store_id"), F.lit("SNAPSHOT").alias("event_type"), F.lit(0).alias("quantity_change"),
            self.changed(2, -10, self.draw("i-hand", 5, 100, i), i).alias("quantity_on_hand"), self.draw("i-level", 5, 20, i).alias("reorder_level"), self.later(self.now, -60).alias("event_timestamp"), F.lit("STORE_INVENTORY").alias("source_system"),
        )

    def returns(self) -> DataFrame:
        """Every line of every tenth order comes back, one piece of it."""
        n, at = F.col("l.number"), F.col("at")
        came = self.later(at, self.draw("r-days", 1, 20, n) * 1_440)
        rows = self._lines().where("id % 10 = 1")
        first = (F.col("id") == 1) & (F.col("at_line") == 0)
        return rows.select(
            self.code("RET", n, 9).alias("return_id"), "order_id", "order_item_id", "customer_id", self.code("P", F.col("l.product"), 6).alias("product_id"), self.pick("r-reason", ("DAMAGED", "WRONG_ITEM", "NOT_AS_DESCRIBED", "CHANGED_MIND"), n).alias("return_reason"),
            F.lit("REFUNDED").alias("return_status"), (F.when(first, 999).otherwise(1) if self.n.defects else F.lit(1)).alias("return_quantity"), (F.col("l.amount") / F.col("l.quantity")).cast(MONEY).alias("refund_amount"), came.alias("return_timestamp"), self.later(came, 240).alias("processed_timestamp"),
        )

    def shipments(self) -> DataFrame:
        """One per order outside the stores; the first of them is the one that arrives before it leaves."""
        i, shipped = F.col("id"), self.later(F.col("at"), 720)
        rows = self._placed().where("channel <> 'STORE'")
        arrives = self.later(shipped, self.draw("sh-days", 1, 7, i) * 1_440)
        if self.n.defects:
            bad = rows.agg(F.min("id")).first()[0]  # one number
            arrives = F.when(i == F.lit(bad), self.later(shipped, -1_440)).otherwise(arrives)
        return rows.select(
            self.code("SHIP", i, 8).alias("shipment_id"), "order_id", self.pick("sh-carrier", ("NORTH_EXPRESS", "PARCEL_LINE", "QUICK_SHIP"), i).alias("carrier"), F.lit("DELIVERED").alias("shipment_status"), shipped.alias("shipped_timestamp"),
            self.later(shipped, 7_200).alias("expected_delivery_timestamp"), arrives.alias("delivered_timestamp"), F.col("shipping").alias("shipping_cost"), self.code("TRACK", i, 12).alias("tracking_number"),
        )

    def customer_events(self) -> DataFrame:
        """View, cart and purchase of each order's first product, in one session."""
        rows = self._placed().select("id", "order_id", "customer_id", "at", F.col("lines")[0]["product"].alias("product"), F.posexplode(F.array(*[F.struct(F.lit(t).alias("type"), F.lit(m).alias("minutes")) for t, m in (("PRODUCT_VIEW", -10), ("ADD_TO_CART", -5), ("PURCHASE", 0))])).alias("step", "e"))
        rows = rows.withColumn("order", F.col("id")).withColumn("id", (F.col("order") - 1) * 3 + F.col("step") + 1)
        i, product = F.col("id"), self.code("P", F.col("product"), 6)
        out = self.again(rows, 1).select(
            self.code("EVT", i, 10).alias("event_id"), F.concat(F.lit("SESSION-"), "order_id").alias("session_id"), "customer_id", F.col("e.type").alias("event_type"), product.alias("product_id"), self.later(F.col("at"), F.col("e.minutes")).alias("event_timestamp"),
            F.concat(F.lit("/products/"), product).alias("page_url"), self.pick("e-device", ("DESKTOP", "MOBILE", "TABLET"), i).alias("device_type"), self.pick("e-browser", ("CHROME", "EDGE", "SAFARI", "FIREFOX"), i).alias("browser"),
            F.lit(None).cast("string").alias("campaign_id"), F.lit("WEB_SHOP").alias("source"), self.now.alias("ingestion_timestamp"), *([F.when(i == 2, "schema_drift").alias("unexpected_field")] if self.n.defects else []),
        )
        return out


FEEDS = ("customers", "products", "stores", "suppliers", "orders", "order_items", "payments", "inventory_events", "returns", "promotions", "shipments", "customer_events")


def generate(spark: SparkSession, sizes: FeedSizes | None = None) -> dict[str, DataFrame]:
    """All twelve feeds as typed frames. Defects need at least four orders, two customers and two products."""
    feeds = _Feeds(spark, sizes or FeedSizes())
    return {name: getattr(feeds, name)() for name in FEEDS}


def write_feeds(spark: SparkSession, root: str, sizes: FeedSizes | None = None) -> dict:
    """Writes the feeds below ``root``/batch_id=... (CSV with header or JSON lines) with a report; returns the report.

    The same sizes write the same rows again.
    """
    sizes = sizes or FeedSizes()
    target, counts = f"{root.rstrip('/')}/batch_id={sizes.batch_id}", {}
    for name, rows in generate(spark, sizes).items():
        writer = rows.write.mode("overwrite")
        path = f"{target}/{name}"
        writer.option("header", True).csv(path) if name in CSV_FEEDS else writer.json(path)
        counts[name] = rows.count()
    report = {"batch_id": sizes.batch_id, "folder": target, "record_counts": counts, "injected_issues": [f"{n}: {what}" for n, what in DEFECTS] if sizes.defects else [], "sizes": asdict(sizes) | {"reference": str(sizes.reference)}}
    Files(spark).write_json(f"{target}/generation_report.json", report)
    return report
