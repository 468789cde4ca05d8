"""Contracts of the sources: columns and types, keys, event time, upper-cased codes, rules, KPIs.

All of this is fixed values: data that states what the sources look like, not logic.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values -----------------------------------------------------------------------------
_MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Contract:
    name: str
    keys: tuple[str, ...]
    event_time: str
    columns: tuple[tuple[str, str], ...]
    upper: tuple[str, ...] = ()
    operation: str | None = None

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in self.columns)


def _contract(name: str, keys: str, event_time: str, columns: str, upper: str = "", operation: str | None = None) -> Contract:
    """``columns``: names with ':type' where it is not string; m is money, ts a time stamp."""
    kinds = {"m": _MONEY, "ts": "timestamp", "d": "date", "i": "int", "r": "decimal(5,2)"}
    pairs = tuple((c.split(":")[0], kinds[c.split(":")[1]] if ":" in c else "string") for c in columns.split())
    return Contract(name, tuple(keys.split()), event_time, pairs, tuple(upper.split()), operation)


CONTRACTS = {
    c.name: c
    for c in (
        _contract("customers", "customer_id", "updated_at", "customer_id first_name last_name email phone date_of_birth:d gender address city state country postal_code loyalty_tier registration_date:d customer_status created_at:ts updated_at:ts cdc_operation", "gender country loyalty_tier customer_status cdc_operation", "cdc_operation"),
        _contract("products", "product_id", "updated_at", "product_id sku product_name category subcategory brand supplier_id unit_cost:m list_price:m product_status launch_date:d created_at:ts updated_at:ts cdc_operation", "product_status cdc_operation", "cdc_operation"),
        _contract("stores", "store_id", "updated_at", "store_id store_name store_type city state country region opening_date:d store_status manager_id created_at:ts updated_at:ts cdc_operation", "store_type country region store_status cdc_operation", "cdc_operation"),
        _contract("suppliers", "supplier_id", "updated_at", "supplier_id supplier_name contact_email country supplier_rating:r lead_time_days:i supplier_status created_at:ts updated_at:ts cdc_operation", "country supplier_status cdc_operation", "cdc_operation"),
        _contract("orders", "order_id", "updated_at", "order_id customer_id store_id channel order_status order_timestamp:ts currency payment_method shipping_amount:m tax_amount:m discount_amount:m gross_amount:m net_amount:m created_at:ts updated_at:ts cdc_operation", "channel order_status currency payment_method cdc_operation", "cdc_operation"),
        _contract("order_items", "order_item_id", "updated_at", "order_item_id order_id product_id quantity:i unit_price:m discount_amount:m tax_amount:m line_amount:m created_at:ts updated_at:ts"),
        _contract("payments", "payment_id", "updated_at", "payment_id order_id payment_status payment_method payment_amount:m transaction_reference payment_timestamp:ts created_at:ts updated_at:ts", "payment_status payment_method"),
        _contract("inventory_events", "inventory_event_id", "event_timestamp", "inventory_event_id product_id store_id event_type quantity_change:i quantity_on_hand:i reorder_level:i event_timestamp:ts source_system", "event_type source_system"),
        _contract("returns", "return_id", "return_timestamp", "return_id order_id order_item_id customer_id product_id return_reason return_status return_quantity:i refund_amount:m return_timestamp:ts processed_timestamp:ts", "return_reason return_status"),
        _contract("promotions", "promotion_id", "end_date", "promotion_id promotion_name promotion_type start_date:d end_date:d discount_percentage:r discount_amount:m category product_id minimum_order_value:m promotion_status", "promotion_type promotion_status"),
        _contract("shipments", "shipment_id", "delivered_timestamp", "shipment_id order_id carrier shipment_status shipped_timestamp:ts expected_delivery_timestamp:ts delivered_timestamp:ts shipping_cost:m tracking_number", "carrier shipment_status"),
        _contract("customer_events", "event_id", "event_timestamp", "event_id session_id customer_id event_type product_id event_timestamp:ts page_url device_type browser campaign_id source ingestion_timestamp:ts", "event_type device_type browser source"),
    )
}

#: rule id, dataset, type, severity, pass expression, (reference dataset, key pairs, compared column)
RULES: tuple[tuple, ...] = (
    ("CUS-001", "customers", "not_null", "CRITICAL", "customer_id IS NOT NULL", None),
    ("CUS-002", "customers", "regex", "ERROR", r"email RLIKE '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'", None),
    ("PRD-001", "products", "not_null", "CRITICAL", "product_id IS NOT NULL", None),
    ("PRD-002", "products", "range", "ERROR", "list_price >= 0 AND unit_cost >= 0", None),
    ("STR-001", "stores", "not_null", "CRITICAL", "store_id IS NOT NULL", None),
    ("SUP-001", "suppliers", "not_null", "CRITICAL", "supplier_id IS NOT NULL", None),
    ("ORD-001", "orders", "not_null", "CRITICAL", "order_id IS NOT NULL", None),
    ("ORD-002", "orders", "accepted_values", "ERROR", "order_status IN ('CREATED', 'PAID', 'COMPLETED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')", None),
    ("ORD-003", "orders", "accepted_values", "ERROR", "currency IN ('USD', 'EUR', 'GBP', 'INR')", None),
    ("ORD-004", "orders", "consistency", "CRITICAL", "abs(net_amount - (gross_amount + tax_amount + shipping_amount - discount_amount)) <= 0.01", None),
    ("ORD-005", "orders", "reference_exists", "ERROR", "_reference_exists", ("customers", (("customer_id", "customer_id"),), None)),
    ("ITM-001", "order_items", "not_null", "CRITICAL", "order_item_id IS NOT NULL", None),
    ("ITM-002", "order_items", "range", "ERROR", "quantity > 0 AND unit_price >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND line_amount >= 0", None),
    ("PAY-001", "payments", "not_null", "CRITICAL", "payment_id IS NOT NULL", None),
    ("PAY-002", "payments", "accepted_values", "ERROR", "payment_status IN ('PENDING', 'AUTHORIZED', 'CAPTURED', 'FAILED', 'REFUNDED') AND payment_amount >= 0", None),
    ("INV-001", "inventory_events", "not_null", "CRITICAL", "inventory_event_id IS NOT NULL", None),
    ("INV-002", "inventory_events", "range", "ERROR", "quantity_on_hand >= 0 AND reorder_level >= 0", None),
    ("RET-001", "returns", "not_null", "CRITICAL", "return_id IS NOT NULL", None),
    ("RET-002", "returns", "range", "ERROR", "return_quantity > 0 AND refund_amount >= 0", None),
    ("RET-003", "returns", "reference_comparison", "ERROR", "return_quantity <= _reference_value", ("order_items", (("order_item_id", "order_item_id"),), "quantity")),
    ("PRO-001", "promotions", "consistency", "ERROR", "promotion_id IS NOT NULL AND end_date >= start_date AND discount_percentage BETWEEN 0 AND 100 AND discount_amount >= 0", None),
    ("SHP-001", "shipments", "not_null", "CRITICAL", "shipment_id IS NOT NULL", None),
    ("SHP-002", "shipments", "consistency", "ERROR", "delivered_timestamp IS NULL OR delivered_timestamp >= shipped_timestamp", None),
    ("EVT-001", "customer_events", "not_null", "CRITICAL", "event_id IS NOT NULL", None),
    ("EVT-002", "customer_events", "accepted_values", "ERROR", "event_type IN ('PRODUCT_VIEW', 'ADD_TO_CART', 'PURCHASE', 'SEARCH', 'CHECKOUT')", None),
)

#: name, grain, table.column, meaning
KPIS: tuple[tuple[str, tuple[str, ...], str, str], ...] = (
    ("gross_sales", ("date", "channel"), "retail_kpi_daily.gross_sales", "Order value before discounts."),
    ("net_sales", ("date", "channel"), "retail_kpi_daily.net_sales", "Gross sales less discounts and refunds."),
    ("net_revenue", ("date", "channel"), "retail_kpi_daily.net_revenue", "Gross sales plus tax and shipping, less discounts and refunds."),
    ("average_order_value", ("date", "channel"), "retail_kpi_daily.average_order_value", "Net sales per distinct order, 0 without orders."),
    ("return_rate", ("date", "product"), "agg_daily_product_sales.return_rate", "Returned units per sold unit, 0 without sales."),
    ("conversion_rate", ("date", "device_type"), "agg_channel_funnel.conversion_rate", "Sessions with a purchase per session."),
    ("stockout_rate", ("date", "store"), "agg_inventory_health.stockout_rate", "Observations without stock per observation."),
)

#: dimension -> (source, key, effective time, tracked columns)
DIMENSION_CONTRACTS = {
    "dim_customer": ("customers", "customer_id", "updated_at", ("first_name", "last_name", "masked_email", "masked_phone", "city", "state", "country", "loyalty_tier", "customer_status", "registration_date")),
    "dim_product": ("products", "product_id", "updated_at", ("sku", "product_name", "category", "subcategory", "brand", "supplier_id", "unit_cost", "list_price", "product_status", "launch_date")),
    "dim_store": ("stores", "store_id", "updated_at", ("store_name", "store_type", "city", "state", "country", "region", "opening_date", "store_status")),
    "dim_supplier": ("suppliers", "supplier_id", "updated_at", ("supplier_name", "country", "supplier_rating", "lead_time_days", "supplier_status")),
}
CHANNELS = (("STORE", "Store"), ("WEB", "Web"), ("MOBILE", "Mobile app"), ("MARKETPLACE", "Marketplace"))
UNKNOWN, NOT_APPLICABLE, NAMESPACE = "__UNKNOWN__", "__NOT_APPLICABLE__", "tidewater"
STOP_WORDS = frozenset("a an and are at be can do does for how i in is it me of on or should the to what when with".split())
INJECTIONS = (
    r"(?i)\bignore\s+(?:all\s+)?(?:previous|prior|system)\s+instructions?\b",
    r"(?i)\b(?:reveal|show|print|dump)\s+(?:the\s+)?(?:system prompt|secrets?|api keys?)\b",
    r"(?i)\byou are now\b",
    r"(?i)\bdeveloper message\b",
)
MAIL_PATTERN = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE_PATTERN = r"(?<!\w)(?:\+?\d[\d ()-]{7,}\d)(?!\w)"
# ---- end of fixed values ----------------------------------------------------------------------
