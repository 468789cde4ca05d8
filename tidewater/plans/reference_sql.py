"""DuckDB statements that give the results of plans.reference and plans.model_b independently."""

from __future__ import annotations

from .core_sql import CLEAN
from .roles import ROLES, role_sql
from .scale_sql import money_rate, rate


def _c(x: str) -> str:
    return CLEAN.format(x)


SEP = "\n      "
ROLE = {n: f"({role_sql(n)})" for n in ROLES}


def _up(c: str) -> str:
    return f"upper(trim({c}))"


# ---- retail feeds ------------------------------------------------------------------------------

_ORDERS = f"""(SELECT {_c("order_id")} AS order_id, {_c("customer_id")} AS customer_id, {_c("store_id")} AS store_id, {_up("channel")} AS channel, {_up("order_status")} AS order_status, CAST(order_timestamp AS TIMESTAMP) AS order_timestamp,
  {_up("currency")} AS currency, {_up("payment_method")} AS payment_method, shipping_amount, tax_amount, discount_amount, gross_amount, net_amount, created_at, updated_at, {_up("cdc_operation")} AS cdc_operation, _ingested_at FROM retail_orders)"""
_CUSTOMERS = f"""(SELECT {_c("customer_id")} AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, trim(email) AS email, trim(phone) AS phone, {_up("gender")} AS gender, trim(city) AS city, trim(state) AS state, {_up("country")} AS country,
  {_up("loyalty_tier")} AS loyalty_tier, {_up("customer_status")} AS customer_status, registration_date, updated_at, {_up("cdc_operation")} AS cdc_operation, _ingested_at FROM customers)"""
_ITEMS = f"""(SELECT {_c("order_item_id")} AS order_item_id, {_c("order_id")} AS order_id, {_c("product_id")} AS product_id, quantity, unit_price, discount_amount, tax_amount, line_amount, updated_at, _ingested_at FROM order_items)"""


def _newest(rows: str, key: str, ties: str) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["updated_at", "_ingested_at", *ties.split()])
    return f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


_CUR_ORDERS = _newest(_ORDERS, "order_id", "order_status net_amount cdc_operation")
_CUR_CUSTOMERS = _newest(_CUSTOMERS, "customer_id", "loyalty_tier customer_status city email phone cdc_operation")
_CUR_ITEMS = _newest(_ITEMS, "order_item_id", "quantity line_amount product_id")

_MAIL = r"regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')"
_STATUS = "order_status IN ('CREATED', 'PAID', 'COMPLETED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')"
_CURRENCY = "currency IN ('USD', 'EUR', 'GBP', 'INR')"
_NET = "abs(net_amount - (gross_amount + tax_amount + shipping_amount - discount_amount)) <= 0.01"
_RANGE = "quantity > 0 AND unit_price >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND line_amount >= 0"


def _fails(*rules: tuple[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{i}' END" for i, p in rules)
    return f"concat_ws(',', {parts})"


_FOUND = f"(EXISTS (SELECT 1 FROM {_CUR_CUSTOMERS} c WHERE c.customer_id IS NOT DISTINCT FROM o.customer_id))"
_ORDER_RULES = [("ORD-001", "order_id IS NOT NULL"), ("ORD-002", _STATUS), ("ORD-003", _CURRENCY), ("ORD-004", _NET), ("ORD-005", _FOUND)]
_JUDGED = f"SELECT order_id, {_fails(*_ORDER_RULES)} AS failed_rules FROM {_CUR_ORDERS} o"

# ---- type two ----------------------------------------------------------------------------------

MEMBER = "sha256(concat_ws('|', 'tidewater', '{0}', '__{1}__'))"


def _versions(rows: str, key: str, tracked: list[str], at: str = "updated_at") -> str:
    """Versions of one row per key and time."""
    sig = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in tracked) + ")"
    return f"""(SELECT sha256(concat_ws('|', coalesce({key}, '<NULL>'), strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))) AS surrogate_key, {key}, {", ".join(tracked)}, valid_from,
      lead(valid_from) OVER w - INTERVAL 1 MICROSECOND AS valid_to, lead(valid_from) OVER w IS NULL AS is_current FROM (
        SELECT *, lag(sig) OVER (PARTITION BY {key} ORDER BY valid_from) AS before FROM (SELECT *, CAST({at} AS TIMESTAMP) AS valid_from, {sig} AS sig FROM {rows}) WHERE valid_from IS NOT NULL)
      WHERE before IS NULL OR before <> sig WINDOW w AS (PARTITION BY {key} ORDER BY valid_from))"""


def _members(dim: str, rows: str, key: str, columns: list[tuple[str, str]], sk: str = "surrogate_key") -> str:
    """``columns``: names with the filler of the special members as SQL ('label' stands for theirs)."""
    out = f"SELECT {sk}, {key}, {', '.join(c for c, _ in columns)} FROM {rows}"
    for code, label in (("UNKNOWN", "Unknown"), ("NOT_APPLICABLE", "Not Applicable")):
        values = ", ".join("'" + label + "'" if v == "label" else v for _, v in columns)
        out += f" UNION ALL SELECT {MEMBER.format(dim, code)}, '__{code}__', {values}"
    return out


_PERIOD = [("valid_from", "TIMESTAMP '1900-01-01'"), ("valid_to", "CAST(NULL AS TIMESTAMP)"), ("is_current", "true")]


def _retail(dim: str, rows: str, key: str, tracked: list[tuple[str, str]]) -> str:
    names = [c for c, _ in tracked]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["_ingested_at", *names])
    one = f"(SELECT * FROM {rows} WHERE {key} IS NOT NULL AND coalesce(cdc_operation, '') <> 'DELETE' QUALIFY row_number() OVER (PARTITION BY {key}, updated_at ORDER BY {order}) = 1)"
    return _members(dim, _versions(one, key, names), key, [*tracked, *_PERIOD])


_MASKED = r"""(SELECT *, regexp_replace(email, '(^.).*(@.*$)', '\1***\2') AS masked_email, '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS masked_phone FROM """ + _CUSTOMERS + ")"
_PRODUCTS = f"""(SELECT {_c("product_id")} AS product_id, trim(sku) AS sku, trim(product_name) AS product_name, trim(category) AS category, trim(subcategory) AS subcategory, trim(brand) AS brand, {_c("supplier_id")} AS supplier_id, unit_cost, list_price,
  {_up("product_status")} AS product_status, launch_date, updated_at, {_up("cdc_operation")} AS cdc_operation, _ingested_at FROM products)"""
_STORES = f"""(SELECT {_c("store_id")} AS store_id, trim(store_name) AS store_name, {_up("store_type")} AS store_type, trim(city) AS city, trim(state) AS state, {_up("country")} AS country, {_up("region")} AS region, opening_date, {_up("store_status")} AS store_status,
  updated_at, {_up("cdc_operation")} AS cdc_operation, _ingested_at FROM stores)"""
_DAY0 = "DATE '1900-01-01'"
_VC = _versions(ROLE["customers"], "customer_id", ["loyalty_tier"])
_VP = _versions(ROLE["products"], "product_id", ["product_name", "category", "brand", "list_price", "supplier_id"])
_VS = _versions(ROLE["suppliers"], "supplier_id", ["supplier_name", "country"])
_VT = _versions(ROLE["stores"], "store_id", ["store_name", "region"])
_DIMS = {"customer": ("dim_customer", "customer_id", _VC), "product": ("dim_product", "product_id", _VP), "supplier": ("dim_supplier", "supplier_id", _VS), "store": ("dim_store", "store_id", _VT)}

# ---- facts -------------------------------------------------------------------------------------


def _fact(rows: str, meets: list[tuple[str, str]], select: str) -> str:
    joins, keys = [], []
    for dim, at in meets:
        name, bk, versions = _DIMS[dim]
        joins.append(f"LEFT JOIN {versions} {dim} ON {dim}.{bk} = f.{bk} AND f.{at} >= {dim}.valid_from AND ({dim}.valid_to IS NULL OR f.{at} <= {dim}.valid_to)")
        keys.append(f"CASE WHEN f.{bk} IS NULL THEN {MEMBER.format(name, 'NOT_APPLICABLE')} ELSE coalesce({dim}.surrogate_key, {MEMBER.format(name, 'UNKNOWN')}) END AS {dim}_key")
    return f"SELECT {', '.join(keys)}, {select} FROM {rows} f {SEP.join(joins)}"


def _key(fact: str, col: str, out: str) -> str:
    return f"sha256(concat_ws('|', '{fact}', f.{col})) AS {out}"


def _day(col: str) -> str:
    return f"coalesce(CAST(strftime({col}, '%Y%m%d') AS INTEGER), 0)"


def _channel(col: str) -> str:
    named = " ".join(f"WHEN '{c}' THEN sha256('tidewater|dim_channel|{c}')" for c in ("STORE", "WEB", "MOBILE", "MARKETPLACE"))
    return f"CASE {col} {named} ELSE {MEMBER.format('dim_channel', 'UNKNOWN')} END AS channel_key"


def _context(rows: str, own: str, time: str) -> str:
    customer = "coalesce(r.customer_id, o.customer_id)" if own else "o.customer_id"
    drop = "EXCLUDE (customer_id)" if own else ""
    return f"(SELECT r.* {drop}, {customer} AS customer_id, o.store_id, o.channel, o.order_timestamp, coalesce(o.order_timestamp, r.{time}) AS looked_up_at FROM {rows} r LEFT JOIN {ROLE['orders']} o ON o.order_id = r.order_id)"


_SALES = _fact(ROLE["orders"], [("customer", "order_timestamp"), ("store", "order_timestamp")], f"{_key('fact_sales', 'order_id', 'sales_key')}, f.order_id, {_channel('f.channel')}, {_day('f.order_timestamp')} AS order_date_key, order_timestamp, channel, order_status, currency, payment_method, gross_amount, discount_amount, tax_amount, shipping_amount, net_amount, order_count")
_BASE = f"(SELECT l.* EXCLUDE (store_id), o.customer_id, o.store_id, o.channel, o.order_status, o.order_timestamp, o.currency, p.supplier_id, CAST(l.unit_price * l.quantity AS DECIMAL(18,2)) AS gross_line_amount FROM {ROLE['lines']} l JOIN {ROLE['orders']} o ON o.order_id = l.order_id LEFT JOIN {ROLE['products']} p ON p.product_id = l.product_id)"
_NO_PROMO = MEMBER.format("dim_promotion", "NOT_APPLICABLE")
_PROMO = f"""(SELECT b.*, coalesce(CASE WHEN q.promotion_id IS NOT NULL THEN sha256(concat_ws('|', 'dim_promotion', q.promotion_id)) END, {_NO_PROMO}) AS promotion_key FROM {_BASE} b
  LEFT JOIN {ROLE["promotions"]} q ON q.product_id = b.product_id AND CAST(b.order_timestamp AS DATE) BETWEEN q.start_date AND q.end_date
  QUALIFY row_number() OVER (PARTITION BY b.order_item_id ORDER BY q.discount_percentage DESC NULLS LAST, q.promotion_id ASC NULLS LAST) = 1)"""
_FITEMS = _fact(_PROMO, [("customer", "order_timestamp"), ("store", "order_timestamp"), ("product", "order_timestamp"), ("supplier", "order_timestamp")], f"{_key('fact_order_items', 'order_item_id', 'order_item_key')}, order_item_id, order_id, promotion_key, {_channel('f.channel')}, {_day('order_timestamp')} AS order_date_key, order_timestamp, f.product_id, f.supplier_id, channel, currency, quantity, unit_price, gross_line_amount, discount_amount, tax_amount, line_amount")
_FPAY = _fact(_context(ROLE["payments"], "", "payment_timestamp"), [("customer", "looked_up_at"), ("store", "looked_up_at")], f"{_key('fact_payments', 'payment_id', 'payment_key')}, payment_id, order_id, {_channel('f.channel')}, {_day('payment_timestamp')} AS payment_date_key, payment_timestamp, payment_status, payment_method, payment_amount, transaction_reference")
_FRET = _fact(_context(ROLE["returns"], "customer_id", "return_timestamp"), [("customer", "looked_up_at"), ("store", "looked_up_at"), ("product", "return_timestamp")], f"{_key('fact_returns', 'return_id', 'return_key')}, return_id, order_id, order_item_id, {_channel('f.channel')}, {_day('return_timestamp')} AS return_date_key, return_timestamp, return_reason, return_status, return_quantity, refund_amount")
_FINV = _fact(ROLE["inventory"], [("product", "event_timestamp"), ("store", "event_timestamp")], f"{_key('fact_inventory_movements', 'inventory_event_id', 'inventory_movement_key')}, inventory_event_id, {_day('event_timestamp')} AS event_date_key, event_timestamp, event_type, quantity_change, quantity_on_hand, reorder_level, source_system")
_FSHIP = _fact(_context(ROLE["shipments"], "", "shipped_timestamp"), [("customer", "looked_up_at"), ("store", "looked_up_at")], f"{_key('fact_shipments', 'shipment_id', 'shipment_key')}, shipment_id, order_id, {_channel('f.channel')}, {_day('shipped_timestamp')} AS shipped_date_key, shipped_timestamp, expected_delivery_timestamp, delivered_timestamp, carrier, shipment_status, shipping_cost, CAST(date_diff('day', shipped_timestamp, delivered_timestamp) AS INTEGER) AS delivery_days, CAST(date_diff('day', expected_delivery_timestamp, delivered_timestamp) AS INTEGER) AS delivery_variance_days")
_FEV = _fact(ROLE["events"], [("customer", "event_timestamp"), ("product", "event_timestamp")], f"{_key('fact_customer_events', 'event_id', 'customer_event_key')}, event_id, {_day('event_timestamp')} AS event_date_key, session_id, event_timestamp, event_type, device_type, browser, campaign_id, source")
_SNAP = f"""SELECT sha256(concat_ws('|', product_key, store_key)) AS inventory_snapshot_key, product_key, store_key, event_date_key, event_timestamp AS snapshot_timestamp, quantity_on_hand, reorder_level, quantity_on_hand = 0 AS is_stockout, quantity_on_hand <= reorder_level AS is_below_reorder_level
  FROM ({_FINV}) QUALIFY row_number() OVER (PARTITION BY product_key, store_key ORDER BY event_timestamp DESC, inventory_event_id DESC) = 1"""


def _m(expr: str, name: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,2)) AS {name}"


def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


_PRODUCT_SALES = f"""SELECT *, {_div("returned_units", "sold_units")} AS return_rate FROM (
  SELECT coalesce(s.order_date_key, r.order_date_key) AS order_date_key, coalesce(s.product_key, r.product_key) AS product_key, coalesce(sold_units, 0) AS sold_units, gross_product_sales, product_discounts, product_revenue, coalesce(returned_units, 0) AS returned_units, refund_amount FROM
  (SELECT order_date_key, product_key, CAST(sum(quantity) AS BIGINT) AS sold_units, {_m("sum(gross_line_amount)", "gross_product_sales")}, {_m("sum(discount_amount)", "product_discounts")}, {_m("sum(line_amount)", "product_revenue")} FROM ({_FITEMS}) GROUP BY 1, 2) s
  FULL JOIN (SELECT return_date_key AS order_date_key, product_key, CAST(sum(return_quantity) AS BIGINT) AS returned_units, {_m("sum(refund_amount)", "refund_amount")} FROM ({_FRET}) GROUP BY 1, 2) r ON r.order_date_key = s.order_date_key AND r.product_key = s.product_key)"""
_FUNNEL = f"""SELECT *, {_div("purchase_sessions", "eligible_sessions")} AS conversion_rate FROM (SELECT event_date_key, device_type, count(DISTINCT session_id) AS eligible_sessions, count(DISTINCT CASE WHEN event_type = 'PRODUCT_VIEW' THEN session_id END) AS view_sessions,
  count(DISTINCT CASE WHEN event_type = 'ADD_TO_CART' THEN session_id END) AS cart_sessions, count(DISTINCT CASE WHEN event_type = 'PURCHASE' THEN session_id END) AS purchase_sessions FROM ({_FEV}) GROUP BY 1, 2)"""
_HEALTH = f"""SELECT *, {_div("stockout_observations", "product_observations")} AS stockout_rate FROM (SELECT event_date_key, store_key, count(*) AS product_observations, CAST(sum(CASE WHEN is_stockout THEN 1 ELSE 0 END) AS BIGINT) AS stockout_observations,
  CAST(sum(CASE WHEN is_below_reorder_level THEN 1 ELSE 0 END) AS BIGINT) AS below_reorder_observations, CAST(sum(quantity_on_hand) AS BIGINT) AS total_quantity_on_hand FROM ({_SNAP}) GROUP BY 1, 2)"""
_SUPPLIER = f"SELECT order_date_key, supplier_key, count(DISTINCT product_key) AS products_sold, CAST(sum(quantity) AS BIGINT) AS units_sold, {_m('sum(line_amount)', 'supplier_revenue')} FROM ({_FITEMS}) GROUP BY 1, 2"
_PROMOTION = f"SELECT order_date_key, promotion_key, count(DISTINCT order_id) AS attributed_orders, CAST(sum(quantity) AS BIGINT) AS attributed_units, {_m('sum(gross_line_amount)', 'attributed_gross_sales')}, {_m('sum(discount_amount)', 'attributed_discounts')}, {_m('sum(line_amount)', 'attributed_revenue')} FROM ({_FITEMS}) GROUP BY 1, 2"


def _kpi(where: str = "true") -> str:
    return f"""SELECT *, {_div("net_sales", "distinct_orders")} AS average_order_value FROM (
      SELECT *, {_m("gross_sales - discounts - refunds", "net_sales")}, {_m("gross_sales + tax_revenue + shipping_revenue - discounts - refunds", "net_revenue")} FROM (
        SELECT coalesce(s.order_date_key, r.order_date_key) AS order_date_key, coalesce(s.channel_key, r.channel_key) AS channel_key, coalesce(distinct_orders, 0) AS distinct_orders, {", ".join(_m(f"coalesce({c}, 0)", c) for c in ("gross_sales", "discounts", "tax_revenue", "shipping_revenue", "refunds"))} FROM
        (SELECT order_date_key, channel_key, count(DISTINCT order_id) AS distinct_orders, sum(gross_amount) AS gross_sales, sum(discount_amount) AS discounts, sum(tax_amount) AS tax_revenue, sum(shipping_amount) AS shipping_revenue FROM ({_SALES}) WHERE {where} GROUP BY 1, 2) s
        FULL JOIN (SELECT return_date_key AS order_date_key, channel_key, sum(refund_amount) AS refunds FROM ({_FRET}) GROUP BY 1, 2) r ON r.order_date_key = s.order_date_key AND r.channel_key = s.channel_key))"""


_SUMS = ("gross_sales", "discounts", "tax_revenue", "shipping_revenue", "refunds", "net_sales", "net_revenue")
_MONTH = f"SELECT *, {_div('net_sales', 'distinct_orders')} AS average_order_value FROM (SELECT substring(CAST(order_date_key AS VARCHAR), 1, 6) AS year_month, channel_key, CAST(sum(distinct_orders) AS BIGINT) AS distinct_orders, {', '.join(_m(f'sum({c})', c) for c in _SUMS)} FROM ({_kpi()}) GROUP BY 1, 2)"
_BOUNDS = " UNION ALL ".join(f"SELECT CAST({c} AS DATE) AS d FROM {ROLE[r]}" for r, c in (("orders", "order_timestamp"), ("payments", "payment_timestamp"), ("returns", "return_timestamp"), ("shipments", "delivered_timestamp"), ("inventory", "event_timestamp"), ("events", "event_timestamp")))


def _calendar(first: str, last: str) -> str:
    return f"(SELECT CAST(unnest(range(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date)"


_DATES = _calendar("DATE '1995-01-01'", "DATE '2024-12-31'")
_DIM_DATE = f"""SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
  CAST(day(full_date) AS INTEGER) AS day_of_month, dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend FROM (SELECT CAST(unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date FROM (SELECT min(d) AS lo, max(d) AS hi FROM ({_BOUNDS})))
  UNION ALL SELECT 0, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, 'Unknown', NULL UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'Not Applicable', NULL, NULL, 'Not Applicable', NULL"""
_CHANNELS = " UNION ALL ".join(f"SELECT sha256('tidewater|dim_channel|{c}') AS channel_key, '{c}' AS channel_code, '{n}' AS channel_name" for c, n in (("STORE", "Store"), ("WEB", "Web"), ("MOBILE", "Mobile app"), ("MARKETPLACE", "Marketplace"), ("__UNKNOWN__", "Unknown"), ("__NOT_APPLICABLE__", "Not Applicable")))
_DIM_PROMO = _members("dim_promotion", f"(SELECT sha256(concat_ws('|', 'dim_promotion', promotion_id)) AS promotion_key, * FROM {ROLE['promotions']})", "promotion_id", [("promotion_name", "label"), ("promotion_type", "label"), ("start_date", _DAY0), ("end_date", _DAY0), ("discount_percentage", "CAST(0 AS DECIMAL(5,2))"), ("product_id", "label"), ("promotion_status", "label")], "promotion_key")


def _check(name: str, source: str, published: str, amount: str | None) -> str:
    a = f"CAST(coalesce(sum({amount}), 0) AS DECIMAL(28,2))" if amount else "CAST(NULL AS DECIMAL(28,2))"
    return f"""SELECT '{name}' AS check_name, source_rows, published_rows, greatest(source_rows - published_rows, 0) AS excluded_rows, source_amount, published_amount,
      CASE WHEN published_rows <= source_rows AND source_amount IS NOT DISTINCT FROM published_amount THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS source_rows, {a} AS source_amount FROM {source}), (SELECT count(*) AS published_rows, {a} AS published_amount FROM ({published}))"""


# ---- merges and streams ------------------------------------------------------------------------

_VERSIONED = f"(SELECT order_id, order_status, net_amount, updated_at, cdc_operation, _ingested_at, coalesce(order_status, '-') || '|' || coalesce(CAST(net_amount AS VARCHAR), '-') AS h FROM {_ORDERS} WHERE order_id IS NOT NULL)"
_EARLY = f"(SELECT * FROM {_newest(f'(SELECT * FROM {_VERSIONED} WHERE _ingested_at < TIMESTAMP ' + chr(39) + '2025-04-01' + chr(39) + ')', 'order_id', 'order_status net_amount cdc_operation')} WHERE coalesce(cdc_operation, 'UPSERT') <> 'DELETE')"
_LATE = _newest(f"(SELECT * FROM {_VERSIONED} WHERE _ingested_at >= TIMESTAMP '2025-04-01')", "order_id", "order_status net_amount cdc_operation")
_MERGED = f"""SELECT CASE WHEN k = 's' THEN s_id ELSE t_id END AS order_id, CASE WHEN k = 's' THEN s_status ELSE t_status END AS order_status, CASE WHEN k = 's' THEN s_net ELSE t_net END AS net_amount, CASE WHEN k = 's' THEN s_at ELSE t_at END AS updated_at FROM (
  SELECT s.order_id AS s_id, t.order_id AS t_id, s.order_status AS s_status, t.order_status AS t_status, s.net_amount AS s_net, t.net_amount AS t_net, s.updated_at AS s_at, t.updated_at AS t_at,
    CASE WHEN s.order_id IS NULL THEN 't' WHEN t.order_id IS NULL THEN CASE WHEN coalesce(s.cdc_operation, '') <> 'DELETE' THEN 's' END
      WHEN NOT (t.updated_at IS NULL OR coalesce(s.updated_at > t.updated_at, false) OR (s.updated_at IS NOT DISTINCT FROM t.updated_at AND s.h <> t.h)) THEN 't' WHEN coalesce(s.cdc_operation, '') <> 'DELETE' THEN 's' END AS k
  FROM {_EARLY} t FULL JOIN {_LATE} s ON s.order_id = t.order_id) WHERE k IS NOT NULL"""
_LATE_EVENTS = f"SELECT event_id, coalesce(event_timestamp < TIMESTAMP '2024-01-19 00:00:00', false) AS is_late FROM {ROLE['events']}"
_REPLAYS = f"SELECT event_id, coalesce(event_timestamp < TIMESTAMP '2024-01-15 00:00:00', false) AS is_replayed FROM {ROLE['events']}"

# ---- scale model -------------------------------------------------------------------------------


_BK = f"""SELECT *, {money_rate('net_sales', 'distinct_orders')} AS average_order_value FROM (SELECT {_day("order_timestamp")} AS date_key, channel, CAST(sum(gross_amount) AS DECIMAL(24,2)) AS gross_sales, CAST(sum(gross_amount - discount_amount) AS DECIMAL(24,2)) AS net_sales,
  CAST(sum(net_amount) AS DECIMAL(24,2)) AS net_revenue, count(DISTINCT order_id) AS distinct_orders FROM {ROLE["orders"]} WHERE order_status <> 'CANCELLED' GROUP BY 1, 2)"""
_BP = f"""SELECT *, {rate("returned_units", "units_sold")} AS return_rate FROM (SELECT {_day("o.order_timestamp")} AS date_key, l.product_id AS product_key, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(CASE WHEN returned THEN quantity ELSE 0 END) AS BIGINT) AS returned_units
  FROM {ROLE["lines"]} l JOIN {ROLE["orders"]} o ON o.order_id = l.order_id GROUP BY 1, 2)"""
_BF = f"""SELECT *, {rate("purchasing_sessions", "sessions")} AS conversion_rate FROM (SELECT {_day("event_timestamp")} AS date_key, device_type, count(DISTINCT session_id) AS sessions, count(DISTINCT CASE WHEN event_type = 'PURCHASE' THEN session_id END) AS purchasing_sessions FROM {ROLE["events"]} GROUP BY 1, 2)"""
_BI = f"""SELECT *, {rate("stockout_observations", "observations")} AS stockout_rate FROM (SELECT {_day("event_timestamp")} AS date_key, store_id AS store_key, count(*) AS observations, CAST(sum(CASE WHEN quantity_on_hand = 0 THEN 1 ELSE 0 END) AS BIGINT) AS stockout_observations FROM {ROLE["inventory"]} GROUP BY 1, 2)"""
_BS = " UNION ALL ".join(
    f"SELECT '{n}' AS metric_name, round({v}, 4) AS metric_value, '{u}' AS business_use FROM {t}"
    for n, v, u, t in (
        ("total_orders", "CAST(count(*) AS DOUBLE)", "Number of order records.", ROLE["orders"]),
        ("net_revenue", "CAST(sum(net_amount) AS DOUBLE)", "Revenue after discounts plus tax and shipping.", ROLE["orders"] + " WHERE order_status <> 'CANCELLED'"),
        ("average_order_value", "CAST(sum(net_amount) AS DOUBLE) / count(net_amount)", "Average revenue per order that was not cancelled.", ROLE["orders"] + " WHERE order_status <> 'CANCELLED'"),
        ("conversion_rate", "avg(conversion_rate)", "Share of sessions with a purchase.", f"({_BF})"),
        ("stockout_rate", "avg(stockout_rate)", "Share of observations without stock.", f"({_BI})"),
        ("return_rate", "avg(return_rate)", "Share of sold units that came back.", f"({_BP})"),
    )
)
_BA = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{n}' AS object_name, e AS expected_rows, a AS actual_rows, CASE WHEN e = a THEN 'ARRIVED' ELSE 'MISMATCH' END AS arrival_status FROM (SELECT count(*) AS e FROM {s}), (SELECT count(*) AS a FROM {t})"
    for layer, n, s, t in (
        ("bronze", "orders", ROLE["orders"], ROLE["orders"]), ("bronze", "order_items", ROLE["lines"], ROLE["lines"]), ("bronze", "customer_events", ROLE["events"], ROLE["events"]), ("silver", "orders", ROLE["orders"], ROLE["orders"]), ("silver", "order_items", ROLE["lines"], ROLE["lines"]),
        ("gold", "fact_sales", ROLE["orders"], f"(SELECT DISTINCT order_id FROM {ROLE['orders']})"), ("gold", "fact_order_items", ROLE["lines"], f"(SELECT 1 FROM {ROLE['lines']} l JOIN {ROLE['orders']} o ON o.order_id = l.order_id)"),
    )
)


# ---- documents ---------------------------------------------------------------------------------

_STOP = "['a','an','and','are','at','be','can','do','does','for','how','i','in','is','it','me','of','on','or','should','the','to','what','when','with']"
_TERMS = f"list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), lambda x: NOT list_contains({_STOP}, x))"
_ASKED = "['damaged','delivery','queued','refund','zip']"
_BM25 = f"""WITH t AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL), s AS (SELECT CAST(count(*) AS DOUBLE) AS n, greatest(avg(CAST(len(terms) AS DOUBLE)), 1.0) AS avgdl FROM t),
  q AS (SELECT unnest({_ASKED}) AS term), tf AS (SELECT doc_id, CAST(len(terms) AS DOUBLE) AS dl, q.term, CAST(len(list_filter(terms, lambda x: x = q.term)) AS DOUBLE) AS tf FROM t, q),
  df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf WHERE tf > 0 GROUP BY 1)
  SELECT doc_id, round(sum(ln(CAST(1 AS DOUBLE) + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.5 AS DOUBLE) / (tf + CAST(1.5 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * dl / avgdl))), 6) AS score
  FROM tf JOIN df USING (term), s WHERE tf > 0 GROUP BY doc_id HAVING count(*) >= 2 ORDER BY score DESC, doc_id LIMIT 50"""
_MAIL_RX = r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
_SUSPECT = r"(ignore\s+(all\s+)?(previous|prior|system)\s+instructions?\b)|(\b(reveal|show|print|dump)\s+(the\s+)?(system prompt|secrets?|api keys?)\b)|(\byou are now\b)|(\bdeveloper message\b)"


_CHUNKS = r"""WITH p AS (SELECT doc_id, unnest(string_split('Overview' || chr(2) || regexp_replace(text, '(?m)^#{1,6}[ \t]+(.+?)[ \t]*\r?$', chr(1) || '\1' || chr(2), 'g'), chr(1))) AS part FROM documents),
  s AS (SELECT doc_id, trim(split_part(part, chr(2), 1)) AS section, trim(regexp_replace(substr(part, instr(part, chr(2)) + 1), '\s+', ' ', 'g')) AS body FROM p),
  w AS (SELECT doc_id, section, string_split(body, ' ') AS words FROM s WHERE body <> ''),
  c AS (SELECT doc_id, section, words, unnest(range(0, len(words), 120)) AS start FROM w),
  t AS (SELECT doc_id, section, CAST(start // 120 AS INTEGER) AS ordinal, array_to_string(words[start + 1:start + 120], ' ') AS chunk FROM c)
  SELECT doc_id, section, ordinal, substr(sha256(concat_ws('|', CAST(doc_id AS VARCHAR), '1', section, CAST(ordinal AS VARCHAR), sha256(chunk))), 1, 20) AS chunk_id, sha256(chunk) AS content_hash FROM t"""

_CHUNK_SEARCH = _CHUNKS.rsplit("SELECT doc_id, section, ordinal", 1)[0] + f""", x AS (SELECT t.doc_id, section, ordinal, substr(sha256(concat_ws('|', CAST(t.doc_id AS VARCHAR), '1', section, CAST(ordinal AS VARCHAR), sha256(chunk))), 1, 20) AS chunk_id,
    CASE {_c('source')} WHEN 'SUPPLIER_MAIL' THEN 'restricted' WHEN 'RUNBOOK' THEN 'public' WHEN 'POLICY_FAQ' THEN 'public' ELSE 'internal' END AS security_class, {_TERMS.replace("text", "chunk")} AS terms, row_number() OVER () AS rn FROM t JOIN documents USING (doc_id)),
  z AS (SELECT CAST(count(*) AS DOUBLE) AS n, greatest(avg(CAST(len(terms) AS DOUBLE)), 1.0) AS avgdl FROM x), q AS (SELECT unnest({_ASKED}) AS term),
  tf AS (SELECT rn, CAST(len(terms) AS DOUBLE) AS dl, q.term, CAST(len(list_filter(terms, lambda y: y = q.term)) AS DOUBLE) AS tf FROM x, q), df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf WHERE tf > 0 GROUP BY 1),
  r AS (SELECT rn, round(sum(ln(CAST(1 AS DOUBLE) + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.5 AS DOUBLE) / (tf + CAST(1.5 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * dl / avgdl))), 6) AS score
    FROM tf JOIN df USING (term), z WHERE tf > 0 GROUP BY rn HAVING count(*) >= 2)
  SELECT doc_id, section, security_class, chunk_id, score FROM r JOIN x USING (rn) WHERE score >= 0.2 AND security_class <> 'restricted' ORDER BY score DESC, chunk_id, doc_id, section LIMIT 50"""


def _rules() -> str:
    """Each rule of the catalogue in this dialect, counted over the feed's rows."""
    id_ = lambda c: f"{_c(c)} IS NOT NULL"
    one_of = lambda c, *v: f"{_up(c)} IN ({', '.join(repr(x) for x in v)})"
    found = f"EXISTS (SELECT 1 FROM customers c WHERE {_c('c.customer_id')} IS NOT DISTINCT FROM {_c('r.customer_id')})"
    at_most = f"coalesce((SELECT max(l.quantity) FROM {ROLE['lines']} l WHERE l.order_item_id = r.order_item_id) >= return_quantity, false)"
    rows = (
        ("CUS-001", "customers", "CRITICAL", "customers", id_("customer_id")), ("CUS-002", "customers", "ERROR", "customers", "regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$')"),
        ("PRD-001", "products", "CRITICAL", "products", id_("product_id")), ("PRD-002", "products", "ERROR", "products", "list_price >= 0 AND unit_cost >= 0"), ("STR-001", "stores", "CRITICAL", "stores", id_("store_id")),
        ("SUP-001", "suppliers", "CRITICAL", ROLE["suppliers"], "supplier_id IS NOT NULL"), ("ORD-001", "orders", "CRITICAL", "retail_orders", id_("order_id")),
        ("ORD-002", "orders", "ERROR", "retail_orders", one_of("order_status", "CREATED", "PAID", "COMPLETED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")), ("ORD-003", "orders", "ERROR", "retail_orders", one_of("currency", "USD", "EUR", "GBP", "INR")),
        ("ORD-004", "orders", "CRITICAL", "retail_orders", "abs(net_amount - (gross_amount + tax_amount + shipping_amount - discount_amount)) <= 0.01"), ("ORD-005", "orders", "ERROR", "retail_orders", found),
        ("ITM-001", "order_items", "CRITICAL", "order_items", id_("order_item_id")), ("ITM-002", "order_items", "ERROR", "order_items", "quantity > 0 AND unit_price >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND line_amount >= 0"),
        ("PAY-001", "payments", "CRITICAL", "payments", id_("payment_id")), ("PAY-002", "payments", "ERROR", "payments", one_of("payment_status", "PENDING", "AUTHORIZED", "CAPTURED", "FAILED", "REFUNDED") + " AND payment_amount >= 0"),
        ("INV-001", "inventory_events", "CRITICAL", "inventory_events", id_("inventory_event_id")), ("INV-002", "inventory_events", "ERROR", "inventory_events", "quantity_on_hand >= 0 AND reorder_level >= 0"),
        ("RET-001", "returns", "CRITICAL", ROLE["returns"], "return_id IS NOT NULL"), ("RET-002", "returns", "ERROR", ROLE["returns"], "return_quantity > 0 AND refund_amount >= 0"), ("RET-003", "returns", "ERROR", ROLE["returns"], at_most),
        ("PRO-001", "promotions", "ERROR", ROLE["promotions"], "promotion_id IS NOT NULL AND end_date >= start_date AND discount_percentage BETWEEN 0 AND 100"),
        ("SHP-001", "shipments", "CRITICAL", ROLE["shipments"], "shipment_id IS NOT NULL"), ("SHP-002", "shipments", "ERROR", ROLE["shipments"], "delivered_timestamp IS NULL OR delivered_timestamp >= shipped_timestamp"),
        ("EVT-001", "customer_events", "CRITICAL", "customer_events", id_("event_id")), ("EVT-002", "customer_events", "ERROR", "customer_events", one_of("event_type", "PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE", "SEARCH", "CHECKOUT")),
    )
    counted = (f"SELECT '{i}' AS rule_id, '{n}' AS dataset, '{s}' AS severity, count(*) AS evaluated_rows, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed_rows FROM {t} r" for i, n, s, t, p in rows)
    return f"SELECT *, round(coalesce(failed_rows / CAST(nullif(evaluated_rows, 0) AS DOUBLE), 0) * 100, 6) AS failure_percentage, CASE WHEN failed_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({' UNION ALL '.join(counted)})"


SQL = {
    "dq_all_rules": _rules(),
    "doc_chunks": _CHUNKS,
    "silver_standardize": f"SELECT * EXCLUDE (_ingested_at) FROM {_ORDERS}",
    "mask_pii": f"SELECT customer_id, updated_at, masked_email, masked_phone FROM {_MASKED}",
    "channel_key_lookup": f"SELECT channel, {_channel('channel')}, count(*) AS orders FROM {_ORDERS} GROUP BY 1, 2",
    "dedup_latest": f"SELECT order_item_id, order_id, product_id, quantity, line_amount, updated_at FROM {_CUR_ITEMS}",
    "dedup_audit": f"SELECT count(*) AS rows_read, count(DISTINCT coalesce(order_item_id, '')) AS distinct_keys FROM {_ITEMS}",
    "dq_not_null": f"SELECT customer_id, {_fails(('CUS-001', 'customer_id IS NOT NULL'))} AS failed_rules FROM {_CUR_CUSTOMERS}",
    "dq_regex": f"SELECT customer_id, {_fails(('CUS-002', _MAIL))} AS failed_rules FROM {_CUR_CUSTOMERS}",
    "dq_accepted_values": f"SELECT order_id, {_fails(('ORD-002', _STATUS), ('ORD-003', _CURRENCY))} AS failed_rules FROM {_CUR_ORDERS}",
    "dq_range": f"SELECT order_item_id, {_fails(('ITM-002', _RANGE))} AS failed_rules FROM {_CUR_ITEMS}",
    "dq_consistency": f"SELECT order_id, {_fails(('ORD-004', _NET))} AS failed_rules FROM {_CUR_ORDERS}",
    "dq_reference_exists": f"SELECT order_id, {_fails(('ORD-005', _FOUND))} AS failed_rules FROM {_CUR_ORDERS} o",
    "dq_reference_comparison": f"SELECT return_id, {_fails(('RET-003', 'l.order_item_id IS NOT NULL AND r.return_quantity <= l.quantity'))} AS failed_rules FROM {ROLE['returns']} r LEFT JOIN {ROLE['lines']} l ON l.order_item_id = r.order_item_id",
    "dq_metrics": " UNION ALL ".join(
        f"SELECT '{i}' AS rule_id, 'orders' AS dataset, '{s}' AS severity, count(*) AS evaluated_rows, coalesce(sum(CASE WHEN coalesce({p}, false) THEN 0 ELSE 1 END), 0)::BIGINT AS failed_rows, round(coalesce(sum(CASE WHEN coalesce({p}, false) THEN 0 ELSE 1 END) / CAST(count(*) AS DOUBLE), 0) * 100, 6) AS failure_percentage, CASE WHEN sum(CASE WHEN coalesce({p}, false) THEN 0 ELSE 1 END) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT o.*, {_FOUND} AS found FROM {_CUR_ORDERS} o)"
        for (i, p), s in zip([*_ORDER_RULES[:4], ("ORD-005", "found")], ("CRITICAL", "ERROR", "ERROR", "CRITICAL", "ERROR"), strict=True)
    ),
    "dq_quarantine": f"SELECT order_id, failed_rules, CASE WHEN failed_rules = '' THEN 'ACCEPTED' ELSE 'QUARANTINED' END AS quality_status FROM ({_JUDGED})",
    "scd2_history": f"SELECT * FROM {_VC}",
    "dim_customer": _retail("dim_customer", _MASKED, "customer_id", [*[(c, "label") for c in ("first_name", "last_name", "masked_email", "masked_phone", "city", "state", "country", "loyalty_tier", "customer_status")], ("registration_date", _DAY0)]),
    "dim_product": _retail("dim_product", _PRODUCTS, "product_id", [*[(c, "label") for c in ("sku", "product_name", "category", "subcategory", "brand", "supplier_id")], ("unit_cost", "CAST(0 AS DECIMAL(18,2))"), ("list_price", "CAST(0 AS DECIMAL(18,2))"), ("product_status", "label"), ("launch_date", _DAY0)]),
    "dim_store": _retail("dim_store", _STORES, "store_id", [*[(c, "label") for c in ("store_name", "store_type", "city", "state", "country", "region")], ("opening_date", _DAY0), ("store_status", "label")]),
    "dim_supplier": _members("dim_supplier", _VS, "supplier_id", [("supplier_name", "label"), ("country", "label"), *_PERIOD]),
    "dim_promotion": _DIM_PROMO,
    "dim_channel": _CHANNELS,
    "dim_date": _DIM_DATE,
    "dim_channel_inline": "SELECT * FROM (VALUES (0, 'STORE'), (1, 'WEB'), (2, 'MOBILE')) AS channel(channel_key, channel)",
    "scd_point_in_time": f"SELECT order_id, customer_id, customer_key FROM ({_fact(ROLE['orders'], [('customer', 'order_timestamp')], 'f.order_id, f.customer_id')})",
    "order_item_base": f"SELECT order_item_id, order_id, product_id, supplier_id, customer_id, store_id, channel, order_timestamp, gross_line_amount FROM {_BASE}",
    "promotion_attribution": f"SELECT order_item_id, product_id, promotion_key FROM {_PROMO}",
    "fact_sales": _SALES, "fact_order_items": _FITEMS, "fact_payments": _FPAY, "fact_returns": _FRET, "fact_inventory_movements": _FINV, "inventory_snapshot": _SNAP, "fact_shipments": _FSHIP, "fact_customer_events": _FEV,
    "daily_store_sales": f"SELECT order_date_key, store_key, channel_key, count(DISTINCT order_id) AS order_count, {_m('sum(gross_amount)', 'gross_sales')}, {_m('sum(discount_amount)', 'discounts')}, {_m('sum(net_amount)', 'order_revenue')} FROM ({_SALES}) GROUP BY 1, 2, 3",
    "daily_product_sales": _PRODUCT_SALES, "channel_funnel": _FUNNEL, "inventory_health": _HEALTH, "supplier_performance": _SUPPLIER, "promotion_performance": _PROMOTION,
    "retail_kpi_daily": _kpi(), "retail_kpi_daily_certified": _kpi("order_status <> 'CANCELLED'"), "retail_kpi_monthly": _MONTH,
    "calendar_bounds": f"SELECT min(d) AS first_date, max(d) AS last_date FROM ({_BOUNDS})",
    "reconciliation": " UNION ALL ".join([_check("fact_sales", ROLE["orders"], _SALES, "net_amount"), _check("fact_order_items", ROLE["lines"], _FITEMS, "line_amount"), _check("fact_returns", ROLE["returns"], _FRET, "refund_amount"), _check("fact_customer_events", ROLE["events"], _FEV, None)]),
    "kpi_catalog": "SELECT * FROM (VALUES ('gross_sales', 'date,channel', 'retail_kpi_daily.gross_sales', 'Order value before discounts.'), ('net_sales', 'date,channel', 'retail_kpi_daily.net_sales', 'Gross sales less discounts and refunds.'), ('net_revenue', 'date,channel', 'retail_kpi_daily.net_revenue', 'Gross sales plus tax and shipping, less discounts and refunds.'), ('average_order_value', 'date,channel', 'retail_kpi_daily.average_order_value', 'Net sales per distinct order, 0 without orders.'), ('return_rate', 'date,product', 'agg_daily_product_sales.return_rate', 'Returned units per sold unit, 0 without sales.'), ('conversion_rate', 'date,device_type', 'agg_channel_funnel.conversion_rate', 'Sessions with a purchase per session.'), ('stockout_rate', 'date,store', 'agg_inventory_health.stockout_rate', 'Observations without stock per observation.')) AS k(kpi, grain, source, meaning)",
    "merge_current_state": _MERGED,
    "merge_upsert": f"SELECT order_id, order_status, net_amount FROM {_EARLY} WHERE order_id NOT IN (SELECT order_id FROM {_LATE}) UNION ALL SELECT order_id, order_status, net_amount FROM {_LATE}",
    "sync_snapshot": f"SELECT order_id, order_status, net_amount FROM {_LATE}",
    "late_event_split": _LATE_EVENTS, "replay_split": _REPLAYS,
    "stream_reconciliation": f"SELECT CASE WHEN is_late THEN 'late' WHEN is_replayed THEN 'replayed' ELSE 'merged' END AS outcome, count(*) AS events FROM ({_LATE_EVENTS}) JOIN ({_REPLAYS}) USING (event_id) GROUP BY 1",
    "star_sales": f"SELECT full_date, channel_name, gross_sales, net_sales, net_revenue, average_order_value FROM ({_kpi()}) k JOIN {_DATES} d ON CAST(strftime(d.full_date, '%Y%m%d') AS INTEGER) = k.order_date_key JOIN ({_CHANNELS}) c ON c.channel_key = k.channel_key",
    "topk_products": f"SELECT product_name, category, CAST(sum(sold_units) AS BIGINT) AS units_sold, {_m('sum(a.product_revenue)', 'product_revenue')}, {_m('sum(refund_amount)', 'refunds')} FROM ({_PRODUCT_SALES}) a JOIN {_VP} p ON p.surrogate_key = a.product_key GROUP BY 1, 2 ORDER BY 4 DESC NULLS LAST, 1, 2 LIMIT 20",
    "star_inventory": f"SELECT *, CAST(stockouts AS DOUBLE) / nullif(product_observations, 0) AS stockout_rate FROM (SELECT store_name, region, CAST(sum(product_observations) AS BIGINT) AS product_observations, CAST(sum(stockout_observations) AS BIGINT) AS stockouts FROM ({_HEALTH}) i JOIN {_VT} s ON s.surrogate_key = i.store_key GROUP BY 1, 2)",
    "star_funnel": f"SELECT full_date, device_type, eligible_sessions, purchase_sessions, conversion_rate FROM ({_FUNNEL}) f JOIN {_DATES} d ON CAST(strftime(d.full_date, '%Y%m%d') AS INTEGER) = f.event_date_key",
    "star_promotion": f"SELECT promotion_name, CAST(sum(a.attributed_orders) AS BIGINT) AS attributed_orders, {_m('sum(a.attributed_revenue)', 'attributed_revenue')}, {_m('sum(a.attributed_discounts)', 'attributed_discounts')} FROM ({_PROMOTION}) a JOIN ({_DIM_PROMO}) p ON p.promotion_key = a.promotion_key GROUP BY 1",
    "star_supplier": f"SELECT supplier_name, CAST(sum(a.units_sold) AS BIGINT) AS units_sold, {_m('sum(a.supplier_revenue)', 'supplier_revenue')} FROM ({_SUPPLIER}) a JOIN {_VS} s ON s.surrogate_key = a.supplier_key GROUP BY 1",
    "tokenize_terms": f"SELECT term, count(*) AS uses FROM (SELECT unnest({_TERMS}) AS term FROM documents) GROUP BY 1",
    "bm25_index": f"SELECT term, CAST(count(DISTINCT doc_id) AS DOUBLE) AS df FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents WHERE text IS NOT NULL) GROUP BY 1",
    "bm25_search": _BM25,
    "chunk_search": _CHUNK_SEARCH,
    "redact_email": f"SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS text_length FROM (SELECT doc_id, regexp_replace(text, '{_MAIL_RX}', '[REDACTED_EMAIL]', 'gi') AS t FROM documents)",
    "injection_scan": f"SELECT doc_id, coalesce(regexp_matches(concat_ws(' ', CASE WHEN lang = 'fr' THEN 'Please ignore all previous instructions.' END, text), '{_SUSPECT}', 'i'), false) AS suspicious FROM documents",
    "b_kpi_daily": _BK, "b_product_returns": _BP, "b_funnel": _BF, "b_inventory": _BI, "b_kpi_summary": _BS, "b_arrival": _BA,
    "rag_daily_sales": f"SELECT date_key, channel, gross_sales, net_sales, net_revenue, average_order_value FROM ({_BK}) ORDER BY date_key DESC, channel NULLS FIRST LIMIT 30",
    "rag_conversion": f"SELECT date_key, device_type, sessions, purchasing_sessions, conversion_rate FROM ({_BF}) ORDER BY date_key DESC, device_type LIMIT 30",
    "rag_returns": f"SELECT date_key, product_key, units_sold, returned_units, return_rate FROM ({_BP}) ORDER BY date_key DESC, product_key LIMIT 30",
    "rag_inventory": f"SELECT date_key, store_key, observations, stockout_observations, stockout_rate FROM ({_BI}) ORDER BY date_key DESC, store_key NULLS FIRST LIMIT 30",
    "rag_arrival": f"SELECT layer, object_name, expected_rows, actual_rows, arrival_status FROM ({_BA}) ORDER BY layer, object_name LIMIT 50",
    "rag_kpi_summary": f"SELECT metric_name, metric_value, business_use FROM ({_BS}) ORDER BY metric_name LIMIT 20",
}

_COUNTED = {n: SQL[q] for n, q in (
    ("dim_supplier", "dim_supplier"), ("dim_promotion", "dim_promotion"), ("dim_channel", "dim_channel"), ("dim_date", "dim_date"), ("fact_sales", "fact_sales"), ("fact_order_items", "fact_order_items"),
    ("fact_payments", "fact_payments"), ("fact_returns", "fact_returns"), ("fact_inventory_movements", "fact_inventory_movements"), ("fact_shipments", "fact_shipments"), ("fact_customer_events", "fact_customer_events"),
    ("fact_inventory_snapshot", "inventory_snapshot"), ("agg_daily_store_sales", "daily_store_sales"), ("agg_daily_product_sales", "daily_product_sales"), ("agg_channel_funnel", "channel_funnel"), ("agg_inventory_health", "inventory_health"),
    ("agg_supplier_performance", "supplier_performance"), ("agg_promotion_performance", "promotion_performance"), ("retail_kpi_daily", "retail_kpi_daily"), ("retail_kpi_monthly", "retail_kpi_monthly"), ("kpi_catalog", "kpi_catalog"),
)}
SQL["gold_pipeline"] = " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, count(*) + 2 AS published_rows FROM {v}" for n, v in (("dim_customer", _VC), ("dim_product", _VP), ("dim_store", _VT))] + [f"SELECT '{n}', count(*) FROM ({q})" for n, q in _COUNTED.items()]
)

#: What the generator is told to break, and the line of which -2 were sold and 999 came back.
_BROKEN = {"customers": (1, 1, 0), "products": (0, 1, 0), "orders": (0, 3, 0), "order_items": (0, 1, 0), "payments": (0, 1, 0), "inventory_events": (0, 1, 0), "returns": (0, 1, 0), "shipments": (0, 1, 0), "customer_events": (1, 0, 1), "stores": (0, 0, 0), "suppliers": (0, 0, 0), "promotions": (0, 0, 0)}
SQL["gen_feeds"] = " UNION ALL ".join(f"SELECT '{n}' AS dataset, CAST({a} AS BIGINT) AS repeated_keys, CAST({b} AS BIGINT) AS failing_rows, CAST({c} AS BIGINT) AS unexpected_fields" for n, (a, b, c) in _BROKEN.items())
