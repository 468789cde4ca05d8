"""DuckDB statements of the scale model: its generated tables and its aggregates at the full load."""

from __future__ import annotations


def half_up(a: str, b: str, digits: int) -> str:
    """a / b rounded half up in whole numbers, a and b not negative and b above 0."""
    return f"(2 * CAST({a} AS HUGEINT) * {10**digits} + {b}) // (2 * {b})"


def rate(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN CAST(0 AS DECIMAL(12,6)) ELSE CAST(CAST({half_up(a, b, 6)} AS DECIMAL(18,0)) / 1000000 AS DECIMAL(12,6)) END"


def money_rate(a: str, b: str) -> str:
    return f"CAST(CAST({half_up(f'({a} * 100)', b, 0)} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))"


def _price(n: str, base: int, step: int, span: int) -> str:
    return f"CAST({base} + CAST(({n} * {step}) % {span} AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))"


def _code(prefix: str, n: str, digits: int) -> str:
    return f"'{prefix}' || lpad(CAST({n} AS VARCHAR), {digits}, '0')"


def _day(n: str) -> str:
    return f"DATE '2024-01-01' + CAST({n} % 730 AS INTEGER)"


def _key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def _wide(*columns: str) -> str:
    return ", ".join(f"CAST(sum({c}) AS DECIMAL(24,2)) AS {c}" for c in columns)


_CHANNEL, _REGION = "['STORE', 'WEB', 'MOBILE']", "['NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL']"


def _orders(n: int, customers: int, stores: int) -> str:
    return f"""SELECT *, CAST((gross_amount - discount_amount) * 0.08 AS DECIMAL(18,2)) AS tax_amount, CAST(CASE WHEN channel = 'STORE' THEN 0 ELSE 5 END AS DECIMAL(18,2)) AS shipping_amount,
  CAST((gross_amount - discount_amount) * 1.08 + CASE WHEN channel = 'STORE' THEN 0 ELSE 5 END AS DECIMAL(18,2)) AS net_amount FROM (
  SELECT *, CAST(CASE WHEN order_number % 10 = 0 THEN gross_amount * 0.10 ELSE 0 END AS DECIMAL(18,2)) AS discount_amount FROM (
    SELECT i AS order_number, {_code("O", "i", 10)} AS order_id, {_code("C", f"(i * 17) % {customers}", 9)} AS customer_id, {_code("S", f"(i * 13) % {stores}", 5)} AS store_id, {_CHANNEL}[i % 3 + 1] AS channel,
      CASE WHEN i % 50 = 0 THEN 'CANCELLED' WHEN i % 20 = 0 THEN 'RETURNED' ELSE 'COMPLETED' END AS order_status, {_day("i")} AS order_date, {_price("i", 20, 29, 48000)} AS gross_amount FROM range({n}) r(i)))"""


def _items(n: int, customers: int, stores: int) -> str:
    return f"""SELECT *, CAST(CASE WHEN order_item_number % 10 = 0 THEN gross_line_amount * 0.10 ELSE 0 END AS DECIMAL(18,2)) AS discount_amount, CAST(CASE WHEN order_item_number % 20 = 0 THEN quantity ELSE 0 END AS INTEGER) AS returned_units FROM (
  SELECT *, CAST(quantity * unit_price AS DECIMAL(18,2)) AS gross_line_amount FROM (
    SELECT i AS order_item_number, i % {n} AS order_number, {_code("OI", "i", 11)} AS order_item_id, {_code("O", f"i % {n}", 10)} AS order_id, CAST(i // {n} + 1 AS INTEGER) AS line_number, {_code("P", "(i * 13) % 10000", 7)} AS product_id,
      {_code("C", f"((i % {n}) * 17) % {customers}", 9)} AS customer_id, {_code("S", f"((i % {n}) * 13) % {stores}", 5)} AS store_id, {_CHANNEL}[(i % {n}) % 3 + 1] AS channel, {_day(f"(i % {n})")} AS order_date,
      CAST(1 + i % 5 AS INTEGER) AS quantity, {_price("i", 5, 17, 49500)} AS unit_price FROM range({2 * n}) r(i)))"""


_FULL_ORDERS, _FULL_ITEMS = _orders(5_000_000, 500_000, 1_000), _items(5_000_000, 500_000, 1_000)
_LAYERS = (("customers", 500_000), ("products", 100_000), ("stores", 1_000), ("orders", 5_000_000), ("order_items", 10_000_000), ("payments", 5_000_000), ("customer_events", 5_000_000), ("inventory_events", 1_000_000))
_ARRIVAL = (("bronze", "orders", 5_000_000), ("bronze", "order_items", 10_000_000), ("bronze", "customer_events", 5_000_000), ("silver", "orders", 5_000_000), ("silver", "order_items", 10_000_000), ("gold", "fact_sales", 5_000_000), ("gold", "fact_order_items", 10_000_000))

SQL = {
    "gen_orders": _orders(20_000, 2_000, 100),
    "gen_order_items": _items(20_000, 2_000, 100),
    "scale_layers": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS generated_rows FROM range({n})" for t, n in (*_LAYERS, ("all", sum(n for _, n in _LAYERS)))),
    "scale_orders": f"SELECT channel, order_status, count(*) AS orders, count(DISTINCT customer_id) AS customers, count(DISTINCT store_id) AS stores, {_wide('gross_amount', 'discount_amount', 'tax_amount', 'shipping_amount', 'net_amount')} FROM ({_FULL_ORDERS}) GROUP BY 1, 2",
    "scale_order_items": f"SELECT channel, line_number, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(returned_units) AS BIGINT) AS returned_units, max(product_id) AS last_product, {_wide('gross_line_amount', 'discount_amount')} FROM ({_FULL_ITEMS}) GROUP BY 1, 2",
    "scale_kpi_daily": f"""SELECT *, {money_rate('net_sales', 'distinct_orders')} AS average_order_value FROM (SELECT {_key('order_date')} AS date_key, channel, CAST(sum(gross_amount) AS DECIMAL(24,2)) AS gross_sales, CAST(sum(gross_amount - discount_amount) AS DECIMAL(24,2)) AS net_sales,
      CAST(sum(net_amount) AS DECIMAL(24,2)) AS net_revenue, count(DISTINCT order_id) AS distinct_orders FROM ({_FULL_ORDERS}) WHERE order_status <> 'CANCELLED' GROUP BY 1, 2)""",
    "scale_funnel": f"SELECT *, {rate('purchasing_sessions', 'sessions')} AS conversion_rate FROM (SELECT {_key(_day('i'))} AS date_key, ['MOBILE', 'DESKTOP', 'TABLET', 'OTHER'][i % 4 + 1] AS device_type, count(*) AS sessions, count(*) FILTER (WHERE i % 4 = 0) AS purchasing_sessions FROM range(5000000) r(i) GROUP BY 1, 2)",
    "scale_inventory": f"SELECT *, {rate('stockout_observations', 'observations')} AS stockout_rate FROM (SELECT {_key(_day('i'))} AS date_key, {_code('S', '(i * 7) % 1000', 5)} AS store_key, count(*) AS observations, count(*) FILTER (WHERE (i * 19) % 101 = 0) AS stockout_observations FROM range(1000000) r(i) GROUP BY 1, 2)",
    "scale_payments": f"""SELECT ['CARD', 'WALLET', 'BANK_TRANSFER', 'CASH'][i % 4 + 1] AS payment_method, CASE WHEN i % 100 = 0 THEN 'REFUNDED' ELSE 'CAPTURED' END AS payment_status, count(*) AS payments,
      CAST(sum({_price('i', 20, 29, 48000)}) AS DECIMAL(24,2)) AS payment_amount, min({_day('i')}) AS first_date, max({_day('i')}) AS last_date FROM range(5000000) r(i) GROUP BY 1, 2""",
    "scale_dimensions": f"""SELECT 'customers' AS table_name, ['BRONZE', 'SILVER', 'GOLD', 'PLATINUM'][i % 4 + 1] || '/' || {_REGION}[i % 5 + 1] AS member, count(*) AS members FROM range(500000) r(i) GROUP BY 1, 2
      UNION ALL SELECT 'products', 'Category ' || (i % 25) || '/' || {_code('SUP', 'i % 2000', 5)}, count(*) FROM range(100000) r(i) GROUP BY 1, 2
      UNION ALL SELECT 'stores', ['MALL', 'STREET', 'OUTLET'][i % 3 + 1] || '/' || {_REGION}[i % 5 + 1], count(*) FROM range(1000) r(i) GROUP BY 1, 2""",
    "scale_arrival": " UNION ALL ".join(f"SELECT '{a}' AS layer, '{n}' AS object_name, CAST({e} AS BIGINT) AS expected_rows, CAST({e} AS BIGINT) AS actual_rows, 'ARRIVED' AS arrival_status" for a, n, e in _ARRIVAL),
}
