"""The star-schema tables read as retail feeds: statements that both engines understand.

Names in braces are tables, {lines} and {placed} the roles of lines and orders. These only say which column plays which part; no operator is here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.derived import derived
from ..sources.tables import small, table

LINES = """SELECT order_item_id, order_id, product_id, store_id, quantity, unit_price, discount_amount, CAST((unit_price - discount_amount) * tax_rate AS DECIMAL(18,2)) AS tax_amount,
  CAST(unit_price - discount_amount + CAST((unit_price - discount_amount) * tax_rate AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_amount, returned, shipped_at FROM (
    SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id, CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS product_id, CAST(s_nationkey AS STRING) AS store_id,
      CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS discount_amount,
      CAST(l_tax AS DECIMAL(4,2)) AS tax_rate, l_returnflag = 'R' AS returned, CAST(l_shipdate AS TIMESTAMP) AS shipped_at FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC) AS rn FROM {lineitem}
      ) x LEFT JOIN {supplier} ON s_suppkey = l_suppkey WHERE rn = 1) y"""

ORDERS = """SELECT order_id, customer_id, CASE WHEN channel = 'STORE' THEN nation END AS store_id, channel, order_status, order_timestamp, 'USD' AS currency, 'CARD' AS payment_method,
  CAST(CASE WHEN gross < 50 THEN 5.99 ELSE 0 END AS DECIMAL(18,2)) AS shipping_amount, tax AS tax_amount, disc AS discount_amount, gross AS gross_amount,
  CAST(gross + tax - disc + CAST(CASE WHEN gross < 50 THEN 5.99 ELSE 0 END AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount, order_timestamp AS updated_at, CAST(1 AS BIGINT) AS order_count FROM (
    SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id, CAST(c_nationkey AS STRING) AS nation,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'STORE' WHEN '2-HIGH' THEN 'WEB' WHEN '3-MEDIUM' THEN 'MOBILE' WHEN '4-NOT SPECIFIED' THEN 'MARKETPLACE' END AS channel,
      CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'SHIPPED' ELSE 'CANCELLED' END AS order_status, CAST(o_orderdate AS TIMESTAMP) AS order_timestamp,
      coalesce(g, CAST(0 AS DECIMAL(18,2))) AS gross, coalesce(ds, CAST(0 AS DECIMAL(18,2))) AS disc, coalesce(tx, CAST(0 AS DECIMAL(18,2))) AS tax
    FROM {orders} LEFT JOIN {customer} ON c_custkey = o_custkey LEFT JOIN (
      SELECT order_id AS oid, CAST(sum(unit_price) AS DECIMAL(18,2)) AS g, CAST(sum(discount_amount) AS DECIMAL(18,2)) AS ds, CAST(sum(tax_amount) AS DECIMAL(18,2)) AS tx FROM {lines} l GROUP BY order_id) m
    ON oid = CAST(o_orderkey AS STRING)) z"""

RETURNS = """SELECT concat('R', order_item_id) AS return_id, order_id, order_item_id, CAST(NULL AS STRING) AS customer_id, product_id, 'CHANGED_MIND' AS return_reason, 'REFUNDED' AS return_status, 1 AS return_quantity,
  CAST(unit_price - discount_amount AS DECIMAL(18,2)) AS refund_amount, shipped_at + INTERVAL 10 DAY AS return_timestamp FROM {lines} l WHERE returned"""

PAYMENTS = """SELECT concat('P', order_id) AS payment_id, order_id, CASE order_status WHEN 'COMPLETED' THEN 'CAPTURED' WHEN 'SHIPPED' THEN 'PENDING' ELSE 'REFUNDED' END AS payment_status, payment_method,
  net_amount AS payment_amount, concat('T', order_id) AS transaction_reference, order_timestamp + INTERVAL 1 HOUR AS payment_timestamp FROM {placed} o"""

SHIPMENTS = """SELECT concat('S', order_id) AS shipment_id, order_id, 'ROAD' AS carrier, 'DELIVERED' AS shipment_status, min(shipped_at) AS shipped_timestamp, min(shipped_at) + INTERVAL 5 DAY AS expected_delivery_timestamp,
  max(shipped_at) AS delivered_timestamp, CAST(count(*) AS DECIMAL(18,2)) AS shipping_cost FROM {lines} l GROUP BY order_id"""

INVENTORY = """SELECT order_item_id AS inventory_event_id, product_id, store_id, 'COUNT' AS event_type, -quantity AS quantity_change, quantity % 10 AS quantity_on_hand, 3 AS reorder_level, shipped_at AS event_timestamp, 'WMS' AS source_system FROM {lines} l"""

EVENTS = """SELECT CAST(event_id AS STRING) AS event_id, concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id, CAST(user_id AS STRING) AS customer_id,
  CASE event_type WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE' ELSE 'SEARCH' END AS event_type, CAST(event_id % 200 + 1 AS STRING) AS product_id,
  CAST(ts AS TIMESTAMP) AS event_timestamp, CASE CAST(user_id % 3 AS INT) WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' ELSE 'TABLET' END AS device_type, 'FIREFOX' AS browser, CAST(NULL AS STRING) AS campaign_id, 'WEB' AS source FROM {events}"""

CUSTOMERS = """SELECT CAST(o_custkey AS STRING) AS customer_id, CASE WHEN max(o_totalprice) < 100000 THEN 'BRONZE' WHEN max(o_totalprice) < 250000 THEN 'SILVER' ELSE 'GOLD' END AS loyalty_tier, CAST(o_orderdate AS TIMESTAMP) AS updated_at
  FROM {orders} GROUP BY o_custkey, o_orderdate"""
PRODUCTS = """SELECT CAST(p_partkey AS STRING) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price, CAST(sup AS STRING) AS supplier_id, TIMESTAMP '1995-01-01 00:00:00' AS updated_at
  FROM {part} LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS sup FROM {lineitem} GROUP BY l_partkey) s ON l_partkey = p_partkey"""
SUPPLIERS = """SELECT CAST(s_suppkey AS STRING) AS supplier_id, s_name AS supplier_name, n_name AS country, TIMESTAMP '1995-01-01 00:00:00' AS updated_at FROM {supplier} LEFT JOIN {nation} ON n_nationkey = s_nationkey"""
STORES = """SELECT CAST(n_nationkey AS STRING) AS store_id, n_name AS store_name, r_name AS region, TIMESTAMP '1995-01-01 00:00:00' AS updated_at FROM {nation} LEFT JOIN {region} ON r_regionkey = n_regionkey"""
PROMOTIONS = """SELECT concat('A-', CAST(p_partkey AS STRING)) AS promotion_id, concat('Spring ', p_brand) AS promotion_name, 'PERCENT' AS promotion_type, DATE '1995-01-01' AS start_date, DATE '1998-12-31' AS end_date, CAST(p_size AS DECIMAL(5,2)) AS discount_percentage, CAST(p_partkey AS STRING) AS product_id, 'ACTIVE' AS promotion_status FROM {part} WHERE p_size <= 7
  UNION ALL SELECT concat('B-', CAST(p_partkey AS STRING)), concat('Autumn ', p_brand), 'PERCENT', DATE '1997-01-01', DATE '2000-12-31', CAST(p_size % 3 * 2 AS DECIMAL(5,2)), CAST(p_partkey AS STRING), 'ACTIVE' FROM {part} WHERE p_size <= 7"""

ROLES = {
    "lines": LINES, "orders": ORDERS, "returns": RETURNS, "payments": PAYMENTS, "shipments": SHIPMENTS, "inventory": INVENTORY, "events": EVENTS,
    "customers": CUSTOMERS, "products": PRODUCTS, "suppliers": SUPPLIERS, "stores": STORES, "promotions": PROMOTIONS,
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


#: Roles that others are made of, and tables that take a pass over all lines: written once per folder.
SHARED = ("lines", "orders", "products")


def role(spark: SparkSession, d: str, name: str, own: dict[str, DataFrame] | None = None) -> DataFrame:
    """A role of the folder's tables; ``own`` takes the place of roles that it is made of, and then nothing is shared."""
    def make() -> DataFrame:
        text = ROLES[name]
        needs = {t: table(spark, d, t) for t in TABLES if "{" + t + "}" in text}
        if name == "lines":
            needs["supplier"] = small(needs["supplier"])
        needs |= {p: (own or {}).get(r) or role(spark, d, r) for p, r in (("lines", "lines"), ("placed", "orders")) if "{" + p + "}" in text}
        return spark.sql(text, **needs)

    return derived(spark, d, f"role-{name}", make) if name in SHARED and own is None else make()


def role_sql(name: str) -> str:
    text = ROLES[name]
    needs = {t: t for t in TABLES} | {p: f"({role_sql(r)})" for p, r in (("lines", "lines"), ("placed", "orders")) if "{" + p + "}" in text}
    return text.format(**needs)
