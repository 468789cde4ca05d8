"""DuckDB statements that give the results of plans.core independently."""

CLEAN = "nullif(upper(trim({0})), '')"


def _c(x: str) -> str:
    return CLEAN.format(x)


def _orphans() -> str:
    refs = [
        ("retail_orders", "order_id", "customer_id", "customers"),
        ("order_items", "order_item_id", "order_id", "retail_orders"),
        ("order_items", "order_item_id", "product_id", "products"),
        ("payments", "payment_id", "order_id", "retail_orders"),
    ]
    parts = []
    for child, key, ref, parent in refs:
        parts.append(f"""
        SELECT '{child}' AS child_table, c.child_id, '{ref}' AS ref_field, c.ref, c.t, CASE WHEN later.last_live > c.t THEN 'ARRIVED_LATER' WHEN r.gone THEN 'REMOVED' ELSE 'MISSING' END AS reason FROM (
          SELECT {_c(key)} AS child_id, max({_c(ref)}) AS ref, min(_ingested_at) AS t FROM {child} GROUP BY 1) c
        LEFT JOIN (
          SELECT cc.child_id, arg_max(p.gone, (p.u, p.g, p.gone)) AS gone FROM (
            SELECT {_c(key)} AS child_id, max({_c(ref)}) AS ref, min(_ingested_at) AS t FROM {child} GROUP BY 1) cc
          JOIN (SELECT {_c(ref)} AS k, updated_at AS u, _ingested_at AS g, coalesce({_c("cdc_operation")} = 'DELETE', false) AS gone
                FROM {parent} WHERE updated_at IS NOT NULL) p ON p.k = cc.ref AND p.g <= cc.t
          GROUP BY 1) r USING (child_id)
        LEFT JOIN (SELECT k, max(g) FILTER (WHERE NOT gone) AS last_live FROM (
          SELECT {_c(ref)} AS k, _ingested_at AS g, arg_max(coalesce({_c("cdc_operation")} = 'DELETE', false), (updated_at, _ingested_at, coalesce({_c("cdc_operation")} = 'DELETE', false)))
            OVER (PARTITION BY {_c(ref)} ORDER BY _ingested_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gone
          FROM {parent} WHERE updated_at IS NOT NULL) GROUP BY 1) later ON later.k = c.ref
        WHERE c.child_id IS NOT NULL AND c.ref IS NOT NULL AND coalesce(r.gone, true)""")
    return " UNION ALL ".join(parts)


def _observed(table: str, key: str, tracked: list[tuple[str, bool]], where: str = "true") -> str:
    """One row per key and updated_at, with a comparable text of the tracked attributes."""
    cols = ", ".join(f"{_c(c) if text else c} AS {c}" for c, text in tracked)
    sig = " || '|' || ".join(f"coalesce({_c(c) if text else f'CAST({c} AS VARCHAR)'}, '<null>')" for c, text in tracked)
    return f"""SELECT {_c(key)} AS business_key, updated_at AS u, coalesce({_c("cdc_operation")} = 'DELETE', false) AS gone, {sig} AS sig, {cols}
        FROM {table} WHERE updated_at IS NOT NULL AND {_c(key)} IS NOT NULL AND {where}
        QUALIFY row_number() OVER (PARTITION BY {_c(key)}, updated_at ORDER BY _ingested_at DESC, coalesce({_c("cdc_operation")} = 'DELETE', false) DESC) = 1"""


def _versions(table: str, key: str, tracked: list[tuple[str, bool]]) -> str:
    return f"""SELECT *, epoch_us(u) AS valid_from_us, coalesce(epoch_us(lead(u) OVER (PARTITION BY business_key ORDER BY u)), -1) AS valid_to_us FROM (
      SELECT *, NOT gone AND (pg IS NULL OR pg OR ps <> sig) AS opens FROM (
        SELECT *, lag(gone) OVER w AS pg, lag(sig) OVER w AS ps FROM ({_observed(table, key, tracked)}) WINDOW w AS (PARTITION BY business_key ORDER BY u)))
      WHERE opens OR gone QUALIFY opens"""


_CUSTOMER = [("loyalty_tier", True), ("customer_status", True), ("city", True)]
_PRODUCT = [("list_price", False), ("unit_cost", False), ("product_status", True), ("category", True), ("subcategory", True)]
_STORE = [("store_status", True), ("store_type", True), ("region", True)]

_KNOWN = f"""WITH o AS (SELECT {_c("order_id")} AS order_id, max({_c("customer_id")}) AS customer_id, max(order_timestamp) AS t FROM retail_orders GROUP BY 1),
  c AS (SELECT {_c("customer_id")} AS customer_id, updated_at AS u, _ingested_at AS g, coalesce({_c("cdc_operation")} = 'DELETE', false) AS gone,
        {_c("loyalty_tier")} AS loyalty_tier, {_c("customer_status")} AS customer_status, {_c("city")} AS city FROM customers WHERE updated_at IS NOT NULL),
  seen AS (SELECT o.order_id, o.customer_id, o.t, c.* EXCLUDE (customer_id) FROM o LEFT JOIN c ON c.customer_id = o.customer_id AND c.u <= o.t AND c.g <= o.t
        QUALIFY row_number() OVER (PARTITION BY o.order_id ORDER BY c.u DESC NULLS LAST, c.g DESC NULLS LAST, c.gone DESC, coalesce(loyalty_tier, '') DESC, coalesce(customer_status, '') DESC, coalesce(city, '') DESC) = 1)"""


def _stream(name: str, key: str) -> str:
    return f"""SELECT '{name}' AS dataset_name, delivery_seq, try_cast(trim(_batch_id) AS BIGINT) AS b, event_timestamp AS t,
      coalesce('i' || {_c(key)}, 'h' || {_c("_record_hash")}, 's' || delivery_seq) AS k FROM {name}"""


_JUDGED = f"""WITH d AS ({_stream("customer_events", "event_id")} UNION ALL {_stream("inventory_events", "inventory_event_id")}),
  tops AS (SELECT dataset_name, b, max(t) AS top FROM d WHERE b IS NOT NULL GROUP BY 1, 2),
  cut AS (SELECT dataset_name, b, max(top) OVER (PARTITION BY dataset_name ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - to_hours(allowed_lateness_hours) AS cutoff FROM tops JOIN stream_settings USING (dataset_name)),
  first AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY dataset_name, k ORDER BY delivery_seq) = 1),
  judged AS (SELECT f.*, coalesce(f.t < cut.cutoff, false) AS late FROM first f LEFT JOIN cut USING (dataset_name, b))"""

_DAY = "CAST(epoch_us(date_trunc('day', t)) AS BIGINT)"


def _orders(where: str = "true") -> str:
    return f"""SELECT * FROM (SELECT {_c("order_id")} AS order_id, {_c("store_id")} AS store_id, CAST(order_timestamp AS DATE) AS day, net_amount,
        coalesce({_c("cdc_operation")} = 'DELETE', false) AS gone FROM retail_orders WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY {_c("order_id")} ORDER BY updated_at DESC NULLS LAST, _ingested_at DESC NULLS LAST, coalesce({_c("cdc_operation")} = 'DELETE', false) DESC, net_amount DESC NULLS LAST) = 1)
      WHERE NOT gone AND store_id IS NOT NULL AND order_id IS NOT NULL"""


def _trailing(windows: str) -> str:
    return f"""WITH o AS ({_orders()}), s AS (SELECT store_id, min(day) AS lo, max(day) AS hi FROM o GROUP BY 1),
      grid AS (SELECT store_id, CAST(unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
      w AS (SELECT unnest({windows}) AS window_days),
      per AS (SELECT store_id, day, sum(coalesce(net_amount, 0)) AS amount, count(*) AS n FROM o GROUP BY 1, 2),
      r AS (SELECT g.store_id, g.day, w.window_days, coalesce(sum(p.amount), 0) AS amount, coalesce(sum(p.n), 0) AS n FROM grid g CROSS JOIN w
        LEFT JOIN per p ON p.store_id = g.store_id AND p.day <= g.day AND p.day > g.day - w.window_days GROUP BY 1, 2, 3)"""


_REPORT = """ SELECT store_id, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS sales_day, window_days, CAST(amount AS DECIMAL(28,2)) AS revenue, CAST(n AS BIGINT) AS orders,
      round(CAST(amount AS DOUBLE) / window_days, 4) AS revenue_per_day, round(CAST(n AS DOUBLE) / window_days, 4) AS orders_per_day FROM r"""


def _kept(name: str, key: str) -> str:
    return f"""SELECT '{name}' AS dataset_name, coalesce(strftime(t, '%Y-%m-%d'), 'none') AS event_day, count(*) AS messages FROM (
      SELECT * FROM ({_stream(name, key)}) QUALIFY row_number() OVER (PARTITION BY k ORDER BY delivery_seq) = 1) GROUP BY 1, 2"""


def _again(name: str, key: str) -> str:
    return f"""SELECT dataset_name, delivery_seq FROM (SELECT * FROM ({_stream(name, key)})
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY delivery_seq) > 1)"""


_ARGS = (("customer_events", "event_id"), ("inventory_events", "inventory_event_id"))

def _composite() -> str:
    pair = f"SELECT {_c('order_id')} AS o, {_c('payment_method')} AS m"
    some = lambda *on: "NOT EXISTS (SELECT 1 FROM p WHERE " + " AND ".join(f"p.{x} = c.{x}" for x in on) + ")"
    whole = f"(o IS NOT NULL AND m IS NOT NULL AND {some('o', 'm')})"
    where = {"simple": whole, "full": f"{whole} OR (o IS NULL) <> (m IS NULL)", "partial": f"{whole} OR (o IS NULL AND m IS NOT NULL AND {some('m')}) OR (m IS NULL AND o IS NOT NULL AND {some('o')})"}
    counted = [f"SELECT '{n}' AS match_semantics, CAST((o IS NULL)::INT + 2 * (m IS NULL)::INT AS INTEGER) AS null_mask, count(*) AS orphans FROM c WHERE {w} GROUP BY 1, 2" for n, w in where.items()]
    return f"WITH c AS ({pair} FROM payments), p AS ({pair} FROM retail_orders) " + " UNION ALL ".join(counted)


SQL = {
    "p1_found": f"SELECT child_table, child_id, ref_field FROM ({_orphans()})",
    "p1_orphans_by_month": f"SELECT child_table, ref_field, strftime(t, '%Y-%m') AS period, count(*) AS orphans, count(DISTINCT ref) AS lost_keys FROM ({_orphans()}) GROUP BY 1, 2, 3",
    "p1_orphan_reasons": f"SELECT child_table, ref_field, strftime(t, '%Y-%m') AS period, reason, count(*) AS orphans FROM ({_orphans()}) GROUP BY 1, 2, 3, 4",
    "p1_composite": _composite(),
    "p2_found": " UNION ALL ".join(
        f"SELECT '{n}' AS dim_name, business_key, valid_from_us, valid_to_us FROM ({_versions(t, k, c)})"
        for n, t, k, c in (("dim_customer", "customers", "customer_id", _CUSTOMER), ("dim_product", "products", "product_id", _PRODUCT), ("dim_store", "stores", "store_id", _STORE))
    ),
    "p2_dim_customer": f"SELECT business_key, loyalty_tier, customer_status, city, valid_from_us, valid_to_us, valid_to_us = -1 AS is_current FROM ({_versions('customers', 'customer_id', _CUSTOMER)})",
    "p2_merged_deliveries": f"SELECT business_key, list_price, product_status, valid_from_us, valid_to_us FROM ({_versions('products', 'product_id', _PRODUCT)})",
    "p3_found": _KNOWN + " SELECT order_id, epoch_us(u) AS known_from_us FROM seen WHERE order_id IS NOT NULL AND u IS NOT NULL AND NOT gone",
    "p3_orders_with_attributes": _KNOWN
    + " SELECT order_id, customer_id, CASE WHEN NOT gone THEN loyalty_tier END AS loyalty_tier, CASE WHEN NOT gone THEN customer_status END AS customer_status, CASE WHEN NOT gone THEN city END AS city FROM seen WHERE order_id IS NOT NULL",
    "p4_found": _JUDGED + " SELECT dataset_name, delivery_seq FROM judged WHERE late",
    "p4_daily_totals": _JUDGED
    + f" SELECT dataset_name, {_DAY} AS pane_us, CAST(sum(CASE WHEN late THEN 0 ELSE 1 END) AS BIGINT) AS events, CAST(sum(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS too_late FROM judged WHERE t IS NOT NULL GROUP BY 1, 2",
    "p4_emissions": _JUDGED
    + f""", p AS (SELECT dataset_name, {_DAY} AS pane_us, b AS batch, sum(CASE WHEN late THEN 0 ELSE 1 END) AS events FROM judged WHERE t IS NOT NULL GROUP BY 1, 2, 3)
      SELECT dataset_name, pane_us, batch, CAST(row_number() OVER w AS INTEGER) AS emission, CAST(sum(events) OVER w AS BIGINT) AS events, lead(batch) OVER w IS NULL AS is_final FROM p
      WINDOW w AS (PARTITION BY dataset_name, pane_us ORDER BY batch)""",
    "p4_weekly_windows": _JUDGED
    + f""", p AS (SELECT dataset_name, {_DAY} AS pane_us, sum(CASE WHEN late THEN 0 ELSE 1 END) AS events FROM judged WHERE t IS NOT NULL GROUP BY 1, 2)
      SELECT dataset_name, CAST(pane_us - i * 86400000000 AS BIGINT) AS window_us, CAST(sum(events) AS BIGINT) AS events FROM p, range(7) r(i) GROUP BY 1, 2""",
    "p5_found": " UNION ALL ".join(_again(*a) for a in _ARGS),
    "p5_messages_per_day": " UNION ALL ".join(_kept(*a) for a in _ARGS),
    "p6_found": _trailing("[1, 7, 30]") + " SELECT store_id, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS sales_day, window_days FROM r WHERE n = 0",
    "p6_trailing": _trailing("[7, 30]") + _REPORT,
    "p6_corrected": _trailing("[7, 30]") + _REPORT,
}
