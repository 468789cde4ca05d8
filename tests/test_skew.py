"""Queries of the general problems where one key holds a third of all rows, with blocks small enough to be cut."""

import os

import pytest

from tidewater.operators import bitemporal, heavy, history, orphans
from tidewater.plans import core, core_sql

duckdb = pytest.importorskip("duckdb")

#: table -> (column that gets the hot value, what decides which rows, hot value)
HOT = {
    "customers": ("customer_id", "customer_id", "HOT-CUSTOMER"), "products": ("product_id", "product_id", "HOT-PRODUCT"), "stores": ("store_id", "store_id", "HOT-STORE"),
    "retail_orders": ("customer_id", "order_id", "HOT-CUSTOMER"), "order_items": ("product_id", "order_item_id", "HOT-PRODUCT"), "payments": ("order_id", "payment_id", "HOT-ORDER"),
    "customer_events": ("event_id", "delivery_seq", "HOT-EVENT"), "inventory_events": ("inventory_event_id", "delivery_seq", "HOT-EVENT"),
}


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    out, c = tmp_path_factory.mktemp("skewed"), duckdb.connect()
    for f in os.listdir(folder):
        name, columns = f.removesuffix(".parquet"), "*"
        if name in HOT:
            column, by, value = HOT[name]
            columns = f"* REPLACE (CASE WHEN hash(upper(trim(CAST({by} AS VARCHAR)))) % 3 = 0 THEN '{value}' ELSE {column} END AS {column})"
        if name == "retail_orders":
            columns = columns.replace("AS customer_id)", "AS customer_id, CASE WHEN hash(upper(trim(order_id)) || 's') % 3 = 0 THEN 'HOT-STORE' ELSE store_id END AS store_id)")
        c.sql(f"COPY (SELECT {columns} FROM '{folder}/{f}') TO '{out}/{f}' (FORMAT parquet)")
        c.sql(f"CREATE VIEW {name} AS FROM '{out}/{f}'")
    return str(out), c


@pytest.fixture
def small_blocks(monkeypatch):
    cut = []

    def find(df, keys, at, target_rows=heavy.TARGET_ROWS, tie=None):
        found = heavy.find_heavy(df, keys, at, min(target_rows, 40), tie)
        cut.append(bool(found))
        return found

    for module in (bitemporal, history, orphans):
        monkeypatch.setattr(module, "find_heavy", find)
    return cut


@pytest.mark.parametrize("name", ["p1_found", "p1_orphan_reasons", "p2_found", "p3_found", "p4_found", "p4_weekly_windows", "p5_found", "p6_found", "p6_trailing"])
def test_a_key_with_a_third_of_all_rows(spark, skewed, small_blocks, name):
    folder, duck = skewed
    df = core.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = duck.sql(core_sql.SQL[name])
    at = [found.columns.index(c) for c in columns]
    text = lambda v: str(v.normalize()) if hasattr(v, "normalize") and v else str(v)
    rows = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    assert rows == sorted(tuple(text(r[i]) for i in at) for r in found.fetchall()) and rows
    if name[:2] in ("p1", "p2", "p3"):
        assert any(small_blocks)
