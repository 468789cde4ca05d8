import pytest

from tidewater.plans.guarded_sql import present
from tidewater.sources.files import SourceError
from tidewater.sources.landing import Landing


def test_files_land_once_and_never_change(spark, tmp_path):
    landing = Landing(spark, f"file://{tmp_path}/landing")
    (tmp_path / "a.csv").write_text("x\n1\n")
    first = landing.stage(f"file://{tmp_path}/a.csv", "orders")
    assert first["status"] == "STAGED" and (tmp_path / "landing/orders/a.csv").read_text() == "x\n1\n"
    assert landing.stage(f"file://{tmp_path}/a.csv", "orders") == first | {"status": "ALREADY_STAGED"}
    assert landing.count() == 1 and landing.get("orders", first["sha256"])["file_size"] == 4 and landing.get("items", first["sha256"]) is None
    (tmp_path / "a.csv").write_text("x\n2\n")
    with pytest.raises(SourceError, match="other content"):
        landing.stage(f"file://{tmp_path}/a.csv", "orders")
    with pytest.raises(SourceError, match="another file"):
        landing.register({k: v for k, v in first.items() if k != "status"} | {"path": "elsewhere"})
    for name, text in (("b.csv", ""), ("c.bin", "x")):
        (tmp_path / name).write_text(text)
        with pytest.raises(SourceError):
            landing.stage(f"file://{tmp_path}/{name}", "orders")
    with pytest.raises(SourceError):
        landing.stage(f"file://{tmp_path}/none.csv", "orders")


def test_a_copy_that_died_before_it_was_registered_is_taken_up(spark, tmp_path, monkeypatch):
    landing = Landing(spark, f"file://{tmp_path}/landing")
    (tmp_path / "a.json").write_text("{}")
    monkeypatch.setattr(Landing, "register", lambda self, m: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        landing.stage(f"file://{tmp_path}/a.json", "events")
    monkeypatch.undo()
    assert landing.stage(f"file://{tmp_path}/a.json", "events")["status"] == "STAGED" and landing.count() == 1


def test_each_template_tells_its_rows_in_its_own_way():
    sales = [{"date_key": d, "channel": "WEB", "net_sales": 1234.5, "average_order_value": 10.0} for d in (20250101, 20250102)]
    assert present("daily_sales", sales) == "On 20250102: WEB net sales 1,234.50 at 10.00 an order."
    assert present("data_arrival", [{"arrival_status": "ARRIVED"}, {"arrival_status": "MISMATCH"}]).startswith("1 of 2")
    assert "from 0.1 to 0.3" in present("conversion_rate", [{"conversion_rate": x} for x in (0.3, None, 0.1)])
    assert present("kpi_summary", [{"metric_name": "net_revenue", "metric_value": 5.0}]) == "1 KPIs: net_revenue 5.00."
    assert present("data_arrival", []) == "data_arrival: no rows."
