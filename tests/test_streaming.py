from tidewater.contracts import CONTRACTS
from tidewater.sources import files
from tidewater.sources.store import SnapshotStore
from tidewater.streaming.processor import StreamProcessor
from tidewater.streaming.query import StreamConfig, start

import pytest


def event(i, at, kind="PRODUCT_VIEW"):
    row = {n: None for n, _ in CONTRACTS["customer_events"].columns}
    return row | {"event_id": i, "event_timestamp": at, "event_type": kind, "session_id": "s"}


def run(spark, config, processor):
    seen = []
    q = start(spark, config, lambda df, n: seen.append(processor(df, n)))
    q.awaitTermination(120)
    assert not q.isActive and q.exception() is None
    return seen


def test_every_row_has_one_outcome_and_a_second_run_changes_nothing(spark, tmp_path):
    batches = [
        [event("e1", "2025-01-10 12:00:00"), event("e1", "2025-01-10 12:00:00"), event("e2", None), event("e3", "2025-01-10 13:00:00", "WISHLIST")],
        [event("e4", "2025-01-09 13:00:00"), event("e5", "2025-01-09 12:59:59.999999"), event("e1", "2025-01-10 12:00:00"), event("e6", "2025-01-12 01:00:00"), event("e1", "2025-01-10 12:00:00", "SEARCH")],
        [event("e7", "2025-01-11 00:59:59"), event("e8", "2025-01-11 01:00:00"), event(None, "2025-01-12 00:00:00")],
    ]
    feed = tmp_path / "in"
    for n, b in enumerate(batches):
        files.emit_microbatches(b, tmp_path / f"b{n}", 100)
        feed.mkdir(exist_ok=True)
        (tmp_path / f"b{n}" / "microbatch-00000.json").rename(feed / f"{n}.json")
        import os

        os.utime(feed / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    processor = StreamProcessor(store, "customer_events", 24)
    config = StreamConfig("customer_events", str(feed), str(tmp_path / "checkpoint"))
    audits = run(spark, config, processor)
    keys = ("rows_read", "duplicate_rows", "late_rows", "rejected_rows", "replayed_rows", "merged_rows")
    assert [tuple(a[k] for k in keys) for a in audits] == [(4, 1, 0, 2, 0, 1), (5, 1, 1, 0, 0, 3), (3, 0, 1, 1, 0, 1)]
    assert all(a["status"] == "PASS" for a in audits)
    state = {r.event_id for r in store.read("silver_customer_events").collect()}
    assert state == {"e1", "e4", "e6", "e8"}
    assert run(spark, config, processor) == []
    assert {r.event_id for r in store.read("silver_customer_events").collect()} == state
    assert processor(spark.createDataFrame([event("e9", "2025-01-12 00:00:00")], ", ".join(f"`{n}` string" for n, _ in CONTRACTS["customer_events"].columns)), 2)["rows_read"] == 3  # a batch that is run again
    assert sorted((r.pane_us, r.events) for r in processor.daily().collect())[0][1] >= 1


def test_a_message_counts_once_on_the_day_of_its_current_version(spark, tmp_path):
    schema = ", ".join(f"`{n}` string" for n, _ in CONTRACTS["customer_events"].columns)
    at = lambda i, when, came: event(i, when) | {"ingestion_timestamp": came, "device_type": "MOBILE"}
    batches = [
        [at("a", "2025-01-10 12:00:00", "2025-01-10 12:01:00"), at("b", "2025-01-10 13:00:00", "2025-01-10 13:01:00"), at("c", "2025-01-10 14:00:00", "2025-01-10 14:01:00"), at(None, "2025-01-10 15:00:00", "2025-01-10 15:01:00")],
        # delivered again; moved to the next day; stale
        [at("a", "2025-01-10 12:00:00", "2025-01-10 18:00:00"), at("b", "2025-01-11 01:00:00", "2025-01-11 01:01:00"), at("c", "2025-01-10 11:00:00", "2025-01-10 18:00:00")],
        [at("a", "2025-01-11 02:00:00", "2025-01-11 02:01:00"), at("c", "2025-01-11 03:00:00", "2025-01-11 03:01:00")],
    ]
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    processor = StreamProcessor(store, "customer_events", 48)
    seen = []
    for n, b in enumerate(batches):
        names = [x for x, _ in CONTRACTS["customer_events"].columns]
        processor(spark.createDataFrame([tuple(r.get(x) for x in names) for r in b], schema), n)
        served = {r.event_date_key for r in processor.serve(n).collect()}
        daily = {r.pane_us // 86_400_000_000 - 20_088: r.events for r in processor.daily().collect()}
        silver = {}
        for r in store.read("silver_customer_events").collect():
            silver[r.event_timestamp.day] = silver.get(r.event_timestamp.day, 0) + 1
        assert daily == silver and len(served) == len(silver)
        seen.append(daily)
    assert seen == [{10: 3}, {10: 2, 11: 1}, {11: 3}]


def test_settings_are_checked(tmp_path):
    for bad in (dict(dataset="orders"), dict(lateness_hours=-1), dict(max_files=0), dict(processing_seconds=0)):
        with pytest.raises(ValueError):
            StreamConfig(**(dict(dataset="customer_events", source="x", checkpoint="y") | bad))
    a = files.emit_microbatches([{"a": 1}], tmp_path)
    assert files.emit_microbatches([{"a": 1}], tmp_path) == a
    with pytest.raises(files.SourceError):
        files.emit_microbatches([{"a": 2}], tmp_path)
    with pytest.raises(files.SourceError):
        files.emit_microbatches(["[1]"], tmp_path / "n")


def test_a_batch_that_dies_anywhere_and_runs_again_ends_as_if_it_never_died(spark, tmp_path, monkeypatch):
    """Every single write of a batch fails once, before and after it happened; state, panes and audit stay equal."""
    from tidewater.operators.key_index import KeyIndex

    schema = ", ".join(f"`{n}` string" for n, _ in CONTRACTS["customer_events"].columns)
    names = [x for x, _ in CONTRACTS["customer_events"].columns]
    frame = lambda rows: spark.createDataFrame([tuple(r.get(x) for x in names) for r in rows], schema)
    batches = [
        [event("a", "2025-01-10 12:00:00"), event("b", "2025-01-10 13:00:00"), event("c", "2025-01-12 14:00:00")],
        [event("b", "2025-01-11 20:00:00"), event("a", "2025-01-10 12:00:00"), event("d", "2025-01-12 15:00:00"), event("e", "2025-01-01 00:00:00")],
    ]

    def outcome(p):
        state = sorted((r.event_id, str(r.event_timestamp)) for r in p.store.read(p.state).collect())
        panes = sorted((r.pane_us, r.events) for r in p.daily().collect())
        audit = sorted(tuple(r) for r in p.read("audit").collect())
        return state, panes, audit, {k: p.store.pointer(p.state)[k] for k in ("batch", "watermark_us", "parts")}

    whole = StreamProcessor(SnapshotStore(spark, f"file://{tmp_path}/whole"), "customer_events", 24)
    for n, b in enumerate(batches):
        whole(frame(b), n)
    want = outcome(whole)
    assert [r.rows_read for r in whole.read("audit").orderBy("batch_id").collect()] == [3, 4]
    broken = StreamProcessor(SnapshotStore(spark, f"file://{tmp_path}/broken"), "customer_events", 24)
    broken(frame(batches[0]), 0)
    first = outcome(broken)
    writes = [(SnapshotStore, "append_once", f"{t}_customer_events") for t in ("raw", "judged", "quarantine", "audit", "panes")] + [(SnapshotStore, "write_parts", None), (KeyIndex, "add", None), (SnapshotStore, "publish", None)]
    for cls, method, only in writes:
        for after in (False, True):
            if method == "publish" and after:
                continue
            real = getattr(cls, method)

            def dies(self, *args, real=real, only=only, after=after):
                if only is None or args[0] == only:
                    if after:
                        real(self, *args)
                    raise RuntimeError("lost")
                return real(self, *args)

            monkeypatch.setattr(cls, method, dies)
            with pytest.raises(RuntimeError, match="lost"):
                broken(frame(batches[1]), 1)
            monkeypatch.setattr(cls, method, real)
            assert outcome(broken) == first
    broken(frame(batches[1]), 1)
    assert outcome(broken) == want
    assert broken(frame(batches[1]), 1)["merged_rows"] == 2 and outcome(broken) == want
    versions = want[3]["parts"]
    assert versions["2025-01-12"] == 2 and versions["2025-01-11"] == 2
    # b left its first day: that day was rewritten too, though no row of the batch falls in it
    assert sorted((r.event_id, r.event_timestamp.day) for r in whole.store.read(whole.state).collect()) == [("a", 10), ("b", 11), ("c", 12), ("d", 12)]
