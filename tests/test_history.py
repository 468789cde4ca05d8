import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import history as H  # noqa: N812

SCHEMA = "k string, u bigint, g bigint, gone boolean, tier string, business_key string"


def feed(seed, n=200):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", "c"]
    return [(rng.choice([*keys, None]), rng.choice([None, *range(60)]), g, rng.random() < 0.15, rng.choice(["S", "G", None]), "noise") for g in range(n)]


def brute(rows):
    out = []
    for k in {r[0] for r in rows} - {None}:
        newest = {}
        for r in rows:
            if r[0] == k and r[1] is not None and (r[1] not in newest or r[2] > newest[r[1]][2]):
                newest[r[1]] = r
        before, open_ = None, None
        for u in sorted(newest):
            r = newest[u]
            opens = not r[3] and (before is None or before[3] or before[4] != r[4])
            if open_ is not None and (opens or r[3]):
                out.append((k, open_, u))
                open_ = None
            if opens:
                open_ = u
            before = r
        if open_ is not None:
            out.append((k, open_, H.OPEN))
    return sorted(out)


def observed(df):
    return H.observations(df, F.col("k"), F.col("u"), F.col("g"), F.col("gone"), {"tier": F.col("tier")})


def periods(df):
    return sorted((r.business_key, r.valid_from_us, r.valid_to_us) for r in df.collect())


@pytest.mark.parametrize("target", [10, 100_000])
def test_periods_against_brute_force(spark, target):
    rows = feed(1)
    out = H.versions(observed(spark.createDataFrame(rows, SCHEMA)), target)
    assert periods(out) == brute(rows)
    assert all(r.is_current == (r.valid_to_us == H.OPEN) for r in out.collect())


@pytest.mark.parametrize("seed", [2, 3])
def test_any_split_into_deliveries_ends_the_same(spark, seed):
    rows = feed(seed)
    parts = [[], [], []]
    rng = random.Random(seed)
    for r in rows:
        parts[rng.randrange(3)].append(r)
    stored = dim = None
    for part in [*parts, parts[0]]:  # the last is a replay
        stored, dim = H.merge_history(stored, dim, observed(spark.createDataFrame(part, SCHEMA)), 10)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        stored = spark.createDataFrame(stored.collect(), stored.schema)
    assert periods(dim) == brute(rows)


def test_empty_feed_and_repeated_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert periods(H.versions(observed(none))) == []
    same = [("a", 1, 1, False, "S", "x")] * 3 + [("a", 2, 1, False, "S", "x")]
    assert periods(H.versions(observed(spark.createDataFrame(same, SCHEMA)))) == [("a", 1, H.OPEN)]


def test_null_is_a_value_of_its_own(spark):
    rows = [("a", 1, 1, False, None, ""), ("a", 2, 2, False, None, ""), ("a", 3, 3, False, "null", ""), ("a", 4, 4, True, None, "")]
    assert periods(H.versions(observed(spark.createDataFrame(rows, SCHEMA)))) == [("a", 1, 3), ("a", 3, 4)]


@pytest.mark.parametrize("seed", [4, 5])
def test_the_store_ends_the_same_and_rewrites_only_named_buckets(spark, tmp_path, seed):
    rows = feed(seed)
    store = H.HistoryStore(spark, f"file://{tmp_path}/h", 10)
    assert store.read() is None and store.deliver(observed(spark.createDataFrame([], SCHEMA))) == 0
    for part in (rows[:50], rows[50:55], sorted(rows[55:], key=lambda r: -r[2]), rows[:50]):
        store.deliver(observed(spark.createDataFrame(part, SCHEMA)))
    assert periods(store.read()) == brute(rows)
    assert store.deliver(observed(spark.createDataFrame([("a", 1_000, 1_000, False, "Z", "x")], SCHEMA))) == 1
    assert periods(store.read()) == brute([*rows, ("a", 1_000, 1_000, False, "Z", "x")])


def test_a_delivery_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    rows = feed(6)
    store = H.HistoryStore(spark, f"file://{tmp_path}/h", 10)
    store.deliver(observed(spark.createDataFrame(rows[:100], SCHEMA)))
    late = observed(spark.createDataFrame(rows[100:], SCHEMA))
    for kind in ("observed", "heads", "dimension"):
        write = H.HistoryStore._write

        def dies(self, frame, what, version, kind=kind, write=write):
            if what == kind:
                raise RuntimeError("lost")
            return write(self, frame, what, version)

        monkeypatch.setattr(H.HistoryStore, "_write", dies)
        with pytest.raises(RuntimeError):
            store.deliver(late)
        monkeypatch.setattr(H.HistoryStore, "_write", write)
        assert periods(store.read()) == brute(rows[:100])
    store.deliver(late)
    assert periods(store.read()) == brute(rows)
