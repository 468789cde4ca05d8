import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.exactly_once import MessageStore, message_key, winners

SCHEMA = "id string, h string, day string, seq bigint, message string"


def store(spark, path):
    return MessageStore(spark, f"file://{path}", message_key("id", "h", "seq"), F.col("day"), "seq")


def key(r):
    i, h = (r[0] or "").strip(" ").upper(), (r[1] or "").strip(" ").upper()
    return "i" + i if i else "h" + h if h else f"s{r[3]}"


def messages(seed, n=120):
    rng = random.Random(seed)
    ids = ["HOT"] * 10 + [f"m{i}" for i in range(30)] + [" m1 ", "M2", None, "", "  "]
    return [(rng.choice(ids), rng.choice(["h1", "h2", None, ""]), rng.choice(["2025-01-01", "2025-01-02", "a/b", None]), s, "x") for s in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_deliveries_keeps_the_first_of_each(spark, tmp_path, seed):
    rows = messages(seed)
    want = {}
    for r in rows:
        want[key(r)] = min(want.get(key(r), r[3]), r[3])
    parts = [rows[60:90], rows[:30], rows[90:], rows[30:60], rows[10:70], []]
    s = store(spark, tmp_path)
    for p in parts:
        s.deliver(spark.createDataFrame(p, SCHEMA))
    kept = s.read()
    assert sorted(r.seq for r in kept.collect()) == sorted(want.values())
    assert set(kept.columns) == {"id", "h", "day", "seq", "message", "message_key"}
    assert s.vacuum() > 0
    assert sorted(r.seq for r in s.read().collect()) == sorted(want.values())


def test_only_affected_partitions_are_written(spark, tmp_path):
    s = store(spark, tmp_path)
    assert s.read() is None
    s.deliver(spark.createDataFrame([(f"m{i}", None, f"2025-01-{i % 9 + 1:02d}", i, "") for i in range(90)], SCHEMA))
    report = s.deliver(spark.createDataFrame([("m1", None, "2025-02-01", 200, ""), ("new", None, "2025-02-01", 201, "")], SCHEMA))
    assert report["found"] == 1 and report["written"] == 2  # the day of m1's first copy, and the new day
    assert s.read().count() == 91


def test_a_failed_delivery_leaves_the_old_state(spark, tmp_path):
    s = store(spark, tmp_path)
    s.deliver(spark.createDataFrame([("a", None, "d1", 1, "")], SCHEMA))
    (tmp_path / "data" / "v=2" / "part=d1").mkdir(parents=True)
    (tmp_path / "data" / "v=2" / "part=d1" / "half.parquet").write_text("broken")
    assert s.read().count() == 1
    s.deliver(spark.createDataFrame([("b", None, "d1", 2, "")], SCHEMA))
    assert sorted(r.id for r in s.read().collect()) == ["a", "b"]


def test_winners_of_nothing_and_of_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, s bigint")
    assert [r.s for r in winners(df, "k", [F.col("s")]).collect()] == [1]
    assert winners(df.limit(0), "k", [F.col("s")]).count() == 0


def test_index_reads_its_buckets_and_is_compacted(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidewater.operators.key_index import KeyIndex

    index, versions = KeyIndex(spark, f"file://{tmp_path}/i"), []
    index.COMPACT_AFTER = 3
    rows = lambda lo, hi, part: spark.range(lo, hi).select(F.xxhash64("id").alias("h"), F.lit(part).alias("part"))
    for n in range(1, 6):
        versions = index.add(versions, n, rows(10 * n, 10 * n + 10, f"p{n}"))
    assert versions == [4, 5] and index.vacuum(versions) == 3
    sought = spark.createDataFrame([(12,), (55,), (999,)], "id bigint").select(F.xxhash64("id").alias("h"))
    assert {r.part for r in index.parts_of(versions, sought).collect()} == {"p1", "p5"}
    assert index.parts_of([], sought).count() == 0
