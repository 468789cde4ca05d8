import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import orphans as O  # noqa: N812

CHILD = "id bigint, a string, b string, note string"
PARENT = "a string, b string, note int"


def violates(ref, parents, match):
    if all(x is None for x in ref):
        return False
    if None in ref:
        if match == O.SIMPLE:
            return False
        if match == O.FULL:
            return True
    return not any(all(x is None or x == y for x, y in zip(ref, p, strict=True)) for p in parents)


@pytest.mark.parametrize("match", [O.SIMPLE, O.FULL, O.PARTIAL])
def test_match_semantics_against_brute_force(spark, match):
    rng = random.Random(3)
    values = ["x", "y", "z", None]
    parents = [(rng.choice(values), rng.choice(values)) for _ in range(5)]
    children = [(i, rng.choice(values), rng.choice(values), "n") for i in range(60)] + [(0, "q", "q", "n")] * 2
    out = O.find_orphans(spark.createDataFrame(children, CHILD), spark.createDataFrame([(*p, 1) for p in parents], PARENT), [("a", "a"), ("b", "b")], match)
    assert out.columns == ["id", "a", "b", "note", "null_mask"]
    want = sorted((i, str(a), str(b)) for i, a, b, _ in children if violates((a, b), parents, match))
    assert sorted((r.id, str(r.a), str(r.b)) for r in out.collect()) == want


def test_empty_sides_and_bad_arguments(spark):
    child = spark.createDataFrame([(1, "x", None, "n")], CHILD)
    parent = spark.createDataFrame([], PARENT)
    assert O.find_orphans(child, parent, [("a", "a")]).count() == 1
    assert O.find_orphans(child.limit(0), parent, [("a", "a")]).count() == 0
    with pytest.raises(ValueError):
        O.find_orphans(child, parent, [("a", "a")], "some")
    with pytest.raises(ValueError):
        O.find_orphans(child, parent, [])


def known(versions, key, t):
    seen = [v for v in versions if v[0] == key and v[1] is not None and v[2] is not None and v[2] <= t]
    return bool(seen) and not max(seen, key=lambda v: (v[1], v[2], v[3]))[3]


@pytest.mark.parametrize("target", [8, 100_000])
def test_as_of_with_a_key_of_a_third_of_all_rows(spark, target):
    rng = random.Random(5)
    keys = ["hot"] * 4 + list("abcdefgh")
    versions = [(rng.choice(keys), rng.choice([None, *range(40)]), rng.randrange(60), rng.random() < 0.3) for _ in range(150)]
    children = [(i, rng.choice([*keys, "none", None]), rng.randrange(-5, 70)) for i in range(200)]
    v = spark.createDataFrame(versions, "k string, u bigint, g bigint, gone boolean")
    periods = O.resolved_periods(v, ["k"], "u", "g", F.col("gone"), target)
    by = {}
    for r in periods.collect():
        by.setdefault(r.k, []).append((r.resolved_from, r.resolved_to))
    for spans in by.values():
        spans.sort()
        assert all(a[1] < b[0] or a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    c = spark.createDataFrame(children, "id bigint, ref string, at bigint")
    out = O.find_orphans(c, periods, [("ref", "k")], as_of=O.AsOf("at"), cell_rows=target)
    assert sorted(r.id for r in out.collect()) == [i for i, k, t in children if k is not None and not known(versions, k, t)]


def test_reasons(spark):
    versions = spark.createDataFrame([("later", 1, 50, False), ("gone", 1, 1, False), ("gone", 2, 2, True), ("back", 1, 1, True), ("back", 2, 90, False)], "k string, u bigint, g bigint, gone boolean")
    periods = O.resolved_periods(versions, ["k"], "u", "g", F.col("gone"))
    child = spark.createDataFrame([(1, "later", 10), (2, "gone", 10), (3, "back", 10), (4, "none", 10), (5, "later", 60)], "id bigint, ref string, at bigint")
    lost = O.find_orphans(child, periods, [("ref", "k")], as_of=O.AsOf("at"))
    out = O.orphan_reasons(lost, versions, periods, ("ref", "k"), "at", "g")
    assert {(r.id, r.reason) for r in out.collect()} == {(1, "ARRIVED_LATER"), (2, "REMOVED"), (3, "ARRIVED_LATER"), (4, "MISSING")}
