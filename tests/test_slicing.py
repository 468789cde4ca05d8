import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import slicing as S  # noqa: N812


@pytest.mark.parametrize("block", [3, 4096])
def test_cutoffs_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(2)
    rows = [(rng.choice("xy"), rng.choice([None, *range(25)]), rng.choice([None, *range(100)])) for _ in range(200)]
    df = spark.createDataFrame(rows, "d string, b bigint, t bigint")
    got = {(r.d, r.b): r.cutoff for r in S.batch_cutoffs(df, "d", "b", "t", F.lit(10).cast("bigint")).collect()}
    for d in "xy":
        for b in {r[1] for r in rows if r[0] == d} - {None}:
            seen = [t for dd, bb, t in rows if dd == d and bb is not None and bb < b and t is not None]
            assert got[d, b] == (max(seen) - 10 if seen else None)


def test_borders_of_lateness(spark):
    first = spark.createDataFrame([("x", 1, 89, 1), ("x", 1, 90, 2), ("x", 1, None, 3), ("x", None, 1, 4), ("x", 0, 1, 5)], "d string, b bigint, t bigint, seq bigint")
    cut = spark.createDataFrame([("x", 0, None), ("x", 1, 90)], "d string, b bigint, cutoff bigint")
    for width in (1, 7, 30, 1000):
        states = S.pane_states(S.pane_log(first, "d", "b", "t", width), cut, "d", "b", width)
        assert [r.seq for r in S.split_late(first, states, "d", "b", "t", width).where("is_late").collect()] == [1]


def test_a_late_event_touches_one_pane_and_the_windows_over_it(spark):
    rng = random.Random(4)
    events = [(rng.choice("ab"), rng.choice([None, *range(100)])) for _ in range(80)]
    late = [("a", 37)]
    panes = lambda rows: S.panes(spark.createDataFrame(rows, "k string, t bigint"), ["k"], "t", 10, {"n": F.lit(1)})
    stored, fresh = panes(events), panes(late)
    assert fresh.count() == 1
    both = S.merge_panes(stored, fresh, ["k"], ["n"])
    again = {(r.k, r.window_us): r.n for r in S.compose(both, fresh, ["k"], ["n"], 30, 10).collect()}
    everything = {(r.k, r.window_us): r.n for r in S.compose(both, None, ["k"], ["n"], 30, 10).collect()}
    assert set(again) == {("a", 10), ("a", 20), ("a", 30)}
    assert all(everything[w] == n for w, n in again.items())
    for (k, w), n in everything.items():
        assert n == sum(1 for kk, t in events + late if kk == k and t is not None and w <= t < w + 30)


def test_emissions_end_in_the_total(spark):
    rows = [("a", 5, 2), ("a", 7, 1), ("a", 8, 3), ("a", 15, 3), ("a", None, 3)]
    p = S.panes(spark.createDataFrame(rows, "k string, t bigint, batch bigint"), ["k"], "t", 10, {"n": F.lit(1)}, "batch")
    out = sorted((r.pane_us, r.emission, r.batch, r.n, r.is_final) for r in S.emissions(p, ["k"], "batch", ["n"]).collect())
    assert out == [(0, 1, 1, 1, False), (0, 2, 2, 2, False), (0, 3, 3, 3, True), (10, 1, 3, 1, True)]


def test_empty_stream(spark):
    df = spark.createDataFrame([], "k string, t bigint")
    p = S.panes(df, ["k"], "t", 10, {"n": F.lit(1)})
    assert p.count() == 0 and S.compose(p, None, ["k"], ["n"], 30, 10).count() == 0
