import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators import rolling as R  # noqa: N812

DAY = date(2025, 1, 1)
SCHEMA = "s string, d date, m decimal(18,2)"


def orders(seed, n=80):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *(DAY + timedelta(i) for i in range(60))]), rng.choice([None, Decimal(rng.randrange(900)) / 100])) for _ in range(n)]


def brute(rows, windows):
    out = {}
    for s in {r[0] for r in rows} - {None}:
        days = [r[1] for r in rows if r[0] == s and r[1]]
        if not days:
            continue
        d = min(days)
        while d <= max(days):
            for w in windows:
                own = [r for r in rows if r[0] == s and r[1] and d - timedelta(w - 1) <= r[1] <= d]
                out[s, d, w] = (sum((r[2] or Decimal(0) for r in own), Decimal(0)), len(own))
            d += timedelta(1)
    return out


def daily(spark, rows):
    return R.daily(spark.createDataFrame(rows, SCHEMA), ["s"], "d", F.col("m"))


def values(state):
    return {(r.s, r.day, r.window_days): (r.amount, r.n) for r in state.collect()}


def test_build_against_brute_force(spark):
    rows = orders(1)
    assert values(R.build(daily(spark, rows), ["s"], [1, 7, 30])) == brute(rows, [1, 7, 30])


def test_a_day_more_from_yesterday(spark):
    rows = [r for r in orders(2) if r[1]] + [("hot", DAY + timedelta(60), Decimal(5)), ("a", DAY + timedelta(60), None), ("hot", DAY + timedelta(59), Decimal(1)), ("a", DAY + timedelta(59), Decimal(1))]
    last = DAY + timedelta(60)
    days = daily(spark, rows)
    state = R.build(daily(spark, [r for r in rows if r[1] < last]), ["s"], [7, 30])
    step = R.advance(state, days, F.lit(last), ["s"], [7, 30], 1)
    want = brute(rows, [7, 30])
    got = values(step)
    assert {k: v for k, v in got.items() if k[0] in ("hot", "a")} == {k: v for k, v in want.items() if k[1] == last and k[0] in ("hot", "a")}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_corrections_end_where_a_rebuild_does(spark, seed):
    rng = random.Random(seed)
    old = orders(seed)
    new = [r for r in old if rng.random() > 0.2] + orders(seed + 50, 10) + [("late", DAY + timedelta(3), Decimal(1))]
    state = R.build(daily(spark, old), ["s"], [7, 30], 0)
    fixed = R.correct(state, daily(spark, old), daily(spark, new), ["s"], [7, 30], 1)
    now = R.current(state.unionByName(fixed), ["s"]).where("n IS NOT NULL")
    assert values(now) == brute(new, [7, 30])


def test_only_reached_days_are_recomputed(spark):
    old = [("a", DAY, Decimal(1)), ("a", DAY + timedelta(10), Decimal(2)), ("a", DAY + timedelta(50), Decimal(3))]
    new = [*old, ("a", DAY + timedelta(20), Decimal(4))]
    state = R.build(daily(spark, old), ["s"], [7], 0)
    fixed = R.correct(state, daily(spark, old), daily(spark, new), ["s"], [7], 1)
    assert sorted(r.day for r in fixed.collect()) == [DAY + timedelta(20 + i) for i in range(7)]


def test_no_orders(spark):
    assert R.build(daily(spark, orders(1)).limit(0), ["s"], [7]).count() == 0
