import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import bitemporal as B  # noqa: N812

V = "k string, u bigint, g bigint, n bigint, id string"
E = "id bigint, k string, v bigint, kn bigint"


def test_rectangles_are_disjoint_and_few():
    rng = random.Random(1)
    for _ in range(50):
        points = [(rng.randrange(12), rng.randrange(12), i) for i in range(rng.randrange(1, 15))]
        rects = list(B.sweep(list(points)))
        assert len(rects) <= 2 * len(points)
        for v in range(13):
            for k in range(13):
                seen = [(u, g, i) for g, u, i in points if u <= v and g <= k]
                hit = [r for r in rects if r[0] <= v < r[1] and r[2] <= k < r[3]]
                assert [r[4] for r in hit] == ([max(seen)[2]] if seen else [])


@pytest.mark.parametrize("cell", [6, 512])
def test_located_versions_against_brute_force(spark, cell):
    rng = random.Random(7)
    keys = ["hot"] * 6 + ["a", "b", None]
    versions = [(rng.choice(keys), rng.choice([None, *range(80)]), rng.choice([None, *range(80)]), n, "x") for n in range(160)]
    events = [(i, rng.choice([*keys, "none"]), rng.choice([None, *range(-5, 95)]), rng.choice([None, *range(-5, 95)])) for i in range(250)] + [(0, "hot", 40, 40)] * 2
    out = B.locate(spark.createDataFrame(events, E), spark.createDataFrame(versions, V), "k", "v", "kn", "u", "g", "n", cell)
    got = sorted((r.id, str(r.v), str(r.kn), -1 if r.v_n is None else r.v_n) for r in out.collect())
    want = []
    for i, k, v, kn in events:
        seen = [] if None in (k, v, kn) else [(u, g, n) for kk, u, g, n, _ in versions if kk == k and u is not None and g is not None and u <= v and g <= kn]
        want.append((i, str(v), str(kn), max(seen)[2] if seen else -1))
    assert got == sorted(want)


def test_empty_sides_and_clashing_names(spark):
    v, e = spark.createDataFrame([], V), spark.createDataFrame([(1, "a", 1, 1)], E)
    assert [r.v_u for r in B.locate(e, v, "k", "v", "kn", "u", "g", "n").collect()] == [None]
    assert B.locate(e.limit(0), v, "k", "v", "kn", "u", "g", "n").count() == 0
    with pytest.raises(ValueError):
        B.locate(e.withColumn("V_id", F.lit(1)), v, "k", "v", "kn", "u", "g", "n")
