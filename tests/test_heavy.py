import random

from pyspark.sql import functions as F

from tidewater.operators.heavy import Heavy, find_heavy, neighbour, running_max, with_block


def rows(seed, n=300):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    seen, out = set(), []
    while len(out) < n:
        k, at = rng.choice(keys), rng.randrange(1000)
        if (k, at) not in seen:
            seen.add((k, at))
            out.append((k, at, rng.choice([None, 1, 2, 3, 50, rng.randrange(9)])))
    return out


def brute(data, step):
    got = {}
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: r[1])
        top = None
        for i, (_, at, v) in enumerate(own):
            if v is not None:
                top = v if top is None else max(top, v)
            j = i + step
            got[k, at] = (top, own[j][1] if 0 <= j < len(own) else None)
    return got


def test_blocks_change_no_result(spark):
    data = rows(1)
    df = spark.createDataFrame(data, "k string, at bigint, v bigint")
    heavy = find_heavy(df, ["k"], "at", 20)
    assert heavy and heavy.levels[0].n >= 1
    for h in (heavy, Heavy()):
        for step in (-1, 1):
            out = running_max(df, h, ["k"], "at", [F.col("at")], F.col("v"), "top")
            out = neighbour(out, h, ["k"], "at", [F.col("at")], F.struct(F.col("at").alias("x")), "near", step)
            got = {(r.k, r.at): (r.top, r.near.x if r.near else None) for r in out.collect()}
            assert got == brute(data, step)


def test_empty_inputs_and_single_rows_have_no_heavy_key(spark):
    df = spark.createDataFrame([], "k string, at bigint")
    assert not find_heavy(df, ["k"], "at", 1)
    assert not find_heavy(spark.createDataFrame([("a", 1)], "k string, at bigint"), ["k"], "at")


def test_equal_positions_of_a_heavy_key(spark):
    df = spark.createDataFrame([("a", 5, i) for i in range(50)], "k string, at bigint, v bigint")
    heavy = find_heavy(df, ["k"], "at", 10)
    out = neighbour(df, heavy, ["k"], "at", [F.col("at"), F.col("v")], F.struct("v"), "p", -1)
    assert {(r.v, r.p.v if r.p else None) for r in out.collect()} == {(i, i - 1 if i else None) for i in range(50)}


def test_a_key_of_three_million_rows_in_a_small_file(spark, tmp_path):
    """Bytes say nothing about rows per key: the file below has a few hundred kB."""
    spark.range(3_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("at")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    heavy = find_heavy(df, ["k"], "at", 50_000)
    sizes = with_block(df, heavy, ["k"], "at").groupBy("__blk").count()
    r = sizes.agg(F.max("count").alias("top"), F.sum("count").alias("all"), F.count("__blk").alias("blocks")).first()
    assert r.all == 3_000_000 and r.top <= 100_000 and r.blocks >= 30


def test_bursts_and_ties_fall_into_bounded_blocks(spark):
    """Nine tenths of a key's rows in one instant, most of the rest in a short burst, some far away; NULL keys and times."""
    n = 200_000
    at = F.when(F.col("id") % 10 < 9, 1_000).when(F.col("id") % 100 == 99, F.col("id") * 1_000_000).when(F.col("id") % 1_000 == 9, None).otherwise(F.col("id") % 5_000)
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), at.cast("bigint").alias("at"), F.xxhash64("id").alias("tie"), "id")
    heavy = find_heavy(df, ["k"], "at", 2_000, "tie")
    cut = with_block(df, heavy, ["k"], "at", tie="tie")
    sizes = cut.groupBy("k", "__blk").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    assert sum(r.n for r in sizes) == n and all(r["__blk"] is not None for r in sizes)
    assert max(r.n for r in sizes) <= 4_000
    for k in ("hot", None):  # blocks of a key follow each other in time
        mine = sorted((r["__blk"], r.lo if r.lo is not None else -(1 << 63), r.hi if r.hi is not None else -(1 << 63)) for r in sizes if r.k == k)
        assert all(a[2] <= b[1] for a, b in zip(mine, mine[1:], strict=False))
    alone = with_block(df, find_heavy(df, ["k"], "at", 2_000), ["k"], "at").where("at = 1000").select("k", "__blk").distinct().count()
    assert alone == 2  # without a second column an instant stays whole


def test_many_heavy_keys_are_all_cut(spark):
    df = spark.range(60_000).select((F.col("id") % 3_000).cast("string").alias("k"), F.col("id").alias("at"))
    heavy = find_heavy(df, ["k"], "at", 10)
    top = with_block(df, heavy, ["k"], "at").groupBy("k", "__blk").count().agg(F.max("count").alias("m"), F.count(F.lit(1)).alias("n")).first()
    assert heavy.levels[0].n == 3_000 and top.m <= 20 and top.n >= 6_000
