"""Keys that hold a large share of all rows, and ordered windows that survive them.

Ordered windows put all rows of a key into one task. The functions here find the keys for which
that is too much, cut their rows into blocks of bounded size, and carry what a window needs across
block borders by way of one summary row per block. Keys of ordinary size take the plain window, so
ordinary data pays for nothing but one pre-aggregated count.

Blocks are cut by row quantiles and not by equal spans of time, so a burst gets many blocks; blocks
that are still too large are cut again, level by level, and rows of one single instant by a second
column. Neither the number of heavy keys nor the number of their blocks has a limit: both are
tables in the shared folder and never reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.fs import written

#: Rows a single task may take for one key.
TARGET_ROWS = 100_000
#: Parts that one level cuts a block into at most; three levels make 262,144.
FAN = 64
#: Rows of a level's table that are sent to every task; a larger table is joined by shuffle.
BROADCAST_ROWS = 100_000


_EARLIEST = -(1 << 63)
_AT, _TIE, _PATH = "__at", "__tie", "__path"


@dataclass(frozen=True)
class Level:
    """Table of (__k0.., __path, by_tie, bounds): block ``__path`` of a key falls into size(bounds) + 1 parts."""

    rows: DataFrame
    n: int


@dataclass(frozen=True)
class Heavy:
    """How the heavy keys are cut; empty if there are none."""

    levels: tuple[Level, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.levels)


def _keyed(df: DataFrame, keys: list[str], at: str, tie: str | None) -> DataFrame:
    ties = F.coalesce(F.col(tie), F.lit(_EARLIEST)) if tie else F.lit(_EARLIEST)
    return df.withColumns({**{f"__k{i}": F.col(k) for i, k in enumerate(keys)}, _AT: F.coalesce(F.col(at), F.lit(_EARLIEST)), _TIE: ties, _PATH: F.lit(0).cast("bigint")})


def find_heavy(df: DataFrame, keys: list[str], at: str, target_rows: int = TARGET_ROWS, tie: str | None = None) -> Heavy:
    """Keys with more than ``target_rows`` rows and the borders of their blocks.

    ``at`` is a bigint position (time) column; rows where it is NULL count as the earliest. Without
    ``tie`` (a bigint column) rows that agree in key and ``at`` stay in one block, which is right for
    callers that reduced them to one row. A block holds twice ``target_rows`` at most. One job counts,
    combined before the shuffle; where nothing is heavy that is all.
    """
    named = [f"__k{i}" for i in range(len(keys))]
    rows = _keyed(df, keys, at, tie).select(*named, _PATH, _AT, _TIE)
    levels: list[Level] = []
    while True:
        size = rows.groupBy(*named, _PATH).agg(F.count(F.lit(1)).alias("n"), F.min(_AT).alias("lo"), F.max(_AT).alias("hi"), F.min(_TIE).alias("tlo"), F.max(_TIE).alias("thi"))
        big = size.where((F.col("n") > (2 * target_rows if levels else target_rows)) & ((F.col("lo") < F.col("hi")) | (F.col("tlo") < F.col("thi"))))
        big = written(big.select(*named, _PATH, "n", (F.col("lo") == F.col("hi")).alias("by_tie")), "heavy-blocks")
        n = big.count()
        if not n:
            return Heavy(tuple(levels))
        # Only rows of blocks that are too large are looked at again.
        other = big.select(*[F.col(c).alias(f"b{c}") for c in (*named, _PATH)], "n", "by_tie")
        inside = rows.join(_sent(other, n), [rows[c].eqNullSafe(other[f"b{c}"]) for c in (*named, _PATH)]).select(*rows.columns, "n", "by_tie")
        cuts = [i / FAN for i in range(1, FAN)]
        where = F.when(F.col("by_tie"), F.col(_TIE)).otherwise(F.col(_AT))
        borders = inside.groupBy(*named, _PATH).agg(F.first("n").alias("n"), F.first("by_tie").alias("by_tie"), F.percentile_approx(where, cuts, 10_000).alias("q"))
        # Every j-th quantile, as many as the block needs; a value that fills a part by itself is set apart.
        step = F.greatest(F.lit(1), F.floor(F.lit(FAN) / F.ceil(F.col("n") / F.lit(target_rows)))).cast("int")
        picked = F.filter("q", lambda x, i: (i + 1) % step == 0)
        often = F.filter("q", lambda x, i: (i > 0) & (F.try_element_at("q", i) == x) & (x < F.lit((1 << 63) - 1)))
        bounds = F.array_sort(F.array_distinct(F.concat(picked, often, F.transform(often, lambda x: x + F.lit(1)))))
        levels.append(Level(written(borders.select(*named, _PATH, "by_tie", bounds.alias("bounds")), "heavy-borders"), n))
        rows = _descend(inside.drop("n", "by_tie"), levels[-1], named)


def _sent(table: DataFrame, n: int) -> DataFrame:
    """A table of n rows for a join: broadcast only if n is within BROADCAST_ROWS."""
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def _descend(rows: DataFrame, level: Level, named: list[str], told: str | None = None) -> DataFrame:
    """Rows with ``__path`` one level deeper, a border belonging to the part that begins with it.

    ``told`` names a column that says whether the level cuts the row's block.
    """
    t = level.rows.select(*[F.col(c).alias(f"t{c}") for c in (*named, _PATH)], F.col("by_tie").alias("__by_tie"), F.col("bounds").alias("__bounds"))
    joined = rows.join(_sent(t, level.n), [rows[c].eqNullSafe(t[f"t{c}"]) for c in (*named, _PATH)], "left")
    where = F.when(F.col("__by_tie"), F.col(_TIE)).otherwise(F.col(_AT))
    part = F.coalesce(F.size(F.filter("__bounds", lambda b: b <= where)), F.lit(0)).cast("bigint")
    out = {_PATH: F.col(_PATH) * (2 * FAN + 64) + part} | ({told: F.col("__bounds").isNotNull()} if told else {})
    return joined.withColumns(out).drop(*[f"t{c}" for c in (*named, _PATH)], "__by_tie", "__bounds")


def with_block(df: DataFrame, heavy: Heavy, keys: list[str], at: str, out: str = "__blk", tie: str | None = None) -> DataFrame:
    """Adds the block number of heavy keys' rows and NULL for all others.

    Numbers of a key's blocks grow with (``at``, tie) but are not consecutive. ``tie`` names this
    frame's second column if the blocks were cut with one; without it a row falls into the first
    block of its instant.
    """
    if not heavy:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    named = [f"__k{i}" for i in range(len(keys))]
    rows = _descend(_keyed(df, keys, at, tie), heavy.levels[0], named, "__cut")
    for level in heavy.levels[1:]:
        rows = _descend(rows, level, named)
    return rows.withColumn(out, F.when(F.col("__cut"), F.col(_PATH))).drop(*named, _AT, _TIE, _PATH, "__cut")


def _frame(keys: list[str], order: list[Column]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_max(df: DataFrame, heavy: Heavy, keys: list[str], at: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """Greatest ``value`` of the key up to this row. ``order`` must begin with ``at``."""
    df = with_block(df, heavy, keys, at)
    within = df.withColumn(out, F.max(value).over(_frame([*keys, "__blk"], order)))
    if not heavy:
        return within.drop("__blk")
    own = df.where(F.col("__blk").isNotNull()).groupBy(*keys, "__blk").agg(F.max(value).alias("__m"))
    before = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = own.select(*[F.col(k).alias(f"__c{k}") for k in keys], F.col("__blk").alias("__cb"), F.max("__m").over(before).alias("__carry"))
    on = [within[k].eqNullSafe(F.col(f"__c{k}")) for k in keys] + [F.col("__blk") == F.col("__cb")]
    joined = within.join(carry, on, "left")
    top = F.when(F.col("__carry").isNull(), F.col(out)).when(F.col(out).isNull(), F.col("__carry")).when(F.col("__carry") > F.col(out), F.col("__carry")).otherwise(F.col(out))
    return joined.withColumn(out, top).drop(*[f"__c{k}" for k in keys], "__cb", "__carry", "__blk")


def neighbour(df: DataFrame, heavy: Heavy, keys: list[str], at: str, order: list[Column], value: Column, out: str, step: int) -> DataFrame:
    """``value`` (a struct, never NULL) of the row before (step -1) or after (+1); NULL at the ends.

    ``order`` must be total on the key's rows and begin with ``at`` ascending.
    """
    df = with_block(df.withColumn("__val", value), heavy, keys, at)
    shift = F.lag if step < 0 else F.lead
    within = df.withColumn(out, shift("__val").over(Window.partitionBy(*keys, "__blk").orderBy(*order)))
    if not heavy:
        return within.drop("__val", "__blk")
    rank = F.struct(*order)
    pick = F.max_by if step < 0 else F.min_by  # the edge of the neighbouring block
    own = df.where(F.col("__blk").isNotNull()).groupBy(*keys, "__blk").agg(pick("__val", rank).alias("__edge"))
    edge = own.select(*[F.col(k).alias(f"__c{k}") for k in keys], F.col("__blk").alias("__cb"), shift("__edge").over(Window.partitionBy(*keys).orderBy("__blk")).alias("__carry"))
    on = [within[k].eqNullSafe(F.col(f"__c{k}")) for k in keys] + [F.col("__blk") == F.col("__cb")]
    return within.join(edge, on, "left").withColumn(out, F.coalesce(out, "__carry")).drop("__val", "__blk", *[f"__c{k}" for k in keys], "__cb", "__carry")
