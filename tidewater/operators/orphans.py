"""References to records that do not exist.

References are grouped by null mask: a mask tells which columns of a (composite) reference are
filled. Each mask that the declared match semantics let through is anti-joined against the parent
keys on exactly its filled columns, so every join is a plain equi anti join that Spark can shuffle
or broadcast by measured size. With ``as_of`` a parent key counts only during the periods in which
it was known and not removed.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .heavy import TARGET_ROWS, Heavy, find_heavy, neighbour, running_max, with_block

#: Children (and periods) of one key that a time cell of the as-of join should hold at most; the join
#: compares all of a cell's, so cells are smaller than the blocks of windows.
CELL_ROWS = 10_000
SIMPLE, FULL, PARTIAL = "simple", "full", "partial"
_END = (1 << 63) - 1


@dataclass(frozen=True)
class AsOf:
    """Child's bigint column with the moment of the check; parent's periods [from, to)."""

    child_at: str
    parent_from: str = "resolved_from"
    parent_to: str = "resolved_to"


def resolved_periods(versions: DataFrame, keys: list[str], updated: str, delivered: str, removal: Column, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Periods of delivery time in which a key is known and its newest known row is no removal.

    ``updated`` and ``delivered`` are bigint; rows in which either is NULL, or a key is NULL, tell
    nothing. Newest means greatest (updated, delivered); of rows equal in both, a removal wins.
    Returns (keys, resolved_from, resolved_to), disjoint per key, end exclusive.
    """
    told = versions.where(F.col(updated).isNotNull() & F.col(delivered).isNotNull())
    for k in keys:
        told = told.where(F.col(k).isNotNull())
    heavy = find_heavy(told, keys, delivered, target_rows)
    # One row per moment of delivery: re-delivered copies fall together before the shuffle.
    told = told.groupBy(*keys, F.col(delivered).alias("__g")).agg(F.max(F.struct(F.col(updated).alias("u"), F.col(delivered).alias("g"), removal.alias("gone"))).alias("__v"))
    newest = running_max(told, heavy, keys, "__g", [F.col("__g")], F.col("__v"), "__top")
    state = newest.select(*keys, "__g", (~F.col("__top.gone")).alias("__live"))
    before = neighbour(state, heavy, keys, "__g", [F.col("__g")], F.struct(F.col("__live").alias("x")), "__prev", -1)
    change = before.where(F.col("__prev").isNull() | (F.col("__prev.x") != F.col("__live"))).drop("__prev")
    ended = neighbour(change, heavy, keys, "__g", [F.col("__g")], F.struct(F.col("__g").alias("x")), "__next", 1)
    return ended.where("__live").select(*keys, F.col("__g").alias("resolved_from"), F.coalesce("__next.x", F.lit(_END)).alias("resolved_to"))


def find_orphans(
    child: DataFrame,
    parent: DataFrame,
    refs: list[tuple[str, str]],
    match: str = SIMPLE,
    as_of: AsOf | None = None,
    cell_rows: int = CELL_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Child rows whose reference violates the declared match semantics, plus ``null_mask``.

    ``refs`` pairs child columns with parent columns. null_mask has bit i set where column i is
    NULL. SIMPLE: a reference with any NULL is satisfied. FULL: an all-NULL one is satisfied, a
    partly NULL one is a violation without any lookup. PARTIAL: an all-NULL one is satisfied,
    others must agree with some parent on their filled columns. Parent rows whose compared columns
    are NULL never match. Repeated child rows are each reported; repeated parents count once. An
    empty parent makes every checked reference an orphan; an empty child gives no rows. All other
    child columns pass through, unless they begin with two underscores. With ``as_of`` the parent's
    periods of a key must be disjoint. ``counted`` (reference columns, child_at and a bigint __tie) is
    what hot keys are counted on, if that is cheaper than the child itself.
    """
    if match not in (SIMPLE, FULL, PARTIAL):
        raise ValueError(f"unknown match semantics: {match}")
    if not refs:
        raise ValueError("a reference needs at least one column")
    names, columns = child.columns, [c for c, _ in refs]
    mask = sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)), F.lit(0)).cast("int")
    tagged = child.withColumn("null_mask", mask)
    full_null = (1 << len(refs)) - 1
    parts = []
    for nulls in product((0, 1), repeat=len(refs)):
        bits = sum(b << i for i, b in enumerate(nulls))
        if bits == full_null or (bits and match == SIMPLE):
            continue
        rows = tagged.where(F.col("null_mask") == bits)
        if bits and match == FULL:
            parts.append(rows)
            continue
        filled = [r for r, b in zip(refs, nulls, strict=True) if not b]
        parts.append(_anti(rows, parent, filled, as_of, cell_rows, counted))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*names, "null_mask")


def orphan_reasons(orphans: DataFrame, versions: DataFrame, periods: DataFrame, ref: tuple[str, str], child_at: str, delivered: str) -> DataFrame:
    """Adds ``reason``: ARRIVED_LATER, REMOVED (known by then, but removed) or MISSING.

    ``versions`` and ``periods`` are the parent's rows and its resolved periods; they meet the
    orphans as one row per key.
    """
    column, key = ref
    first = versions.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.min(delivered).alias("__first"))
    last = periods.groupBy(F.col(key).alias("__k")).agg(F.max("resolved_from").alias("__last"))
    known = first.join(last, "__k", "left")
    out = orphans.join(known, orphans[column] == known["__k"], "left")
    reason = F.when(F.col("__last") > F.col(child_at), "ARRIVED_LATER").when(F.col("__first") <= F.col(child_at), "REMOVED").otherwise("MISSING")
    return out.withColumn("reason", reason).drop("__k", "__first", "__last")


def _anti(child: DataFrame, parent: DataFrame, refs: list[tuple[str, str]], as_of: AsOf | None, cell_rows: int, counted: DataFrame | None) -> DataFrame:
    keys = [f"__p{i}" for i in range(len(refs))]
    held = parent.select(*[F.col(p).alias(k) for (_, p), k in zip(refs, keys, strict=True)], *([F.col(as_of.parent_from).alias("__from"), F.col(as_of.parent_to).alias("__to")] if as_of else []))
    for k in keys:
        held = held.where(F.col(k).isNotNull())
    on = [child[c] == F.col(k) for (c, _), k in zip(refs, keys, strict=True)]
    if not as_of:
        return child.join(held.distinct(), on, "left_anti")
    # Children of a heavy key are spread over time cells, those of one instant by a hash.
    columns = [c for c, _ in refs]
    told = child.withColumn("__tie", F.xxhash64(*child.columns)) if counted is None else counted
    told = told.select(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)], F.col(as_of.child_at).alias("__at"), "__tie")
    for k in keys:
        told = told.where(F.col(k).isNotNull())
    both = told.unionByName(held.select(*keys, F.col("__from").alias("__at"), F.lit(None).cast("bigint").alias("__tie")))
    heavy = find_heavy(both, keys, "__at", cell_rows, "__tie")
    if not heavy:
        at = child[as_of.child_at]
        return child.join(held, [*on, at >= F.col("__from"), at < F.col("__to")], "left_anti")
    located = with_block(child.withColumn("__tie", F.xxhash64(*child.columns)), heavy, columns, as_of.child_at, "__cell", "__tie").withColumn("__cell", F.coalesce("__cell", F.lit(-1).cast("bigint")))
    filed = _file_periods(held, located.select(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)], "__cell"), heavy, keys)
    on = [located[c] == F.col(k) for c, k in zip(columns, keys, strict=True)]
    hit = located.join(filed, [*on, located["__cell"] == F.col("__pcell"), located[as_of.child_at] >= F.col("__from"), located[as_of.child_at] < F.col("__to")], "left_anti")
    return hit.drop("__cell", "__tie")


def _file_periods(held: DataFrame, cells: DataFrame, heavy: Heavy, keys: list[str]) -> DataFrame:
    """Each period under the cell in which it begins, and once more under each later cell that it reaches into.

    Periods of a key are disjoint, so only the last one that began before a cell can reach into it:
    one row more per cell, whatever the number of periods.
    """
    own = with_block(held, heavy, keys, "__from", "__pcell").withColumn("__pcell", F.coalesce("__pcell", F.lit(-1).cast("bigint")))
    there = cells.where("__cell >= 0").select(*keys, F.col("__cell").alias("__pcell"), F.lit(None).cast("bigint").alias("__from"), F.lit(None).cast("bigint").alias("__to"))
    spans = own.where("__pcell >= 0").select(*there.columns).unionByName(there)
    period = F.struct("__from", "__to")
    last = spans.groupBy(*keys, "__pcell").agg(F.max(F.when(F.col("__from").isNotNull(), period)).alias("__l"))
    earlier = Window.partitionBy(*keys).orderBy("__pcell").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("__c", F.max("__l").over(earlier)).where("__c IS NOT NULL").select(*keys, F.col("__c.__from").alias("__from"), F.col("__c.__to").alias("__to"), "__pcell")
    return own.select(*keys, "__from", "__to", "__pcell").unionByName(carried)
