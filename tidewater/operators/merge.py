"""Merges as pure functions from (target, source) to the new target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """The source of a merge names a key twice."""


def refuse_duplicates(source: DataFrame, keys: list[str]) -> None:
    """Raises if a key (NULL included) repeats in the source; stops at the first."""
    if source.groupBy(*keys).count().where("count > 1").limit(1).collect():
        raise DuplicateKeys(f"the source repeats a key of {', '.join(keys)}")


def _both(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    t = target.select(F.struct(*target.columns).alias("t"))
    s = source.select(F.struct(*source.columns).alias("s"))
    same = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    return t.join(s, [same(F.col(f"t.`{k}`"), F.col(f"s.`{k}`")) for k in keys], "full")


def _emit(joined: DataFrame, columns: list[str], keep) -> DataFrame:
    """``keep``: column that is 't', 's' or NULL (no row)."""
    return joined.withColumn("__k", keep).where("__k IS NOT NULL").select(*[F.when(F.col("__k") == "t", F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`")).alias(c) for c in columns])


def _newer(at: str, version_hash: str) -> Column:
    newer = F.col(f"t.`{at}`").isNull() | (F.col(f"s.`{at}`") > F.col(f"t.`{at}`")) | (F.col(f"s.`{at}`").eqNullSafe(F.col(f"t.`{at}`")) & ~F.col(f"s.`{version_hash}`").eqNullSafe(F.col(f"t.`{version_hash}`")))
    return F.coalesce(newer, F.lit(False))


def replacements(target: DataFrame, source: DataFrame, keys: list[str], at: str, version_hash: str) -> DataFrame:
    """(old_at, new_at) of the source rows that :func:`merge_current_state` takes as upserts; old_at is NULL for unknown keys."""
    taken = _both(target, source, keys).where(F.col("s").isNotNull() & (F.col("t").isNull() | _newer(at, version_hash)))
    return taken.select(F.col(f"t.`{at}`").alias("old_at"), F.col(f"s.`{at}`").alias("new_at"))


def merge_current_state(target: DataFrame | None, source: DataFrame, keys: list[str], at: str, version_hash: str, operation: str | None = None, check: bool = True) -> DataFrame:
    """Current state after a change feed: newer rows update, removals delete, unknown keys are inserted.

    Newer: the target has no ``at``, or the source's is later, or it is equal with another hash. A
    NULL operation is an upsert. Stale and identical rows change nothing; a removal of an unknown
    key is ignored; no trace of a deleted key is kept, so an older upsert brings it back. NULL keys
    are keys like any other. The source must hold a key once at most.
    """
    if check:
        refuse_duplicates(source, keys)
    op = F.upper(F.coalesce(F.col(f"s.`{operation}`"), F.lit("UPSERT"))) if operation else F.lit("UPSERT")
    if target is None:
        return source.where(F.upper(F.coalesce(operation, F.lit("UPSERT"))) != "DELETE") if operation else source
    newer = _newer(at, version_hash)
    here, there = F.col("s").isNotNull(), F.col("t").isNotNull()
    keep = (
        F.when(there & ~here, "t")
        .when(here & ~there, F.when(op != "DELETE", "s"))
        .when(~newer, "t")
        .when(op != "DELETE", "s")
    )
    return _emit(_both(target, source, keys), target.columns, keep)


def merge_upsert(target: DataFrame | None, source: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Source rows replace target rows of equal key and join the rest; a NULL key equals none."""
    if check:
        refuse_duplicates(source.where(F.col(key).isNotNull()), [key])
    if target is None:
        return source
    return target.join(source.select(key).where(F.col(key).isNotNull()), key, "left_anti").select(*target.columns).unionByName(source)


def sync_snapshot(target: DataFrame | None, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Target made equal to the source: matched rows updated, new ones inserted, missing ones deleted."""
    if not keys:
        raise ValueError("a snapshot needs at least one identifying column")
    if check:
        refuse_duplicates(source, keys)
    return source if target is None else source.select(*target.columns)
