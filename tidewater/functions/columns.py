"""Column builders: cleaning, hashing, guarded arithmetic and time conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def clean(col: Column | str) -> Column:
    """Spelling rule for ids and codes: outer spaces removed, upper-cased, empty is NULL."""
    text = F.upper(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when(text != "", text)


def micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp (session time zone must be UTC)."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def is_removal(op: Column | str) -> Column:
    """True for DELETE; NULL and every other operation state attributes."""
    return F.coalesce(clean(op) == "DELETE", F.lit(False))


def null_safe_hash(columns: Sequence[Column | str]) -> Column:
    """SHA-256 over the values in order; NULL is kept apart from every text, NULL equals NULL."""
    return F.sha2(F.to_json(F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])), 256)


def surrogate_key(*parts: Column | str) -> Column:
    """SHA-256 of the parts joined by '|'; NULL parts are skipped."""
    return F.sha2(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]), 256)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """0.0 where the denominator is 0, NULL where it is NULL, a double otherwise."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def date_key(ts: Column) -> Column:
    """yyyymmdd as int; 0 for NULL."""
    return F.coalesce(F.date_format(ts, "yyyyMMdd").cast("int"), F.lit(0))


def mask_email(col: Column) -> Column:
    return F.regexp_replace(col, r"(^.).*(@.*$)", "$1***$2")


def mask_phone(col: Column) -> Column:
    return F.concat(F.lit("***-***-"), F.right(F.regexp_replace(col, "[^0-9]", ""), F.lit(4)))


def fresh(prefix: str, taken: Sequence[str]) -> str:
    """A column name that clashes with none in ``taken`` (Spark compares names without case)."""
    low, name, n = {t.lower() for t in taken}, prefix, 0
    while name.lower() in low:
        n += 1
        name = f"{prefix}{n}"
    return name
