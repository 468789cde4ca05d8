"""Dimensions: type-two rebuild with surrogate keys, special members, calendar, as-of key lookup."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import CHANNELS, NAMESPACE, NOT_APPLICABLE, UNKNOWN
from ..functions.columns import UTC_FORMAT, mask_email, mask_phone, micros, null_safe_hash, surrogate_key
from .heavy import TARGET_ROWS, find_heavy, neighbour


def member_key(dimension: str, business_key: str) -> str:
    """Stable key of a member that does not come from data."""
    return hashlib.sha256(f"{NAMESPACE}|{dimension}|{business_key}".encode()).hexdigest()


def masked_contacts(customers: DataFrame) -> DataFrame:
    """Adds masked_email and masked_phone and drops what they mask; NULL stays NULL."""
    return customers.withColumns({"masked_email": mask_email(F.col("email")), "masked_phone": mask_phone(F.col("phone"))}).drop("email", "phone", "address")


def build_scd2(incoming: DataFrame, keys: list[str], tracked: list[str], effective: str, existing: DataFrame | None = None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """All versions of each key: surrogate_key, keys, tracked, attribute_hash, valid_from, valid_to, is_current.

    Existing versions enter with their valid_from as effective time. Of rows of one key and time the
    incoming one counts, then the greater hash. A row equal to the one before it in time is no
    version; valid_to is one microsecond before the next version, NULL while open. Late rows re-slot
    and replays vanish. Rows without effective time are ignored. NULL keys form one key.
    """
    wanted = [*keys, *tracked, effective]
    if missing := [c for c in wanted if c not in incoming.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rows = incoming.select(*keys, *tracked, F.col(effective).cast("timestamp").alias("valid_from"), F.lit(2).alias("priority"))
    if existing is not None:
        rows = rows.unionByName(existing.select(*keys, *tracked, "valid_from", F.lit(1).alias("priority")))
    rows = rows.where("valid_from IS NOT NULL").withColumn("attribute_hash", null_safe_hash(tracked))
    one = rows.groupBy(*keys, "valid_from").agg(F.max(F.struct("priority", "attribute_hash", *tracked)).alias("r"))
    one = one.select(*keys, "valid_from", F.col("r.attribute_hash").alias("attribute_hash"), *[F.col(f"r.{c}").alias(c) for c in tracked]).withColumn("__at", micros("valid_from"))
    heavy = find_heavy(rows.withColumn("__at", micros("valid_from")).select(*keys, "__at"), keys, "__at", target_rows)
    seen = neighbour(one, heavy, keys, "__at", [F.col("__at")], F.struct(F.col("attribute_hash").alias("h")), "__p", -1)
    changed = seen.where("__p IS NULL OR __p.h != attribute_hash").drop("__p")
    closed = neighbour(changed, heavy, keys, "__at", [F.col("__at")], F.struct(F.col("valid_from").alias("x")), "__n", 1)
    text = [F.coalesce(F.col(k).cast("string"), F.lit("<NULL>")) for k in keys]
    return closed.select(
        surrogate_key(*text, F.date_format("valid_from", UTC_FORMAT)).alias("surrogate_key"), *keys, *tracked, "attribute_hash", "valid_from",
        (F.col("__n.x") - F.expr("INTERVAL 1 MICROSECOND")).alias("valid_to"), F.col("__n").isNull().alias("is_current"),
    )


def _filler(kind: T.DataType, label: str):
    if isinstance(kind, T.StringType):
        return label
    if isinstance(kind, T.TimestampType):
        return datetime(1900, 1, 1)
    if isinstance(kind, T.DateType):
        return date(1900, 1, 1)
    if isinstance(kind, T.BooleanType):
        return True
    return 0


def with_special_members(dimension: DataFrame, name: str, business_key: str, key: str = "surrogate_key") -> DataFrame:
    """Adds the Unknown and Not Applicable members, typed fillers in every other column."""
    def member(code: str, label: str) -> list[Column]:
        out = []
        for f in dimension.schema.fields:
            if f.name == key:
                value = F.lit(member_key(name, code))
            elif f.name == business_key:
                value = F.lit(code)
            elif f.name == "valid_to":
                value = F.lit(None)
            else:
                value = F.lit(_filler(f.dataType, label))
            out.append(value.cast(f.dataType).alias(f.name))
        return out

    one = dimension.sparkSession.range(1)
    for code, label in ((UNKNOWN, "Unknown"), (NOT_APPLICABLE, "Not Applicable")):
        dimension = dimension.unionByName(one.select(*member(code, label)))
    return dimension


def date_dimension(spark, first: date, last: date) -> DataFrame:
    """A row per day from ``first`` to ``last``, and rows 0 (Unknown) and -1 (Not Applicable) without any part of a date."""
    if last < first:
        raise ValueError("the calendar ends before it begins")
    d = F.col("full_date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    days = days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"), F.date_format(d, "EEEE").alias("day_name"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )
    special = [(key, None, None, None, None, name, None, None, name, None) for key, name in ((0, "Unknown"), (-1, "Not Applicable"))]
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in days.schema.fields])
    return days.unionByName(spark.createDataFrame(special, loose))


def channel_dimension(spark) -> DataFrame:
    rows = [(member_key("dim_channel", c), c, n) for c, n in (*CHANNELS, (UNKNOWN, "Unknown"), (NOT_APPLICABLE, "Not Applicable"))]
    return spark.createDataFrame(rows, "channel_key string, channel_code string, channel_name string")


def promotion_dimension(promotions: DataFrame) -> DataFrame:
    """Type one, keyed by the promotion's id; with special members."""
    keyed = promotions.select(surrogate_key(F.lit("dim_promotion"), "promotion_id").alias("promotion_key"), "*")
    return with_special_members(keyed, "dim_promotion", "promotion_id", "promotion_key")


def channel_key(channel: Column) -> Column:
    """Key of a channel code; Unknown for NULL and codes that are no channel."""
    out = F.when(channel == CHANNELS[0][0], F.lit(member_key("dim_channel", CHANNELS[0][0])))
    for code, _ in CHANNELS[1:]:
        out = out.when(channel == code, F.lit(member_key("dim_channel", code)))
    return out.otherwise(F.lit(member_key("dim_channel", UNKNOWN)))


def resolve_key(facts: DataFrame, dimension: DataFrame, name: str, fact_key: str, business_key: str, at: str, out: str) -> DataFrame:
    """Adds the surrogate key of the version valid at ``at``.

    NULL business key: Not Applicable. No version at that time, or NULL time: Unknown. An equi left
    join with the period as residual, so Spark broadcasts or shuffles it by measured size and splits
    skewed keys on the fact side.
    """
    held = dimension.where(~F.col(business_key).isin(UNKNOWN, NOT_APPLICABLE)).select(
        F.col(business_key).alias("__bk"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"), F.col("surrogate_key").alias("__sk")
    )
    moment = facts[at]
    # Rows without a key match nothing; a text of their own spreads them over all partitions of the join.
    sought = F.coalesce(facts[fact_key].cast("string"), F.concat(F.lit("\0"), F.xxhash64(*facts.columns).cast("string")))
    joined = facts.join(held, (sought == F.col("__bk").cast("string")) & (moment >= F.col("__from")) & (F.col("__to").isNull() | (moment <= F.col("__to"))), "left")
    key = F.when(F.col(fact_key).isNull(), F.lit(member_key(name, NOT_APPLICABLE))).otherwise(F.coalesce("__sk", F.lit(member_key(name, UNKNOWN))))
    return joined.withColumn(out, key).drop("__bk", "__from", "__to", "__sk")
