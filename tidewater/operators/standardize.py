"""From source rows to typed, current rows: projection by contract, lineage, newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import Contract

LINEAGE = (
    "_corrupt_record", "_record_hash", "_source_system", "_source_file_path", "_source_file_name", "_source_file_size", "_source_file_modified_at",
    "_file_checksum", "_ingested_at", "_pipeline_run_id", "_batch_id", "_schema_version",
)


def standardize(rows: DataFrame, contract: Contract, stamp: bool = True) -> DataFrame:
    """Contract columns, trimmed, upper-cased where they are codes, and typed; ``_`` columns kept.

    Values that do not fit their type become NULL. ``stamp`` adds _silver_record_hash (of all
    contract columns; NULL fields do not enter) and _silver_processed_at. Missing columns raise
    ValueError with all of their names; columns outside the contract are dropped.
    """
    kinds = dict(rows.dtypes)
    if missing := [n for n, _ in contract.columns if n not in kinds]:
        raise ValueError(f"{contract.name} lacks columns: {', '.join(missing)}")
    named = {n for n, _ in contract.columns}

    def typed(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kinds[name] == "string":
            c = F.trim(c)
        if name in contract.upper:
            c = F.upper(c)
        if kind == "string":
            return c.cast("string").alias(name)
        return (c.try_cast(kind) if kinds[name] == "string" else c.cast(kind)).alias(name)

    out = rows.select(*[typed(n, t) for n, t in contract.columns], *[F.col(f"`{c}`") for c in rows.columns if c.startswith("_") and c not in named])
    if stamp:
        out = out.withColumn("_silver_record_hash", F.sha2(F.to_json(F.struct(*[n for n, _ in contract.columns])), 256)).withColumn("_silver_processed_at", F.current_timestamp())
    return out


def deduplicate_latest(rows: DataFrame, keys: list[str], event_time: str, ties: list[str] | None = None) -> DataFrame:
    """The newest row per key by event time, then _ingested_at if present, then ``ties``, all descending, NULL last.

    NULL keys are one key. Spark prunes to one row per key and task before the shuffle, so copies of
    one key that make up a third of all rows stay small.
    """
    order = [F.col(event_time).desc_nulls_last()]
    if "_ingested_at" in rows.columns and event_time != "_ingested_at":
        order.append(F.col("_ingested_at").desc_nulls_last())
    ties = ties if ties is not None else [c for c in ("_silver_record_hash", "_record_hash") if c in rows.columns][:1]
    order += [F.col(t).desc_nulls_last() for t in ties]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def with_lineage(rows: DataFrame, source: str, run_id: str, batch_id: str, checksum: str | None = None, schema_version: str = "1") -> DataFrame:
    """Adds the twelve lineage columns to rows read from files (uses the hidden file metadata)."""
    data = sorted(c for c in rows.columns if not c.startswith("_"))
    meta = "_metadata"
    out = rows if "_corrupt_record" in rows.columns else rows.withColumn("_corrupt_record", F.lit(None).cast("string"))
    return out.select(
        *rows.columns, *([] if "_corrupt_record" in rows.columns else ["_corrupt_record"]),
        F.sha2(F.to_json(F.struct(*data)), 256).alias("_record_hash"), F.lit(source).alias("_source_system"),
        F.col(f"{meta}.file_path").alias("_source_file_path"), F.col(f"{meta}.file_name").alias("_source_file_name"),
        F.col(f"{meta}.file_size").alias("_source_file_size"), F.col(f"{meta}.file_modification_time").alias("_source_file_modified_at"),
        F.lit(checksum).cast("string").alias("_file_checksum"), F.current_timestamp().alias("_ingested_at"), F.lit(run_id).alias("_pipeline_run_id"),
        F.lit(batch_id).alias("_batch_id"), F.lit(schema_version).alias("_schema_version"),
    )
