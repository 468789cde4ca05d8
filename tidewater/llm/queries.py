"""Queries of the text problems 7 to 9, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clean
from ..sources.derived import derived
from ..sources.tables import table
from . import mixing, packing, pii
from .text import token_counts


def _sized(spark: SparkSession, d: str) -> DataFrame:
    """Token counts of all documents, with source and language; counted once per folder and session."""

    def count() -> DataFrame:
        docs = table(spark, d, "documents").select("doc_id", clean("source").alias("source"), mixing.language("lang").alias("lang"), "text")
        return token_counts(docs, ["doc_id", "source", "lang"], "text")

    return derived(spark, d, "document-tokens", count)


def _items(spark: SparkSession, d: str) -> DataFrame:
    return _sized(spark, d).select("doc_id", "n_tokens")


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Where each text, or piece of a text longer than the container, lies in containers of each size."""
    return packing.pack(_items(spark, d), table(spark, d, "pack_capacities"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used and the share of them that is filled, per size."""
    sizes = table(spark, d, "pack_capacities")
    return packing.fill_report(packing.pack(_items(spark, d), sizes), sizes).withColumn("fill", F.round("fill", 6))


def _mixed(spark: SparkSession, d: str, exact: bool = False) -> tuple[DataFrame, mixing.Plan]:
    """Documents and plan of mixes of as many tokens as all documents have, or as large as exact shares allow."""
    sized = _sized(spark, d)
    total = None if exact else sized.agg(F.sum("n_tokens")).first()[0] or 0
    the_plan = mixing.plan(sized, table(spark, d, "mix_targets"), total)
    return mixing.select(sized, the_plan), the_plan


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every packing, counted over all containers: documents placed, and breaches of any kind."""
    sizes, items = table(spark, d, "pack_capacities"), _items(spark, d)
    packed = packing.pack(items, sizes)
    held = packed.join(sizes.select("container_name", F.col("capacity_tokens").cast("bigint").alias("capacity")), "container_name").join(items.select(F.col("doc_id").alias("id"), F.col("n_tokens").alias("size")), F.col("doc_id") == F.col("id"))
    bins = held.groupBy("container_name", "bin_id", "capacity").agg(F.sum("n_tokens").alias("t"), F.max(F.col("offset_tokens") + F.col("n_tokens")).alias("end"))
    of_bins = bins.groupBy("container_name", "capacity").agg(F.count(F.lit(1)).alias("bins"), F.sum("t").alias("tokens"), F.count_if((F.col("t") > F.col("capacity")) | (F.col("end") != F.col("t"))).alias("bad_bins"))
    docs = held.groupBy("container_name", "doc_id", "size", "capacity").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("t"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"))
    broken = (F.col("t") != F.col("size")) | (F.col("end") != F.col("size")) | (F.col("pieces") != F.ceil(F.col("size") / F.col("capacity")))
    of_docs = docs.groupBy("container_name").agg(F.count(F.lit(1)).alias("documents"), F.count_if(broken).alias("bad_documents"))
    # Bins that every packing needs; what is open at the end of a lane and a hundredth may come on top.
    tight = F.col("bins") <= F.ceil(F.col("tokens") / F.col("capacity")) * F.lit(1.01) + F.lit(2)
    return of_bins.join(of_docs, "container_name").select("container_name", "documents", "bad_bins", "bad_documents", tight.alias("nearly_full"))


def p8_mix_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each mix with the number of times each is used; shortages go to siblings, then further."""
    return _mixed(spark, d)[0]


def p8_mix_documents_exact(spark: SparkSession, d: str) -> DataFrame:
    """As p8_mix_documents, but every source keeps its exact share, so the scarcest one limits the mix."""
    return _mixed(spark, d, exact=True)[0]


def p8_mix_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mixes of p8_mix_documents."""
    return mixing.shares(*_mixed(spark, d))


def p8_mix_shares_exact(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of each mix, as large as exact shares allow."""
    return mixing.shares(*_mixed(spark, d, exact=True))


def p8_mix_shares_full(spark: SparkSession, d: str) -> DataFrame:
    """The same as p8_mix_shares, under its earlier name."""
    return p8_mix_shares(spark, d)


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every mix: no document of a source that it does not name, none used too often, none without text."""
    chosen, _ = _mixed(spark, d)
    want = table(spark, d, "mix_targets").where("target_weight > 0").groupBy("mix_name", clean("source").alias("source")).agg(F.max("max_repeats").alias("r")).where("source IS NOT NULL")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), clean("source").alias("s"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    joined = chosen.join(want.withColumnRenamed("mix_name", "m").withColumnRenamed("source", "w"), (F.col("mix_name") == F.col("m")) & (F.col("source") == F.col("w")), "left").join(docs, F.col("doc_id") == F.col("id"), "left")
    bad = F.col("r").isNull() | (F.col("copies") > F.col("r")) | ~F.col("s").eqNullSafe(F.col("source")) | (F.coalesce("chars", F.lit(0)) == 0)
    found = joined.groupBy("mix_name").agg(F.count_if(bad).alias("bad_documents"), (F.count(F.lit(1)) - F.count_distinct("doc_id")).alias("repeated_rows"))
    return want.groupBy("mix_name").agg(F.count(F.lit(1)).alias("named_sources")).join(found, "mix_name", "left").select("mix_name", "named_sources", F.coalesce("bad_documents", F.lit(0)).cast("bigint").alias("bad_documents"), F.coalesce("repeated_rows", F.lit(0)).cast("bigint").alias("repeated_rows"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(table(spark, d, "documents"), ["doc_id"], "text")


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every document with typed placeholders in place of personal information."""
    return pii.redact_pii(table(spark, d, "documents"), ["doc_id"], "text")


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per type: occurrences whose placeholder stands in the redacted text as often as the type was found there; none may be off."""
    docs = table(spark, d, "documents")
    found = pii.find_pii(docs, ["doc_id"], "text").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end_pos") - F.col("start_pos") - F.length("pii_type") - 2).alias("shorter"))
    clear = pii.redact_pii(docs, ["doc_id"], "text").withColumnRenamed("doc_id", "id")
    both = docs.select("doc_id", "text").join(clear, F.col("doc_id") == F.col("id")).join(found, "doc_id", "left")
    off = (F.coalesce("n", F.lit(0)) != F.col("replaced")) | ~F.length("redacted_text").eqNullSafe(F.length("text") - F.coalesce("shorter", F.lit(0)).cast("int"))
    return both.agg(F.count(F.lit(1)).alias("documents"), F.count_if(off).alias("off"))


QUERIES = {f.__name__: f for f in (p7_packed, p7_fill, p7_checks, p8_mix_documents, p8_mix_documents_exact, p8_mix_shares, p8_mix_shares_exact, p8_mix_shares_full, p8_checks, p9_found, p9_redacted, p9_checks)}
