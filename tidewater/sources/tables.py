"""Table access by folder: one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table that is joined by key goes to every executor whole.
SMALL_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Reads ``folder/name.parquet``; time stamps without zone are taken as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame) -> DataFrame:
    """A stored table of at most SMALL_ROWS rows marked for broadcast, so what it is joined to need not move; counted first."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """Gives every core work on rows that are costly to process: few splits are dealt out, many stay."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    splits = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // split
    return df if splits >= 2 * cores else df.repartition(4 * cores)
