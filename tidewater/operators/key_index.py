"""An index from key hashes to the partitions that hold the keys, kept beside a partitioned store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fs import Files


class KeyIndex:
    """Rows (h, part) below ``path``, one folder per version, cut into BUCKETS by hash.

    A lookup reads only the buckets of the hashes sought. After COMPACT_AFTER versions an addition
    rewrites all of them into one. The index may name partitions that a key has left since: that
    costs a read and changes no result.
    """

    BUCKETS = 16
    COMPACT_AFTER = 16

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def _bucket(self, h: str = "h") -> Column:
        return F.pmod(F.col(h), F.lit(self.BUCKETS)).cast("int")

    def _read(self, versions: list[int]) -> DataFrame:
        return self.spark.read.schema("h bigint, part string, v int, bucket int").option("basePath", self.path).parquet(*[f"{self.path}/v={v}" for v in versions])

    def parts_of(self, versions: list[int], hashes: DataFrame) -> DataFrame:
        """Distinct ``part`` of the keys whose hashes (column h) are sought."""
        if not versions:
            return self.spark.createDataFrame([], "part string")
        buckets = [r[0] for r in hashes.select(self._bucket()).distinct().collect()]  # BUCKETS rows at most
        held = self._read(versions).where(F.col("bucket").isin(buckets))
        return held.join(hashes.select("h").distinct(), "h", "left_semi").select("part").distinct()

    def add(self, versions: list[int], version: int, rows: DataFrame) -> list[int]:
        """Writes rows (h, part) as a version; returns the versions that now make up the index."""
        rows = rows.select("h", "part")
        compact = len(versions) >= self.COMPACT_AFTER
        if compact:
            rows = rows.unionByName(self._read(versions).select("h", "part")).distinct()
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}")
        return [version] if compact else [*versions, version]

    def vacuum(self, versions: list[int]) -> int:
        gone = [n for n in self.files.names(self.path) if n.startswith("v=") and int(n[2:]) not in versions]
        for n in gone:
            self.files.delete(f"{self.path}/{n}")
        return len(gone)
