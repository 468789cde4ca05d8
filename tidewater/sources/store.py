"""Versioned Parquet tables: each write is a new folder, one atomic rename makes it current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fs import Files


class SnapshotStore:
    """Tables below ``root``; a single writer per table, readers see whole versions only."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep, self.files = spark, root.rstrip("/"), keep, Files(spark)

    def _pointer(self, table: str) -> str:
        return f"{self.root}/{table}/_current.json"

    def exists(self, table: str) -> bool:
        return self.files.exists(self._pointer(table))

    def read(self, table: str) -> DataFrame | None:
        """The current version, resolved once; None if there is none."""
        if not self.exists(table):
            return None
        now = self.pointer(table)
        schema = T.StructType.fromJson(now["schema"])
        if "parts" not in now:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/v={now['version']}")
        return self.read_parts(table, schema, now["parts"])

    def pointer(self, table: str) -> dict | None:
        """What is current: version or parts, schema, and whatever else was published with them."""
        return self.files.read_json(self._pointer(table)) if self.exists(table) else None

    def read_parts(self, table: str, schema: T.StructType, parts: dict[str, int]) -> DataFrame:
        places = [f"{self.root}/{table}/v={v}/part={p}" for p, v in sorted(parts.items())]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def write_parts(self, table: str, version: int, rows: DataFrame, part: str) -> set[str]:
        """Writes rows by ``part`` as a version that nothing names yet; returns the parts. The column ``part`` itself stays."""
        path = f"{self.root}/{table}/v={version}"
        rows.withColumn("__part", F.col(part)).withColumnRenamed("__part", "part").hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)
        return {n[5:] for n in self.files.names(path) if n.startswith("part=")}

    def publish(self, table: str, value: dict) -> None:
        """Makes parts current, with all else in ``value``, by one atomic rename; removes versions of parts that nothing names."""
        self.files.write_json(self._pointer(table), value)
        for v in self.files.names(f"{self.root}/{table}"):
            if v.startswith("v=") and int(v[2:]) < value["version"] - self.keep:
                parts = [n for n in self.files.names(f"{self.root}/{table}/{v}") if n.startswith("part=")]
                stale = [n for n in parts if value["parts"].get(n[5:]) != int(v[2:])]
                for n in stale:
                    self.files.delete(f"{self.root}/{table}/{v}/{n}")
                if len(stale) == len(parts):
                    self.files.delete(f"{self.root}/{table}/{v}")

    def write(self, table: str, rows: DataFrame) -> int:
        """Replaces the table, also by something computed from it; older versions are removed later."""
        old = self.files.read_json(self._pointer(table))["version"] if self.exists(table) else 0
        path = f"{self.root}/{table}/v={old + 1}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self._point(table, old + 1, rows.schema.jsonValue())

    def take(self, table: str, staged: str) -> int:
        """Replaces the table by the current version of ``staged``, which is moved, not copied, and then gone."""
        now, old = self.pointer(staged), (self.pointer(table) or {"version": 0})["version"]
        path = f"{self.root}/{table}/v={old + 1}"
        self.files.delete(path)  # of a run that broke off
        self.files.make_folder(f"{self.root}/{table}")
        self.files.rename(f"{self.root}/{staged}/v={now['version']}", path)
        self._point(table, old + 1, now["schema"])
        self.files.delete(f"{self.root}/{staged}")
        return old + 1

    def _point(self, table: str, version: int, schema: dict) -> int:
        """Makes a whole version current and removes those out of keeping."""
        self.files.write_json(self._pointer(table), {"version": version, "schema": schema})
        for name in self.files.names(f"{self.root}/{table}"):
            if name.startswith("v=") and int(name[2:]) <= version - self.keep:
                self.files.delete(f"{self.root}/{table}/{name}")
        return version

    def append_once(self, table: str, rows: DataFrame, token: str) -> None:
        """Adds rows under ``token``; the same token again replaces what it wrote before."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/token={token}")

    def read_appended(self, table: str, upto: str | None = None) -> DataFrame | None:
        """All appended rows, of tokens not greater than ``upto`` if that is given."""
        path = f"{self.root}/{table}"
        names = [n for n in self.files.names(path) if n.startswith("token=") and (upto is None or n <= f"token={upto}")]
        return self.spark.read.parquet(*[f"{path}/{n}" for n in names]) if names else None
