"""One copy of every message that was delivered at least once.

The store keeps messages in partitions (by event day, say) and, beside them, an index from message
identifier to the partition that holds the message. A delivery first looks its identifiers up in the
index; the partitions found there and the delivery's own are read, combined with it, one winner per
identifier is recomputed, and exactly these partitions are written anew. A manifest names the
current version of each partition and is replaced by one atomic rename, so readers and failed jobs
never see half a delivery, and taking a delivery in twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean
from ..sources.fs import Files
from .key_index import KeyIndex

#: Partitions a store may have; their names, and nothing else, are listed on the driver.
MAX_PARTITIONS = 20_000


def message_key(identifier: str, fallback: str, seq: str) -> Column:
    """Text that two deliveries share exactly if they are the same message.

    The cleaned identifier; where that is NULL the fallback (a content hash), never equal to any
    identifier; where both are NULL the delivery stands alone, told by its ``seq``.
    """
    return F.coalesce(
        F.concat(F.lit("i:"), clean(identifier)),
        F.concat(F.lit("h:"), clean(fallback)),
        F.concat(F.lit("s:"), F.col(seq).cast("string")),
    )


def winners(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row by ``order`` of each key.

    Spark keeps only a task's best row per key before the shuffle (WindowGroupLimit), so copies of
    one message that make up a third of all rows move one row per task. ``order`` should be total;
    among rows equal in it any one stays. Empty in, empty out.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


class MessageStore:
    """Exactly-once store below ``path`` with a single writer and atomic deliveries.

    ``key`` is the message key, ``partition`` a coarse text of a row (NULL becomes 'none'; characters
    that a path cannot hold become '_'), ``seq`` orders deliveries: the smallest wins, whatever
    order they come in. Columns named message_key or beginning with two underscores are the store's.
    """

    def __init__(self, spark: SparkSession, path: str, key: Column, partition: Column, seq: str):
        self.spark, self.path, self.files, self._key, self._seq = spark, path.rstrip("/"), Files(spark), key, seq
        self._index = KeyIndex(spark, f"{self.path}/index")
        self._partition = F.coalesce(F.regexp_replace(partition.cast("string"), "[^A-Za-z0-9_-]", "_"), F.lit("none"))

    def _manifest(self) -> dict:
        at = f"{self.path}/manifest.json"
        return self.files.read_json(at) if self.files.exists(at) else {"version": 0, "parts": {}, "index": [], "schema": None}

    def _rows(self, manifest: dict, parts: set[str]) -> DataFrame | None:
        chosen = sorted(parts & manifest["parts"].keys())
        if not chosen:
            return None
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/v={manifest['parts'][p]}/part={p}" for p in chosen])

    def read(self) -> DataFrame | None:
        """The kept messages with message_key; None before the first delivery."""
        manifest = self._manifest()
        rows = self._rows(manifest, set(manifest["parts"]))
        return rows.drop("__part", "__fresh") if rows is not None else None

    def deliver(self, batch: DataFrame) -> dict:
        """Takes a delivery in and returns how many partitions were found by the index and written.

        An empty delivery changes nothing. All deliveries must have the columns of the first.
        """
        old = self._manifest()
        version = old["version"] + 1
        incoming = batch.withColumns({"message_key": self._key, "__part": self._partition, "__fresh": F.lit(True)})
        found, own = self._affected(old, incoming)
        if not own:
            return {"version": old["version"], "found": 0, "written": 0}
        affected = (found | own) & old["parts"].keys()
        stored = self._rows(old, affected)
        combined = incoming if stored is None else incoming.unionByName(stored.withColumn("__fresh", F.lit(False)))
        kept = winners(combined, "message_key", [F.col(self._seq), F.col("__fresh")])
        target = f"{self.path}/data/v={version}"
        # REBALANCE lets AQE split a partition that holds a large share of all rows and join small ones.
        kept.withColumn("part", F.col("__part")).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(target)
        new = {n[5:] for n in self.files.names(target) if n.startswith("part=")}
        schema = old["schema"] or combined.schema.jsonValue()
        fresh = self.spark.read.schema(T.StructType.fromJson(schema)).parquet(*[f"{target}/part={p}" for p in sorted(new)]).where("__fresh")
        index = self._index.add(old["index"], version, fresh.select(F.xxhash64("message_key").alias("h"), F.col("__part").alias("part")))
        parts = {p: v for p, v in old["parts"].items() if p not in affected} | dict.fromkeys(new, version)
        self.files.write_json(f"{self.path}/manifest.json", {"version": version, "parts": parts, "index": index, "schema": schema})
        return {"version": version, "found": len(found), "written": len(new)}

    def _affected(self, manifest: dict, incoming: DataFrame) -> tuple[set[str], set[str]]:
        """Names of the partitions that the index gives for the delivery, and of those it falls in itself."""
        names = incoming.select(F.col("__part").alias("part"), F.lit(False).alias("found")).distinct()
        if manifest["index"]:
            found = self._index.parts_of(manifest["index"], incoming.select(F.xxhash64("message_key").alias("h")))
            names = names.unionByName(found.select("part", F.lit(True).alias("found")))
        rows = names.limit(2 * MAX_PARTITIONS + 1).collect()
        if len(rows) > 2 * MAX_PARTITIONS:
            raise ValueError(f"more than {MAX_PARTITIONS} partitions; choose a coarser partition text")
        return {r.part for r in rows if r.found}, {r.part for r in rows if not r.found}

    def vacuum(self) -> int:
        """Deletes partition and index versions that the manifest no longer names; returns how many."""
        manifest, gone = self._manifest(), 0
        for v in self.files.names(f"{self.path}/data"):
            for name in self.files.names(f"{self.path}/data/{v}"):
                if name.startswith("part=") and f"v={manifest['parts'].get(name[5:])}" != v:
                    self.files.delete(f"{self.path}/data/{v}/{name}")
                    gone += 1
        return gone + self._index.vacuum(manifest["index"])
