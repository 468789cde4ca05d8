"""History of changing attributes as type-two versions.

``observations`` reduces a dirty change feed to one row per key and moment. ``merge_history`` compares
the attribute hashes of a delivery with the versions that are current, closes changed ones at the
time of the change and opens new ones; ``HistoryStore`` keeps a dimension that way, delivery by
delivery. ``versions`` builds a dimension from all observations at once, for keys whose deliveries
came out of order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import null_safe_hash
from ..sources.fs import Files, written
from .heavy import TARGET_ROWS, Heavy, find_heavy, neighbour

OPEN = -1


def observations(feed: DataFrame, key: Column, updated: Column, delivered: Column, removal: Column, tracked: dict[str, Column]) -> DataFrame:
    """(business_key, at_us, delivered_us, is_removal, attribute_hash, tracked...), one per key and moment.

    ``updated`` and ``delivered`` are bigint microseconds. Rows with NULL key or NULL updated are
    ignored. Of rows equal in both, the one delivered last counts (NULL delivery is the earliest);
    of those equal in that too, the one greater in (removal, hash) - any fixed order gives a
    repeatable result. Columns of the feed that are not named never enter.
    """
    rows = feed.select(
        key.alias("business_key"), updated.alias("at_us"), delivered.alias("delivered_us"), removal.alias("is_removal"),
        null_safe_hash(list(tracked.values())).alias("attribute_hash"), *[c.alias(n) for n, c in tracked.items()],
    ).where("business_key IS NOT NULL AND at_us IS NOT NULL")
    return latest_observation(rows)


def latest_observation(rows: DataFrame) -> DataFrame:
    """Keeps the row delivered last per key and moment; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in ("business_key", "at_us")]
    front = ["delivered_us", "is_removal", "attribute_hash"]
    packed = F.struct(*front, *[c for c in rest if c not in front])
    return rows.groupBy("business_key", "at_us").agg(F.max(packed).alias("__r")).select("business_key", "at_us", *[F.col(f"__r.{c}").alias(c) for c in rest])


def versions(observed: DataFrame, target_rows: int = TARGET_ROWS, heavy: Heavy | None = None) -> DataFrame:
    """Version periods: observation columns of the opening row plus valid_from_us, valid_to_us, is_current.

    A version opens at a row that is no removal and is the key's first, follows a removal, or
    differs in hash from the row before. It ends, exclusively, at the next opening or removal; -1
    if there is none. ``heavy``: keys to split, if the caller has counted them on the raw feed.
    """
    order, keys = [F.col("at_us")], ["business_key"]
    if heavy is None:
        heavy = find_heavy(observed, keys, "at_us", target_rows)
    seen = neighbour(observed, heavy, keys, "at_us", order, F.struct(F.col("is_removal").alias("gone"), F.col("attribute_hash").alias("hash")), "__before", -1)
    opens = ~F.col("is_removal") & (F.col("__before").isNull() | F.col("__before.gone") | (F.col("__before.hash") != F.col("attribute_hash")))
    edges = seen.withColumn("__opens", opens).where(F.col("__opens") | F.col("is_removal")).drop("__before")
    closed = neighbour(edges, heavy, keys, "at_us", order, F.struct(F.col("at_us").alias("at")), "__after", 1)
    return _as_versions(closed.where("__opens"))


def heads_of(observed: DataFrame) -> DataFrame:
    """(business_key, at_us, is_removal, attribute_hash) of each key's last observation."""
    last = observed.groupBy("business_key").agg(F.max(F.struct("at_us", "is_removal", "attribute_hash")).alias("h"))
    return last.select("business_key", "h.at_us", "h.is_removal", "h.attribute_hash")


def _late_keys(heads: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys of which an observation is not later than what is known: their versions must be slotted anew."""
    first = incoming.groupBy("business_key").agg(F.min("at_us").alias("__first"))
    known = heads.select("business_key", F.col("at_us").alias("__last"))
    return first.join(known, "business_key").where("__first <= __last").select("business_key")


def _follow(heads: DataFrame, incoming: DataFrame, target_rows: int) -> tuple[DataFrame, DataFrame]:
    """Versions that in-order observations open, and (business_key, closed_at) of what they close.

    The first observation of a key is compared with the key's head, that is with the version that is
    current or the removal that closed it; each further one with the one before it.
    """
    order, keys = [F.col("at_us")], ["business_key"]
    heavy = find_heavy(incoming, keys, "at_us", target_rows)
    seen = neighbour(incoming, heavy, keys, "at_us", order, F.struct(F.col("is_removal").alias("gone"), F.col("attribute_hash").alias("hash")), "__before", -1)
    head = heads.select("business_key", F.struct(F.col("is_removal").alias("gone"), F.col("attribute_hash").alias("hash")).alias("__head"))
    seen = seen.join(head, "business_key", "left").withColumn("__was", F.coalesce("__before", "__head")).drop("__before", "__head")
    opens = ~F.col("is_removal") & (F.col("__was").isNull() | F.col("__was.gone") | (F.col("__was.hash") != F.col("attribute_hash")))
    edges = seen.withColumn("__opens", opens).where(F.col("__opens") | F.col("is_removal")).drop("__was")
    closes = edges.groupBy("business_key").agg(F.min("at_us").alias("closed_at"))
    after = neighbour(edges, heavy, keys, "at_us", order, F.struct(F.col("at_us").alias("at")), "__after", 1)
    return _as_versions(after.where("__opens")), closes


def _as_versions(opened: DataFrame) -> DataFrame:
    ends = {"valid_from_us": F.col("at_us"), "valid_to_us": F.coalesce("__after.at", F.lit(OPEN)), "is_current": F.col("__after").isNull()}
    return opened.withColumns(ends).drop("__opens", "__after", "is_removal", "at_us")


def merge_history(stored: DataFrame | None, dimension: DataFrame | None, incoming: DataFrame, target_rows: int = TARGET_ROWS, heads: DataFrame | None = None, late: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Merges new observations into a dimension; returns (observations, dimension) after it.

    ``stored`` and ``incoming`` come from :func:`observations`, ``dimension`` from an earlier merge
    (None: empty). Incoming attribute hashes are compared with the versions that are current, changed
    or removed ones are closed at the time of the change, and new ones opened. Only keys with an
    observation that is not later than all they had are slotted anew, from their stored
    observations. Versions of keys that are not named pass through. Replays change nothing, and any
    split of a feed into deliveries ends in the same dimension as one delivery of everything.

    ``heads`` (see :func:`heads_of`) may be given where they are kept beside the store, and with them
    the ``late`` keys, None for none; stored observations are then read for late keys only.
    """
    if stored is None or dimension is None:
        none = incoming.limit(0)
        opened, _ = _follow(heads_of(none), incoming, target_rows)
        return incoming, opened
    if heads is None:
        heads = heads_of(stored.join(incoming.select("business_key").distinct(), "business_key", "left_semi"))
        late = _late_keys(heads, incoming)
    rebuilt = None
    if late is not None:
        named = lambda rows: rows.join(late, "business_key", "left_semi").select(*incoming.columns)
        rebuilt = versions(latest_observation(named(stored).unionByName(named(incoming))), target_rows)
        dimension = dimension.join(late, "business_key", "left_anti")
    in_order = incoming if late is None else incoming.join(late, "business_key", "left_anti")
    opened, closes = _follow(heads, in_order, target_rows)
    kept = dimension.join(closes, "business_key", "left")
    shut = F.col("is_current") & F.col("closed_at").isNotNull()
    kept = kept.withColumns({"valid_to_us": F.when(shut, F.col("closed_at")).otherwise(F.col("valid_to_us")), "is_current": F.col("is_current") & ~shut}).drop("closed_at")
    out = kept.unionByName(opened)
    return latest_observation(stored.select(*incoming.columns).unionByName(incoming)), out if rebuilt is None else out.unionByName(rebuilt)


class HistoryStore:
    """A dimension kept below ``path``, with its observations and heads, in BUCKETS by hash of the key.

    A delivery rewrites the dimension and heads of the buckets that its keys fall in and appends its
    observations; stored observations are read only for late keys. A manifest, replaced by one
    atomic rename, names what is current, so a delivery that dies halfway changes nothing and may be
    run again. Single writer.
    """

    BUCKETS = 16

    def __init__(self, spark: SparkSession, path: str, target_rows: int = TARGET_ROWS):
        self.spark, self.path, self.files, self.target = spark, path.rstrip("/"), Files(spark), target_rows

    def _manifest(self) -> dict:
        at = f"{self.path}/manifest.json"
        return self.files.read_json(at) if self.files.exists(at) else {"version": 0, "current": {}, "observed": {}, "schemas": {}}

    def _read(self, manifest: dict, kind: str, places: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schemas"][kind])
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame | None:
        """The dimension; None before the first delivery."""
        m = self._manifest()
        return self._read(m, "dimension", [f"{self.path}/dimension/v={v}/bucket={b}" for b, v in m["current"].items()]) if m["version"] else None

    def _write(self, rows: DataFrame, kind: str, version: int) -> list[str]:
        """Writes rows by bucket; returns the buckets."""
        target = f"{self.path}/{kind}/v={version}"
        rows.withColumn("bucket", F.pmod(F.xxhash64("business_key"), F.lit(self.BUCKETS))).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        return [n[7:] for n in self.files.names(target) if n.startswith("bucket=")]

    def deliver(self, incoming: DataFrame) -> int:
        """Takes observations in; returns how many buckets were rewritten. An empty delivery changes nothing."""
        old = self._manifest()
        version = old["version"] + 1
        buckets = self._write(incoming, "observed", version)
        if not buckets:
            return 0
        schemas = {"observed": incoming.schema.jsonValue()} | old["schemas"]
        came = self._read({"schemas": schemas}, "observed", [f"{self.path}/observed/v={version}/bucket={b}" for b in buckets])
        held = [b for b in buckets if b in old["current"]]
        if not held:
            _, dimension = merge_history(None, None, came, self.target)
            heads = heads_of(came)
        else:
            heads = self._read(old, "heads", [f"{self.path}/heads/v={old['current'][b]}/bucket={b}" for b in held])
            before = self._read(old, "dimension", [f"{self.path}/dimension/v={old['current'][b]}/bucket={b}" for b in held])
            late = written(_late_keys(heads, came), "history-late")
            if late.isEmpty():  # all in order: nothing stored is read again
                _, dimension = merge_history(came.limit(0), before, came, self.target, heads, None)
            else:
                places = [f"{self.path}/observed/v={v}/bucket={b}" for b in held for v in old["observed"].get(b, [])]
                _, dimension = merge_history(self._read(old, "observed", places), before, came, self.target, heads, late)
            heads = heads_of(heads.unionByName(came.select(*heads.columns)))
        schemas |= {"dimension": dimension.schema.jsonValue(), "heads": heads.schema.jsonValue()}
        self._write(heads, "heads", version)
        made = set(self._write(dimension, "dimension", version))
        for b in set(buckets) - made:  # all keys of the bucket are removed: an empty part
            self.spark.createDataFrame([], dimension.schema).write.mode("overwrite").parquet(f"{self.path}/dimension/v={version}/bucket={b}")
        observed = old["observed"] | {b: [*old["observed"].get(b, []), version] for b in buckets}
        self.files.write_json(f"{self.path}/manifest.json", {"version": version, "current": old["current"] | dict.fromkeys(buckets, version), "observed": observed, "schemas": schemas})
        return len(buckets)
