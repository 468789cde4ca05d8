"""What a micro-batch does to the stored state, and the account of every row in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import CONTRACTS, RULES
from ..functions.columns import date_key, micros
from ..operators import slicing
from ..operators.facts import inventory_snapshot
from ..operators.marts import channel_funnel, inventory_health
from ..operators.key_index import KeyIndex
from ..operators.merge import merge_current_state, replacements
from ..operators.quality import flag, load_rules
from ..operators.standardize import deduplicate_latest, standardize
from ..sources.store import SnapshotStore

DAY_US = 24 * slicing.HOUR_US
OUTCOMES = ("duplicate", "late", "rejected", "replayed", "merged")


def late_split(rows: DataFrame, at: str, cutoff_us: int | None) -> DataFrame:
    """Adds _late: before the cutoff (exclusive). NULL times and rows before any cutoff are not late."""
    late = F.lit(False) if cutoff_us is None else F.coalesce(micros(at) < F.lit(cutoff_us), F.lit(False))
    return rows.withColumn("_late", late)


def replay_split(rows: DataFrame, stored: DataFrame | None, keys: list[str], version_hash: str) -> DataFrame:
    """Adds _replayed: a stored row has the same key (NULL equals NULL) and the same hash."""
    if stored is None:
        return rows.withColumn("_replayed", F.lit(False))
    held = stored.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(version_hash).alias("__h"))
    on = [rows[k].eqNullSafe(held[f"__k{i}"]) for i, k in enumerate(keys)]
    return rows.join(held, on, "left").withColumn("_replayed", F.coalesce(F.col("__h") == F.col(version_hash), F.lit(False))).drop("__h", *[f"__k{i}" for i in range(len(keys))])


class StreamProcessor:
    """Keeps raw rows, current state, quarantine, day panes, control and audit in a store.

    All of a micro-batch is written aside first: raw and judged rows, quarantine, panes and audit under
    the batch's token, and new versions of the state's day partitions that the batch touches (its own
    days, and those in which an index finds its keys). The account of the batch is checked, and then
    one atomic rename of the state's manifest publishes everything. A batch that dies before it changed
    nothing and may be run again; after it, running it again returns its audit. Readers see tokens up
    to the published batch only. A row with NULL event time is rejected by the quality step, so each
    row has exactly one outcome.
    """

    def __init__(self, store: SnapshotStore, dataset: str, lateness_hours: int = 24):
        self.store, self.dataset, self.contract = store, dataset, CONTRACTS[dataset]
        self.lateness_us = lateness_hours * slicing.HOUR_US
        self.rules = load_rules(RULES, dataset)
        self.state = f"silver_{dataset}"
        self.index = KeyIndex(store.spark, f"{store.root}/index_{dataset}")

    def __call__(self, batch: DataFrame, batch_id: int) -> dict:
        c, name, at = self.contract, self.dataset, self.contract.event_time
        keys, spark, token = list(c.keys), self.store.spark, f"{batch_id:09d}"
        before = self.store.pointer(self.state) or {"batch": -1, "version": 0, "parts": {}, "index": [], "watermark_us": None, "schema": None}
        if before["batch"] >= batch_id:
            return self._token(f"audit_{name}", token).first().asDict()
        raw = standardize(batch.drop("_event_time"), c)
        raw = raw.withColumn("_raw_id", F.sha2(F.concat_ws("|", F.lit(name), *[F.coalesce(k, F.lit("<NULL>")) for k in keys], "_silver_record_hash"), 256))
        # The batch is written once; every later step reads the written rows.
        self.store.append_once(f"raw_{name}", raw.withColumn("_stream_batch", F.lit(batch_id)), token)
        raw = self._token(f"raw_{name}", token).drop("_stream_batch")
        read, seen = raw.agg(F.count(F.lit(1)), F.max(micros(at))).first()
        kept = deduplicate_latest(raw, keys, at, ["_silver_record_hash"])
        cutoff = before["watermark_us"] - self.lateness_us if before["watermark_us"] is not None else None
        judged = flag(late_split(kept, at, cutoff), self.rules)
        bad = (F.size("_failed_rule_ids") > 0) | F.col(at).isNull()
        judged = judged.withColumn("_fit", ~F.col("_late") & ~bad)
        stored = self._stored(before, judged.where("_fit"), at, keys)
        judged = replay_split(judged, stored, keys, "_silver_record_hash")
        outcome = F.when(F.col("_late"), "late").when(~F.col("_fit"), "rejected").when(F.col("_replayed"), "replayed").otherwise("merged")
        self.store.append_once(f"judged_{name}", judged.withColumn("_outcome", outcome).drop("_fit"), token)
        judged = self._token(f"judged_{name}", token)
        out = judged.where("_outcome IN ('late', 'rejected')")
        reason = F.when(F.col("_outcome") == "late", "STREAM_LATE_EVENT").otherwise(F.coalesce(F.nullif(F.array_join("_failed_rule_ids", ","), F.lit("")), F.lit("NULL_EVENT_TIME")))
        self.store.append_once(f"quarantine_{name}", out.withColumn("_reason", reason), token)
        counts = {r["_outcome"]: r["n"] for r in judged.groupBy("_outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
        audit = {"dataset": name, "batch_id": batch_id, "rows_read": read, "duplicate_rows": read - kept.count()} | {f"{o}_rows": counts.get(o, 0) for o in OUTCOMES[1:]} | {"watermark_cutoff_us": cutoff}
        audit["status"] = "PASS" if read == sum(audit[f"{o}_rows"] for o in OUTCOMES) else "FAIL"
        columns = "dataset string, batch_id bigint, rows_read bigint, duplicate_rows bigint, late_rows bigint, rejected_rows bigint, replayed_rows bigint, merged_rows bigint, watermark_cutoff_us bigint, status string"
        self.store.append_once(f"audit_{name}", spark.createDataFrame([tuple(audit.values())], columns), token)
        if audit["status"] == "FAIL":
            raise RuntimeError(f"{name} batch {batch_id} does not add up: {audit}")
        merged = judged.where("_outcome = 'merged'").drop("_late", "_failed_rule_ids", "_replayed", "_outcome", "_raw_id")
        self._panes(stored, merged, token)
        state = merge_current_state(stored, merged, keys, at, "_silver_record_hash", check=False).withColumn("_day", self._day(at))
        version = batch_id + 1
        made = self.store.write_parts(self.state, version, state, "_day")
        touched = {r[0] for r in merged.select(self._day(at)).distinct().collect()} | (set() if stored is None else {r[0] for r in stored.select(self._day(at)).distinct().collect()})
        parts = {p: v for p, v in before["parts"].items() if p not in touched} | dict.fromkeys(made, version)
        index = self.index.add(before["index"], version, merged.select(self._hash(keys).alias("h"), self._day(at).alias("part")))
        tops = [x for x in (before["watermark_us"], seen) if x is not None]
        self.store.publish(self.state, {"batch": batch_id, "version": version, "parts": parts, "index": index, "watermark_us": max(tops) if tops else None, "schema": state.schema.jsonValue()})
        return audit

    @staticmethod
    def _day(at: str) -> Column:
        return F.date_format(at, "yyyy-MM-dd")

    @staticmethod
    def _hash(keys: list[str]) -> Column:
        return F.xxhash64(F.to_json(F.struct(*keys)))

    def _token(self, table: str, token: str) -> DataFrame:
        return self.store.spark.read.parquet(f"{self.store.root}/{table}/token={token}")

    def _stored(self, before: dict, rows: DataFrame, at: str, keys: list[str]) -> DataFrame | None:
        """State of the days that the rows fall in or in which the index finds their keys; day names only reach the driver."""
        if before["schema"] is None:
            return None
        days = rows.select(self._day(at).alias("part")).distinct().unionByName(self.index.parts_of(before["index"], rows.select(self._hash(keys).alias("h"))))
        wanted = {r.part for r in days.collect()}
        return self.store.read_parts(self.state, T.StructType.fromJson(before["schema"]), {p: v for p, v in before["parts"].items() if p in wanted}).drop("_day")

    def read(self, table: str) -> DataFrame | None:
        """Rows of raw, judged, quarantine, panes or audit of all published batches."""
        now = self.store.pointer(self.state)
        return None if now is None else self.store.read_appended(f"{table}_{self.dataset}", f"{now['batch']:09d}")

    def _panes(self, stored: DataFrame | None, merged: DataFrame, token: str) -> None:
        """Adds 1 to the day of each row that becomes current and takes 1 from the day of the version it
        replaces; stale rows change nothing. Panes of a batch replace themselves."""
        c = self.contract
        if stored is None:
            taken = merged.select(F.lit(None).cast("timestamp").alias("old_at"), F.col(c.event_time).alias("new_at"))
        else:
            taken = replacements(stored, merged, list(c.keys), c.event_time, "_silver_record_hash")
        step = lambda at, n: F.struct(micros(at).alias("_at_us"), F.lit(n).alias("n"))
        rows = taken.select(F.inline(F.array(step("new_at", 1), step("old_at", -1))))
        self.store.append_once(f"panes_{self.dataset}", slicing.panes(rows, [], "_at_us", DAY_US, {"events": F.col("n")}), token)

    def serve(self, batch_id: int) -> DataFrame | None:
        """Serving table of the stream, recomputed for the days that the batch touched and kept for all others.

        customer_events: sessions per day and device; inventory_events: stock health per day and
        store, over the latest observation of each product and store.
        """
        touched = self.read("panes")
        silver = self.store.read(f"silver_{self.dataset}")
        if touched is None or silver is None:
            return None
        rows = silver.drop("_day").withColumn("event_date_key", date_key(F.col("event_timestamp")))
        if self.dataset == "inventory_events":
            # The latest observation may move between days, so health is formed anew as a whole.
            snap = inventory_snapshot(rows.withColumns({"product_key": F.col("product_id"), "store_key": F.col("store_id")}))
            self.store.write(f"serving_{self.dataset}", inventory_health(snap))
        else:
            fresh = self.store.spark.read.schema(touched.schema).parquet(f"{self.store.root}/panes_{self.dataset}/token={batch_id:09d}")
            days = fresh.select(date_key(F.timestamp_micros("pane_us")).alias("event_date_key")).distinct()
            again = channel_funnel(rows.join(days, "event_date_key", "left_semi"))
            old = self.store.read(f"serving_{self.dataset}")
            self.store.write(f"serving_{self.dataset}", again if old is None else old.join(days, "event_date_key", "left_anti").unionByName(again))
        return self.store.read(f"serving_{self.dataset}")

    def daily(self) -> DataFrame | None:
        """Events per day over all batches so far, each by its current version."""
        panes = self.read("panes")
        return None if panes is None else slicing.merge_panes(None, panes.select("pane_us", "events"), [], ["events"]).where("events <> 0")
