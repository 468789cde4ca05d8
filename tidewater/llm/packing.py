"""Packing texts into containers of fixed capacity by bounded-space online best-fit.

Items come in a fixed pseudo-random order. A fixed number of bins is open at a time; a bitset keyed
by free space finds the open bin that an item fills best in a few machine words, whatever the number
of bins. If no open bin takes the item and the limit is reached, the fullest bin is closed. Items are
dealt by hash to lanes that hold many containers each and are packed independently, so any number
of tasks can work and the space lost to bins left open at the end stays a small, fixed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins that a lane keeps open.
OPEN_BINS = 128
#: Containers' worth of tokens in a lane: bins left open at its end lose less than OPEN_BINS of these.
LANE_CONTAINERS = 4_096


class BestFit:
    """One lane. ``place`` returns the number of the bin and the tokens that it already holds."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free = 0  # bit s is set if an open bin has s tokens free
        self.bins: dict[int, list[int]] = {}  # free space -> open bins
        self.open = self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1  # smallest space that is enough
            chosen = self._take(space)
        else:
            if self.open == self.limit and size < self.capacity:  # a full bin never stays open
                self._take((self.free & -self.free).bit_length() - 1)  # closes the fullest
            chosen, space = self.made, self.capacity
            self.made += 1
        if left := space - size:
            self.bins.setdefault(left, []).append(chosen)
            self.free |= 1 << left
            self.open += 1
        return chosen, self.capacity - space

    def _take(self, space: int) -> int:
        same = self.bins[space]
        chosen = same.pop(0)
        if not same:
            del self.bins[space]
            self.free ^= 1 << space
        self.open -= 1
        return chosen


def pieces(size: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(number, first token, tokens) of an item: whole if it fits, else full containers and a rest."""
    for k, start in enumerate(range(0, size, capacity)):
        yield k, start, min(capacity, size - start)


_OUT = ["container_name", "lane", "bin_no", "offset_tokens", "doc_id", "piece_no", "start_token", "n_tokens"]


def _packer(open_bins: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lane = None, None
        for batch in batches:
            out: list[list] = [[] for _ in _OUT]
            for name, number, capacity, doc, size in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (name, number) != at:
                    at, lane = (name, number), BestFit(capacity, open_bins)
                for k, start, n in pieces(size, capacity):
                    chosen, offset = lane.place(n)
                    for column, value in zip(out, (name, number, chosen, offset, doc, k, start, n), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *[pa.array(x, pa.int64()) for x in out[1:]]], _OUT)

    return pack


def pack(items: DataFrame, containers: DataFrame, open_bins: int = OPEN_BINS, lane_containers: int = LANE_CONTAINERS) -> DataFrame:
    """Places each item of (doc_id bigint, n_tokens bigint) in one container of every (container_name, capacity_tokens).

    Returns (container_name, bin_id, doc_id, piece_no, start_token, n_tokens, offset_tokens): tokens
    [start_token, start_token + n_tokens) of the document lie in the bin from offset_tokens on. An
    item is divided only if it alone exceeds the capacity. Items with NULL doc_id or without tokens
    need no container and give no row; repeated ids are items of their own; capacities that are
    NULL or below 1 are refused. ``items`` is read twice: give a written table.
    """
    sizes = containers.select("container_name", F.col("capacity_tokens").cast("bigint").alias("capacity")).collect()  # a setting: one row per container kind
    if len(sizes) > 1_000 or any(s.capacity is None or s.capacity < 1 or s.container_name is None for s in sizes):
        raise ValueError("containers must be at most 1000 named kinds with capacities of 1 or more")
    rows = items.where("doc_id IS NOT NULL AND n_tokens > 0").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("n_tokens").cast("bigint").alias("n_tokens"))
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    spark = items.sparkSession
    kinds = spark.createDataFrame([(s.container_name, s.capacity, max(1, total // (s.capacity * lane_containers))) for s in sizes], "container_name string, capacity bigint, lanes bigint")
    # Every item meets every container kind: rows grow by the number of kinds, a setting of at most 1000.
    dealt = rows.withColumn("kind", F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(kinds.columns, k, strict=True)]) for k in kinds.collect()]) if sizes else F.array().cast("array<struct<container_name:string,capacity:bigint,lanes:bigint>>")))
    order = F.xxhash64("doc_id", F.lit(1))
    laid = dealt.select("kind.container_name", F.pmod(F.xxhash64("doc_id"), F.col("kind.lanes")).alias("lane"), "kind.capacity", "doc_id", "n_tokens", order.alias("o"))
    laid = laid.repartition("container_name", "lane").sortWithinPartitions("container_name", "lane", "o", "doc_id", "n_tokens")
    placed = laid.select("container_name", "lane", "capacity", "doc_id", "n_tokens").mapInArrow(
        _packer(open_bins), "container_name string, lane bigint, bin_no bigint, offset_tokens bigint, doc_id bigint, piece_no bigint, start_token bigint, n_tokens bigint"
    )
    return placed.select("container_name", F.concat_ws("-", "lane", "bin_no").alias("bin_id"), "doc_id", "piece_no", "start_token", "n_tokens", "offset_tokens")


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_name, bins, tokens, capacity_tokens, fill) per kind that has bins."""
    used = packed.groupBy("container_name", "bin_id").agg(F.sum("n_tokens").alias("t")).groupBy("container_name").agg(F.count(F.lit(1)).alias("bins"), F.sum("t").alias("tokens"))
    both = used.join(containers.select("container_name", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens")), "container_name")
    return both.select("container_name", "bins", "tokens", "capacity_tokens", (F.col("tokens") / (F.col("bins") * F.col("capacity_tokens"))).alias("fill"))
