"""Attributes as they held, and were already known, at the time of an event.

Every version of an entity is a point (valid time, recorded time). Its effect covers all later
valid and recorded times until a greater version takes over. ``rectangles`` splits that plane into
disjoint rectangles with one current version each: sweeping by recorded time, a new version cuts
only the rectangle of its predecessor in valid time, so n versions give fewer than 2n rectangles.

``locate`` indexes the rectangles by grid. An entity of ordinary size is one cell. The valid time of
a large entity is cut into slabs of bounded size; each slab is swept on its own, and one coarse
sweep over the slabs' first recorded times tells, for a point that no rectangle of its own slab
holds, which earlier slab has the answer. So no task ever takes an unbounded entity.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .heavy import find_heavy, with_block

#: Versions that one grid cell should hold at most; larger entities are cut into slabs.
CELL_ROWS = 512
END = (1 << 63) - 1
_EDGES = ["vf", "vt", "rf", "rt"]


def sweep(points: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """Rectangles (valid from, to, recorded from, to, version) of one cell's (recorded, valid, version).

    Ends are exclusive, END is open. Of versions with one valid time the later recorded one takes
    over; of equal points the one with the greater version number.
    """
    points.sort()
    starts: list[int] = []  # valid times known so far, in order
    now: dict[int, tuple[int, int, int]] = {}  # valid from -> (valid to, recorded from, version)
    for g, u, ver in points:
        if u in now:
            to, since, old = now[u]
            if since < g:
                yield u, to, since, g, old
            now[u] = (to, g, ver)
            continue
        i = bisect_right(starts, u)
        to = starts[i] if i < len(starts) else END
        if i:
            p = starts[i - 1]
            p_to, since, old = now[p]
            if since < g:
                yield p, p_to, since, g, old
            now[p] = (u, g, old)
        insort(starts, u)
        now[u] = (to, g, ver)
    for u, (to, since, ver) in now.items():
        yield u, to, since, END, ver


def _sweep_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, recorded, valid, payload) sorted by cell; a cell may span Arrow batches."""
    held: list[pa.RecordBatch] = []

    def swept(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, recorded, valid = (table.column(i).to_pylist() for i in range(3))
        edges: list[list[int]] = [[], [], [], []]
        rows: list[int] = []
        begin = 0
        for i in range(1, len(cells) + 1):
            if i == len(cells) or cells[i] != cells[begin]:
                for *rect, row in sweep([(recorded[j], valid[j], j) for j in range(begin, i)]):
                    for column, value in zip(edges, rect, strict=True):
                        column.append(value)
                    rows.append(row)
                begin = i
        at = pa.array(rows, pa.int64())
        columns = [table.column(0).take(at), *[pa.array(e, pa.int64()) for e in edges], table.column(3).take(at)]
        yield from pa.table(columns, names=["cid", *_EDGES, "row"]).combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column(0)
        last, cut = cells[batch.num_rows - 1], batch.num_rows
        while cut and cells[cut - 1].equals(last):
            cut -= 1
        if cut:
            yield from swept(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from swept(pa.Table.from_batches(held))


def rectangles(points: DataFrame) -> DataFrame:
    """(cid, vf, vt, rf, rt, row) from columns (cid string, g bigint, u bigint, row), times NOT NULL."""
    laid = points.select("cid", "g", "u", "row").repartition("cid").sortWithinPartitions("cid")
    kind = points.schema["row"].dataType.simpleString()
    return laid.mapInArrow(_sweep_cells, f"cid string, vf bigint, vt bigint, rf bigint, rt bigint, row {kind}")


def _cell(slab: Column, key: Column) -> Column:
    return F.concat_ws("|", F.coalesce(slab, F.lit(-1)).cast("string"), key)


def _spread(*cols: str) -> Column:
    """A join key that matches nothing, spread so that rows without a key share no partition."""
    return F.concat(F.lit("~"), F.pmod(F.xxhash64(*cols), F.lit(4096)).cast("string"))


def _within(left: DataFrame, cell: str, valid: str, known: str, rects: DataFrame, tag: str) -> DataFrame:
    r = rects.select(*[F.col(c).alias(f"__{tag}{c}") for c in ["cid", *_EDGES, "row"]])
    on = [left[cell] == r[f"__{tag}cid"]]
    for point, edge in ((valid, "v"), (known, "r")):
        on += [left[point] >= r[f"__{tag}{edge}f"], left[point] < r[f"__{tag}{edge}t"]]
    return left.join(r, on, "left").drop(f"__{tag}cid", *[f"__{tag}{e}" for e in _EDGES])


def locate(
    events: DataFrame, versions: DataFrame, key: str, event_valid: str, event_known: str,
    valid_from: str, recorded: str, order: str, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Left join of each event with the version that held at its point; that version's columns get prefix ``v_``.

    ``key`` is a string column of both sides; times are bigint microseconds. An event sees, among
    versions of its key with valid_from <= event_valid and recorded <= event_known, the one with
    the greatest (valid_from, recorded, order); ``order`` is a column that tells copies of one
    point apart. No such version, a NULL key or a NULL event time: all ``v_`` columns are NULL.
    Versions with NULL key or time never hold. Every event row comes out once, repeated or not, with
    all its columns; an event column that is itself called v_... is refused with ValueError.
    """
    taken = {c.lower() for c in events.columns}
    if clash := [c for c in versions.columns if f"v_{c}".lower() in taken]:
        raise ValueError(f"event columns would clash with the version's: {clash}")
    told = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull() & F.col(recorded).isNotNull())
    heavy = find_heavy(told, [key], valid_from, cell_rows)
    points = told.groupBy(F.col(key).alias("key"), F.col(valid_from).alias("u"), F.col(recorded).alias("g")).agg(F.max_by(F.struct(*versions.columns), order).alias("row"))
    points = with_block(points, heavy, ["key"], "u", "slab").withColumn("cid", _cell(F.col("slab"), F.col("key")))
    rects = rectangles(points)
    ev = with_block(events.withColumns({"__key": F.col(key), "__v": F.col(event_valid), "__k": F.col(event_known)}), heavy, ["__key"], "__v", "__slab")
    ev = ev.withColumn("__cid", F.when(F.col("__key").isNull(), _spread("__v", "__k")).otherwise(_cell(F.col("__slab"), F.col("__key"))))
    out = _within(ev, "__cid", "__v", "__k", rects, "a")
    hit = F.col("__arow")
    if heavy:
        # Slabs of heavy keys as points: (slab number, first time anything of the slab was recorded).
        slabs = points.where(F.col("slab").isNotNull()).groupBy("key", "slab").agg(F.min("g").alias("g"))
        coarse = rectangles(slabs.select(F.col("key").alias("cid"), "g", F.col("slab").alias("u"), F.struct("slab").alias("row")))
        missed = F.col("__slab").isNotNull() & hit.isNull()
        out = out.withColumns({"__ckey": F.when(missed, F.col("__key")).otherwise(_spread("__key", "__v", "__k")), "__before": F.col("__slab") - 1})
        out = _within(out, "__ckey", "__before", "__k", coarse, "b")
        there = F.col("__brow.slab")
        out = out.withColumns({"__fcid": F.when(there.isNull(), _spread("__key", "__v", "__k")).otherwise(_cell(there, F.col("__key"))), "__top": F.lit(END - 1)})
        out = _within(out, "__fcid", "__top", "__k", rects, "c")
        hit = F.coalesce(hit, F.col("__crow"))
    return out.withColumn("__hit", hit).select(*events.columns, *[F.col(f"__hit.{c}").alias(f"v_{c}") for c in versions.columns])
