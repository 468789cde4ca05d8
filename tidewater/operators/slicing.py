"""Late and out-of-order events by stream slicing.

Time is cut into non-overlapping panes at the granularity at which windows begin and end. A pane
holds additive totals, so an event, late or not, changes exactly one pane; a window is recomposed
from the panes it covers, and only windows over changed panes are emitted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exactly_once import message_key

#: Batches per block of the two-level running maximum.
BLOCK = 4_096
HOUR_US = 3_600_000_000


def batch_cutoffs(deliveries: DataFrame, group: str, batch: str, at: str, lateness_us: Column) -> DataFrame:
    """(group, batch, cutoff): greatest ``at`` of all smaller batches minus the lateness; NULL before the first.

    ``batch`` and ``at`` are bigint, ``lateness_us`` a column constant per group. NULL ``at`` is
    never the greatest; rows with NULL batch are left out. A pane log with its ``top`` does as well as
    the deliveries. One row per batch, found by partial
    aggregation; the running maximum goes by blocks of BLOCK batches and then inside each block.
    """
    tops = deliveries.where(F.col(batch).isNotNull()).groupBy(group, batch).agg(F.max(at).alias("top"), F.max(lateness_us).alias("late_us"))
    tops = tops.withColumn("blk", F.floor(F.col(batch) / BLOCK))
    ahead = lambda *keys: Window.partitionBy(group, *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    inside = tops.withColumn("before", F.max("top").over(ahead("blk", batch)))
    blocks = tops.groupBy(group, "blk").agg(F.max("top").alias("t")).withColumn("carry", F.max("t").over(ahead("blk"))).drop("t")
    return inside.join(blocks, [group, "blk"]).select(group, batch, (F.greatest("before", "carry") - F.col("late_us")).alias("cutoff"))


def first_deliveries(deliveries: DataFrame, dataset: str, identifier: str, fallback: str, seq: str, keep: list[str]) -> DataFrame:
    """One row per message: its first delivery's ``seq`` and ``keep`` columns; combined before the shuffle."""
    keyed = deliveries.select(dataset, message_key(identifier, fallback, seq).alias("message_key"), seq, *keep)
    first = keyed.groupBy(dataset, "message_key").agg(F.min(F.struct(seq, *keep)).alias("r"))
    return first.select(dataset, "message_key", f"r.{seq}", *[f"r.{c}" for c in keep])


def pane_log(deliveries: DataFrame, group: str, batch: str, at: str, width_us: int = 24 * HOUR_US, lateness_us: Column | None = None) -> DataFrame:
    """(group, batch, pane_us, rows, top, [late_us]): what each batch put into each pane, and the latest time there.

    Rows with NULL time or batch are in no pane. All deliveries count, combined before the shuffle.
    """
    rows = deliveries.where(F.col(batch).isNotNull() & F.col(at).isNotNull())
    extra = [F.max(lateness_us).alias("late_us")] if lateness_us is not None else []
    return rows.groupBy(group, batch, pane_of(F.col(at), width_us).alias("pane_us")).agg(F.count(F.lit(1)).alias("rows"), F.max(at).alias("top"), *extra)


def pane_states(log: DataFrame, cutoffs: DataFrame, group: str, batch: str, width_us: int = 24 * HOUR_US) -> DataFrame:
    """(group, batch, pane_us, state, cutoff): how each pane stood when the batch arrived.

    CLOSED: it ended at or before the batch's cutoff. CUT: the cutoff lies inside it. OPEN: all else,
    also where there is no cutoff yet.
    """
    joined = log.select(group, batch, "pane_us").join(cutoffs, [group, batch], "left")
    state = F.when(F.col("pane_us") + width_us <= F.col("cutoff"), "CLOSED").when(F.col("pane_us") < F.col("cutoff"), "CUT").otherwise("OPEN")
    return joined.withColumn("state", state)


def split_late(messages: DataFrame, states: DataFrame, group: str, batch: str, at: str, width_us: int = 24 * HOUR_US) -> DataFrame:
    """Adds ``pane_us`` and ``is_late``, from the state of the message's pane when its batch arrived.

    What falls into a closed pane is late, into an open one not; only in the one pane that a cutoff
    cuts are event times compared with it. NULL time or batch is never late.
    """
    joined = messages.withColumn("pane_us", pane_of(F.col(at), width_us)).join(states, [group, batch, "pane_us"], "left")
    late = (F.col("state") == "CLOSED") | ((F.col("state") == "CUT") & (F.col(at) < F.col("cutoff")))
    return joined.withColumn("is_late", F.coalesce(late, F.lit(False))).drop("state")


def pane_of(at: Column, width_us: int) -> Column:
    """Start of the pane that holds a time."""
    return (at - F.pmod(at, F.lit(width_us))).cast("bigint")


def panes(messages: DataFrame, keys: list[str], at: str, width_us: int, measures: dict[str, Column], revision: str | None = None) -> DataFrame:
    """(keys, pane_us, [revision], measures): additive totals per pane, of all or per revision (batch).

    ``measures`` are row-level columns to be summed; NULL counts as 0. Rows with NULL time fall in
    no pane.
    """
    pane = pane_of(F.col(at), width_us).alias("pane_us")
    by = [*keys, pane, *([revision] if revision else [])]
    return messages.where(F.col(at).isNotNull()).groupBy(*by).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(n) for n, c in measures.items()])


def merge_panes(stored: DataFrame | None, fresh: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Adds new pane totals to the stored ones."""
    rows = fresh if stored is None else stored.unionByName(fresh)
    return rows.groupBy(*keys, "pane_us").agg(*[F.sum(m).alias(m) for m in measures])


def covering_windows(pane_us: Column, size_us: int, slide_us: int) -> Column:
    """Array of the starts of all windows [start, start + size) that hold the pane."""
    last = pane_of(pane_us, slide_us)
    return F.transform(F.sequence(F.lit(0), F.lit(-(-size_us // slide_us) - 1)), lambda i: last - i.cast("bigint") * F.lit(slide_us))


def compose(all_panes: DataFrame, changed: DataFrame | None, keys: list[str], measures: list[str], size_us: int, slide_us: int) -> DataFrame:
    """Windows (keys, window_us, measures); with ``changed`` panes, only those that cover one of them.

    Size and slide must be whole multiples of the pane width. Windows without any pane do not exist.
    """
    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("window_us", F.explode(covering_windows(F.col("pane_us"), size_us, slide_us)))

    rows = spread(all_panes)
    if changed is not None:
        touched = spread(changed.select(*keys, "pane_us")).select(*keys, "window_us").distinct()
        rows = rows.join(touched, [*keys, "window_us"], "left_semi")
    rows = rows.where((F.col("pane_us") >= F.col("window_us")) & (F.col("pane_us") < F.col("window_us") + size_us))
    return rows.groupBy(*keys, "window_us").agg(*[F.sum(m).alias(m) for m in measures])


def emissions(by_revision: DataFrame, keys: list[str], revision: str, measures: list[str]) -> DataFrame:
    """Every emission of every pane: totals as they stood after each revision that changed it.

    Input has one row per pane and revision. The last emission of a pane is flagged is_final.
    """
    order = Window.partitionBy(*keys, "pane_us").orderBy(revision)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_revision.select(
        *keys, "pane_us", revision, F.row_number().over(order).alias("emission"),
        *[F.sum(m).over(upto).alias(m) for m in measures], F.lead(revision).over(order).isNull().alias("is_final"),
    )
