"""Rolling totals over trailing periods, kept as a versioned daily state.

The total of a window on day d is yesterday's total plus the day's arrivals minus the amount of the
day that expires. ``build`` unrolls that recurrence over a calendar in one pass, ``advance`` does one
step of it, ``correct`` goes on from a kept state: it recomputes the days that late corrections touch
and unrolls the recurrence over days that came since. Both write rows with a higher version, and
``current`` reads the newest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def daily(rows: DataFrame, keys: list[str], day: str, amount: Column) -> DataFrame:
    """(keys, day, amount, n) per day with rows; summed before the shuffle, so a hot key is no burden.

    NULL amounts count as rows but add 0; rows with a NULL day or key are left out.
    """
    kept = rows.where(F.col(day).isNotNull())
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    return kept.groupBy(*keys, F.col(day).alias("day")).agg(F.sum(F.coalesce(amount, F.lit(0))).cast(MONEY).alias("amount"), F.count(F.lit(1)).alias("n"))


def _unroll(segments: DataFrame, days: DataFrame, keys: list[str], version: int) -> DataFrame:
    """State rows of stretches of days (keys, window_days, start, stop, amount, n), from the totals on the day before each.

    Each day adds its arrivals and takes off the amount of the day that expires; the running sum of
    these steps goes on from the totals given. One row per day and window, whatever the number of events.
    """
    of = [*keys, "window_days", "start"]
    sized = days.select(*keys, "day", "amount", "n").join(segments.select(*of, "stop", (F.col("n") != 0).alias("goes_on")), keys)
    arriving = sized.where("day BETWEEN start AND stop").select(*of, "day", "amount", "n")
    leaves = sized.withColumn("gone", F.date_add("day", F.col("window_days"))).where("gone BETWEEN start AND stop AND (day >= start OR goes_on)")
    expiring = leaves.select(*of, F.col("gone").alias("day"), (-F.col("amount")).cast(MONEY).alias("amount"), (-F.col("n")).alias("n"))
    calendar = segments.where("start <= stop").select(*of, F.explode(F.sequence("start", "stop")).alias("day"), F.col("amount").alias("a0"), F.col("n").alias("n0"))
    first = F.col("day") == F.col("start")
    carried = calendar.select(*of, "day", F.when(first, F.col("a0")).otherwise(F.lit(0)).cast(MONEY).alias("amount"), F.when(first, F.col("n0")).otherwise(F.lit(0)).cast("bigint").alias("n"))
    steps = arriving.unionByName(expiring).unionByName(carried).groupBy(*of, "day").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))
    upto = Window.partitionBy(*of).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.select(*keys, "day", "window_days", F.sum("amount").over(upto).cast(MONEY).alias("amount"), F.sum("n").over(upto).alias("n"), F.lit(version).alias("version"))


def _spans(days: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    return days.groupBy(*keys).agg(F.min("day").alias(low), F.max("day").alias(high))


def _each_window(windows: list[int]) -> Column:
    return F.explode(F.array(*[F.lit(w) for w in windows])).alias("window_days")


def build(days: DataFrame, keys: list[str], windows: list[int], version: int = 0) -> DataFrame:
    """State (keys, day, window_days, amount, n, version) from daily amounts, every day of each key's span.

    The span runs from the key's first to its last day; the recurrence starts from nothing.
    """
    segments = _spans(days, keys, "start", "stop").select(*keys, "start", "stop", _each_window(windows), F.lit(0).cast(MONEY).alias("amount"), F.lit(0).cast("bigint").alias("n"))
    return _unroll(segments, days, keys, version)


def current(state: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of every key, day and window."""
    newest = state.groupBy(*keys, "day", "window_days").agg(F.max_by(F.struct("amount", "n", "version"), "version").alias("r"))
    return newest.select(*keys, "day", "window_days", "r.amount", "r.n", "r.version")


def advance(state: DataFrame, days: DataFrame, today: Column, keys: list[str], windows: list[int], version: int) -> DataFrame:
    """Rows of ``today``: yesterday's totals joined with today's arrivals and the expiring day's amounts.

    Keys without yesterday's state start from their arrivals. Append the result to ``state``.
    """
    sized = F.explode(F.array(*[F.lit(w) for w in windows]))
    yesterday = current(state.where(F.col("day") == F.date_sub(today, 1)), keys).select(*keys, "window_days", "amount", "n")
    arrived = days.where(F.col("day") == today).select(*keys, sized.alias("window_days"), "amount", "n")
    gone = days.select(*keys, "day", sized.alias("window_days"), "amount", "n").where(F.col("day") == F.date_sub(today, F.col("window_days")))
    gone = gone.join(yesterday.select(*keys, "window_days"), [*keys, "window_days"], "left_semi")
    signed = gone.select(*keys, "window_days", (-F.col("amount")).cast(MONEY).alias("amount"), (-F.col("n")).alias("n"))
    rows = yesterday.unionByName(arrived).unionByName(signed)
    return rows.groupBy(*keys, "window_days").agg(F.sum("amount").cast(MONEY).alias("amount"), F.sum("n").alias("n")).select(*keys, today.alias("day"), "window_days", "amount", "n", F.lit(version).alias("version"))


def correct(state: DataFrame, old_days: DataFrame, new_days: DataFrame, keys: list[str], windows: list[int], version: int) -> DataFrame:
    """New versions of exactly those state rows that a change from ``old_days`` to ``new_days`` moves.

    A day's change reaches the window_days days that begin with it. Days after a key's last one go on
    from its totals on that day, days before its first one and new keys start from nothing; rows that
    fall out of a span get n = NULL (no row). Nothing else is computed again. The three frames are
    read several times: give written tables.
    """
    minus = old_days.select(*keys, "day", (-F.col("amount")).cast(MONEY).alias("amount"), (-F.col("n")).alias("n"))
    change = new_days.select(*keys, "day", "amount", "n").unionByName(minus).groupBy(*keys, "day").agg(F.sum("amount").cast(MONEY).alias("amount"), F.sum("n").alias("n")).where("amount != 0 OR n != 0")
    spans = _spans(new_days, keys, "alo", "ahi").join(_spans(old_days, keys, "blo", "bhi"), keys, "full")
    now = current(state, keys).where("n IS NOT NULL").drop("version")
    # Inside the old span: yesterday's row plus what changed in its window.
    reach = change.select(*keys, F.col("day").alias("from_day"), _each_window(windows), "amount", "n")
    reach = reach.select(*keys, F.explode(F.sequence("from_day", F.date_add("from_day", F.col("window_days") - 1))).alias("day"), "window_days", "amount", "n")
    delta = reach.groupBy(*keys, "day", "window_days").agg(F.sum("amount").alias("da"), F.sum("n").alias("dn"))
    both = now.join(spans, keys).join(delta, [*keys, "day", "window_days"], "left")
    out = F.col("alo").isNull() | (F.col("day") < F.col("alo")) | (F.col("day") > F.col("ahi"))
    total = both.withColumns({"amount": (F.col("amount") + F.coalesce("da", F.lit(0))).cast(MONEY), "n": F.col("n") + F.coalesce("dn", F.lit(0)), "out": out})
    moved = total.where("da IS NOT NULL OR out").select(*keys, "day", "window_days", F.when(~F.col("out"), F.col("amount")).alias("amount"), F.when(~F.col("out"), F.col("n")).alias("n"), F.lit(version).alias("version"))
    # Beyond it: days after the last one go on from there, all others start from nothing.
    nothing = [F.lit(0).cast(MONEY).alias("amount"), F.lit(0).cast("bigint").alias("n")]
    onward = total.where("day = bhi AND ahi > bhi").select(*keys, F.date_add("bhi", 1).alias("start"), F.col("ahi").alias("stop"), "window_days", "amount", "n")
    fresh = spans.where("alo IS NOT NULL AND (blo IS NULL OR alo < blo)").select(*keys, F.col("alo").alias("start"), F.least("ahi", F.date_sub("blo", 1)).alias("stop"), _each_window(windows), *nothing)
    grown = _unroll(onward.unionByName(fresh), new_days, keys, version).join(spans.select(*keys, "alo"), keys).where("day >= alo").drop("alo")
    return moved.unionByName(grown)
