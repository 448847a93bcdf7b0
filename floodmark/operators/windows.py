"""Time windows, late records, and when results are emitted.

Tumbling and hopping windows are half-open and aligned to the epoch; sliding and session windows and
join windows include both ends. ``stream time`` is the highest event time seen so far, in arrival order.
Batch functions replay it exactly; on streams use ``with_grace`` and the output modes, where the
watermark moves once a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running
from ..functions.times import epoch_millis
from .aggregates import aggregate as fold_rows


def interval(ms: int) -> Column:
    return F.make_dt_interval(secs=F.lit(ms / 1000).cast("decimal(18,6)"))


def tumbling(ts: str, size: str) -> Column:
    return F.window(ts, size)


def hopping(df: DataFrame, ts: str, size: str, advance: str, name: str = "window") -> DataFrame:
    """One row for each window that holds the record; no window starts before the epoch."""
    rows = df.withColumn(name, F.window(ts, size, advance))
    return rows.filter(F.col(f"{name}.start") >= F.lit("1970-01-01 00:00:00").cast(rows.schema[ts].dataType))


def unlimited(df: DataFrame, ts: str, start: Column) -> DataFrame:
    """The one window [start, forever): earlier records are out."""
    return df.filter(F.col(ts) >= start)


def windowed(df: DataFrame, key: str | Sequence[str], window: Column | str, *aggregates: Column) -> DataFrame:
    """Aggregates by key and window; records without a key take no part."""
    keys = [key] if isinstance(key, str) else list(key)
    window = F.col(window) if isinstance(window, str) else window.alias("window")
    return df.dropna(subset=keys).groupBy(*keys, window).agg(*aggregates)


def sliding(df: DataFrame, key: str, ts: str, difference_ms: int, *aggregates: Column) -> DataFrame:
    """Sliding windows of ``difference_ms``, at ms precision: key, start_ms, end_ms (inclusive) and aggregates.

    For a record at t there are windows [t - d, t] and, if it holds a record, [t + 1, t + 1 + d]. Starts
    meet records through time buckets as wide as the window, so the join is an equality join on key and
    bucket, and a record meets the starts of two buckets only. Windows that would start before 0 are
    those of early records: [0, d] takes their place.
    """
    rows = df.dropna(subset=[key]).withColumn("_t", epoch_millis(F.col(ts)))
    starts = F.array(F.greatest(F.col("_t") - difference_ms, F.lit(0)), F.col("_t") + 1)
    starts = rows.select(F.col(key).alias("_k"), F.explode(starts).alias("start_ms")).distinct()
    width = difference_ms + 1
    near = F.floor(F.col("start_ms") / width)
    starts = starts.withColumn("_b", F.explode(F.array(near, near + 1)))
    rows = rows.withColumn("_rb", F.floor(F.col("_t") / width))
    within = F.col("_t").between(F.col("start_ms"), F.col("start_ms") + difference_ms)
    joined = rows.join(starts, (F.col(key) == F.col("_k")) & (F.col("_rb") == F.col("_b")) & within)
    return joined.groupBy(key, "start_ms").agg(*aggregates).withColumn("end_ms", F.col("start_ms") + difference_ms)


_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGED = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
#: Whose record cuts a pair of buckets, in the order of those with the same place.
SECOND, MARK, FIRST = 0, 1, 2


def sliding_merged(df: DataFrame, key: str, ts: str, difference_ms: int, results: dict[str, tuple[str, Column]]) -> DataFrame:
    """As ``sliding``, for aggregates that merge: ``results`` maps names to (sum, count, min or max, column).

    Linear in the records of a window: they are first aggregated by time, times are cut into buckets as
    wide as the window, and a window is the end of one bucket and the beginning of the next. A record at
    place p of its bucket cuts two pairs of buckets there: the window up to it ends at p of the pair's second
    bucket, the window after it starts behind p of the pair's first. So a time is two rows, one for each pair, and
    a pair's windows are running results over its rows by place, from both ends.
    """
    width = difference_ms + 1
    rows = df.dropna(subset=[key]).withColumn("_t", epoch_millis(F.col(ts)))
    counted = results | {"_records": ("count", F.lit(1))}
    times = rows.groupBy(key, "_t").agg(*[_PARTIAL[k](c).alias(n) for n, (k, c) in counted.items()])
    bucket, place = F.floor(F.col("_t") / width), F.pmod(F.col("_t"), F.lit(width))
    cut = lambda pair, at, side: F.struct(pair.cast("long").alias("_pair"), at.cast("long").alias("_at"), F.lit(side).alias("_side"))
    cuts = [cut(bucket - 1, place, SECOND), cut(bucket, place, FIRST)]
    early = [cut(F.lit(-1), F.lit(difference_ms), MARK)]  # the window [0, d] in place of one that would start before 0
    cuts = F.when(F.col("_t") < difference_ms, F.array(*cuts, *early)).otherwise(F.array(*cuts))
    both = times.withColumn("_c", F.explode(cuts)).select(key, *counted, "_c.*")
    # seen from either end, what has the same place comes in this order of sides: a row's own time counts only if it's of the second bucket
    part = Window.partitionBy(key, "_pair")
    from_start = part.orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    from_end = part.orderBy(F.desc("_at"), "_side").rowsBetween(Window.unboundedPreceding, -1)
    merge = {n: {"count": "sum"}.get(k, k) for n, (k, _) in counted.items()}
    so_far = lambda n, side, w: _PARTIAL[merge[n]](F.when(F.col("_side") == side, F.col(n))).over(w)
    start = F.col("_pair") * width + F.col("_at") + 1
    starts = F.when((F.col("_side") != SECOND) | (start >= 0), F.col("_at"))
    found = both.withColumns({**{f"_{n}1": so_far(n, FIRST, from_end) for n in counted}, **{f"_{n}2": so_far(n, SECOND, from_start) for n in counted}, "_last": F.max(starts).over(from_start.rowsBetween(Window.unboundedPreceding, -1))})
    found = found.filter(starts.isNotNull() & (F.col("_last").isNull() | (F.col("_last") < F.col("_at"))))
    merged = {n: _MERGED[merge[n]](F.col(f"_{n}1"), F.col(f"_{n}2")) for n in counted}
    out = found.select(key, start.alias("start_ms"), *[c.alias(n) for n, c in merged.items()]).filter("_records > 0").drop("_records")
    return out.withColumn("end_ms", F.col("start_ms") + difference_ms)


def sessions(df: DataFrame, key: str | Sequence[str], ts: str, gap: str, *aggregates: Column) -> DataFrame:
    """Sessions that merge while records are at most ``gap`` apart: key, start, end (the last record) and aggregates.

    Start and end are aggregates of the records, so later filters on them aren't pushed below the merge.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bounds = (F.min(ts).alias("start"), F.max(ts).alias("end"))
    return df.dropna(subset=keys).groupBy(*keys, F.session_window(ts, gap).alias("_s")).agg(*aggregates, *bounds).drop("_s")


def session_fold(df: DataFrame, key: str, ts: str, gap: str, value: str, initial: Column, aggregator: Callable[[Column, Column], Column], merger: Callable[[Column, Column], Column], order: str) -> DataFrame:
    """Sessions as ``sessions`` forms them, each folded from ``initial``: key, start, end, aggregate.

    ``merger`` joins the aggregates of neighbouring parts of a session. Numbering the sessions sorts a key.
    """
    by = Window.partitionBy(key).orderBy(ts, order)
    fresh = F.coalesce(F.col(ts) > F.lag(ts).over(by) + F.expr(f"interval {gap}"), F.lit(True))
    rows = df.dropna(subset=[key, value]).withColumn("_fresh", fresh.cast("long")).withColumn("_s", F.sum("_fresh").over(by))
    bounds = rows.groupBy(key, "_s").agg(F.min(ts).alias("start"), F.max(ts).alias("end"))
    in_order = rows.withColumn("_at", F.struct(ts, order))
    return bounds.join(fold_rows(in_order, [key, "_s"], value, initial, aggregator, "_at", merger), [key, "_s"]).drop("_s")


def cogroup_windowed(streams: dict[str, DataFrame], key: str, window: Column, aggregates: dict[str, Column]) -> DataFrame:
    """Several streams into one aggregate by key and window; see ``aggregates.cogroup``."""
    tagged = tag(streams, key)
    return tagged.groupBy(key, window.alias("window")).agg(*[c.alias(n) for n, c in aggregates.items()])


def cogroup_sessions(streams: dict[str, DataFrame], key: str, ts: str, gap: str, aggregates: dict[str, Column]) -> DataFrame:
    return sessions(tag(streams, key), key, ts, gap, *[c.alias(n) for n, c in aggregates.items()])


def cogroup_sliding(streams: dict[str, DataFrame], key: str, ts: str, difference_ms: int, results: dict[str, tuple[str, Column]]) -> DataFrame:
    """``results`` as in ``sliding_merged``; their columns see ``stream``, the name a row's stream has in ``streams``."""
    return sliding_merged(tag(streams, key), key, ts, difference_ms, results)


def tag(streams: dict[str, DataFrame], key: str) -> DataFrame:
    tagged = None
    for name, df in streams.items():
        df = df.dropna(subset=[key]).withColumn("stream", F.lit(name))
        tagged = df if tagged is None else tagged.unionByName(df, allowMissingColumns=True)
    return tagged


def retain(windows: DataFrame, retention: str, start: str = "start") -> DataFrame:
    """Windows that start no longer than ``retention`` before the newest start."""
    newest = windows.agg(F.max(start)).first()[0]  # one value
    if newest is None:
        return windows
    kind = windows.schema[start].dataType
    return windows.filter(F.col(start) >= F.lit(newest).cast(kind) - F.expr(f"interval {retention}"))


# --- grace and lateness

def with_grace(stream: DataFrame, ts: str, grace: str) -> DataFrame:
    """For streams: the watermark trails stream time by the grace period. Zoneless times become instants."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, grace)


def inherited_grace(*parents_ms: int | None) -> int:
    """Grace of a downstream operator: the longest of its windowed parents; without any, an error."""
    known = [g for g in parents_ms if g is not None]
    if not known:
        raise ValueError("no windowed operator upstream, so there is no grace period")
    return max(known)


def stream_time(df: DataFrame, ts: str, order: str, partition: str | Sequence[str] | None = None, block: Column | None = None) -> DataFrame:
    """Adds ``stream_time``: the highest ``ts`` up to and with each row, in arrival order within the partition.

    Stream time belongs to a task, that is to a partition of the log: name its columns, or else one task
    sees all rows. With ``block``, which grows with ``order``, a partition is worked on block by block.
    """
    parts = [] if partition is None else [partition] if isinstance(partition, str) else list(partition)
    if block is not None:
        return running(df, parts, [order], block, {"stream_time": ("max", F.col(ts))})
    return df.withColumn("stream_time", F.max(ts).over(Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def drop_late(windowed_rows: DataFrame, end: Column, grace: str, time: str = "stream_time") -> DataFrame:
    """Records whose window had closed on arrival go: closed is stream time > end + grace."""
    return windowed_rows.filter(F.col(time) <= end + F.expr(f"interval {grace}"))


def on_window_update(rows: DataFrame, key: str, window: str, order: str, aggregate: Column | tuple[str, Column], name: str = "result", block: Column | None = None) -> DataFrame:
    """A result for every record: the aggregate of its window so far.

    With ``block``, which grows with ``order``, a window is worked on block by block; ``aggregate`` is then
    (sum, max, min or last, column).
    """
    if block is not None:
        return running(rows, [key, window], [order], block, {name: aggregate})
    so_far = Window.partitionBy(key, window).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, aggregate.over(so_far))


def on_window_close(results: DataFrame, end: Column | None, grace: str, now: Column) -> DataFrame:
    """One final result per key and window, for windows that have closed by stream time ``now``.

    Unlimited windows never close: an ``end`` of None is refused.
    """
    if end is None:
        raise ValueError("a window without an end never closes")
    return results.filter(end + F.expr(f"interval {grace}") < now)


suppress_until_close = on_window_close


def drop_tombstones(results: DataFrame, value: str) -> DataFrame:
    """Deletes say nothing in final results, since no earlier result went out."""
    return results.filter(F.col(value).isNotNull())


def refuse_old(rows: DataFrame, ts: str, retention: str, time: str = "stream_time") -> DataFrame:
    """Writes older than the history kept are refused."""
    return rows.filter(F.col(ts) >= F.col(time) - F.expr(f"interval {retention}"))


def emit_on_change(updates: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Updates that repeat the value before them are left out."""
    by = Window.partitionBy(key).orderBy(order)
    rows = updates.withColumns({"_before": F.lag(value).over(by), "_n": F.row_number().over(by)})
    return rows.filter((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_before", "_n")
