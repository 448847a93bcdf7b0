"""Versioned history and queries on materialised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import convert


def versions(changelog: DataFrame, key: str, ts: str, order: str, deleted: Column, retention: str | None = None) -> DataFrame:
    """Rows with ``valid_from`` and ``valid_to`` (null: still valid); a delete ends the version before it.

    Of several rows of a key at one time the last to arrive holds. Rows more than ``retention`` behind
    the key's newest time on arrival are refused.
    """
    rows = changelog.dropna(subset=[key])
    if retention is not None:
        newest = F.max(ts).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("_newest", newest).filter(F.col(ts) >= F.col("_newest") - F.expr(f"interval {retention}")).drop("_newest")
    gone = F.coalesce(deleted, F.lit(False))
    later = Window.partitionBy(key).orderBy(ts, order)
    rows = rows.withColumns({"_gone": gone, "valid_from": F.col(ts), "valid_to": F.lead(ts).over(later)})
    return rows.filter(~F.col("_gone") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))).drop("_gone")


def as_of(history: DataFrame, time: Column) -> DataFrame:
    """The version of each key that holds at ``time``."""
    return history.filter((F.col("valid_from") <= time) & (F.col("valid_to").isNull() | (time < F.col("valid_to"))))


def between(history: DataFrame, low: Column | None = None, high: Column | None = None, ascending: bool = True) -> DataFrame:
    """All versions valid at some time in [low, high], by start."""
    if high is not None:
        history = history.filter(F.col("valid_from") <= high)
    if low is not None:
        history = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > low))
    return history.orderBy(F.col("valid_from").asc() if ascending else F.col("valid_from").desc())


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    return table.filter(F.col(key) == F.lit(value))


def key_range(table: DataFrame, key: str, low=None, high=None, ascending: bool = True) -> DataFrame:
    """Keys in [low, high], either end open if None, in logical order (strings by UTF-8 bytes)."""
    if low is not None:
        table = table.filter(F.col(key) >= F.lit(low))
    if high is not None:
        table = table.filter(F.col(key) <= F.lit(high))
    return table.orderBy(F.col(key).asc() if ascending else F.col(key).desc())


def key_range_by_bytes(table: DataFrame, key: str, low=None, high=None, ascending: bool = True) -> DataFrame:
    """``key_range`` in the order of serialised keys: of whole numbers the negative ones come after all others.

    Bounds are compared as numbers on each side of that break, so they still reach the files.
    """
    kind = {"bigint": "long", "int": "int", "string": "string"}[table.schema[key].dataType.simpleString()]
    k = F.col(key)
    if kind == "string":
        return key_range(table, key, low, high, ascending)
    if low is not None:
        table = table.filter((k >= low) | (k < 0) if low >= 0 else (k < 0) & (k >= low))
    if high is not None:
        table = table.filter((k >= 0) & (k <= high) if high >= 0 else (k >= 0) | (k <= high))
    by = convert.key_bytes(k, kind)
    return table.orderBy(by.asc() if ascending else by.desc())


def prefix_scan(table: DataFrame, key: str, prefix: str) -> DataFrame:
    return table.filter(F.col(key).startswith(prefix)).orderBy(key)


def scan(table: DataFrame, key: str, reverse: bool = False) -> DataFrame:
    return table.orderBy(F.col(key).desc() if reverse else F.col(key).asc())


def approximate_entries(table: DataFrame, key: str) -> DataFrame:
    return table.agg(F.count(key).alias("entries"))


def window_fetch(windows: DataFrame, low: Column, high: Column, key: str | None = None, value=None, start: str = "start", backward: bool = False) -> DataFrame:
    """Windows that start in [low, high], of one key or all."""
    rows = windows.filter(F.col(start).between(low, high))
    rows = rows if key is None else rows.filter(F.col(key) == F.lit(value))
    return rows.orderBy(F.col(start).desc() if backward else F.col(start).asc())


def find_sessions(sessions: DataFrame, earliest_end: Column, latest_start: Column, key: str | None = None, value=None) -> DataFrame:
    """Sessions that end at ``earliest_end`` or later and start at ``latest_start`` or before."""
    rows = sessions.filter((F.col("end") >= earliest_end) & (F.col("start") <= latest_start))
    return rows if key is None else rows.filter(F.col(key) == F.lit(value))


def position(log: DataFrame) -> DataFrame:
    """Topic, partition and the highest offset read."""
    return log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def require_position(table: DataFrame, reached: DataFrame, bound: DataFrame) -> DataFrame:
    """``table``, if what was read has reached ``bound`` (both topic, partition, offset); else an error."""
    b = bound.select("topic", "partition", F.col("offset").alias("_wanted"))
    behind = b.join(reached, ["topic", "partition"], "left").filter(F.coalesce("offset", F.lit(-1)) < F.col("_wanted"))
    if not behind.isEmpty():
        raise RuntimeError("the table has not reached the asked position")
    return table


def state_snapshot(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """The state of a streaming query, all partitions, as of a batch (``batchId``, ``operatorId``)."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


def apply_puts(table: DataFrame, puts: DataFrame, key: str, order: str, mode: str = "put", deleted: Column | None = None) -> DataFrame:
    """A table after ``put``, ``put_if_absent`` or ``delete`` of all rows of ``puts`` (its columns and ``order``).

    Of several rows of a key the last put holds, or the first for ``put_if_absent``.
    """
    new = puts.dropna(subset=[key])
    if mode == "delete":
        return table.join(new.select(key).distinct(), key, "left_anti")
    whole = F.struct(*table.columns)
    pick = F.min_by if mode == "put_if_absent" else F.max_by
    flag = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    new = new.withColumn("_gone", flag).groupBy(key).agg(pick(F.struct(whole.alias("r"), F.col("_gone")), order).alias("_p")).select(key, "_p.*")
    if mode == "put_if_absent":
        return table.unionByName(new.filter(~F.col("_gone")).join(table.select(key), key, "left_anti").select("r.*"))
    return table.join(new.select(key), key, "left_anti").unionByName(new.filter(~F.col("_gone")).select("r.*"))
