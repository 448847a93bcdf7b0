"""Queries on record logs: offsets, lag, compaction, transactions, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import running
from ..functions.times import epoch_micros

PLACE = ("topic", "partition")


def offsets(log: DataFrame) -> DataFrame:
    """First offset and the one after the last, for each partition."""
    return log.groupBy(*PLACE).agg(F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset"))


def offsets_for_time(log: DataFrame, time: Column) -> DataFrame:
    """The first offset whose timestamp is at least ``time``; partitions without one are left out."""
    return log.filter(F.col("timestamp") >= time).groupBy(*PLACE).agg(F.min(F.struct("offset", "timestamp")).alias("_o")).select(*PLACE, "_o.offset", "_o.timestamp")


def offsets_for_times(log: DataFrame, times: DataFrame) -> DataFrame:
    """As ``offsets_for_time`` for many (topic, partition, time): the union by falling time, the lowest offset carried along.

    Where timestamps aren't in offset order, the lowest offset of all later timestamps counts. A partition
    is worked on hour by hour.
    """
    rows = log.select(*PLACE, F.col("timestamp").alias("t"), "offset").withColumn("_q", F.lit(0))
    asked = times.select(*PLACE, F.col("time").alias("t"), F.lit(None).cast("long").alias("offset"), F.lit(1).alias("_q"))
    both = rows.unionByName(asked).withColumn("_back", -epoch_micros(F.col("t")))
    found = running(both, PLACE, ["_back", "_q"], F.floor(F.col("_back") / 3_600_000_000), {"_lowest": ("min", F.col("offset"))})
    return found.filter("_q = 1").select(*PLACE, F.col("t").alias("time"), F.col("_lowest").alias("offset"))


def offsets_of(log: DataFrame, specs: dict[str, str], time: Column | None = None) -> DataFrame:
    """Offsets of each partition by names, in one aggregation: ``earliest``, ``latest`` (one past the end), ``max_timestamp`` or ``at`` a time."""
    aggs = {
        "earliest": F.min("offset"), "latest": F.max("offset") + 1, "max_timestamp": F.max_by("offset", F.struct("timestamp", -F.col("offset"))),
        "at": F.min(F.when(F.col("timestamp") >= time, F.col("offset"))) if time is not None else None,
    }
    return log.groupBy(*PLACE).agg(*[aggs[s].alias(name) for name, s in specs.items()])


def offset_of(log: DataFrame, spec: str, time: Column | None = None) -> DataFrame:
    """One of ``offsets_of``; partitions without it are left out."""
    return offsets_of(log, {"offset": spec}, time).filter(F.col("offset").isNotNull())


def read_range(log: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Offsets from ``start`` to before ``end``; None is the beginning or the end."""
    log = log if start is None else log.filter(F.col("offset") >= start)
    return log if end is None else log.filter(F.col("offset") < end)


def lag(committed: DataFrame, log: DataFrame) -> DataFrame:
    """Records not yet consumed: ``committed`` is (group, topic, partition, committed_offset)."""
    ends = offsets(log).select(*PLACE, "end_offset")
    return committed.join(ends, list(PLACE)).withColumn("lag", F.greatest(F.col("end_offset") - F.coalesce("committed_offset", F.lit(0)), F.lit(0)))


def write_reset_plan(plan: DataFrame, path: str) -> None:
    plan.select("group", "topic", "partition", "offset").write.mode("overwrite").option("header", False).csv(path)


def read_reset_plan(spark, path: str) -> DataFrame:
    """(group, topic, partition, offset) of a plan; lines of three fields have no group."""
    f = F.split("value", ",")
    four = F.size(f) == 4
    at = lambda i: F.try_element_at(f, F.when(four, F.lit(i)).otherwise(F.lit(i - 1)))
    return spark.read.text(path).select(F.when(four, F.element_at(f, 1)).alias("group"), at(2).alias("topic"), at(3).cast("int").alias("partition"), at(4).cast("long").alias("offset"))


def delete_before(log: DataFrame, low: DataFrame) -> DataFrame:
    """The log without records before ``low`` (topic, partition, offset); -1 deletes all."""
    cut = low.select(*PLACE, F.col("offset").alias("_low"))
    return log.join(cut, list(PLACE), "left").filter(F.col("_low").isNull() | ((F.col("_low") >= 0) & (F.col("offset") >= F.col("_low")))).drop("_low").select(*log.columns)


def compact(log: DataFrame, delete_retention: str | None = None, now: Column | None = None) -> DataFrame:
    """The last record of each key; tombstones go once older than ``delete_retention`` before ``now``.

    Records without a key are not allowed in a compacted log and are dropped. Order and offsets stay.
    """
    whole = F.struct(*log.columns)
    kept = log.filter(F.col("key").isNotNull()).groupBy(*PLACE, "key").agg(F.max_by(whole, "offset").alias("_r")).select("_r.*")
    if delete_retention is not None:
        kept = kept.filter(F.col("value").isNotNull() | (F.col("timestamp") >= now - F.expr(f"interval {delete_retention}")))
    return kept


def read_committed(log: DataFrame, aborted: DataFrame) -> DataFrame:
    """Hides records of aborted transactions: ``aborted`` is (topic, partition, producer_id, first_offset, last_offset)."""
    a = aborted.select(*[F.col(c).alias(f"_{c}") for c in (*PLACE, "producer_id", "first_offset", "last_offset")])
    on = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition")) & (F.col("producer_id") == F.col("_producer_id")) & F.col("offset").between(F.col("_first_offset"), F.col("_last_offset"))
    return log.join(a, on, "left_anti")


def filter_partitions(df: DataFrame, topic: str | None = None, pattern: str | None = None, partitions: list[int] | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """By topic, topic pattern, partition numbers, or a range of them (``high`` exclusive)."""
    if topic is not None:
        df = df.filter(F.col("topic") == topic)
    if pattern is not None:
        df = df.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
    if partitions is not None:
        df = df.filter(F.col("partition").isin(partitions))
    if low is not None:
        df = df.filter(F.col("partition") >= low)
    return df if high is None else df.filter(F.col("partition") < high)


def retain_time(log: DataFrame, retention: str, now: Column) -> DataFrame:
    return log.filter(F.col("timestamp") >= now - F.expr(f"interval {retention}"))


def retain_bytes(log: DataFrame, size: Column, limit: int, block: int = 100_000) -> DataFrame:
    """The newest records of each partition whose sizes sum up to at most ``limit``, by blocks of so many offsets."""
    rows = log.withColumn("_back", -F.col("offset"))
    return running(rows, PLACE, ["_back"], F.floor(F.col("_back") / block), {"_sum": ("sum", size)}).filter(F.col("_sum") <= limit).select(*log.columns)
