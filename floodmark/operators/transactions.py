"""Transactions of a log from its own control records.

A log here has topic, partition, offset, ``producer_id`` (null outside transactions) and ``control``: null for
data, ``commit`` or ``abort`` for the marker that ends the producer's transaction in the partition. A
producer's transaction is numbered by the markers before it, a running sum in blocks of offsets, so one
busy producer is many tasks and records find their transaction by equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.running import running
from .topics import PLACE

TRANSACTION = (*PLACE, "producer_id", "transaction")


def numbered(log: DataFrame, block: int = 100_000) -> DataFrame:
    """The transactional records with the number of their ``transaction``; its marker is its last record."""
    rows = log.filter(F.col("producer_id").isNotNull())
    marker = F.col("control").isNotNull().cast("long")
    out = running(rows, [*PLACE, "producer_id"], ["offset"], F.floor(F.col("offset") / block), {"transaction": ("sum", marker)})
    return out.withColumn("transaction", F.col("transaction") - marker)


def transactions(log: DataFrame, block: int = 100_000) -> DataFrame:
    """topic, partition, producer_id, transaction, first_offset, last_offset, outcome: ``commit``, ``abort`` or ``open``.

    The last offset is that of the marker, null while there is none. A marker without records ends nothing.
    """
    data = F.when(F.col("control").isNull(), F.col("offset"))
    marker = F.when(F.col("control").isNotNull(), F.col("offset"))
    spans = numbered(log, block).groupBy(*TRANSACTION).agg(F.min(data).alias("first_offset"), F.max(marker).alias("last_offset"), F.coalesce(F.max("control"), F.lit("open")).alias("outcome"))
    return spans.filter(F.col("first_offset").isNotNull())


def aborted_transactions(log: DataFrame) -> DataFrame:
    """What ``topics.read_committed`` takes: the spans of aborted transactions."""
    return transactions(log).filter("outcome = 'abort'").drop("transaction", "outcome")


def last_stable_offsets(log: DataFrame) -> DataFrame:
    """topic, partition, last_stable_offset: the first offset of an open transaction, or the one after the end."""
    ends = log.groupBy(*PLACE).agg((F.max("offset") + 1).alias("_end"))
    opened = transactions(log).filter("outcome = 'open'").groupBy(*PLACE).agg(F.min("first_offset").alias("_first"))
    return ends.join(opened, list(PLACE), "left").select(*PLACE, F.coalesce("_first", "_end").alias("last_stable_offset"))


def committed_view(log: DataFrame, block: int = 100_000) -> DataFrame:
    """The data records that a reader of committed ones sees: before the last stable offset, and of no aborted transaction."""
    rows = numbered(log, block)
    outcome = F.coalesce(F.max("control"), F.lit("open")).alias("outcome")
    spans = rows.groupBy(*TRANSACTION).agg(outcome, F.min(F.when(F.col("control").isNull(), F.col("offset"))).alias("_first"))
    stable = spans.filter("outcome = 'open'").groupBy(*PLACE).agg(F.min("_first").alias("_stable"))
    good = rows.filter("control IS NULL").join(spans.filter("outcome = 'commit'").drop("outcome", "_first"), list(TRANSACTION), "left_semi").select(*log.columns)
    plain = log.filter("producer_id IS NULL AND control IS NULL")
    seen = good.unionByName(plain).join(stable, list(PLACE), "left")
    return seen.filter(F.col("_stable").isNull() | (F.col("offset") < F.col("_stable"))).select(*log.columns)
