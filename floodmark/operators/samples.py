"""Samples that close by time or by number of events, whichever comes first.

Where a sample ends decides where the next one begins, so a metric is one chain of samples. It is followed
in blocks of records in order of time: each block works out, for every record that a sample could begin
with, which sample is open at the block's end if it does. Only that is then handed from block to block, a
row a metric, and once it is known with what each block begins, all blocks number their samples at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.places import shared_folder
from ..functions.running import numbers
from ..functions.times import epoch_millis


def _next(times: np.ndarray, window_ms: int, events: int) -> np.ndarray:
    """With which record of the block the sample after the one begun by each record begins; the block's size for none."""
    places = np.arange(len(times))
    return np.minimum(np.minimum(places + events, np.searchsorted(times, times + window_ms)), len(times))


def _ends(window_ms: int, events: int):
    """For each record of a block: number and time of the last sample's first record, if a sample begins with it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        times = rows["at"].to_numpy()
        after = _next(times, window_ms, events)
        last = np.append(np.arange(len(times)), len(times))
        jump = np.append(np.where(after < len(times), after, np.arange(len(times))), len(times))
        while (jump[last] != last).any():  # each round doubles the way
            last, jump = jump[last], jump[jump]
        last = last[:-1]
        out = rows[["metric", "block", "number", "at"]].copy()
        out["last_number"], out["last_at"] = rows["number"].to_numpy()[last], times[last]
        return out

    return run


def _numbered(window_ms: int, events: int):
    """The first record's number of the sample of each record of a block, given the one open at its start."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        times, numbers_ = rows["at"].to_numpy(), rows["number"].to_numpy()
        open_number, open_at = int(rows["open_number"].iloc[0]), int(rows["open_at"].iloc[0])
        first = open_number < 0
        at = 0 if first else int(min(np.searchsorted(times, open_at + window_ms), max(0, open_number + events - numbers_[0])))
        samples = np.full(len(times), open_number, np.int64)
        after = _next(times, window_ms, events)
        while at < len(times):
            samples[at : after[at]] = numbers_[at]
            at = int(after[at])
        return pd.DataFrame({"metric": rows["metric"], "number": numbers_, "sample": samples})

    return run


def closed_samples(df: DataFrame, ts: str, order: str, window_ms: int, events: int, metric: str = "metric", block: int = 500_000) -> DataFrame:
    """``df`` with ``sample``: the number, in time and then ``order``, of the record its sample begins with.

    A record begins a new sample if the open one began ``window_ms`` or more before it, or has ``events``
    records. Records without a time are dropped, and those without a metric are a metric of their own.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(ts).isNotNull()).withColumns({"_at": epoch_millis(F.col(ts)), "_order": F.col(order)})
    # equal times go by order; times in ms decide
    placed = numbers(rows, [metric], ["_at", "_order"], F.floor(F.col("_at") / 3_600_000), "_number").withColumn("_block", F.floor(F.col("_number") / block))
    folder = shared_folder(spark, "samples")
    placed.write.parquet(f"{folder}/rows")
    placed = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    own = placed.select(F.coalesce(F.to_json(F.struct(metric)), F.lit("")).alias("metric"), F.col("_block").alias("block"), F.col("_number").alias("number"), F.col("_at").alias("at"))
    ends = own.groupBy("metric", "block").applyInPandas(_ends(window_ms, events), "metric string, block long, number long, at long, last_number long, last_at long")
    ends.write.partitionBy("block").parquet(f"{folder}/ends")
    last = placed.agg(F.max("_block")).first()[0]
    state = own.select("metric").distinct().select("metric", F.lit(-1).cast("long").alias("open_number"), F.lit(0).cast("long").alias("open_at"))
    begun = None
    for n in range((last if last is not None else -1) + 1):  # as many as the longest metric has blocks
        here = spark.read.schema("metric string, number long, at long, last_number long, last_at long, block long").parquet(f"{folder}/ends").filter(F.col("block") == n)
        begins = (F.col("open_number") < 0) | (F.col("at") >= F.col("open_at") + window_ms) | (F.col("number") >= F.col("open_number") + events)
        entry = F.min_by(F.struct("last_number", "last_at"), F.when(begins, F.col("number"))).alias("_e")
        found = here.join(state, "metric").groupBy("metric", "open_number", "open_at").agg(entry)
        found = found.select("metric", F.lit(n).cast("long").alias("block"), "open_number", "open_at", F.coalesce("_e.last_number", "open_number").alias("next_number"), F.coalesce("_e.last_at", "open_at").alias("next_at"))
        found.write.parquet(f"{folder}/states/{n}")  # a row for each metric
        found = spark.read.schema(found.schema).parquet(f"{folder}/states/{n}")
        state = found.select("metric", F.col("next_number").alias("open_number"), F.col("next_at").alias("open_at"))
        begun = found if begun is None else begun.unionByName(found)
    if begun is None:
        return df.limit(0).withColumn("sample", F.lit(None).cast("long"))
    known = own.join(begun.select("metric", "block", "open_number", "open_at"), ["metric", "block"])
    samples = known.groupBy("metric", "block").applyInPandas(_numbered(window_ms, events), "metric string, number long, sample long")
    keyed = placed.withColumn("_metric", F.coalesce(F.to_json(F.struct(metric)), F.lit("")))
    out = keyed.join(samples.withColumnsRenamed({"metric": "_metric", "number": "_number"}), ["_metric", "_number"])
    return out.select(*df.columns, "sample")
