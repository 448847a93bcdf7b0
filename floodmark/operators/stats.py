"""Statistics over measurements (metric, ts, value), whole or by sample window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running


def sampled(df: DataFrame, ts: str, sample: str, *aggregates: Column, metric: str = "metric") -> DataFrame:
    """Aggregates by metric and sample window."""
    return df.groupBy(metric, F.window(ts, sample).alias("w")).agg(*aggregates).withColumn("start", F.col("w.start")).drop("w")


def basic(value: str = "value") -> list[Column]:
    return [F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"), F.count(value).alias("count")]


def cumulative(df: DataFrame, order: str, value: str = "value", metric: str = "metric", block: Column | None = None) -> DataFrame:
    """Running sum and count of each metric, block by block if ``block`` is given (see ``functions.running``)."""
    if block is not None:
        counted = {"cumulative_sum": ("sum", F.col(value)), "cumulative_count": ("sum", F.col(value).isNotNull().cast("long"))}
        return running(df, [metric], [order], block, counted)
    so_far = Window.partitionBy(metric).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"cumulative_sum": F.sum(value).over(so_far), "cumulative_count": F.count(value).over(so_far)})


def rates(df: DataFrame, ts: str, sample: str, samples: int, value: str = "value", metric: str = "metric") -> DataFrame:
    """Rate a second over the ``samples`` newest windows with each sample window, and the total so far (a meter).

    The simple rate is that of the window alone. Only windows with values have a row, and empty ones in
    between count as 0.
    """
    w = sampled(df, ts, sample, F.sum(value).alias("sum"), F.count(value).alias("count"), metric=metric)
    at = w.withColumn("_s", F.col("start").cast("timestamp").cast("long"))
    size = F.lit(_seconds(sample))
    recent = Window.partitionBy(metric).orderBy("_s").rangeBetween(-(samples - 1) * _seconds(sample), 0)
    so_far = Window.partitionBy(metric).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    return at.withColumns({"rate": F.sum("sum").over(recent) / (size * samples), "simple_rate": F.col("sum") / size, "total": F.sum("sum").over(so_far)}).drop("_s")


def _seconds(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def percentiles(df: DataFrame, shares: list[float], value: str = "value", metric: str = "metric", exact: bool = True) -> DataFrame:
    """Percentiles of each metric: exact, or approximate for groups too large to sort."""
    p = F.percentile(value, shares) if exact else F.percentile_approx(value, shares)
    return df.groupBy(metric).agg(p.alias("p")).select(metric, *[F.col("p")[i].alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])


def histogram(df: DataFrame, low: float, high: float, buckets: int, linear: bool = False, value: str = "value", metric: str = "metric") -> DataFrame:
    """Counts by bucket; values outside fall into the first or last one.

    Constant buckets are equally wide; linear ones grow in proportion to their number.
    """
    share = (F.col(value) - low) / (high - low)
    place = F.floor((F.sqrt(1 + 4 * F.greatest(share, F.lit(0.0)) * buckets * (buckets + 1)) - 1) / 2) if linear else F.floor(share * buckets)
    bucket = F.least(F.greatest(place, F.lit(0)), F.lit(buckets - 1)).cast("int")
    return df.groupBy(metric, bucket.alias("bucket")).agg(F.count("*").alias("count"))


def binned_percentiles(df: DataFrame, shares: list[float], low: float, high: float, buckets: int, linear: bool = False, value: str = "value", metric: str = "metric") -> DataFrame:
    """Percentiles as the lower end of the first bucket by which more than the share of all values has come.

    Only bucket counts are shuffled, so a metric may have any number of values. Linear buckets start at 0.
    """
    counts = histogram(df, low, high, buckets, linear, value, metric)
    so_far = Window.partitionBy(metric).orderBy("bucket")
    share = F.sum("count").over(so_far) / F.sum("count").over(Window.partitionBy(metric))
    bucket = F.col("bucket")
    start = bucket * (bucket + 1) / F.lit(2.0) * (high / (buckets * (buckets + 1) / 2)) if linear else low + bucket * ((high - low) / buckets)
    rows = counts.withColumns({"_share": share, "_start": start})
    return rows.groupBy(metric).agg(*[F.coalesce(F.min(F.when(F.col("_share") > s, F.col("_start"))), F.max("_start")).alias(f"p{round(100 * s)}") for s in shares])


def frequencies(df: DataFrame, low: float, high: float, buckets: int, value: str = "value", metric: str = "metric") -> DataFrame:
    """The share of each metric's values in each of equally wide buckets."""
    counts = histogram(df, low, high, buckets, value=value, metric=metric)
    return counts.withColumn("frequency", F.col("count") / F.sum("count").over(Window.partitionBy(metric)))


def last_value(df: DataFrame, order: str, value: str = "value", metric: str = "metric") -> DataFrame:
    return df.groupBy(metric).agg(F.max_by(value, order).alias("value"))


def out_of_quota(df: DataFrame, measured: str, bound: float, upper: bool = True) -> DataFrame:
    """Rows above an upper bound, or below a lower one."""
    return df.filter(F.col(measured) > bound if upper else F.col(measured) < bound)
