"""Row-wise operators on streams, and keys. All work on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def filter_not(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate isn't true; a null result counts as false."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def map_rows(df: DataFrame, key: Column, value: Column, *keep: str) -> DataFrame:
    """New key and value; ``keep`` names further columns, such as the timestamp."""
    return df.select(key.alias("key"), value.alias("value"), *keep)


def map_values(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """A new value; the key, and with it the partitioning, stays."""
    return df.withColumn(name, value)


def flat_map(df: DataFrame, pairs: Column, *keep: str) -> DataFrame:
    """Any number of rows for each: ``pairs`` is an array of structs (key, value). Null or empty gives none."""
    return df.select(F.explode(pairs).alias("_p"), *keep).select("_p.key", "_p.value", *keep)


def flat_map_values(df: DataFrame, values: Column, name: str = "value") -> DataFrame:
    return df.withColumn(name, F.explode(values))


def split_words(df: DataFrame, text: Column, name: str = "word", lower: bool = True) -> DataFrame:
    """A row for each word of ``words``; empty parts go after the split, as rows, which costs less than by array."""
    parts = F.split(F.lower(text) if lower else text, r"[^a-zA-Z0-9_]+")
    return flat_map_values(df, parts, name).filter(F.col(name) != "")


def words(text: Column, lower: bool = True) -> Column:
    """Words of letters, digits and underscores (ASCII), without empty ones."""
    text = F.lower(text) if lower else text
    return F.filter(F.split(text, r"[^a-zA-Z0-9_]+"), lambda w: w != "")


def select_key(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return df.withColumn(name, key)


def peek(df: DataFrame, observation: Observation | str, *metrics: Column) -> DataFrame:
    """Metrics computed as rows pass; the rows are unchanged."""
    return df.observe(observation, *metrics)


def for_each(df: DataFrame, action: Callable[[Iterator], None]) -> None:
    """Terminal side effect on each partition's rows as they come, on the executors."""
    df.foreachPartition(action)


def branch(df: DataFrame, branches: dict[str, Column], default: str | None = None) -> dict[str, DataFrame]:
    """First matching predicate wins; rows that match none go to ``default``, or are dropped."""
    label = F.lit(None).cast("string")
    for name, predicate in reversed(branches.items()):
        label = F.when(predicate, F.lit(name)).otherwise(label)
    named = df.withColumn("_branch", label)
    out = {name: named.filter(F.col("_branch") == name).drop("_branch") for name in branches}
    if default is not None:
        out[default] = named.filter(F.col("_branch").isNull()).drop("_branch")
    return out


def merge(df: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of the streams, in no promised order; columns go by name."""
    for other in others:
        df = df.unionByName(other, allowMissingColumns=True)
    return df


def unwrap_window(df: DataFrame, window: str = "window") -> DataFrame:
    """``start`` and ``end`` in place of the window struct."""
    return df.withColumns({"start": F.col(f"{window}.start"), "end": F.col(f"{window}.end")}).drop(window)


def group_by_key(df: DataFrame, key: Column | str = "key", name: str = "key"):
    """Groups by a column, or by a key that an expression makes of each row; rows without one are dropped."""
    if isinstance(key, str):
        return df.groupBy(key)
    return df.withColumn(name, key).dropna(subset=[name]).groupBy(name)


def repartition(df: DataFrame, partitions: int | None = None, key: str = "key", partitioner: Column | None = None) -> DataFrame:
    """By key, to a given number of partitions, or as the numbers of ``partitioner`` say."""
    if partitioner is not None:
        return df.repartitionById(partitions, partitioner.cast("int"))
    return df.repartition(partitions, key) if partitions else df.repartition(key)
