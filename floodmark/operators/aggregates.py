"""Aggregations over keyed streams, without windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Rows with a key and a value; others take no part in aggregation."""
    return df.dropna(subset=[*([key] if isinstance(key, str) else key), value])


def count(df: DataFrame, key: str, value: str) -> DataFrame:
    return present(df, key, value).groupBy(key).agg(F.count("*").alias("count"))


#: Rows that a fold takes at a time, a power of two.
PIECE = 4096


def reduce_values(df: DataFrame, key: str, value: str, reducer: str | Callable[[Column, Column], Column], order: str | None = None) -> DataFrame:
    """One value for each key. ``reducer``: ``sum``, ``min``, ``max``, ``first``, ``last``, or a fold.

    The named ones combine on the map side. A fold takes the values of a key in ``order`` and has to be
    associative, as pieces of a key are folded apart (see ``_fold``).
    """
    rows = present(df, key, value)
    named = {"sum": F.sum(value), "min": F.min(value), "max": F.max(value)}
    if reducer in ("first", "last"):
        agg = (F.min_by if reducer == "first" else F.max_by)(value, order)
    elif isinstance(reducer, str):
        agg = named[reducer]
    else:
        def fold(listed: Column) -> Column:
            seed = F.element_at(listed, 1)["v"]
            return F.aggregate(F.slice(listed, 2, F.greatest(F.size(listed) - 1, F.lit(0))), seed, lambda a, x: reducer(a, x["v"]))

        return _fold(rows, [key], value, order, fold, fold).withColumnRenamed("_v", "reduced")
    return rows.groupBy(key).agg(agg.alias("reduced"))


def reduce_all(df: DataFrame, key: str, reducers: dict[str, tuple[str, str]], order: str | None = None) -> DataFrame:
    """Several reductions by name, ``{name: (value, reducer)}``, in one aggregation; each skips the nulls of its value."""
    plain = {"sum": F.sum, "min": F.min, "max": F.max}
    pick = {"first": F.min_by, "last": F.max_by}
    aggs = [(plain[how](value) if how in plain else pick[how](value, F.when(F.col(value).isNotNull(), F.col(order)))).alias(name) for name, (value, how) in reducers.items()]
    return df.dropna(subset=[key]).groupBy(key).agg(*aggs)


def aggregate(df: DataFrame, key: str | list[str], value: str, initial: Column, aggregator: Callable[[Column, Column], Column], order: str, merger: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """A fold from ``initial`` in ``order``; where the aggregator gives null the group is deleted and the next value starts anew.

    The result has no row for a group that ends deleted. ``merger`` makes one aggregate of those of two
    neighbouring pieces, each begun from ``initial``; with it a key of any size is folded in pieces, and
    whether a value deletes its group may then depend on that value alone. Without it the values of a key
    meet in one row: keys of bounded size only.
    """
    keys = [key] if isinstance(key, str) else key
    rows = present(df, keys, value)
    if merger is None:
        listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
        folded = F.aggregate(listed, initial, lambda a, x: aggregator(F.coalesce(a, initial), x["v"]))
        return rows.groupBy(*keys).agg(folded.alias("aggregate")).filter("aggregate is not null")

    def state(value: Column, deleted: Column) -> Column:
        return F.struct(value.alias("value"), deleted.alias("deleted"))

    def step(a: Column, x: Column) -> Column:
        now = aggregator(F.coalesce(a["value"], initial), x["v"])
        return state(now, a["deleted"] | now.isNull())

    def join(a: Column, x: Column) -> Column:
        b = x["v"]
        both = F.when(a["value"].isNull(), b["value"]).when(b["value"].isNull(), a["value"]).otherwise(merger(a["value"], b["value"]))
        return state(F.when(b["deleted"], b["value"]).otherwise(both), a["deleted"] | b["deleted"])

    # the value's type has to allow nulls, since a delete makes it null
    first = lambda listed: F.aggregate(listed, state(F.when(F.size(listed) > 0, initial), F.lit(False)), step)
    later = lambda listed: F.aggregate(F.slice(listed, 2, F.greatest(F.size(listed) - 1, F.lit(0))), F.element_at(listed, 1)["v"], join)
    return _fold(rows, keys, value, order, first, later).select(*keys, F.col("_v.value").alias("aggregate")).filter("aggregate is not null")


def _fold(rows: DataFrame, keys: list[str], value: str, order: str, first: Callable[[Column], Column], later: Callable[[Column], Column]) -> DataFrame:
    """Keys and ``_v``, folded in three steps: pieces of at most ``PIECE`` rows, pieces of a range, ranges of a key.

    Rows are range-partitioned by key and order, so a hot key lies in many partitions; no array is longer
    than ``PIECE``, the pieces of a partition, or the number of partitions. ``first`` folds an array of
    structs (o, v) of values, ``later`` one of folded pieces.
    """
    sorted_rows = rows.select(*keys, F.col(order).alias("_o"), F.col(value).alias("_v")).repartitionByRange(*keys, "_o").sortWithinPartitions(*keys, "_o")
    out = sorted_rows.withColumn("_p", F.shiftright(F.monotonically_increasing_id(), PIECE.bit_length() - 1))
    for by, fold in ((["_p"], first), (["_range"], later), ([], later)):
        if by == ["_range"]:  # the number of the partition
            out = out.withColumns({"_range": F.shiftright("_p", 33 - (PIECE.bit_length() - 1)), "_o": F.col("_p")})
        elif not by:
            out = out.withColumn("_o", F.col("_range"))
        listed = F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"), F.col("_v").alias("v"))))
        out = out.groupBy(*keys, *by).agg(fold(listed).alias("_v"))
    return out


def cogroup(streams: dict[str, DataFrame], key: str, aggregates: dict[str, Column]) -> DataFrame:
    """Several streams into one aggregate by key. Each of ``aggregates`` sees the column ``stream`` and that stream's columns.

    Streams are tagged, put together and aggregated in one shuffle; a key is there if any stream has it.
    """
    tagged = None
    for name, df in streams.items():
        df = df.dropna(subset=[key]).withColumn("stream", F.lit(name))
        tagged = df if tagged is None else tagged.unionByName(df, allowMissingColumns=True)
    return tagged.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])


def distinct_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in order."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.dropna(subset=[key]).groupBy(key).agg(F.min_by(whole, order).alias("_r")).select("_r.*")


def result_time(ts: str) -> Column:
    """Time of an aggregate: the highest of its records."""
    return F.max(ts)
