"""Functions handed to operators: predicates, mappers, reducers and joiners as column expressions.

Prefer these to Python callables: they stay in generated code. ``vectorised`` wraps a function over
pandas series for what expressions can't say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add(a: Column, x: Column) -> Column:
    return a + x


def larger(a: Column, x: Column) -> Column:
    return F.greatest(a, x)


def smaller(a: Column, x: Column) -> Column:
    return F.least(a, x)


def append(a: Column, x: Column) -> Column:
    """For folds over arrays: the element at the end."""
    return F.concat(a, F.array(x))


def union(a: Column, x: Column) -> Column:
    return F.array_union(a, x)


def difference(a: Column, x: Column) -> Column:
    return F.array_except(a, x)


def concatenated(separator: str) -> Callable[[Column, Column], Column]:
    """Joiner: both values as text; a missing one is ``null``."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return lambda a, b: F.concat(text(a), F.lit(separator), text(b))


def vectorised(function: Callable, returns: str):
    """A mapper or predicate over pandas series, by Arrow batches."""
    return F.pandas_udf(function, returns)


def transform_values(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """A transformer over Arrow batches as pandas frames that keeps the keys' partitioning."""
    return df.mapInPandas(lambda batches: (function(b) for b in batches), schema)
