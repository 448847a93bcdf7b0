"""Running results over long groups, in blocks of their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], block: Column, results: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds running sums, maxima, minima and last values of each group in ``order``: ``results`` maps names to (kind, column).

    ``block`` has to grow with the order (such as its thousands, or the day of a time). Rows are sorted
    within their block only, and the small table of block totals carries what came before, so a hot group
    spreads over as many tasks as it has blocks. Nulls form a group and a block of their own; a result is
    null as long as no value was seen.
    """
    group = list(group)
    rows = df.withColumns({"_block": block, **{f"_v_{n}": c for n, (_, c) in results.items()}})
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order)))
    totals = rows.groupBy(*group, "_block").agg(*[(newest if k == "last" else _COMBINE[k])(f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in results.items()])
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({f"_t_{n}": _COMBINE[k](f"_t_{n}").over(before) for n, (k, _) in results.items()})
    totals = totals.select(*[F.col(c).alias(f"_g_{c}") for c in [*group, "_block"]], *[f"_t_{n}" for n in results])
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_v_{n}": _COMBINE[k](f"_v_{n}").over(inside) for n, (k, _) in results.items()})
    same = F.lit(True)
    for c in [*group, "_block"]:  # plain equality, where there are no nulls, needs no other shuffle than the window's
        here, there = F.col(c), F.col(f"_g_{c}")
        same = same & (here.eqNullSafe(there) if rows.schema[c].nullable else here == there)
    out = rows.join(totals, same, "left")
    done = {}
    for n, (k, _) in results.items():
        here, past = F.col(f"_v_{n}"), F.col(f"_t_{n}")
        done[n] = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest, "min": F.least, "last": F.coalesce}[k](here, past)
    return out.select(*[F.col(c) for c in df.columns if c not in done], *[c.alias(n) for n, c in done.items()])


def numbers(df: DataFrame, group: Sequence[str], order: Sequence[str], block: Column, name: str = "offset") -> DataFrame:
    """Adds gapless numbers from 0 within each group, in blocks as ``running`` does."""
    out = running(df, group, order, block, {name: ("sum", F.lit(1).cast("long"))})
    return out.withColumn(name, F.col(name) - 1)
