"""Tables: changelogs as latest values, change rows, and aggregates that follow updates.

A changelog has a key, a value and an order (arrival). A row whose ``value`` is null deletes its key; a
row with a null key is skipped. Arrival decides what is latest, not the timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running
from .aggregates import aggregate


def latest(changelog: DataFrame, key: str | list[str], order: str, deleted: Column | None = None, versioned_by: str | None = None) -> DataFrame:
    """The row of each key that arrived last, unless it deletes.

    One aggregation with partial maxima on the map side, so a hot key costs a row per task. With
    ``versioned_by`` the time column decides and ``order`` breaks ties: late updates are not latest.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.struct(versioned_by, order) if versioned_by else F.col(order)
    whole = F.struct(*[F.col(c) for c in changelog.columns])
    rows = changelog.dropna(subset=keys).groupBy(*keys).agg(F.max_by(whole, rank).alias("_row")).select("_row.*")
    return rows if deleted is None else rows.filter(~F.coalesce(deleted, F.lit(False)))


def stream_to_table(stream: DataFrame, key: str, order: str, value: str) -> DataFrame:
    return latest(stream, key, order, F.col(value).isNull())


def changes(changelog: DataFrame, key: str, value: str | list[str], order: str, deleted: Column | None = None) -> DataFrame:
    """Change rows: key, order, ``new`` and ``old`` structs (null where there is no value), is_latest.

    A delete of what isn't there is no change and left out.
    """
    values = [value] if isinstance(value, str) else value
    cell = F.struct(*[F.col(v) for v in values])
    gone = deleted if deleted is not None else F.col(values[0]).isNull()
    by = Window.partitionBy(key).orderBy(order)
    rows = changelog.dropna(subset=[key]).withColumn("new", F.when(~F.coalesce(gone, F.lit(False)), cell))
    rows = rows.withColumn("old", F.lag("new").over(by)).withColumn("is_latest", F.lead(F.lit(1)).over(by).isNull())
    return rows.filter(F.col("new").isNotNull() | F.col("old").isNotNull()).select(key, order, "new", "old", "is_latest")


def filter_table(change_rows: DataFrame, predicate) -> DataFrame:
    """A failing row becomes a delete; ``predicate`` maps a cell to a boolean. No-op deletes are dropped."""
    keep = lambda c: F.when(F.coalesce(predicate(F.col(c)), F.lit(False)), F.col(c))
    out = change_rows.withColumns({"new": keep("new"), "old": keep("old")})
    return out.filter(F.col("new").isNotNull() | F.col("old").isNotNull())


def map_table(change_rows: DataFrame, mapper) -> DataFrame:
    """``mapper`` on both sides of a change; deletes stay deletes."""
    on = lambda c: F.when(F.col(c).isNotNull(), mapper(F.col(c)))
    return change_rows.withColumns({"new": on("new"), "old": on("old")})


def to_stream(change_rows: DataFrame, key: Column | None = None, name: str = "key") -> DataFrame:
    """The new side of each change as ``value``; a delete is a row with a null value.

    ``key`` makes a new key ``name`` of each row, from its old key and ``value``.
    """
    rows = change_rows.withColumnRenamed("new", "value").drop("old", "is_latest")
    return rows if key is None else rows.withColumn(name, key)


def regroup(change_rows: DataFrame, group) -> DataFrame:
    """Signed rows (group, cell, sign): the old value leaves its group, then the new one joins its own.

    ``group`` maps a cell to a group key; cells without one are skipped. An update within one group is
    one remove and one add in the same row order.
    """
    side = lambda c, sign: F.when(F.col(c).isNotNull(), F.struct(group(F.col(c)).alias("group"), F.col(c).alias("cell"), F.lit(sign).alias("sign")))
    pairs = F.filter(F.array(side("old", -1), side("new", 1)), lambda x: x.isNotNull() & x["group"].isNotNull())
    return change_rows.withColumn("_s", F.explode(pairs)).select("_s.*", *[c for c in change_rows.columns if c not in ("new", "old", "is_latest")])


def count_table(signed: DataFrame) -> DataFrame:
    """Rows in each group now; a group that has emptied has count 0."""
    return signed.groupBy("group").agg(F.sum("sign").cast("long").alias("count"))


def sum_table(signed: DataFrame, field: str) -> DataFrame:
    """Adder and subtractor for sums: what joins is added, what leaves subtracted; with the ``count`` of rows now in the group."""
    return signed.groupBy("group").agg(F.sum(F.col("sign") * F.col(f"cell.{field}")).alias("sum"), F.sum("sign").cast("long").alias("count"))


def aggregate_table(signed: DataFrame, order: str, initial: Column, adder, subtractor, merger=None) -> DataFrame:
    """A fold over a changing table: ``adder(a, cell)`` for what joins a group, ``subtractor(a, cell)`` for what leaves.

    Changes go by ``order``, subtractions first. ``merger`` as in ``aggregates.aggregate``.
    """
    rows = signed.withColumns({"_at": F.struct(order, "sign"), "_change": F.struct("cell", "sign")})
    step = lambda a, x: F.when(x["sign"] < 0, subtractor(a, x["cell"])).otherwise(adder(a, x["cell"]))
    return aggregate(rows, "group", "_change", initial, step, "_at", merger)


def running_sum(signed: DataFrame, field: str, order: str, block: Column) -> DataFrame:
    """``count`` and ``sum`` of a field of the group after each change, block by block."""
    value = F.col("sign") * F.col(f"cell.{field}")
    return running(signed, ["group"], [order, "sign"], block, {"count": ("sum", F.col("sign")), "sum": ("sum", value)})


def running_count(signed: DataFrame, order: str, block: Column | None = None) -> DataFrame:
    """The count of the group after each change, subtractions before additions; block by block if ``block`` is given."""
    if block is not None:
        return running(signed, ["group"], [order, "sign"], block, {"count": ("sum", F.col("sign"))})
    so_far = Window.partitionBy("group").orderBy(order, "sign").rowsBetween(Window.unboundedPreceding, 0)
    return signed.withColumn("count", F.sum("sign").over(so_far))
