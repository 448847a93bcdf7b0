"""Joins of streams and tables.

Stream rows have a key, a time and an arrival order; table rows are changelogs with the same. Inner and
stream-table joins drop null keys; left and outer joins keep a left row without a key and pad it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running
from . import tables

#: Global tables are broadcast up to so many bytes by the optimiser's estimate, or else as JSON text; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: From here on an estimate says no more than that nothing is known.
UNKNOWN_BYTES = 1 << 60


def size_in_bytes(df: DataFrame) -> int:
    """The optimiser's estimate, which costs no job; only where it knows nothing the rows are measured as JSON text."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < UNKNOWN_BYTES:
        return estimate
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, before_ms: int, after_ms: int, how: str = "inner", bucketed: bool = True) -> DataFrame:
    """Pairs of equal key whose right time is in [left time - before, left time + after], both ends included.

    Columns come back as ``l_*`` and ``r_*`` with ``result_ts``, the later of both times. ``how``:
    inner, left, full_outer. In a batch the times are cut into buckets as wide as the window that join
    by equality with the key, so a hot key is spread over its buckets. A left row lies in one bucket and a
    right row in up to two, so each pair comes once and a left join pads by itself; a full join adds the
    right rows that meet none. On streams
    (pass ``bucketed=False``, watermarks on both sides) Spark keeps state for the interval.
    """
    if before_ms + after_ms < 0:
        raise ValueError("the window is empty: before + after < 0")
    l, r = _renamed(left, "l_"), _renamed(right, "r_")  # noqa: E741
    lt, rt = F.col(f"l_{ts}"), F.col(f"r_{ts}")
    low, high = lt - _ms(before_ms), lt + _ms(after_ms)
    on = (F.col(f"l_{key}") == F.col(f"r_{key}")) & (rt >= low) & (rt <= high)
    if bucketed:
        width = before_ms + after_ms + 1
        at = lambda c, shift: F.floor((F.unix_micros(c.cast("timestamp")) + 1000 * shift) / (1000 * width))
        home = lambda df, c: df.withColumn(f"{c}_b", at(F.col(f"{c}_{ts}"), 0))
        near = lambda df, c, low, high: df.withColumn(f"{c}_b", F.explode_outer(F.array_distinct(F.array(at(F.col(f"{c}_{ts}"), low), at(F.col(f"{c}_{ts}"), high)))))
        on = on & (F.col("l_b") == F.col("r_b"))
        out = home(l, "l").join(near(r, "r", -after_ms, before_ms), on, "inner" if how == "inner" else "left_outer").drop("l_b", "r_b")
        if how == "full_outer":
            lone = home(r, "r").join(near(l, "l", -before_ms, after_ms), on, "left_anti").drop("r_b")
            out = out.unionByName(lone, allowMissingColumns=True)
    else:
        out = l.join(r, on, {"full_outer": "full_outer", "left": "left_outer"}.get(how, how))
    return out.withColumn("result_ts", F.greatest(f"l_{ts}", f"r_{ts}"))


def _ms(n: int) -> Column:
    return F.expr(f"interval {abs(n)} milliseconds") if n >= 0 else F.expr(f"interval -{abs(n)} milliseconds")


def self_join(stream: DataFrame, key: str, ts: str, before_ms: int, after_ms: int) -> DataFrame:
    """All pairs within the window in both roles, each record with itself included."""
    return window_join(stream, stream, key, ts, before_ms, after_ms)


def stream_table_join(stream: DataFrame, table: DataFrame, key: str, order: str, values: list[str], deleted: Column | None = None, how: str = "inner", asof: str | None = None, block: Column | None = None) -> DataFrame:
    """Each stream row with the table's value when it arrived; table updates trigger nothing.

    ``order`` is arrival, common to both sides; a table row of the same order comes first. With ``asof``,
    a time column, the lookup goes by time in place of arrival: the version valid at the stream row's own
    time, a table row of equal time included. Values come back as ``t_*``; the row keeps its own time.
    One shuffle of the union by key, sorted, with the last value carried along; with ``block``, which is made
    of ``order`` (or ``asof``) and grows with it, a hot key is worked on block by block.
    """
    by = [asof] if asof else [order]
    cell = F.struct(*[F.col(v).alias(f"t_{v}") for v in values])
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    kinds = stream.schema
    t = table.dropna(subset=[key]).select(F.col(key), *[F.col(c).cast(kinds[c].dataType) for c in by], F.col(order).alias("_o"), F.lit(0).alias("_side"), F.struct(F.when(~gone, cell).alias("cell")).alias("_cell"))
    s = stream.select(F.col(key), *by, F.col(order).alias("_o"), F.lit(1).alias("_side"), F.struct(*stream.columns).alias("_row"))
    keyed = s.filter(F.col(key).isNotNull()).unionByName(t, allowMissingColumns=True)
    if block is not None:
        found = running(keyed, [key], [*by, "_side", "_o"], block, {"_found": ("last", F.col("_cell"))})
    else:
        carried = F.last("_cell", ignorenulls=True).over(Window.partitionBy(key).orderBy(*by, "_side", "_o").rowsBetween(Window.unboundedPreceding, 0))
        found = keyed.withColumn("_found", carried)
    out = found.filter("_side = 1").select("_row.*", F.col("_found.cell").alias("_c"))
    if how == "inner":
        out = out.filter(F.col("_c").isNotNull())
    else:
        out = out.unionByName(stream.filter(F.col(key).isNull()), allowMissingColumns=True)
    return out.select(*stream.columns, *[F.col(f"_c.t_{v}").alias(f"t_{v}") for v in values])


def versioned_join(stream: DataFrame, versions: DataFrame, key: str, ts: str, values: list[str], how: str = "inner") -> DataFrame:
    """As-of join with validity intervals (``history.versions``): the version that holds at the stream row's time."""
    v = versions.select(F.col(key).alias("_k"), "valid_from", "valid_to", *[F.col(x).alias(f"t_{x}") for x in values])
    on = (F.col(key) == F.col("_k")) & (F.col(ts) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(ts) < F.col("valid_to")))
    return stream.join(v, on, {"left": "left_outer"}.get(how, how)).drop("_k", "valid_from", "valid_to")


def global_join(stream: DataFrame, table: DataFrame, mapped: Column, table_key: str, values: list[str], how: str = "inner") -> DataFrame:
    """Stream rows with a fully replicated table by a key mapped from the row; a null mapped key is dropped or padded.

    Up to ``BROADCAST_BYTES`` (``size_in_bytes``) the table is broadcast, beyond it the join shuffles.
    """
    t = table.select(F.col(table_key).alias("_gk"), *[F.col(v).alias(f"t_{v}") for v in values])
    if size_in_bytes(t) <= BROADCAST_BYTES:
        t = F.broadcast(t)
    return stream.join(t, mapped == F.col("_gk"), {"left": "left_outer"}.get(how, how)).drop("_gk")


def table_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", ts: str | None = None) -> DataFrame:
    """Tables (latest rows) by primary key: inner, left, right or full_outer, with ``result_ts``, the later time.

    A key deleted on one side has no row there, so its results vanish or are padded.
    """
    l, r = _renamed(left, "l_"), _renamed(right, "r_")  # noqa: E741
    out = l.join(r, F.col(f"l_{key}") == F.col(f"r_{key}"), {"left": "left_outer", "right": "right_outer"}.get(how, how))
    out = out.withColumn(key, F.coalesce(f"l_{key}", f"r_{key}"))
    return out.withColumn("result_ts", F.greatest(f"l_{ts}", f"r_{ts}")) if ts else out


def foreign_key_join(left: DataFrame, right: DataFrame, foreign: Column, right_key: str, values: list[str], how: str = "inner") -> DataFrame:
    """Table rows with the row of the other table that their foreign key names; values come back as ``t_*``.

    Both sides are snapshots, so no stale answer can appear. A null foreign key gives no row, or a padded
    one for a left join.
    """
    r = right.select(F.col(right_key).alias("_fk"), *[F.col(v).alias(f"t_{v}") for v in values])
    return left.join(r, foreign == F.col("_fk"), {"left": "left_outer"}.get(how, how)).drop("_fk")


def foreign_key_changes(change_rows: DataFrame, foreign, how: str = "inner") -> DataFrame:
    """What an update does to the subscription at the other table: (fk, action) rows per change.

    The old key gets ``delete``, or ``delete_and_propagate_null`` for left joins whose new key is null;
    the new key gets ``subscribe``. An unchanged key only subscribes again.
    """
    old, new = foreign(F.col("old")), foreign(F.col("new"))
    lost = F.when(old.isNotNull() & ~old.eqNullSafe(new), F.struct(old.alias("fk"), F.when(F.lit(how == "left") & new.isNull(), "delete_and_propagate_null").otherwise("delete").alias("action")))
    won = F.when(new.isNotNull(), F.struct(new.alias("fk"), F.lit("subscribe").alias("action")))
    rows = change_rows.withColumn("_a", F.explode(F.filter(F.array(lost, won), lambda x: x.isNotNull())))
    return rows.select(*[c for c in change_rows.columns if c not in ("new", "old", "is_latest")], "_a.*")


def joined_value(pairs: DataFrame, joiner: Callable[[Column, Column, Column], Column], key: str, left: str, right: str, name: str = "value") -> DataFrame:
    """The result of a join as one value: ``joiner(key, left, right)`` over its rows. The key is there to read and stays."""
    if name == key:
        raise ValueError("a joiner can't replace the key")
    return pairs.withColumn(name, joiner(F.col(key), F.col(left), F.col(right)))


def versioned_table_join(left: DataFrame, right: DataFrame, key: str, ts: str, order: str, how: str = "inner", deleted_left: Column | None = None, deleted_right: Column | None = None) -> DataFrame:
    """Changelogs of versioned tables by primary key: updates that come out of order change no result."""
    return table_join(latest_by_time(left, key, ts, order, deleted_left), latest_by_time(right, key, ts, order, deleted_right), key, how, ts)


def latest_by_time(changelog: DataFrame, key: str, ts: str, order: str, deleted: Column | None = None) -> DataFrame:
    """The latest view that out-of-order updates don't move: time decides, arrival breaks ties."""
    return tables.latest(changelog, key, order, deleted, versioned_by=ts)
