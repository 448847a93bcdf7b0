"""Foreign-key joins of changing tables, kept up to date on streams.

A left row subscribes at the right row that its foreign key names, and takes its subscription back when
the key changes; the right side answers each subscriber when it changes itself, and each new one at once.
An answer carries the number of the left row's version that it is for and is dropped if there is a newer one.
Three stateful steps, each keyed: by left key, by foreign key, by left key. What a step has to tell the
last one goes through the middle one under a route of its own, so no stream is read twice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .buffers import deep


class _Subscribe(StatefulProcessor):
    """By left key: what a change means to the right side, and a note of the newest version."""

    def __init__(self, foreign_kind: str):
        self.kind = foreign_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", f"foreign_key {self.kind}, version long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old, version = tuple(self.last.get()) if self.last.exists() else (None, 0)
        row = max(rows, key=lambda r: r["arrived"])  # what came before it in this batch is out of date already
        gone, new = row["gone"], None if row["gone"] else row["foreign_key"]
        version += 1
        message = lambda route, action: Row(route=route, action=action, pk=row["pk"], version=version, cell=None if gone else row["cell"], other=None, arrived=None)
        if old is not None and old != new:
            yield message(f"f{old}", "leave")
        yield message(f"p{key[0]}", "deleted" if gone else "unkeyed" if new is None else "changed")
        if new is not None:
            yield message(f"f{new}", "subscribe")
        self.last.update((new, version))  # kept for a deleted key too, so that its versions go on

    def close(self) -> None:
        pass


class _Answer(StatefulProcessor):
    """By foreign key: the right row, its subscribers, and answers to them. Notes pass through."""

    def __init__(self, pk_kind: str, cell: tuple[str, list[str]], other: tuple[str, list[str]]):
        self.pk_kind, self.cell, self.other = pk_kind, cell, other

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.right = handle.getValueState("right", f"other {self.other[0]}")
        self.subscribers = handle.getMapState("subscribers", f"pk {self.pk_kind}", f"version long, cell {self.cell[0]}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        if key[0].startswith("p"):
            yield from (Row(pk=r["pk"], action=r["action"], version=r["version"], cell=r["cell"], other=None) for r in rows)
            return
        answers: dict = {}
        changes = [r for r in rows if r["action"] in ("right", "right_gone")]
        if changes:
            last = max(changes, key=lambda r: r["arrived"])
            if last["action"] == "right":
                self.right.update((deep(last["other"]),))
            else:
                self.right.clear()
        for r in sorted((r for r in rows if r["action"] in ("leave", "subscribe")), key=lambda r: r["version"]):
            if r["action"] == "leave":
                if self.subscribers.containsKey((r["pk"],)):
                    self.subscribers.removeKey((r["pk"],))
                answers.pop(r["pk"], None)
            else:
                answers[r["pk"]] = (r["version"], deep(r["cell"]))
                self.subscribers.updateValue((r["pk"],), answers[r["pk"]])
        if changes:  # all of them, else the new ones
            answers = {k[0]: deep(v) for k, v in self.subscribers.iterator()}
        found = dict(zip(self.other[1], deep(self.right.get())[0], strict=True)) if self.right.exists() else None
        for pk, (version, cell) in answers.items():
            yield Row(pk=pk, action="answer", version=version, cell=dict(zip(self.cell[1], cell, strict=True)), other=found)

    def close(self) -> None:
        pass


class _Result(StatefulProcessor):
    """By left key: answers to the newest version become results, and results that no longer hold are deleted."""

    def __init__(self, key_name: str, left: bool, cell_names: list[str], other_names: list[str]):
        self.key_name, self.left, self.cell_names, self.other_names = key_name, left, cell_names, other_names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "version long, shown boolean")

    def _row(self, pk, cell: dict | None, other: dict | None) -> Row:
        cell, other = cell or {}, other or {}
        return Row(**{self.key_name: pk, "deleted": not cell}, **{f"l_{n}": cell.get(n) for n in self.cell_names}, **{f"t_{n}": other.get(n) for n in self.other_names})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        version, shown = tuple(self.state.get()) if self.state.exists() else (0, False)
        result = None
        for r in sorted(rows, key=lambda r: (r["version"], r["action"] == "answer")):
            if r["version"] < version:
                continue  # an answer to what has changed since
            version = r["version"]
            if r["action"] == "deleted" or r["action"] == "unkeyed" and not self.left or r["action"] == "answer" and r["other"] is None and not self.left:
                result = (None, None)
            elif r["action"] != "changed":
                result = (r["cell"], r["other"])
        if result is not None and (result[0] is not None or shown):
            shown = result[0] is not None
            yield self._row(key[0], *result)
        self.state.update((version, shown))

    def close(self) -> None:
        pass


def foreign_key_join(
    left: DataFrame, right: DataFrame, key: str, foreign: Column, right_key: str, order: str, left_values: list[str], right_values: list[str], how: str = "inner",
    deleted_left: Column | None = None, deleted_right: Column | None = None,
) -> DataFrame:
    """Changes of a foreign-key join of two changelogs on streams: ``key``, deleted, ``l_*`` and ``t_*``.

    Of changes in one micro-batch the last by ``order`` counts, so after each batch the latest row of each
    key is what the join of both tables' latest rows has. A row that is no longer in the join comes as
    ``deleted``, if it was in it before. A left row without a foreign key is padded in a left join. Null keys are dropped.
    """
    flag = lambda d: F.coalesce(d, F.lit(False)) if d is not None else F.lit(False)
    rows = left.dropna(subset=[key]).select(F.col(key).alias("pk"), F.col(order).alias("arrived"), flag(deleted_left).alias("gone"), foreign.alias("foreign_key"), F.struct(*left_values).alias("cell"))
    others = right.dropna(subset=[right_key]).select(
        F.concat(F.lit("f"), F.col(right_key).cast("string")).alias("route"), F.when(flag(deleted_right), "right_gone").otherwise("right").alias("action"), F.col(order).alias("arrived"), F.struct(*right_values).alias("other")
    )
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    pk, cell, other, at = kind(rows, "pk"), kind(rows, "cell"), kind(others, "other"), kind(rows, "arrived")
    messages = rows.groupBy("pk").transformWithState(_Subscribe(kind(rows, "foreign_key")), f"route string, action string, pk {pk}, version long, cell {cell}, other {other}, arrived {at}", "append", "None")
    answers = messages.unionByName(others, allowMissingColumns=True).groupBy("route").transformWithState(
        _Answer(pk, (cell, left_values), (other, right_values)), f"pk {pk}, action string, version long, cell {cell}, other {other}", "append", "None"
    )
    fields = [(f"l_{f.name}", f) for f in rows.schema["cell"].dataType] + [(f"t_{f.name}", f) for f in others.schema["other"].dataType]
    schema = f"`{key}` {pk}, deleted boolean, " + ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in fields)
    return answers.groupBy("pk").transformWithState(_Result(key, how == "left", left_values, right_values), schema, "append", "None")
