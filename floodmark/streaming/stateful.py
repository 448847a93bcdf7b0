"""Stateful processors for Structured Streaming, where built-in operators can't say it.

Each runs by ``groupBy(key).transformWithStateInPandas``: state lies in the state store, keyed and
checkpointed by Spark. Timers go by event time (the watermark) or by the wall clock.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions import files
from ..sources.keyed_tables import KeyedTable


class FunctionProcessor(StatefulProcessor):
    """State of one row and a function: ``step(key, state or None, rows) -> (state or None, output rows)``.

    A state of None clears it. Output rows may be of any number, with any key.
    """

    def __init__(self, step: Callable, state_schema: str, on_timer: Callable | None = None, timer_at: Callable | None = None):
        self.step, self.state_schema, self.on_timer, self.timer_at = step, state_schema, on_timer, timer_at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)

    def _keep(self, state: tuple | None) -> None:
        if state is None:
            self.state.clear()
        else:
            self.state.update(state)
        if self.timer_at is not None:  # one timer at most: that of the state as it is now
            at = None if state is None else self.timer_at(state)
            held = [int(t) for t in self.handle.listTimers()]
            for t in held:
                if at is None or t != int(at):
                    self.handle.deleteTimer(t)
            if at is not None and int(at) not in held:
                self.handle.registerTimer(int(at))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else None
        batch = pd.concat(list(rows), ignore_index=True)
        state, out = self.step(key, state, batch)
        self._keep(state)
        if out is not None and len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.on_timer is not None and self.state.exists():
            state, out = self.on_timer(key, tuple(self.state.get()))
            self._keep(state)
            if out is not None and len(out):
                yield out

    def close(self) -> None:
        pass


def process(stream: DataFrame, key: str, step: Callable, state_schema: str, output: str | StructType, output_mode: str = "append", time_mode: str = "None", on_timer: Callable | None = None, timer_at: Callable | None = None) -> DataFrame:
    """The generic stateful operator. ``time_mode``: None, ProcessingTime or EventTime (for timers, times in ms)."""
    return stream.groupBy(key).transformWithStateInPandas(FunctionProcessor(step, state_schema, on_timer, timer_at), output, output_mode, time_mode)


def process_values(stream: DataFrame, key: str, step: Callable, state_schema: str, output: str, output_mode: str = "append", **timers) -> DataFrame:
    """As ``process``, but rows stay under their key: ``step`` gives rows of ``output`` (DDL) without it, and can't change it."""
    kind = stream.schema[key].dataType.simpleString()

    def keyed(k, state, rows):
        state, out = step(k, state, rows)
        if out is not None and len(out):
            if key in out:
                raise ValueError(f"{key} is the key and can't be set")
            out = out.copy()
            out.insert(0, key, k[0])
        return state, out

    return process(stream, key, keyed, state_schema, f"`{key}` {kind}, {output}", output_mode, **timers)


def with_global_state(stream: DataFrame, table: KeyedTable, put: Callable[[DataFrame, DataFrame, int], None], checkpoint: str, **options):
    """Micro-batches with a table that all tasks share: ``put(batch, table, batch_id)`` gets one version of it.

    The version that a batch sees first is written down under its id beside the checkpoint, so a batch that
    is run again after a failure sees the same rows, whatever other queries have written to the table since.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        pin, spark = f"{checkpoint.rstrip('/')}/pinned/{batch_id}", batch.sparkSession
        files.write_new(spark, pin, str(table.version()))  # the first try decides
        put(batch, table.read(int(files.read_text(spark, pin))), batch_id)

    return stream.writeStream.foreachBatch(each).options(**options).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_by_key(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key ever seen."""

    def step(_, state, rows):
        return (state, None) if state else ((True,), rows.sort_values(order).head(1))

    return process(stream, key, step, "seen boolean", stream.schema)


def arrival_join(tagged: DataFrame, key: str, order: str, side: str, value: str, how: str = "inner") -> DataFrame:
    """Stream-table join by arrival on a tagged stream: ``side`` is ``table`` or ``stream``.

    Table rows set the key's value (null deletes); stream rows come out with it as ``table_value``.
    Within a micro-batch rows go by ``order``, table rows first.
    """
    kind = tagged.schema[value].dataType.simpleString()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema if f.name != side)

    def step(_, state, rows):
        held, out = (state[0] if state else None), []
        rows = rows.assign(_s=(rows[side] == "stream")).sort_values([order, "_s"], kind="stable")
        for r in rows.to_dict("records"):
            if r[side] == "table":
                held = None if pd.isna(r[value]) else r[value]
            elif held is not None or how == "left":
                out.append({k: v for k, v in r.items() if k not in (side, "_s")} | {"table_value": held})
        return (None if held is None else (held,)), pd.DataFrame(out)

    return process(tagged, key, step, f"held {kind}", f"{fields}, table_value {kind}")
