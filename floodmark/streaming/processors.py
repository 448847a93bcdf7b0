"""Processors with several states, timers and outputs.

A ``Processor`` names its states (a value, a list or a map, each with a time to live if need be) and its
outputs, and says what to do with each row and when a timer fires. Its rows come as one stream of tagged
structs; ``output`` gives the rows of one name. Timers have names, any number of them, and go by event
time (the watermark) or by the wall clock.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .buffers import deep


@dataclass(frozen=True)
class State:
    """``kind``: value, list or map; ``schema`` of the value or element, ``key`` that of a map's keys, as DDL."""

    kind: str
    schema: str
    key: str | None = None
    ttl_ms: int | None = None


class Value:
    """A state of one row, None if there is none."""

    def __init__(self, state):
        self._state = state

    def get(self) -> tuple | None:
        return deep(tuple(self._state.get())) if self._state.exists() else None

    def put(self, *row) -> None:
        self._state.update(row)

    def clear(self) -> None:
        self._state.clear()


class List:
    """A state of any number of rows in order."""

    def __init__(self, state):
        self._state = state

    def __iter__(self) -> Iterator[tuple]:
        return (deep(tuple(r)) for r in self._state.get()) if self._state.exists() else iter(())

    def append(self, *row) -> None:
        self._state.appendValue(row)

    def put(self, rows: list[tuple]) -> None:
        if rows:
            self._state.put(rows)
        else:
            self._state.clear()

    def clear(self) -> None:
        self._state.clear()


class Map:
    """A state of rows by key; a key is a tuple of one or more."""

    def __init__(self, state):
        self._state = state

    def get(self, *key) -> tuple | None:
        return deep(tuple(self._state.getValue(key))) if self._state.containsKey(key) else None

    def put(self, key: tuple, row: tuple) -> None:
        self._state.updateValue(key, row)

    def remove(self, *key) -> None:
        if self._state.containsKey(key):
            self._state.removeKey(key)

    def items(self) -> Iterator[tuple[tuple, tuple]]:
        return ((deep(tuple(k)), deep(tuple(v))) for k, v in self._state.iterator())

    def clear(self) -> None:
        self._state.clear()


class Context:
    """What a processor works with: ``context.name`` for each of its states, outputs, timers, and the times."""

    def __init__(self, states: dict, handle: StatefulProcessorHandle, timers: Map | None, outputs: dict[str, str]):
        self.__dict__.update(states)
        self._handle, self._timers, self._outputs, self._out = handle, timers, outputs, []
        self.now: int = -1
        self.watermark: int = -1

    def forward(self, name: str, /, **fields) -> None:
        """A row for one output."""
        if name not in self._outputs:
            raise ValueError(f"no output {name!r}")
        self._out.append(Row(output=name, **{n: fields if n == name else None for n in self._outputs}))

    def schedule(self, name: str, at_ms: int) -> None:
        """A timer; one of the same name and time is set once, those of other names or times stay."""
        names = (self._timers.get(at_ms) or ([],))[0]
        if name not in names:
            self._timers.put((at_ms,), ([*names, name],))
            if not names:
                self._handle.registerTimer(at_ms)

    def cancel(self, name: str, at_ms: int) -> None:
        names = [n for n in (self._timers.get(at_ms) or ([],))[0] if n != name]
        if names:
            self._timers.put((at_ms,), (names,))
        elif self._timers.get(at_ms) is not None:
            self._timers.remove(at_ms)
            self._handle.deleteTimer(at_ms)


class Processor:
    """Subclass with ``states``, ``outputs`` (DDL of each) and ``on_row``, and ``on_timer`` if it schedules any."""

    states: dict[str, State] = {}
    outputs: dict[str, str] = {}

    def on_row(self, context: Context, key: tuple, row: Row) -> None:
        raise NotImplementedError

    def on_timer(self, context: Context, key: tuple, name: str, at_ms: int) -> None:
        raise NotImplementedError


class _Running(StatefulProcessor):
    def __init__(self, processor: Processor, order: str | None, timers: bool):
        self.processor, self.order, self.timers = processor, order, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        made = {}
        for name, s in self.processor.states.items():
            if s.kind == "value":
                made[name] = Value(handle.getValueState(name, s.schema, s.ttl_ms))
            elif s.kind == "list":
                made[name] = List(handle.getListState(name, s.schema, s.ttl_ms))
            else:
                made[name] = Map(handle.getMapState(name, s.key, s.schema, s.ttl_ms))
        timers = Map(handle.getMapState("timer_names", "at long", "names array<string>")) if self.timers else None
        self.context = Context(made, handle, timers, self.processor.outputs)

    def _given(self, times) -> Iterator[Row]:
        out, self.context._out = self.context._out, []
        return iter(out)

    def _times(self, times) -> None:
        if self.timers:
            self.context.now, self.context.watermark = times.getCurrentProcessingTimeInMs(), times.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self._times(timerValues)
        for row in rows if self.order is None else sorted(rows, key=lambda r: r[self.order]):
            self.processor.on_row(self.context, tuple(key), row)
        return self._given(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._times(timerValues)
        at = int(expiredTimerInfo.getExpiryTimeInMs())
        names = (self.context._timers.get(at) or ([],))[0]
        self.context._timers.remove(at)
        for name in names:
            self.processor.on_timer(self.context, tuple(key), name, at)
        return self._given(timerValues)

    def close(self) -> None:
        pass


def process(stream: DataFrame, key: str | list[str], processor: Processor, order: str | None = None, clock: str | None = None) -> DataFrame:
    """All outputs of a processor, tagged: ``output`` and a struct for each of its outputs.

    Rows of a key in a micro-batch go by ``order``. ``clock`` is ``event`` (the stream needs a watermark) or
    ``wall`` for timers, None without any. States with a time to live need a wall clock.
    """
    mode = {None: "None", "event": "EventTime", "wall": "ProcessingTime"}[clock]
    schema = "output string, " + ", ".join(f"`{n}` struct<{ddl}>" for n, ddl in processor.outputs.items())
    keys = [key] if isinstance(key, str) else key
    return stream.groupBy(*keys).transformWithState(_Running(processor, order, clock is not None), schema, "append", mode)


def output(processed: DataFrame, name: str) -> DataFrame:
    """The rows of one output."""
    return processed.filter(processed["output"] == name).select(f"{name}.*")


def write_outputs(processed: DataFrame, put: dict, checkpoint: str):
    """Runs the processor once and gives each output's rows of a micro-batch to ``put[name](rows, batch_id)``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for name, to in put.items():
                to(output(held, name), batch_id)
        finally:
            held.unpersist()

    return processed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
