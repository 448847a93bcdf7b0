"""Operators that hold rows back, in a buffer ordered by time for each partition of a stream.

A partition is a group of its own, as in a log: it has its stream time, the highest time it has seen, and
one buffer over all its keys. Rows go in order of arrival, one by one, so limits hold after every row and
not only between micro-batches. The buffer lies in map state by slots of time, of which only those that a
micro-batch touches are read, so its cost follows the batch and not the buffer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import epoch_millis


class BufferFull(RuntimeError):
    """A buffer that has to stay within its limits, and may not give rows early, has met them."""


def deep(value):
    """Rows and state as plain tuples and lists, which can be written to state as they are."""
    if isinstance(value, dict):
        return tuple(map(deep, value.values()))
    if isinstance(value, tuple):
        return tuple(map(deep, value))
    return list(map(deep, value)) if isinstance(value, list) else value


class TimeSlots:
    """Entries (time, tie), the lowest first, over a map state from slot to entries."""

    def __init__(self, state, width: int, slots: list[int]):
        self.state, self.width = state, max(1, width)
        self.slots = list(slots)
        heapq.heapify(self.slots)
        self.known, self.open, self.changed = set(self.slots), {}, set()

    def _entries(self, slot: int) -> list[tuple]:
        if slot not in self.open:
            held = self.state.getValue((slot,)) if slot in self.known else None
            entries = deep(held)[0] if held is not None else []
            heapq.heapify(entries)
            self.open[slot] = entries
        return self.open[slot]

    def add(self, time: int, tie) -> None:
        slot = time // self.width
        heapq.heappush(self._entries(slot), (time, tie))
        if slot not in self.known:
            self.known.add(slot)
            heapq.heappush(self.slots, slot)
        self.changed.add(slot)

    def first(self) -> tuple | None:
        while self.slots:
            entries = self._entries(self.slots[0])
            if entries:
                return entries[0]
            slot = heapq.heappop(self.slots)
            self.known.discard(slot)
            self.changed.add(slot)
        return None

    def pop(self) -> tuple:
        self.first()
        slot = self.slots[0]
        self.changed.add(slot)
        return heapq.heappop(self._entries(slot))

    def save(self) -> list[int]:
        """Write what has changed; the slots that are left."""
        for slot in self.changed:
            entries = self.open.get(slot)
            if entries:
                self.state.updateValue((slot,), (entries,))
            elif self.state.containsKey((slot,)):
                self.state.removeKey((slot,))
        return sorted(s for s in self.known if s not in self.open or self.open[s])


class _Cached:
    """A map state by key of which a micro-batch reads each entry once and writes it once."""

    def __init__(self, state):
        self.state, self.seen, self.changed = state, {}, set()

    def get(self, key) -> tuple | None:
        if key not in self.seen:
            found = self.state.getValue((key,)) if self.state.containsKey((key,)) else None
            self.seen[key] = None if found is None else deep(found)
        return self.seen[key]

    def put(self, key, value: tuple | None) -> None:
        self.seen[key] = value
        self.changed.add(key)

    def save(self) -> None:
        for key in self.changed:
            if self.seen[key] is not None:
                self.state.updateValue((key,), self.seen[key])
            elif self.state.containsKey((key,)):
                self.state.removeKey((key,))


class SuppressProcessor(StatefulProcessor):
    def __init__(self, key_kind: str, value_kind: str, limit_ms: int, max_records: int | None, max_bytes: int | None, when_full: str, drop_tombstones: bool):
        self.kinds, self.limit, self.drop_tombstones = (key_kind, value_kind), limit_ms, drop_tombstones
        self.most = (max_records if max_records is not None else float("inf"), max_bytes if max_bytes is not None else float("inf"))
        self.shut_down = when_full == "shut_down"

    def init(self, handle: StatefulProcessorHandle) -> None:
        key, value = self.kinds
        self.totals = handle.getValueState("totals", "stream_time long, records long, bytes long, slots array<long>")
        self.held = handle.getMapState("held", f"k {key}", f"time long, ts long, size long, value {value}")
        self.slots = handle.getMapState("slots", "slot long", f"entries array<struct<time: long, k: {key}>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stream_time, records, size, slots = tuple(self.totals.get()) if self.totals.exists() else (None, 0, 0, [])
        held, order, out = _Cached(self.held), TimeSlots(self.slots, self.limit // 16, slots), []

        def evict() -> None:
            nonlocal records, size
            _, k = order.pop()
            _, ts, bytes_, value = held.get(k)
            held.put(k, None)
            records, size = records - 1, size - bytes_
            if value is not None or not self.drop_tombstones:
                out.append((k, ts, value))

        for k, ts, time, bytes_, value in _arrivals(rows, ("b_key", "b_ts", "b_time", "b_size", "b_value")):
            stream_time = ts if stream_time is None else max(stream_time, ts)
            before = held.get(k)
            if before is None:
                order.add(time, k)
                records, size = records + 1, size + bytes_
                held.put(k, (time, ts, bytes_, value))
            else:  # an update takes the place of the one that is held
                size += bytes_ - before[2]
                held.put(k, (before[0], ts, bytes_, value))
            while (first := order.first()) is not None and first[0] <= stream_time - self.limit:
                evict()
            while records > self.most[0] or size > self.most[1]:
                if self.shut_down:
                    raise BufferFull(f"the buffer of partition {key[0]} holds {records} records and {size} bytes")
                evict()
        held.save()
        self.totals.update((stream_time, records, size, order.save()))
        yield from (Row(key=k, ts_ms=ts, value=v) for k, ts, v in out)

    def close(self) -> None:
        pass


def _arrivals(rows: Iterator[Row], columns: tuple[str, ...]) -> list[tuple]:
    """The rows of a group in order of arrival; Spark hands them on in any order."""
    return [tuple(r[c] for c in columns) for r in sorted(rows, key=lambda r: r["b_order"])]


def _partitioned(partition: Column | None, key: Column, partitions: int) -> Column:
    return (partition if partition is not None else F.pmod(F.xxhash64(key), F.lit(partitions))).cast("long").alias("b_partition")


def suppress(
    updates: DataFrame, key: str, ts: str, value: str, order: str, limit_ms: int, time: Column | None = None, partition: Column | None = None, partitions: int = 32,
    max_records: int | None = None, max_bytes: int | None = None, size: Column | None = None, when_full: str = "emit", drop_tombstones: bool = False,
) -> DataFrame:
    """Holds back updates of a table: key, ts_ms, value of each key's last one, once stream time is ``limit_ms`` past its time in the buffer.

    That time is the ``ts`` of the first update held, or ``time`` (such as a window's end, with the grace
    period for a limit: final results). A key takes one place, whatever its updates. ``max_records`` and
    ``max_bytes`` (of ``size``, by default the bytes of key and value as text) bound the buffer of each
    partition: beyond them the oldest go out early (``emit``), ties by key, or the query ends with ``BufferFull``
    (``shut_down``). A null value is a delete, handed on unless ``drop_tombstones``. Null keys are dropped.
    ``partition`` says which rows share a stream time and a buffer; by default the key's hash does.
    """
    if when_full not in ("emit", "shut_down"):
        raise ValueError(f"no such policy: {when_full}")
    kinds = [updates.schema[c].dataType.simpleString() for c in (key, value)]
    text = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    at = epoch_millis(F.col(ts))
    rows = updates.dropna(subset=[key, ts]).select(
        _partitioned(partition, F.col(key), partitions), F.col(order).alias("b_order"), F.col(key).alias("b_key"), at.alias("b_ts"),
        (epoch_millis(time) if time is not None else at).alias("b_time"), (size if size is not None else text(key) + text(value)).cast("long").alias("b_size"), F.col(value).alias("b_value"),
    )
    processor = SuppressProcessor(*kinds, limit_ms, max_records, max_bytes, when_full, drop_tombstones)
    out = rows.groupBy("b_partition").transformWithState(processor, f"key {kinds[0]}, ts_ms long, value {kinds[1]}", "append", "None")
    return out.select(F.col("key").alias(key), "ts_ms", F.col("value").alias(value))


class GraceJoinProcessor(StatefulProcessor):
    def __init__(self, key_kind: str, row_kind: str, value_kind: str, names: tuple[list[str], list[str]], grace_ms: int, retention_ms: int, left: bool):
        self.kinds, self.names, self.grace, self.retention, self.left = (key_kind, row_kind, value_kind), names, grace_ms, retention_ms, left

    def init(self, handle: StatefulProcessorHandle) -> None:
        key, row, value = self.kinds
        self.totals = handle.getValueState("totals", "stream_time long, table_time long, number long, slots array<long>")
        self.versions = handle.getMapState("versions", f"k {key}", f"held array<struct<at: long, gone: boolean, value: {value}>>")
        self.rows = handle.getMapState("rows", "n long", f"k {key}, at long, row {row}")
        self.slots = handle.getMapState("slots", "slot long", "entries array<struct<time: long, n: long>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stream_time, table_time, number, slots = tuple(self.totals.get()) if self.totals.exists() else (None, None, 0, [])
        versions, waiting, order, out = _Cached(self.versions), _Cached(self.rows), TimeSlots(self.slots, self.grace // 16, slots), []

        def join(k, at: int, row: tuple) -> None:
            held = versions.get(k)
            valid = [v for v in held[0] if v[0] <= at] if held is not None else []
            found = None if not valid or valid[-1][1] else valid[-1][2]
            if found is not None or self.left:
                out.append((*row, *(found if found is not None else [None] * len(self.names[1]))))

        for side, k, at, gone, row, value in _arrivals(rows, ("b_table", "b_key", "b_ts", "b_gone", "b_row", "b_value")):
            if side:
                table_time = at if table_time is None else max(table_time, at)
                if at < table_time - self.retention:
                    continue
                held = versions.get(k)
                kept = [v for v in held[0] if v[0] != at] if held is not None else []
                kept = sorted([*kept, (at, bool(gone), None if gone else deep(value))], key=lambda v: v[0])
                old = sum(v[0] <= table_time - self.retention for v in kept)
                versions.put(k, (kept[max(0, old - 1) :],))  # the newest of the old ones still holds
                continue
            stream_time = at if stream_time is None else max(stream_time, at)
            if at <= stream_time - self.grace:  # it would not wait
                join(k, at, deep(row))
            else:
                order.add(at, number)
                waiting.put(number, (k, at, deep(row)))
                number += 1
            while (first := order.first()) is not None and first[0] <= stream_time - self.grace:
                _, n = order.pop()
                join(*waiting.get(n))
                waiting.put(n, None)
        versions.save(), waiting.save()
        self.totals.update((stream_time, table_time, number, order.save()))
        names = [*self.names[0], *self.names[1]]
        yield from (Row(**dict(zip(names, r, strict=True))) for r in out)

    def close(self) -> None:
        pass


def grace_join(
    stream: DataFrame, table: DataFrame, key: str, ts: str, order: str, values: list[str], grace_ms: int, retention_ms: int, deleted: Column | None = None,
    how: str = "inner", partition: Column | None = None, partitions: int = 32,
) -> DataFrame:
    """A stream against a versioned table, on streams: the version that holds at the row's own time, as ``t_*``.

    Rows wait until the stream time of their partition is ``grace_ms`` past their time, so versions that
    come late still count; they then go out by time. A row that comes later than that is joined at once.
    ``table`` is a changelog with the stream's ``key``, ``ts`` and ``order``; of versions of one time the
    last to arrive holds, those ``retention_ms`` behind the table's own time are refused, and history is
    kept as far back. Rows without a key are dropped, or padded at once in a left join.
    """
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    number = (lambda n: partition) if partition is not None else (lambda n: None)
    common = lambda df: (_partitioned(number(df), F.col(key), partitions), F.col(order).alias("b_order"), F.col(key).alias("b_key"), epoch_millis(F.col(ts)).alias("b_ts"))
    row, cell = F.struct(*stream.columns), F.struct(*[F.col(v).alias(f"t_{v}") for v in values])
    left = stream if how == "left" else stream.filter(F.col(key).isNotNull())
    s = left.select(*common(stream), F.lit(False).alias("b_table"), F.lit(False).alias("b_gone"), row.alias("b_row"))
    t = table.dropna(subset=[key]).select(*common(table), F.lit(True).alias("b_table"), gone.alias("b_gone"), cell.alias("b_value"))
    both = s.unionByName(t, allowMissingColumns=True)
    kinds = (stream.schema[key].dataType.simpleString(), both.schema["b_row"].dataType.simpleString(), both.schema["b_value"].dataType.simpleString())
    processor = GraceJoinProcessor(*kinds, (stream.columns, [f"t_{v}" for v in values]), grace_ms, retention_ms, how == "left")
    fields = [*stream.schema, *both.schema["b_value"].dataType]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return both.groupBy("b_partition").transformWithState(processor, schema, "append", "None")
