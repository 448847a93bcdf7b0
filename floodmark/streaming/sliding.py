"""Sliding windows on streams: one result a window, once the watermark is past its end."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import epoch_millis
from .buffers import deep

_MERGE = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "min": min, "max": max}


class SlidingProcessor(StatefulProcessor):
    """State: for each bucket of time, as wide as a window, one merged entry for each time there is."""

    def __init__(self, key_name: str, kinds: dict[str, str], types: dict[str, str], difference_ms: int):
        self.key_name, self.names, self.difference, self.width = key_name, list(kinds), difference_ms, difference_ms + 1
        self.merges = [_MERGE[k] for k in kinds.values()]
        self.entry = "array<struct<t: long, records: long" + "".join(f", v{i}: {types[n]}" for i, n in enumerate(kinds)) + ">>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket long", f"entries {self.entry}")

    def _merge(self, a: tuple, b: tuple) -> tuple:
        both = (y if x is None else x if y is None else m(x, y) for m, x, y in zip(self.merges, a[1:], b[1:], strict=True))
        return (a[0] + b[0], *both)

    def _held(self, bucket: int) -> list[tuple]:
        return deep(self.buckets.getValue((bucket,)))[0] if self.buckets.containsKey((bucket,)) else []

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, dict[int, tuple]] = {}
        for r in rows:
            at, entry = r["b_t"], (1, *[r[f"b_{n}"] for n in self.names])
            held = new.setdefault(at // self.width, {})
            held[at] = self._merge(held[at], entry) if at in held else entry
        for bucket, times in new.items():
            for at, *entry in self._held(bucket):
                times[at] = self._merge(tuple(entry), times[at]) if at in times else tuple(entry)
            self.buckets.updateValue((bucket,), ([(at, *times[at]) for at in sorted(times)],))
        held = set(self.handle.listTimers())
        for at in {self._closing(b + k) for b in new for k in (-1, 0, 1)} - held:
            self.handle.registerTimer(at)
        return iter(())

    def _closing(self, bucket: int) -> int:
        """When all windows that start in a bucket are over."""
        return (bucket + 2) * self.width - 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bucket = (int(expiredTimerInfo.getExpiryTimeInMs()) + 1) // self.width - 2
        first, here, last = (self._held(b) for b in (bucket - 1, bucket, bucket + 1))
        low, high = bucket * self.width, (bucket + 1) * self.width
        times = [e[0] for e in (*first, *here, *last)]
        starts = sorted(s for s in {*(max(t - self.difference, 0) for t in times), *(t + 1 for t in times)} if low <= s < high)
        # merged from each time to the bucket's end, and from the next one's start to each time
        to_end, so_far = [None] * len(here), None
        for i in range(len(here) - 1, -1, -1):
            so_far = here[i][1:] if so_far is None else self._merge(here[i][1:], so_far)
            to_end[i] = so_far
        i, j, begun = 0, 0, None
        for s in starts:
            while i < len(here) and here[i][0] < s:
                i += 1
            while j < len(last) and last[j][0] <= s + self.difference:
                begun = last[j][1:] if begun is None else self._merge(begun, last[j][1:])
                j += 1
            end = to_end[i] if i < len(here) else None
            if end is not None or begun is not None:
                found = begun if end is None else end if begun is None else self._merge(end, begun)
                yield Row(**{self.key_name: key[0], "start_ms": s, "end_ms": s + self.difference}, **dict(zip(self.names, found[1:], strict=True)))
        if first:
            self.buckets.removeKey((bucket - 1,))

    def close(self) -> None:
        pass


def sliding(stream: DataFrame, key: str, ts: str, difference_ms: int, results: dict[str, tuple[str, Column]]) -> DataFrame:
    """As ``windows.sliding_merged``, on a stream with a watermark on ``ts``, whose delay is the grace period.

    Windows go out when those that start in their bucket are all over, so up to two windows' length after
    their end. Rows behind the watermark are late and take no part. Work and state are linear in the
    distinct times of a key.
    """
    rows = stream.dropna(subset=[key, ts])
    columns = {n: F.lit(1).cast("long") if k == "count" else c for n, (k, c) in results.items()}
    counted = {n: F.when(results[n][1].isNotNull(), c).otherwise(0).cast("long") if results[n][0] == "count" else c for n, c in columns.items()}
    rows = rows.select(F.col(key).alias("b_key"), F.col(ts).alias("b_ts"), epoch_millis(F.col(ts)).alias("b_t"), *[c.alias(f"b_{n}") for n, c in counted.items()])
    wide = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}
    types = {n: rows.schema[f"b_{n}"].dataType.simpleString() for n in results}
    types = {n: wide.get(t, t) if results[n][0] == "sum" else t for n, t in types.items()}
    processor = SlidingProcessor(key, {n: k for n, (k, _) in results.items()}, types, difference_ms)
    schema = f"`{key}` {rows.schema['b_key'].dataType.simpleString()}, start_ms long, end_ms long, " + ", ".join(f"`{n}` {types[n]}" for n in results)
    return rows.groupBy("b_key").transformWithState(processor, schema, "append", "EventTime")
