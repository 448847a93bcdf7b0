"""Processors: several states and outputs, timers on both clocks, times to live, and reading state back."""

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from floodmark.operators import history, windows
from floodmark.streaming import processors, stateful
from floodmark.streaming.processors import Processor, State
from tests.test_buffers import BASE, streamed

SCHEMA = "n long, user string, kind string, ts timestamp"


def rows(count=60):
    return [(i, "abc"[i % 3], ("view", "buy", "view", "error")[i % 4], BASE + dt.timedelta(seconds=i)) for i in range(count)]


def finish(query):
    assert query.awaitTermination(120) and query.exception() is None


class Baskets(Processor):
    """Counts kinds, keeps what was seen since the last buy, and tells of both."""

    states = {"total": State("value", "n long"), "since": State("list", "n long"), "kinds": State("map", "n long", key="kind string")}
    outputs = {"sales": "user string, before array<bigint>, total bigint", "alarms": "user string, n bigint, errors bigint"}

    def on_row(self, c, key, row):
        total = (c.total.get() or (0,))[0] + 1
        c.total.put(total)
        seen = (c.kinds.get(row["kind"]) or (0,))[0] + 1
        c.kinds.put((row["kind"],), (seen,))
        if row["kind"] == "buy":
            c.forward("sales", user=key[0], before=[x[0] for x in c.since], total=total)
            c.since.clear()
        elif row["kind"] == "error":
            c.forward("alarms", user=key[0], n=row["n"], errors=seen)
        else:
            c.since.append(row["n"])


def test_two_outputs_of_one_run(spark, tmp_path):
    stream = streamed(spark, tmp_path / "in", rows(), SCHEMA, 4)
    got = {"sales": [], "alarms": []}
    finish(processors.write_outputs(processors.process(stream, "user", Baskets(), "n"), {k: (lambda df, i, k=k: got[k].extend(map(tuple, df.collect()))) for k in got}, str(tmp_path / "c")))
    sales, alarms = [], []
    for user in "abc":
        since, total, errors = [], 0, 0
        for n, u, kind, _ in rows():
            if u == user:
                total += 1
                if kind == "buy":
                    sales.append((user, since, total))
                    since = []
                elif kind == "error":
                    errors += 1
                    alarms.append((user, n, errors))
                else:
                    since = [*since, n]
    assert sorted(got["sales"]) == sorted(sales) and sorted(got["alarms"]) == sorted(alarms)
    # the state of all partitions can be read back
    totals = history.state_snapshot(spark, str(tmp_path / "c"), stateVarName="total").select("key.user", "value.n")
    assert {r.user: r.n for r in totals.collect()} == dict.fromkeys("abc", 20)
    early = history.state_snapshot(spark, str(tmp_path / "c"), stateVarName="total", batchId=0).select("key.user", "value.n")
    assert sum(r.n for r in early.collect()) == 15


class Reminders(Processor):
    """Two timers a row, one of which a later row takes back."""

    states = {"last": State("value", "at long")}
    outputs = {"fired": "user string, name string, at bigint"}

    def __init__(self, after_ms):
        self.after = after_ms

    def on_row(self, c, key, row):
        at = row["b_at"] if row["b_at"] is not None else c.now
        last = c.last.get()
        if last is not None:
            c.cancel("quiet", last[0] + self.after)
        c.last.put(at)
        c.schedule("quiet", at + self.after)
        c.schedule("each", at + self.after)

    def on_timer(self, c, key, name, at):
        c.forward("fired", user=key[0], name=name, at=at)


def test_timers_by_event_time(spark, tmp_path):
    times = {"a": [0, 10, 50], "b": [5]}
    moves = sorted((s, u) for u, ss in times.items() for s in ss) + [(1000, "z"), (1001, "z")]
    data = [(i, u, "x", BASE + dt.timedelta(seconds=s)) for i, (s, u) in enumerate(moves)]
    stream = windows.with_grace(streamed(spark, tmp_path / "in", data, SCHEMA, 3), "ts", "0 seconds").withColumn("b_at", F.unix_millis("ts"))
    out = processors.output(processors.process(stream, "user", Reminders(20_000), "n", "event"), "fired")
    finish(out.writeStream.format("memory").queryName("fired").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    start = int((BASE - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    got = sorted((r.user, r.name, (r.at - start) // 1000) for r in spark.table("fired").filter("user <> 'z'").collect())
    assert got == sorted([("a", "each", 20), ("a", "each", 30), ("a", "each", 70), ("a", "quiet", 70), ("b", "each", 25), ("b", "quiet", 25)])


def test_timers_by_the_wall_clock(spark, tmp_path):
    data = [(0, "a", "x", BASE), (1, "b", "x", BASE)]
    stream = streamed(spark, tmp_path / "in", data, SCHEMA, 1).withColumn("b_at", F.lit(None).cast("long"))
    out = processors.output(processors.process(stream, "user", Reminders(300), "n", "wall"), "fired")
    query = out.writeStream.format("memory").queryName("walled").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    until = time.time() + 120
    while spark.table("walled").count() < 4 and time.time() < until:
        time.sleep(1)
    query.stop()
    assert sorted((r.user, r.name) for r in spark.table("walled").collect()) == [("a", "each"), ("a", "quiet"), ("b", "each"), ("b", "quiet")]


class Fresh(Processor):
    states = {"seen": State("value", "n long", ttl_ms=1500)}
    outputs = {"out": "n bigint, before bigint"}

    def on_row(self, c, key, row):
        before = c.seen.get()
        c.forward("out", n=row["n"], before=None if before is None else before[0])
        c.seen.put(row["n"])


def test_states_run_out(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([(0, "a", "x", BASE)], SCHEMA).coalesce(1).write.parquet(str(folder))
    stream = spark.readStream.schema(SCHEMA).parquet(str(folder))
    out = processors.output(processors.process(stream, "user", Fresh(), "n", "wall"), "out")
    go = lambda: finish(out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start())  # noqa: E731  a wall clock always has another batch to run
    go()
    time.sleep(2)
    spark.createDataFrame([(1, "a", "x", BASE), (2, "a", "x", BASE)], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    go()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(0, None), (1, None), (2, 1)]


def test_unknown_outputs_are_refused(spark):
    context = processors.Context({}, None, None, {"a": "x int"})
    with pytest.raises(ValueError):
        context.forward("b", x=1)


def test_values_stay_under_their_key(spark, tmp_path):
    """Fixed-key processing: rows come without the key, which can't be set."""
    stream = streamed(spark, tmp_path / "in", rows(), SCHEMA, 2)

    def step(key, state, batch):
        n = (state[0] if state else 0) + len(batch)
        return (n,), pd.DataFrame({"n": [n]})

    out = stateful.process_values(stream, "user", step, "n long", "n long")
    finish(out.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert sorted(map(tuple, spark.table("kept").collect())) == [(u, n) for u in "abc" for n in (10, 20)]
    bad = stateful.process_values(stream, "user", lambda k, s, b: ((1,), pd.DataFrame({"user": ["x"], "n": [1]})), "n long", "n long")
    query = bad.writeStream.format("memory").queryName("unkept").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="can't be set"):
        query.awaitTermination(240)
