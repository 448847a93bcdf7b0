"""Buffers ordered by time on streams, against plain replays row by row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from floodmark.operators import history, joins
from floodmark.streaming import buffers

BASE = dt.datetime(2024, 1, 1)


def streamed(spark, path, rows, schema, parts):
    """A stream of ``parts`` micro-batches of ``rows``, in order."""
    for i in range(parts):
        spark.createDataFrame(rows[i * len(rows) // parts : (i + 1) * len(rows) // parts], schema).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def run(df, name, checkpoint):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination(240)
    if query.exception() is not None:
        raise query.exception()
    return df.sparkSession.table(name).collect()


def updates(seed, n=400):
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += rng.randrange(0, 4000)
        late = rng.randrange(0, 9000) if rng.random() < 0.2 else 0
        value = None if rng.random() < 0.1 else "v" * rng.randrange(1, 30) + str(i)
        rows.append((i, rng.choice("abcdefghij"), BASE + dt.timedelta(milliseconds=max(0, at - late)), value, rng.randrange(2)))
    return rows


UPDATES = "n long, key string, ts timestamp, value string, part long"


def replay(rows, limit, most=float("inf"), most_bytes=float("inf"), drop=False):
    """The buffer of one partition as a list that is sorted anew for each row."""
    out = []
    for part in (0, 1):
        held, now = {}, None
        for _, key, ts, value, p in rows:
            if p != part:
                continue
            at = int((ts - dt.datetime(1970, 1, 1)).total_seconds() * 1000 + 0.5)
            now = at if now is None else max(now, at)
            held[key] = (held[key][0] if key in held else at, at, value, len(key) + len(value or ""))
            while held:
                oldest = min(held, key=lambda k: (held[k][0], k))
                if held[oldest][0] > now - limit and len(held) <= most and sum(h[3] for h in held.values()) <= most_bytes:
                    break
                _, last, v, _ = held.pop(oldest)
                if v is not None or not drop:
                    out.append((oldest, last, v))
    return out


@pytest.mark.parametrize("limits", [{}, {"max_records": 3}, {"max_bytes": 60}, {"max_records": 5, "max_bytes": 90, "drop_tombstones": True}])
def test_suppress_equals_replay(spark, tmp_path, limits):
    rows = updates(len(limits))
    stream = streamed(spark, tmp_path / "in", rows, UPDATES, 5)
    out = run(buffers.suppress(stream, "key", "ts", "value", "n", 20_000, partition=F.col("part"), **limits), "suppressed" + str(len(str(limits))), tmp_path / "c")
    want = replay(rows, 20_000, limits.get("max_records", 9e9), limits.get("max_bytes", 9e9), limits.get("drop_tombstones", False))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr) and len(want) > 50


def test_a_buffer_of_three_keys_evicts_from_the_fourth_on(spark, tmp_path):
    rows = [(i, "abcdef"[i % 6], BASE + dt.timedelta(seconds=i), f"{i}", 0) for i in range(60)]
    stream = streamed(spark, tmp_path / "in", rows, UPDATES, 2)
    out = run(buffers.suppress(stream, "key", "ts", "value", "n", 10**9, partition=F.col("part"), max_records=3), "three", tmp_path / "c")
    assert [r.value for r in out] == [str(i) for i in range(57)]


@pytest.mark.parametrize("limits", [{"max_records": 9}, {"max_bytes": 200}])
def test_a_full_buffer_shuts_down(spark, tmp_path, limits):
    rows = updates(1)
    stream = streamed(spark, tmp_path / "in", rows, UPDATES, 2)
    with pytest.raises(Exception, match="BufferFull"):
        run(buffers.suppress(stream, "key", "ts", "value", "n", 10**9, partition=F.col("part"), when_full="shut_down", **limits), "full" + str(len(str(limits))), tmp_path / "c")
    with pytest.raises(ValueError):
        buffers.suppress(stream, "key", "ts", "value", "n", 1, when_full="wait")


def test_final_results_of_windows(spark, tmp_path):
    """The window's end is the time in the buffer, the grace period the limit."""
    rows = updates(6)
    stream = streamed(spark, tmp_path / "in", rows, UPDATES, 4)
    ends = stream.withColumn("end", F.window("ts", "30 seconds")["end"]).withColumn("k", F.concat("key", F.lit("@"), F.col("end").cast("string")))
    out = run(buffers.suppress(ends, "k", "ts", "n", "n", 5000, time=F.col("end"), partition=F.lit(0)), "finals", tmp_path / "c")
    held, done, now = {}, [], BASE
    for n, key, ts, _, _ in rows:
        end = BASE + dt.timedelta(seconds=((ts - BASE).total_seconds() // 30 + 1) * 30)
        now = max(now, ts)
        held[key, end] = n
        for k in [k for k in held if k[1] <= now - dt.timedelta(seconds=5)]:
            done.append((f"{k[0]}@{k[1]}", held.pop(k)))
    assert sorted((r.k, r.n) for r in out) == sorted(done)


TABLE = "n long, key string, ts timestamp, price long, gone boolean"


@pytest.mark.parametrize("how", ["inner", "left"])
def test_grace_join_equals_versions(spark, tmp_path, how):
    """Within the grace period input in any order gives what the batch join over all versions gives."""
    rng = random.Random(3)
    moves = [("t", i * 1000 + 500, rng.choice("abcd"), rng.randrange(10**17), rng.random() < 0.15) for i in range(150)] + [("s", i * 700, rng.choice("abcde"), None, None) for i in range(200)]
    moves.sort(key=lambda m: m[1] + rng.randrange(0, 20_000))
    moves += [("s", 10**9, "a", None, None)]  # moves stream time past the end
    moves = [(n, *m) for n, m in enumerate(moves)]
    time = lambda ms: BASE + dt.timedelta(milliseconds=ms)
    schema = TABLE + ", side string"
    rows = [(n, k, time(at), p, bool(g), side) for n, side, at, k, p, g in moves]
    both = streamed(spark, tmp_path / "in", rows, schema, 6)
    stream, table = both.filter("side = 's'").select("n", "key", "ts"), both.filter("side = 't'").drop("side")
    out = run(buffers.grace_join(stream, table, "key", "ts", "n", ["price"], 25_000, 10**10, F.col("gone"), how, partition=F.lit(0)), "grace" + how, tmp_path / "c")
    batch = spark.createDataFrame(rows, schema)
    held = history.versions(batch.filter("side = 't'"), "key", "ts", "n", F.col("gone"))
    want = joins.versioned_join(batch.filter("side = 's'").select("n", "key", "ts"), held, "key", "ts", ["price"], how).filter("n < 350")
    assert sorted(((r.n, r.t_price) for r in out if r.n < 350), key=repr) == sorted(((r.n, r.t_price) for r in want.collect()), key=repr)
    assert len(out) > 100


def test_grace_join_late_rows_and_retention(spark, tmp_path):
    time = lambda s: BASE + dt.timedelta(seconds=s)
    rows = [
        (0, "a", time(100), 1, False, "t"), (1, "a", time(200), None, False, "s"), (2, "a", time(50), None, False, "s"), (3, "a", time(195), None, False, "s"),
        (4, "a", time(190), 2, False, "t"), (5, "a", time(60), 3, False, "t"), (6, None, time(150), None, False, "s"), (7, "a", time(300), None, True, "t"), (8, "a", time(320), None, False, "s"), (9, "a", time(400), None, False, "s"),
    ]
    both = streamed(spark, tmp_path / "in", rows, TABLE + ", side string", 10)
    stream, table = both.filter("side = 's'").select("n", "key", "ts"), both.filter("side = 't'").drop("side")
    out = run(buffers.grace_join(stream, table, "key", "ts", "n", ["price"], 10_000, 100_000, F.col("gone"), "left", partition=F.lit(0)), "late", tmp_path / "c")
    # 2 comes late and is joined at once, before any version; 5 is older than what is kept; 3 waits for 4; 9 still waits
    assert [(r.n, r.t_price) for r in out] == [(2, None), (6, None), (3, 2), (1, 2), (8, None)]
