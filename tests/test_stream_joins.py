"""Foreign-key joins and sliding windows on streams, against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from floodmark.operators import joins, tables, windows
from floodmark.streaming import foreign_keys, sliding
from tests.test_buffers import BASE, streamed

MOVES = "n long, side string, k long, fk long, price long, gone boolean"


def moves(seed, n=300):
    rng = random.Random(seed)
    return [(i, "l", rng.randrange(12), rng.choice([None, 0, 1, 2, 3, 4]), i * 10**15, rng.random() < 0.15) if rng.random() < 0.6 else (i, "r", rng.randrange(5), None, i * 10**15 + 1, rng.random() < 0.25) for i in range(n)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_foreign_key_join_is_the_snapshot_after_every_batch(spark, tmp_path, how):
    rows, parts = moves(5 if how == "left" else 6), 7
    both = streamed(spark, tmp_path / "in", rows, MOVES, parts)
    left, right = both.filter("side = 'l'"), both.filter("side = 'r'")
    live = foreign_keys.foreign_key_join(left, right, "k", F.col("fk"), "k", "n", ["n", "fk", "price"], ["price"], how, F.col("gone"), F.col("gone"))
    seen = []
    query = live.writeStream.foreachBatch(lambda df, i: seen.append((i, df.collect()))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None and len(seen) == parts
    table, changes = {}, 0
    for i, out in seen:
        for r in out:
            changes += 1
            assert not r.deleted or r.k in table
            table[r.k] = None if r.deleted else (r.l_n, r.l_fk, r.l_price, r.t_price)
        table = {k: v for k, v in table.items() if v is not None}
        batch = spark.createDataFrame(rows[: (i + 1) * len(rows) // parts], MOVES)
        l, r = (tables.latest(batch.filter(F.col("side") == s), "k", "n", F.col("gone")) for s in "lr")
        want = joins.foreign_key_join(l.select("k", "n", "fk", "price"), r, F.col("fk"), "k", ["price"], how).collect()
        assert table == {x.k: (x.n, x.fk, x.price, x.t_price) for x in want}
    assert changes > 40


def records(seed, n=500):
    rng = random.Random(seed)
    out, at = [], 0
    for i in range(n):
        at += rng.choice([0, 1, 40, 300, 2500])
        out.append((i, rng.choice(["a", "b", None]), BASE + dt.timedelta(milliseconds=at), rng.choice([None, i, i * 10**14])))
    return out


def results():
    return {"n": ("count", F.lit(1)), "values": ("count", F.col("v")), "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))}


def plain():
    return [F.count("*").alias("n"), F.count("v").alias("values"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high")]


COLUMNS = ["key", "start_ms", "end_ms", "n", "values", "total", "low", "high"]


@pytest.mark.parametrize("difference", [1, 500, 3000, 10**7])
def test_merged_sliding_windows(spark, difference):
    df = spark.createDataFrame(records(difference), "i long, key string, ts timestamp, v long")
    early = df.limit(0).unionByName(spark.createDataFrame([(0, "a", dt.datetime(1970, 1, 1, 0, 0, 0, ms * 1000), ms) for ms in (0, 1, 7, 400)], df.schema))
    for rows in (df, early):
        got, want = windows.sliding_merged(rows, "key", "ts", difference, results()), windows.sliding(rows, "key", "ts", difference, *plain())
        assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(map(tuple, want.select(*COLUMNS).collect()))


def test_a_hot_key_is_linear(spark):
    """Hundred thousands of records in one window: the record x window join would make their square."""
    hot = spark.range(300_000).select(F.lit("a").alias("key"), F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id")).alias("ts"), F.col("id").alias("v"))
    out = windows.sliding_merged(hot, "key", "ts", 3_600_000, results())
    assert out.agg(F.max("n"), F.max("total"), F.count("*")).first()[:2] == (300_000, 299_999 * 150_000)


@pytest.mark.parametrize("difference", [0, 1, 9, 50])
def test_merged_sliding_windows_sort_two_rows_a_time(spark, difference):
    """A time is in two pairs of buckets and no more rows: they are made once, of one scan, and sorted from both ends."""
    rng = random.Random(difference)
    rows = [(rng.choice("ab"), rng.randrange(-40, 60), rng.choice([None, rng.randrange(99)])) for _ in range(120)]
    df = spark.createDataFrame(rows, "key string, ms long, v long").select("key", F.timestamp_millis("ms").alias("ts"), "v")
    got, want = windows.sliding_merged(df, "key", "ts", difference, results()), windows.sliding(df, "key", "ts", difference, *plain())
    assert sorted(map(str, got.select(*COLUMNS).collect())) == sorted(map(str, want.select(*COLUMNS).collect()))
    nodes = [line.strip(" :+-").split(" ")[0] for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert [nodes.count(n) for n in ("Generate", "Window", "Aggregate", "Union", "Join")] == [1, 2, 1, 0, 0]


def test_sliding_windows_on_a_stream(spark, tmp_path):
    rng = random.Random(2)
    rows = records(77)
    rows.sort(key=lambda r: r[2] + dt.timedelta(milliseconds=rng.randrange(900)))
    rows += [(999, "z", BASE + dt.timedelta(days=9), None)] * 2  # moves the watermark past all
    schema = "i long, key string, ts timestamp, v long"
    stream = windows.with_grace(streamed(spark, tmp_path / "in", rows, schema, 5), "ts", "1 second")
    live = sliding.sliding(stream, "key", "ts", 3000, results())
    query = live.writeStream.format("memory").queryName("slid").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    want = windows.sliding_merged(spark.createDataFrame(rows, schema).filter("key <> 'z'"), "key", "ts", 3000, results())
    assert sorted(map(tuple, spark.table("slid").filter("key <> 'z'").select(*COLUMNS).collect())) == sorted(map(tuple, want.select(*COLUMNS).collect()))
