"""Tables in files: cost by batch, repeated batches, versions, and state that a failed batch sees again."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from floodmark.sources.keyed_tables import ConcurrentWrite, KeyedTable
from floodmark.streaming import stateful

SCHEMA = "k long, n long, v string"


def table(spark, path, **more):
    return KeyedTable(spark, str(path), "k", "n", **more)


def rows(t, version=None):
    return sorted((r.k, r.n, r.v) for r in t.read(version).collect())


def test_upserts_touch_their_buckets_alone(spark, tmp_path):
    t = table(spark, tmp_path, buckets=16)
    t.upsert(spark.range(2000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("n"), F.lit("a").alias("v")), 0)
    before = t._manifest(0)["folders"]
    t.upsert(spark.createDataFrame([(5, 1, "b"), (9999, 1, "new"), (5, 2, "c"), (7, 1, None), (None, 1, "x")], SCHEMA), 1, deleted=F.col("v").isNull())
    after = t._manifest(1)["folders"]
    assert len(before) == len(after) == 16 and 1 <= sum(before[b] != after[b] for b in before) <= 3
    got = rows(t)
    assert len(got) == 2000 and (5, 2, "c") in got and (9999, 1, "new") in got and 7 not in {r[0] for r in got}
    assert len(rows(t, 0)) == 2000 and (5, 0, "a") in rows(t, 0)
    assert [tuple(r) for r in t.lookup(5).collect()] == [(5, 2, "c")] and t.lookup(7).collect() == []
    assert t.lookup(5, 0).first().v == "a"


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    assert t.upsert(spark.createDataFrame([(1, 0, "a")], SCHEMA), 0, "q") == 0
    assert t.upsert(spark.createDataFrame([(1, 9, "wrong")], SCHEMA), 0, "q") == 0
    assert t.upsert(spark.createDataFrame([(2, 0, "b")], SCHEMA), 0, "other") == 1
    assert rows(t) == [(1, 0, "a"), (2, 0, "b")]
    assert t.upsert(spark.createDataFrame([], SCHEMA), 1, "q") == 2 and rows(t) == [(1, 0, "a"), (2, 0, "b")]
    t.upsert(spark.createDataFrame([(1, 5, None), (2, 5, None)], SCHEMA), 2, "q", F.col("v").isNull())
    assert rows(t) == [] and rows(t, 1) != []


def test_concurrent_writers_and_vacuum(spark, tmp_path, monkeypatch):
    a = table(spark, tmp_path, buckets=2)
    a.upsert(spark.createDataFrame([(1, 0, "a")], SCHEMA))
    b = table(spark, tmp_path)
    monkeypatch.setattr(b, "version", lambda: -1)
    with pytest.raises(ConcurrentWrite):
        b.upsert(spark.createDataFrame([(2, 0, "b")], SCHEMA))
    assert rows(a) == [(1, 0, "a")]
    a.upsert(spark.createDataFrame([(1, 1, "c"), (2, 1, "d"), (3, 1, "e")], SCHEMA))
    a.vacuum()
    assert rows(a) == [(1, 1, "c"), (2, 1, "d"), (3, 1, "e")] and len(os.listdir(tmp_path / "data")) == 1
    with pytest.raises(ValueError):
        a.read(0)


def test_a_stream_into_a_table(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([(k, i, f"{i}") for k in range(i, i + 5)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    t = table(spark, tmp_path / "t", buckets=4)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(t.sink("q")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    assert rows(t) == [(k, min(k, 3), str(min(k, 3))) for k in range(8)] and t.version() == 3


def test_a_failed_batch_sees_the_same_state_again(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=2)
    t.upsert(spark.createDataFrame([(1, 0, "old"), (2, 0, "old")], SCHEMA))
    spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], SCHEMA).write.parquet(str(tmp_path / "in"))
    seen = []

    def put(batch, held, batch_id):
        seen.append(sorted((r.v, r.s) for r in batch.join(held.select("k", F.col("v").alias("s")), "k").collect()))
        if len(seen) == 1:
            t.upsert(spark.createDataFrame([(1, 1, "new")], SCHEMA))  # another query writes, and this one fails
            raise RuntimeError("first try")

    def go():
        stateful.with_global_state(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), t, put, str(tmp_path / "c")).awaitTermination(120)

    with pytest.raises(StreamingQueryException, match="first try"):
        go()
    go()
    assert seen[0] == seen[1] == [("x", "old"), ("y", "old")]
    spark.createDataFrame([(1, 2, "z")], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert seen[2] == [("z", "new")]
