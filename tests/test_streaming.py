"""The same operators on streams: a stream over all files gives what a batch replay gives."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from floodmark.operators import joins, windows
from floodmark.sources import records
from floodmark.streaming import stateful


def split(spark, sf_dir, path, parts=3):
    """Events in several files, by arrival; each is one micro-batch."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    n = events.count()
    for i in range(parts):
        events.filter((F.col("event_id") >= i * n / parts) & (F.col("event_id") < (i + 1) * n / parts)).coalesce(1).write.mode("append").parquet(str(path))
    return events, spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def run(df, name, mode="append", checkpoint=None):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return df.sparkSession.table(name)


def test_tumbling_windows_close(spark, sf_dir, tmp_path):
    batch, stream = split(spark, sf_dir, tmp_path / "in")
    count = F.count("*").alias("n")
    got = run(windows.windowed(windows.with_grace(stream, "ts", "1 hour"), "event_type", windows.tumbling("ts", "1 hour"), count), "tumbling", checkpoint=tmp_path / "c")
    whole = windows.windowed(batch, "event_type", windows.tumbling("ts", "1 hour"), count)
    want = {(r.event_type, r.window.start): r.n for r in whole.collect()}
    rows = got.collect()
    assert len(rows) > 0.9 * len(want) and all(want[(r.event_type, r.window.start)] == r.n for r in rows)


def test_stream_stream_join(spark, sf_dir, tmp_path):
    batch, stream = split(spark, sf_dir, tmp_path / "in")
    side = lambda df, kind: df.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    l, r = (windows.with_grace(side(stream, k), "ts", "1 day") for k in ("click", "purchase"))  # noqa: E741
    live = joins.window_join(l, r, "user_id", "ts", 7_200_000, 7_200_000, bucketed=False).select("l_event_id", "r_event_id")
    got = run(live, "pairs", checkpoint=tmp_path / "c")
    want = joins.window_join(side(batch, "click"), side(batch, "purchase"), "user_id", "ts", 7_200_000, 7_200_000)
    assert sorted(map(tuple, got.collect())) == sorted((x.l_event_id, x.r_event_id) for x in want.collect())


def test_first_by_key(spark, sf_dir, tmp_path):
    batch, stream = split(spark, sf_dir, tmp_path / "in")
    got = run(stateful.first_by_key(stream.select("event_id", "user_id"), "user_id", "event_id"), "firsts", checkpoint=tmp_path / "c")
    want = {r.user_id: r.e for r in batch.groupBy("user_id").agg(F.min("event_id").alias("e")).collect()}
    assert {r.user_id: r.event_id for r in got.collect()} == want


def test_arrival_join(spark, sf_dir, tmp_path):
    batch, stream = split(spark, sf_dir, tmp_path / "in")
    tagged = stream.filter(F.col("event_type").isin("signup", "purchase")).select("event_id", "user_id", F.when(F.col("event_type") == "signup", "table").otherwise("stream").alias("side"), "value")
    got = run(stateful.arrival_join(tagged, "user_id", "event_id", "side", "value"), "arrivals", checkpoint=tmp_path / "c")
    table = batch.filter("event_type = 'signup'").select("user_id", "event_id", "value")
    want = joins.stream_table_join(batch.filter("event_type = 'purchase'").select("event_id", "user_id"), table, "user_id", "event_id", ["value"])
    assert sorted((r.event_id, r.table_value) for r in got.collect()) == sorted((r.event_id, r.t_value) for r in want.collect())


def test_log_sink_and_source(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    log = records.as_log(events, F.col("event_type"), F.col("user_id").cast("string"), F.col("props"), F.col("ts"), F.col("event_id"))
    records.write_log(log, str(tmp_path / "log"))
    back = records.read_log(spark, str(tmp_path / "log"), pattern="cl.*|view")
    assert back.count() == events.filter("event_type in ('click', 'view')").count()
    stream = records.read_log_stream(spark, str(tmp_path / "log"), back.schema, topics="click")
    assert run(stream.groupBy("partition").count(), "clicks", "complete", tmp_path / "c").agg(F.sum("count")).first()[0] == events.filter("event_type = 'click'").count()


def test_generic_process(spark, sf_dir, tmp_path):
    _, stream = split(spark, sf_dir, tmp_path / "in")

    def step(key, state, rows):
        n = (state[0] if state else 0) + len(rows)
        return (n,), pd.DataFrame({"user_id": [key[0]], "n": [n]})

    got = run(stateful.process(stream, "user_id", step, "n long", "user_id long, n long", "update"), "counts", "update", tmp_path / "c")
    top = {r.user_id: r.n for r in got.groupBy("user_id").agg(F.max("n").alias("n")).collect()}
    assert sum(top.values()) == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_start_positions(spark, sf_dir):
    log = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("ts", "timestamp")
    assert records.start_at(log, "latest").count() == 0
    assert 0 < records.start_at(log, "by_duration", "1 day").count() < log.count()
    with pytest.raises(ValueError):
        records.start_at(log, "none")
