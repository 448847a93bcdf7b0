"""Queries of sinks read back, named functions, settings, and what the other modules leave."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import reducers
from ..functions.places import shared_folder
from ..operators import aggregates, errors, history, joins, replication, stateless, stats, tables, topics, transforms, windows
from ..sources import records
from .log_queries import LOG, log, measured
from .record_queries import order_records
from .registry import arrival_block, query
from .stream_queries import LATE_SQL, SESSIONS, by_type, late
from .table_queries import LATE_USERS, LATEST, gone, signed

# --- sources and sinks

@query("SELECT event_id, user_id AS key, event_type AS value, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def src4_consumed(t):
    """Bytes decoded, event time from inside the value, reading from ten days before the end."""
    body = F.to_json(F.struct("event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))).cast("binary")
    raw = t.events.select(F.col("user_id").cast("string").cast("binary").alias("key"), body.alias("value"), F.col("ts").alias("timestamp"), "event_id")
    at = F.timestamp_micros(F.col("value.us")).cast("timestamp_ntz")
    out = records.consumed(raw, lambda k: k.cast("string").cast("long"), lambda v: F.from_json(v.cast("string"), "event_type string, us long"), at, "by_duration", "10 days")
    return out.select("event_id", "key", F.col("value.event_type").alias("value"), F.col("timestamp").alias("ts"))


@query("SELECT event_type AS topic, event_id AS \"offset\", user_id AS key, value FROM events")
def src8_write_log(t):
    path = shared_folder(t.spark, "log")
    records.write_log(by_type(t), path)
    return records.read_log(t.spark, path).select("topic", "offset", "key", "value")


@query("SELECT user_id, count(DISTINCT time_bucket(INTERVAL 1 DAY, ts)) AS windows, 1::BIGINT AS partitions FROM events GROUP BY 1")
def src11_partition_windowed(t):
    counts = windows.windowed(t.events, "user_id", windows.tumbling("ts", "1 day"), F.count("*").alias("n"))
    placed = records.partition_windowed(counts, 16, "user_id").withColumn("at", F.spark_partition_id())
    return placed.groupBy("user_id").agg(F.count("*").alias("windows"), F.countDistinct("at").alias("partitions"))


@query("SELECT count(*) AS lines, count(*) AS places, sum(octet_length((event_id || ':' || props)::BLOB) + 1)::BIGINT AS bytes FROM events")
def src14_line_positions(t):
    """Lines with the bytes they start at: no two in one place, and the last one of each file ends it."""
    path = shared_folder(t.spark, "lines")
    records.write_lines(t.events.select(F.concat_ws(":", "event_id", "props").alias("value")), path)
    rows = records.line_positions(t.spark, path)
    files = rows.groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("position").alias("p"), F.max(F.col("position") + F.octet_length("value") + 1).alias("size"))
    return files.agg(F.sum("n").alias("lines"), F.sum("p").alias("places"), F.sum("size").alias("bytes"))


@query("SELECT user_id || ' ' || event_type AS value, count(*) AS n FROM events GROUP BY 1")
def src15_file_sink(t):
    path = shared_folder(t.spark, "lines")
    records.write_lines(t.events.select(F.concat_ws(" ", "user_id", "event_type").alias("value")), path)
    return records.read_lines(t.spark, path, "lines").groupBy("value").agg(F.count("*").alias("n"))


@query(f"SELECT 'g' AS \"group\", 'events' AS topic, partition, min(off) AS \"offset\" FROM {LOG} WHERE ts >= TIMESTAMP '2024-01-12' GROUP BY 3")
def log6_reset_plan(t):
    path = shared_folder(t.spark, "plan")
    plan = topics.offsets_for_time(log(t), F.lit("2024-01-12").cast("timestamp_ntz")).withColumn("group", F.lit("g"))
    topics.write_reset_plan(plan, path)
    return topics.read_reset_plan(t.spark, path)


@query("SELECT event_id, CASE WHEN value > 60 THEN 'reported' ELSE 'put' END AS went FROM events")
def err5_reject(t):
    """A sink that refuses large values: both ways end in a table."""
    path = shared_folder(t.spark, "sink")
    to = lambda name: lambda batch, n: batch.select("event_id", F.lit(name).alias("went")).write.mode("append").parquet(path)
    errors.reject(~F.coalesce(F.col("value") > 60, F.lit(False)), to("put"), to("reported"))(t.events, 0)
    return t.spark.read.parquet(path)


@query("SELECT event_id, 'no such type' AS error FROM events WHERE event_type IN ('signup', 'error')")
def err3_tolerance(t):
    refused = F.when(F.col("event_type").isin("signup", "error"), "no such type")
    _, failed = errors.process(t.events, F.upper("event_type"), refused, tolerance="all")
    return failed.select("event_id", "error")


# --- row-wise and keys

@query("SELECT event_id, event_type FROM events WHERE value > 10")
def prj7_peek(t):
    """Counted as they pass; the rows go on."""
    return stateless.peek(t.events.filter("value > 10"), Observation(), F.count("*").alias("n"), F.max("value").alias("top")).select("event_id", "event_type")


@query("SELECT substr(event_type, 1, 1) || (user_id % 3) AS key, count(*) AS n, max(value) AS top FROM events WHERE event_type <> 'view' GROUP BY 1")
def key2_group_by_mapper(t):
    key = F.when(F.col("event_type") != "view", F.concat(F.substring("event_type", 1, 1), (F.col("user_id") % 3).cast("string")))
    return stateless.group_by_key(t.events, key).agg(F.count("*").alias("n"), F.max("value").alias("top"))


# --- windows

@query("""SELECT event_type, start, max(value) AS top, min(value) AS low, round(sum(value), 2) AS total FROM (
SELECT event_type, ts, value, time_bucket(INTERVAL 4 HOUR, ts) - to_hours((i * 4)::INT) AS start FROM events, range(2) r(i)) WHERE ts < start + INTERVAL 8 HOUR GROUP BY 1, 2""")
def win6_hopping_reduce(t):
    rows = windows.hopping(t.events, "ts", "8 hours", "4 hours")
    out = windows.windowed(rows, "event_type", "window", F.max("value").alias("top"), F.min("value").alias("low"), F.round(F.sum("value"), 2).alias("total"))
    return out.select("event_type", F.col("window.start").alias("start"), "top", "low", "total")


@query(SESSIONS.replace("count(*) AS n", "string_agg(event_type, '>' ORDER BY ts, event_id) AS aggregate"))
def win7_session_fold(t):
    """The path of each session, by initial value, aggregator and merger."""
    both = lambda a, b: F.when(a == "", b).when(b == "", a).otherwise(F.concat(a, F.lit(">"), b))
    return windows.session_fold(t.events, "user_id", "ts", "2 hours", "event_type", F.lit(""), both, both, "event_id")


LATE_TYPES = f"(SELECT *, max(ts) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS st FROM {LATE_SQL})"


@query(f"SELECT event_id FROM {LATE_TYPES} WHERE st <= time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR + INTERVAL 45 MINUTE")
def win10_inherited_grace(t):
    """Grace of a merged stream: the longer one of its parents."""
    rows = windows.stream_time(late(t).withColumn("p", F.col("user_id") % 4), "ts", "event_id", "p", arrival_block()).withColumn("window", windows.tumbling("ts", "1 hour"))
    grace = windows.inherited_grace(45 * 60_000, None, 10 * 60_000)
    return windows.drop_late(rows, F.col("window.end"), f"{grace} milliseconds").select("event_id")


@query("SELECT * FROM (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS start, max(value) FILTER (event_type = 'purchase') AS top FROM events GROUP BY 1, 2) WHERE top IS NOT NULL")
def late7_drop_tombstones(t):
    """Days without a purchase end as deletes, which final results leave out."""
    top = F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("top")
    results = windows.windowed(t.events, "user_id", windows.tumbling("ts", "1 day"), top)
    return windows.drop_tombstones(results, "top").select("user_id", F.col("window.start").alias("start"), "top")


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 25 HOUR < (SELECT max(ts) FROM events)")
def late3_on_window_close(t):
    results = windows.windowed(t.events, "event_type", windows.tumbling("ts", "1 day"), F.count("*").alias("n"))
    now = t.events.agg(F.max("ts").alias("now"))  # one row
    held = results.select("event_type", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n").join(F.broadcast(now))
    return windows.on_window_close(held, F.col("end"), "1 hour", F.col("now")).select("event_type", "start", "n")


# --- tables and joins

@query("SELECT o_orderkey, 'customer ' || o_custkey || ': ' || o_orderstatus || '/' || c_mktsegment AS value FROM orders JOIN customer ON o_custkey = c_custkey")
def joi15_joiner_with_key(t):
    pairs = joins.foreign_key_join(t.orders, t.customer, F.col("o_custkey"), "c_custkey", ["c_mktsegment"])
    joiner = lambda key, left, right: F.concat(F.lit("customer "), key.cast("string"), F.lit(": "), left, F.lit("/"), right)
    return joins.joined_value(pairs, joiner, "o_custkey", "o_orderstatus", "t_c_mktsegment").select("o_orderkey", "value")


@query("SELECT l.event_id AS l, r.event_id AS r FROM (SELECT * FROM events WHERE event_type = 'view') l JOIN (SELECT * FROM events WHERE event_type = 'click') r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts AND l.ts + INTERVAL 20 MINUTE")
def joi16_window_after(t):
    side = lambda kind: t.events.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    return joins.window_join(side("view"), side("click"), "user_id", "ts", 0, 1_200_000).select(F.col("l_event_id").alias("l"), F.col("r_event_id").alias("r"))


@query(f"""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM {LATE_USERS}) WHERE r = 1 AND event_type <> 'error'),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1)
SELECT user_id, event_id, o_orderkey FROM l JOIN r ON user_id = o_custkey""")
def joi17_versioned_tables(t):
    shifted = t.events.withColumn("ts", F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("interval 30 days")).otherwise(F.col("ts")))
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("event_id"))
    out = joins.versioned_table_join(shifted, orders, "user_id", "ts", "event_id", deleted_left=gone())
    return out.select("user_id", F.col("l_event_id").alias("event_id"), F.col("r_event_id").alias("o_orderkey"))


@query(f"SELECT event_type AS \"group\", (sum(floor(value)) * 10)::BIGINT AS aggregate FROM {LATEST} GROUP BY 1")
def agg6_adder_subtractor(t):
    """Any adder and subtractor over a table whose rows move between groups."""
    points = lambda cell: F.floor(cell["value"]) * 10
    both = lambda a, b: a + b
    out = tables.aggregate_table(signed(t), "event_id", F.lit(0).cast("long"), lambda a, c: a + points(c), lambda a, c: a - points(c), both)
    live = tables.count_table(signed(t)).filter("count > 0").select("group")
    return out.join(live, "group", "left_semi")


@query("SELECT user_id, event_type, event_id FROM " + LATEST)
def his10_position_bound(t):
    """The table, once what was read has reached the asked offsets."""
    reached = history.position(log(t))
    bound = reached.withColumn("offset", F.col("offset") - 1)
    return history.require_position(tables.latest(t.events, "user_id", "event_id", gone()), reached, bound).select("user_id", "event_type", "event_id")


# --- functions

@query("SELECT event_id, value * 2 + 1 AS score FROM events WHERE value IS NOT NULL AND value > 5")
def udf1_mapper(t):
    """A predicate as an expression, and a mapper over pandas series."""

    def scored(v: pd.Series) -> pd.Series:
        return v * 2 + 1

    rows = stateless.filter_rows(t.events, F.col("value") > 5)
    return stateless.map_values(rows, reducers.vectorised(scored, "double")("value"), "score").select("event_id", "score")


@query("SELECT event_type, string_agg(user_id % 7, ',' ORDER BY event_id) AS aggregate FROM events GROUP BY 1")
def udf2_merger(t):
    """Initializer, aggregator and merger over groups of any size."""
    digits = t.events.withColumn("d", (F.col("user_id") % 7).cast("string"))
    both = lambda a, b: F.when(a == "", b).when(b == "", a).otherwise(F.concat(a, F.lit(","), b))
    return aggregates.aggregate(digits, "event_type", "d", F.lit(""), both, "event_id", both)


@query("SELECT user_id || '/' || event_type AS joined, count(*) AS n FROM events GROUP BY 1")
def udf8_joiner(t):
    joiner = reducers.concatenated("/")
    return t.events.groupBy(joiner(F.col("user_id"), F.col("event_type")).alias("joined")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'orders-' || strftime(o_orderdate, '%Y%m%d') END AS topic, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END AS price FROM orders WHERE o_totalprice >= 2000")
def udf9_configured(t):
    """A chain from settings, with a transform and predicates of one's own."""
    transforms.register("status_is")(lambda status: F.col("value.status") == status)
    transforms.register("cheap")(lambda below: F.col("value.price") < below)
    steps = [
        {"type": "drop_where", "predicate": {"type": "cheap", "below": 2000}},
        {"type": "mask_field", "paths": ["price"], "predicate": {"type": "status_is", "status": "O"}, "negate": True},
        {"type": "regex_router", "regex": ".*", "replacement": "open", "predicate": {"type": "status_is", "status": "O"}},
    ]
    return order_records(t).transform(transforms.configured(steps)).select(F.col("offset").alias("id"), "topic", "value.price")


@query("SELECT o_orderkey AS id, o_orderstatus || ':order:2' AS text FROM orders")
def smt13_schema_metadata(t):
    out = order_records(t).transform(transforms.set_schema_metadata("order", 2))
    meta = out.schema["value"].metadata
    return out.select("value.id", F.concat_ws(":", "value.status", F.lit(meta["name"]), F.lit(str(meta["version"]))).alias("text"))


@query("SELECT DISTINCT event_type AS topic, event_type IN ('error', 'view', 'click') AS internal, event_type AS original FROM events")
def rep4_internal_topics(t):
    c = F.col("event_type")
    name = F.when(c == "error", F.concat(F.lit("__"), c)).when(c == "view", F.concat(F.lit("mm2-"), c, F.lit(".internal"))).when(c == "click", F.concat(c, F.lit(".checkpoints.internal"))).otherwise(F.concat(F.lit("west.east."), c))
    original = F.when(c.isin("error", "view", "click"), c).otherwise(replication.original_topic(name))
    return t.events.select(c.alias("topic"), replication.is_internal(name).alias("internal"), original.alias("original")).distinct()


# --- statistics

@query("SELECT event_type AS metric, time_bucket(INTERVAL 6 HOUR, ts) AS start, round(sum(value), 2) AS sum, count(value) AS count FROM events GROUP BY 1, 2")
def sta2_windowed(t):
    out = stats.sampled(measured(t), "ts", "6 hours", F.round(F.sum("value"), 2).alias("sum"), F.count("value").alias("count"))
    return out.select("metric", "start", "sum", "count")


@query("""WITH h AS (SELECT event_type AS metric, least(greatest(floor(value / 100 * 50), 0), 49)::INT AS bucket, count(*) AS n FROM events GROUP BY 1, 2),
c AS (SELECT metric, bucket * 2.0::DOUBLE AS v, sum(n) OVER (PARTITION BY metric ORDER BY bucket) / sum(n) OVER (PARTITION BY metric) AS share FROM h)
SELECT metric, coalesce(min(v) FILTER (share > 0.5), max(v)) AS p50, coalesce(min(v) FILTER (share > 0.95), max(v)) AS p95 FROM c GROUP BY 1""")
def sta5_binned_percentiles(t):
    return stats.binned_percentiles(measured(t).dropna(subset=["value"]), [0.5, 0.95], 0, 100, 50)
