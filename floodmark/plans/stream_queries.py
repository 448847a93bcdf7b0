"""Queries of sources, row-wise operators, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import reducers
from ..functions.times import epoch_millis
from ..operators import aggregates, stateless, windows
from ..sources import records
from .registry import arrival_block, query

#: Late events: every seventh arrives three hours after its time.
LATE_SQL = "(SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 3 HOUR ELSE ts END AS ts) FROM events)"


def late(t):
    return t.events.withColumn("ts", F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("interval 3 hours")).otherwise(F.col("ts")))


def by_type(t):
    return t.events.select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"), F.lit(0).alias("timestampType"), F.col("user_id").alias("key"), F.col("value"), F.array().cast(records.HEADERS).alias("headers"))


@query("SELECT event_type AS topic, event_id AS \"offset\", user_id AS key, value FROM events WHERE event_type IN ('click', 'view')")
def src1_topics(t):
    return records.select_topics(by_type(t), ["click", "view"]).select("topic", "offset", "key", "value")


@query("SELECT event_type AS topic, event_id AS \"offset\", user_id AS key FROM events WHERE regexp_full_match(event_type, '(pur|sig).*')")
def src1_pattern(t):
    return records.select_topics(by_type(t), pattern="(pur|sig).*").select("topic", "offset", "key")


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY")
def src5_start_by_duration(t):
    log = by_type(t)
    return records.start_at(log, "by_duration", "2 days").select(F.col("offset").alias("event_id"), F.col("key").alias("user_id"))


@query("SELECT event_id, ts + to_milliseconds(event_id % 1000) AS ts FROM events")
def src6_extracted_time(t):
    at = F.col("ts") + F.make_dt_interval(secs=((F.col("event_id") % 1000) / 1000).cast("decimal(18,6)"))
    return records.with_timestamp(t.events, at, "ts").select("event_id", "ts")


def _bad_times(t):
    ms = F.when(F.col("event_id") % 11 == 0, F.lit(-1)).otherwise(epoch_millis(F.col("ts")))
    return t.events.select("event_id", (F.col("user_id") % 4).alias("partition"), ms.alias("ts_ms"))


BAD = "(SELECT event_id, user_id % 4 AS partition, CASE WHEN event_id % 11 = 0 THEN -1 ELSE (epoch_us(ts) // 1000) END AS ts_ms FROM events)"


@query(f"SELECT event_id, partition, ts_ms FROM {BAD} WHERE ts_ms >= 0")
def src7_skip_invalid(t):
    return records.handle_invalid_timestamps(_bad_times(t), "skip", order="event_id")


@query(f"SELECT * FROM (SELECT event_id, partition, CASE WHEN ts_ms < 0 THEN max(CASE WHEN ts_ms >= 0 THEN ts_ms END) OVER (PARTITION BY partition ORDER BY event_id) ELSE ts_ms END AS ts_ms FROM {BAD}) WHERE ts_ms IS NOT NULL")
def src7_partition_time(t):
    return records.handle_invalid_timestamps(_bad_times(t), "partition_time", order="event_id")


@query("SELECT CASE WHEN value > 50 THEN 'large' ELSE 'small' END AS topic, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def src9_route(t):
    target = F.when(F.col("topic") != "error", F.when(F.col("value") > 50, "large").otherwise("small"))
    return records.route(by_type(t), target).groupBy("topic").agg(F.count("*").alias("n"))


@query("SELECT partition, count(*) AS n FROM (SELECT unnest(CASE event_id % 3 WHEN 0 THEN [] WHEN 1 THEN [0, 1] ELSE [(event_id % 4)::INT] END) AS partition FROM events) GROUP BY 1")
def src10_multicast(t):
    targets = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<int>")).when(F.col("event_id") % 3 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array((F.col("event_id") % 4).cast("int")))
    return records.partition_to(t.events.withColumnRenamed("user_id", "key"), targets, 4).groupBy("partition").agg(F.count("*").alias("n"))


@query("SELECT event_type AS topic, event_id, ((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) % 5)::INT AS partition FROM events")
def src12_round_robin(t):
    return records.round_robin(t.events.withColumn("topic", F.col("event_type")), 5, "event_id", block=arrival_block()).select("topic", "event_id", "partition")


@query("SELECT '[events]: ' || user_id || ', ' || event_type AS value FROM events")
def src13_print(t):
    return records.print_records(t.events.select(F.col("user_id").alias("key"), F.col("event_type").alias("value")), "events")


@query("SELECT event_id, split_part(line, ':', 1) AS key, nullif(substr(line, instr(line, ':') + 1), 'error') AS value FROM (SELECT event_id, user_id || ':' || event_type AS line FROM events)")
def src17_parse_lines(t):
    lines = t.events.select("event_id", F.concat_ws(":", "user_id", "event_type").alias("value"))
    return records.parse_lines(lines, key_separator=":", null_marker="error").select("event_id", "key", "value")


@query("SELECT 'CreateTime:' || (epoch_us(ts) // 1000) || chr(9) || 'Partition:' || (user_id % 4) || chr(9) || 'Offset:' || event_id || chr(9) || 'NO_HEADERS' || chr(9) || user_id AS line FROM events")
def src18_format_records(t):
    return records.format_records(by_type(t), timestamp=True, partition=True, offset=True, headers=True, key=True, value=False)


# --- row-wise

@query("SELECT event_id, value FROM events WHERE value > 20 AND event_type = 'purchase'")
def prj1_filter(t):
    return stateless.filter_rows(t.events, (F.col("value") > 20) & (F.col("event_type") == "purchase")).select("event_id", "value")


@query("SELECT event_id, value FROM events WHERE NOT coalesce(value > 20, false)")
def prj1_filter_not(t):
    return stateless.filter_not(t.events, F.col("value") > 20).select("event_id", "value")


@query("SELECT event_type AS key, round(value * 2, 4) AS value, ts FROM events")
def prj2_map(t):
    return stateless.map_rows(t.events, F.col("event_type"), F.round(F.col("value") * 2, 4), "ts")


@query("SELECT event_id, upper(event_type) AS value FROM events")
def prj3_map_values(t):
    return stateless.map_values(t.events, F.upper("event_type")).select("event_id", "value")


@query("SELECT event_id, unnest([user_id, user_id + 1000]) AS key, unnest([event_type, 'copy']) AS value FROM events WHERE event_type <> 'view'")
def prj4_flat_map(t):
    pairs = F.when(F.col("event_type") != "view", F.array(F.struct(F.col("user_id").alias("key"), F.col("event_type").alias("value")), F.struct((F.col("user_id") + 1000).alias("key"), F.lit("copy").alias("value"))))
    return stateless.flat_map(t.events, pairs, "event_id")


@query("SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> '')) AS word FROM documents")
def prj5_words(t):
    return stateless.flat_map_values(t.documents, stateless.words(F.col("text")), "word").select("doc_id", "word")


@query("SELECT event_id, event_type || '-' || (value > 50)::VARCHAR AS key FROM events")
def prj6_select_key(t):
    return stateless.select_key(t.events, F.concat_ws("-", "event_type", (F.col("value") > 50).cast("string"))).select("event_id", "key")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'errors' WHEN value > 50 THEN 'large' ELSE 'rest' END AS branch FROM events")
def prj9_branches(t):
    parts = stateless.branch(t.events, {"errors": F.col("event_type") == "error", "large": F.col("value") > 50}, default="rest")
    return stateless.merge(*[df.select("event_id", F.lit(name).alias("branch")) for name, df in parts.items()])


@query("SELECT user_id AS key, event_id AS id FROM events UNION ALL SELECT o_custkey, o_orderkey FROM orders")
def prj10_merge(t):
    return stateless.merge(t.events.select(F.col("user_id").alias("key"), F.col("event_id").alias("id")), t.orders.select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id")))


@query("SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS \"end\", count(*) AS n FROM events GROUP BY 1, 2, 3")
def prj16_unwrap_window(t):
    return stateless.unwrap_window(windows.windowed(t.events, "user_id", windows.tumbling("ts", "1 day"), F.count("*").alias("n")))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def key1_group_by_key(t):
    return stateless.group_by_key(t.events, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def key4_repartition(t):
    return stateless.repartition(t.events, 6, "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


# --- aggregations

@query("SELECT word, count(*) AS count FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> '')) AS word FROM documents) GROUP BY 1")
def agg1_word_count(t):
    return aggregates.count(stateless.split_words(t.documents, F.col("text")), "word", "word")


@query("SELECT user_id, round(sum(value), 2) AS total, max(value) AS top, arg_min(event_type, event_id) AS first_type FROM events GROUP BY 1")
def agg2_reduce(t):
    out = aggregates.reduce_all(t.events, "user_id", {"total": ("value", "sum"), "top": ("value", "max"), "first_type": ("event_type", "first")}, "event_id")
    return out.withColumn("total", F.round("total", 2))


@query("SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS reduced FROM conversations GROUP BY 1")
def agg2_ordered_fold(t):
    return aggregates.reduce_values(t.conversations, "conv_id", "role", reducers.concatenated(">"), "turn")


@query("SELECT conv_id, (10 + sum(length(text)))::BIGINT AS aggregate FROM conversations GROUP BY 1")
def agg3_aggregate(t):
    lengths = t.conversations.withColumn("n", F.length("text").cast("long"))
    return aggregates.aggregate(lengths, "conv_id", "n", F.lit(10).cast("long"), lambda a, x: a + x, "turn", lambda a, b: a + b - 10)


@query("""WITH m AS (SELECT user_id, max(event_id) FILTER (event_type = 'error') AS last_error FROM events GROUP BY 1)
SELECT e.user_id, count(*)::BIGINT AS aggregate FROM events e JOIN m USING (user_id)
WHERE last_error IS NULL OR event_id > last_error GROUP BY 1""")
def agg4_reset_on_null(t):
    return aggregates.aggregate(t.events, "user_id", "event_type", F.lit(0).cast("long"), lambda a, x: F.when(x != "error", a + 1), "event_id", lambda a, b: a + b)


@query("""SELECT key, count(*) FILTER (s = 'events') AS events, count(*) FILTER (s = 'orders') AS orders, round(sum(price), 2) AS spent
FROM (SELECT user_id AS key, 'events' AS s, NULL AS price FROM events UNION ALL SELECT o_custkey, 'orders', o_totalprice FROM orders) GROUP BY 1""")
def agg8_cogroup(t):
    streams = {"events": t.events.select(F.col("user_id").alias("key")), "orders": t.orders.select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("price"))}
    of = lambda s: F.count(F.when(F.col("stream") == s, 1))
    return aggregates.cogroup(streams, "key", {"events": of("events"), "orders": of("orders"), "spent": F.round(F.sum("price"), 2)})


@query("SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY 1")
def agg9_distinct_first(t):
    return aggregates.distinct_first(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


# --- windows

@query("SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def win1_tumbling(t):
    out = windows.windowed(t.events, "user_id", windows.tumbling("ts", "6 hours"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return out.select("user_id", F.col("window.start").alias("start"), "n", "total")


@query("""SELECT event_type, start, count(*) AS n FROM (SELECT event_type, ts, time_bucket(INTERVAL 2 HOUR, ts) - to_hours((i * 2)::INT) AS start FROM events, range(3) r(i))
WHERE ts < start + INTERVAL 6 HOUR GROUP BY 1, 2""")
def win2_hopping(t):
    rows = windows.hopping(t.events, "ts", "6 hours", "2 hours")
    return windows.windowed(rows, "event_type", "window", F.count("*").alias("n")).select("event_type", F.col("window.start").alias("start"), "n")


SLIDING = """WITH e AS (SELECT user_id, (epoch_us(ts) // 1000) AS t, value FROM events),
s AS (SELECT user_id, t - 3600000 AS start_ms FROM e UNION SELECT user_id, t + 1 FROM e)
SELECT e.user_id, start_ms, count(*) AS n, round(sum(value), 2) AS total, start_ms + 3600000 AS end_ms
FROM e JOIN s ON e.user_id = s.user_id AND t BETWEEN start_ms AND start_ms + 3600000 GROUP BY e.user_id, start_ms"""


@query(SLIDING)
def win3_sliding(t):
    out = windows.sliding_merged(t.events, "user_id", "ts", 3_600_000, {"n": ("count", F.lit(1)), "total": ("sum", F.col("value"))})
    return out.withColumn("total", F.round("total", 2))


SESSIONS = """SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM (
SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s"""


@query(SESSIONS)
def win4_sessions(t):
    return windows.sessions(t.events, "user_id", "ts", "2 hours", F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1")
def win5_unlimited(t):
    return windows.unlimited(t.events, "ts", F.lit("2024-01-15").cast("timestamp_ntz")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS buys
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2""")
def win8_cogroup(t):
    streams = {k: t.events.filter(F.col("event_type") == k).select("user_id", "ts") for k in ("click", "purchase")}
    of = lambda s: F.count(F.when(F.col("stream") == s, 1))
    out = windows.cogroup_windowed(streams, "user_id", windows.tumbling("ts", "1 day"), {"clicks": of("click"), "buys": of("purchase")})
    return out.select("user_id", F.col("window.start").alias("start"), "clicks", "buys")


@query(SESSIONS.replace("FROM events)", "FROM events WHERE event_type IN ('click', 'view'))").replace("count(*) AS n", "count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views"))
def win8_cogroup_sessions(t):
    streams = {k: t.events.filter(F.col("event_type") == k).select("user_id", "ts") for k in ("click", "view")}
    of = lambda s: F.count(F.when(F.col("stream") == s, 1))
    return windows.cogroup_sessions(streams, "user_id", "ts", "2 hours", {"clicks": of("click"), "views": of("view")})


@query("SELECT * FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY 1, 2) WHERE start >= (SELECT max(time_bucket(INTERVAL 1 HOUR, ts)) FROM events) - INTERVAL 2 DAY")
def win11_retention(t):
    w = windows.windowed(t.events, "event_type", windows.tumbling("ts", "1 hour"), F.count("*").alias("n"))
    return windows.retain(w.select("event_type", F.col("window.start").alias("start"), "n"), "2 days")


LATE_COUNTS = f"""SELECT user_id % 4 AS p, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM (
SELECT *, max(ts) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS st FROM {LATE_SQL})
WHERE st <= time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR + INTERVAL 30 MINUTE GROUP BY 1, 2"""


def _on_time(t):
    rows = windows.stream_time(late(t).withColumn("p", F.col("user_id") % 4), "ts", "event_id", "p", arrival_block()).withColumn("window", windows.tumbling("ts", "1 hour"))
    return windows.drop_late(rows, F.col("window.end"), "30 minutes")


@query(LATE_COUNTS)
def late1_drop(t):
    return windows.windowed(_on_time(t), "p", "window", F.count("*").alias("n")).select("p", F.col("window.start").alias("start"), "n")


@query("SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type, time_bucket(INTERVAL 1 DAY, ts) ORDER BY event_id) AS n FROM events")
def late2_on_update(t):
    rows = t.events.withColumn("window", windows.tumbling("ts", "1 day"))
    return windows.on_window_update(rows, "event_type", "window", "event_id", ("sum", F.lit(1).cast("long")), "n", arrival_block()).select("event_id", "event_type", "n")


@query(f"SELECT * FROM ({LATE_COUNTS}) JOIN (SELECT user_id % 4 AS p, max(ts) AS now FROM {LATE_SQL} GROUP BY 1) USING (p) WHERE start + INTERVAL 90 MINUTE < now".replace("SELECT * FROM (SELECT", "SELECT p, start, n FROM (SELECT"))
def late4_final_results(t):
    now = late(t).groupBy((F.col("user_id") % 4).alias("p")).agg(F.max("ts").alias("now"))
    counts = late1_drop(t).join(now, "p")
    return windows.suppress_until_close(counts, F.col("start") + F.expr("interval 1 hour"), "30 minutes", F.col("now")).select("p", "start", "n")


@query(f"SELECT event_id, user_id FROM (SELECT *, max(ts) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS st FROM {LATE_SQL}) WHERE ts >= st - INTERVAL 1 HOUR")
def late8_refuse_old(t):
    rows = windows.stream_time(late(t).withColumn("p", F.col("user_id") % 4), "ts", "event_id", "p", arrival_block())
    return windows.refuse_old(rows, "ts", "1 hour").select("event_id", "user_id")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n = 1 OR event_type <> b")
def late8_emit_on_change(t):
    return windows.emit_on_change(t.events.select("event_id", "user_id", "event_type"), "user_id", "event_id", "event_type")
