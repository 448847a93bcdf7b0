"""Queries of replication, record logs and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.running import numbers
from ..functions.times import epoch_millis
from ..operators import replication, stats, topics
from .registry import arrival_block, query


def log(t):
    """Events as a log: partition by user, gapless offsets of arrival."""
    part = (F.col("user_id") % 4).cast("int")
    value = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = t.events.select(F.lit("events").alias("topic"), part.alias("partition"), F.col("ts").alias("timestamp"), F.col("user_id").alias("key"), value.alias("value"), "event_id", F.length("props").alias("size"))
    return numbers(rows, ["topic", "partition"], ["event_id"], arrival_block())


LOG = "(SELECT 'events' AS topic, (user_id % 4)::INT AS partition, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS off, ts, user_id AS key, CASE WHEN event_type <> 'error' THEN event_type END AS value, event_id, length(props) AS size FROM events)"


# --- replication

@query("SELECT topic, count(*) AS n FROM (SELECT CASE event_type WHEN 'error' THEN '__errors' WHEN 'view' THEN 'view.replica' ELSE event_type END AS topic FROM events) WHERE topic NOT LIKE '\\_\\_%' ESCAPE '\\' AND topic NOT LIKE '%.replica' GROUP BY 1")
def rep1_topic_filter(t):
    name = F.when(F.col("event_type") == "error", "__errors").when(F.col("event_type") == "view", "view.replica").otherwise(F.col("event_type"))
    return replication.included(t.events.select(name.alias("topic"))).groupBy("topic").agg(F.count("*").alias("n"))


@query("SELECT 'group-' || (c_custkey % 10) AS \"group\", c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'")
def rep2_group_filter(t):
    group = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "console-consumer-").otherwise("group-"), (F.col("c_custkey") % 10).cast("string"))
    return replication.included(t.customer.select(group.alias("group"), "c_custkey"), "group", exclude=replication.EXCLUDED_GROUPS)


@query("SELECT DISTINCT event_type AS topic, 'west.east.' || event_type AS remote, 'west' AS source, 'east.' || event_type AS upstream, event_type AS original, 2::INT AS hops, false AS internal FROM events")
def rep3_names(t):
    remote = replication.remote_topic("west", replication.remote_topic("east", F.col("event_type")))
    rows = t.events.select("event_type").distinct().select(F.col("event_type").alias("topic"), remote.alias("remote"))
    c = F.col("remote")
    return rows.select("topic", "remote", replication.topic_source(c).alias("source"), replication.upstream_topic(c).alias("upstream"), replication.original_topic(c).alias("original"), replication.hops(c).alias("hops"), replication.is_internal(c).alias("internal"))


@query(f"SELECT 'east.events' AS topic, partition, row_number() OVER (PARTITION BY partition ORDER BY off) - 1 AS \"offset\", off AS upstream_offset, event_id FROM {LOG} WHERE value IS NOT NULL")
def rep5_copy(t):
    out = replication.replicate(log(t).filter("value is not null"), "east")
    return out.select("topic", "partition", "offset", "upstream_offset", "event_id")


SYNCS = f"(SELECT partition, min(off) AS up, arg_min(d, off) AS down FROM (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY off) - 1 AS d FROM {LOG} WHERE value IS NOT NULL) GROUP BY partition, off // 100)"


@query(f"SELECT partition, up AS upstream_offset, down AS downstream_offset FROM {SYNCS}")
def rep6_offset_syncs(t):
    replica = replication.replicate(log(t).filter("value is not null"), "east")
    return replication.offset_syncs(replica, 100).select("partition", "upstream_offset", "downstream_offset")


@query(f"SELECT 'g' || c.key AS \"group\", c.partition, c.off AS upstream_offset, s.down + CASE WHEN c.off > s.up THEN 1 ELSE 0 END AS downstream_offset FROM (SELECT key, partition, max(off) AS off FROM {LOG} GROUP BY 1, 2) c ASOF JOIN {SYNCS} s ON c.partition = s.partition AND c.off >= s.up")
def rep7_translate_offsets(t):
    replica = replication.replicate(log(t).filter("value is not null"), "east")
    committed = log(t).groupBy(F.concat(F.lit("g"), F.col("key")).alias("group"), "partition").agg(F.max("offset").alias("committed_offset"))
    syncs = replication.offset_syncs(replica, 100).withColumn("topic", F.lit("events"))
    return replication.translate_offsets(committed.withColumn("topic", F.lit("events")), syncs).drop("topic")


@query("SELECT event_type AS topic, time_bucket(INTERVAL 1 DAY, ts + INTERVAL 5 SECOND) AS start, round(count(*) / 86400.0, 8)::DOUBLE AS record_rate, round(sum(length(props)) / 86400.0, 8)::DOUBLE AS byte_rate, 5000::BIGINT AS age_min, 5000::DOUBLE AS age_avg, 5000::BIGINT AS age_max FROM events GROUP BY 1, 2")
def rep9_metrics(t):
    out = replication.metrics(t.events.select(F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"), "props"), "1 day", F.length("props"), F.col("timestamp") + F.expr("interval 5 seconds"))
    return out.withColumns({"record_rate": F.round("record_rate", 8), "byte_rate": F.round("byte_rate", 8)})


# --- logs

@query(f"SELECT topic, partition, min(off) AS begin_offset, max(off) + 1 AS end_offset FROM {LOG} GROUP BY 1, 2")
def log1_offsets(t):
    return topics.offsets(log(t))


@query(f"SELECT partition, min(off) AS \"offset\" FROM {LOG} WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def log2_offsets_for_time(t):
    return topics.offsets_for_time(log(t), F.lit("2024-01-10").cast("timestamp_ntz")).select("partition", "offset")


@query(f"SELECT l.partition, d.day AS time, min(off) AS \"offset\" FROM {LOG} l JOIN (SELECT DISTINCT date_trunc('day', ts) AS day FROM events) d ON l.ts >= d.day GROUP BY 1, 2")
def log2_offsets_for_times(t):
    days = t.events.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time")).distinct()
    asked = days.withColumn("topic", F.lit("events")).withColumn("partition", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return topics.offsets_for_times(log(t), asked).select("partition", "time", "offset")


@query(f"SELECT partition, arg_max(off, ts) AS newest, min(off) AS earliest, max(off) + 1 AS latest FROM {LOG} GROUP BY 1")
def log3_offset_specs(t):
    return topics.offsets_of(log(t), {"newest": "max_timestamp", "earliest": "earliest", "latest": "latest"}).drop("topic")


@query(f"SELECT partition, off AS \"offset\", event_id FROM {LOG} WHERE off >= 100 AND off < 900")
def log4_read_range(t):
    return topics.read_range(log(t), 100, 900).select("partition", "offset", "event_id")


@query(f"SELECT event_type AS \"group\", partition, e - c AS lag FROM (SELECT event_type, (user_id % 4)::INT AS partition, max(o) + 1 AS c FROM (SELECT *, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS o FROM events) GROUP BY 1, 2) JOIN (SELECT partition, max(off) + 1 AS e FROM {LOG} GROUP BY 1) USING (partition)")
def log5_lag(t):
    kind = F.coalesce("value", F.lit("error"))
    committed = log(t).groupBy(kind.alias("group"), "topic", "partition").agg((F.max("offset") + 1).alias("committed_offset"))
    return topics.lag(committed, log(t)).select("group", "partition", "lag")


@query(f"SELECT partition, off AS \"offset\" FROM {LOG} WHERE off >= partition * 200")
def log7_delete_before(t):
    low = log(t).select("topic", "partition").distinct().withColumn("offset", (F.col("partition") * 200).cast("long"))
    return topics.delete_before(log(t), low).select("partition", "offset")


@query(f"SELECT partition, key, max(off) AS \"offset\", arg_max(coalesce(value, '(deleted)'), off) AS value FROM {LOG} GROUP BY 1, 2")
def log8_compact(t):
    return topics.compact(log(t)).select("partition", "key", "offset", F.coalesce("value", F.lit("(deleted)")).alias("value"))


@query(f"SELECT partition, off AS \"offset\" FROM {LOG} WHERE NOT (key % 10 = 3 AND off BETWEEN 200 AND 700)")
def log9_read_committed(t):
    rows = log(t).withColumn("producer_id", F.col("key") % 10)
    aborted = rows.select("topic", "partition").distinct().select("topic", "partition", F.lit(3).alias("producer_id"), F.lit(200).alias("first_offset"), F.lit(700).alias("last_offset"))
    return topics.read_committed(rows, aborted).select("partition", "offset")


@query(f"SELECT partition, count(*) AS n FROM {LOG} WHERE partition >= 1 AND partition < 3 GROUP BY 1")
def log10_partition_filter(t):
    return topics.filter_partitions(log(t), topic="events", low=1, high=3).groupBy("partition").agg(F.count("*").alias("n"))


@query(f"SELECT partition, off AS \"offset\" FROM (SELECT *, sum(size) OVER (PARTITION BY partition ORDER BY off DESC) AS s FROM {LOG} WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 14 DAY) WHERE s <= 5000")
def log11_retention(t):
    kept = topics.retain_time(log(t), "14 days", F.lit("2024-01-30").cast("timestamp_ntz"))
    return topics.retain_bytes(kept, F.col("size"), 5000).select("partition", "offset")


# --- statistics

def measured(t):
    return t.events.select(F.col("event_type").alias("metric"), "ts", "value", "event_id")


@query("SELECT event_type AS metric, time_bucket(INTERVAL 1 DAY, ts) AS start, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max, round(sum(value), 2) AS sum, count(value) AS count FROM events GROUP BY 1, 2")
def sta1_sampled(t):
    out = stats.sampled(measured(t), "ts", "1 day", *stats.basic())
    return out.withColumns({"avg": F.round("avg", 6), "sum": F.round("sum", 2)})


@query("SELECT event_id, round(sum(value) OVER w, 2) AS cumulative_sum, count(value) OVER w AS cumulative_count FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def sta3_cumulative(t):
    return stats.cumulative(measured(t), "event_id", block=arrival_block()).select("event_id", F.round("cumulative_sum", 2).alias("cumulative_sum"), "cumulative_count")


@query("""SELECT metric, start, round(s / 3600, 8) AS simple_rate, round(sum(s) OVER (PARTITION BY metric ORDER BY start RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) / 10800, 8) AS rate,
round(sum(s) OVER (PARTITION BY metric ORDER BY start), 2) AS total FROM (SELECT event_type AS metric, time_bucket(INTERVAL 1 HOUR, ts) AS start, sum(value) AS s FROM events GROUP BY 1, 2)""")
def sta4_rates(t):
    out = stats.rates(measured(t), "ts", "1 hour", 3)
    return out.select("metric", "start", F.round("simple_rate", 8).alias("simple_rate"), F.round("rate", 8).alias("rate"), F.round("total", 2).alias("total"))


@query("SELECT event_type AS metric, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
def sta5_percentiles(t):
    out = stats.percentiles(measured(t), [0.5, 0.95, 0.99])
    return out.select("metric", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query("SELECT event_type AS metric, least(greatest(floor(value / 100 * 20), 0), 19)::INT AS bucket, count(*) AS count FROM events GROUP BY 1, 2")
def sta5_histogram(t):
    return stats.histogram(measured(t), 0, 100, 20)


@query("SELECT metric, bucket, round(count / sum(count) OVER (PARTITION BY metric), 8) AS frequency FROM (SELECT event_type AS metric, least(greatest(floor(value / 100 * 4), 0), 3)::INT AS bucket, count(*) AS count FROM events GROUP BY 1, 2)")
def sta6_frequencies(t):
    return stats.frequencies(measured(t), 0, 100, 4).select("metric", "bucket", F.round("frequency", 8).alias("frequency"))


@query("SELECT event_type AS metric, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def sta7_last_value(t):
    return stats.last_value(measured(t), "event_id")


@query("SELECT event_type AS metric, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 4")
def sta8_quota(t):
    w = stats.sampled(measured(t), "ts", "1 hour", F.count("*").alias("n"))
    return stats.out_of_quota(w, "n", 4).select("metric", "start", "n")


@query("SELECT event_type AS topic, (epoch_us(max(ts)) // 1000) AS ms FROM events GROUP BY 1")
def rep8_heartbeats(t):
    beats = replication.heartbeats(t.events.withColumnRenamed("ts", "timestamp"), F.col("event_type"), "target")
    return beats.select(F.col("key.source_cluster").alias("topic"), epoch_millis(F.col("timestamp")).alias("ms"))
