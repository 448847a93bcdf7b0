"""Queries on tables in files, connectors, transactions, samples and envelopes."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.places import shared_folder
from ..functions.times import epoch_millis
from ..operators import history, replication, samples, stateless, tables, transactions, transforms, windows
from ..sources import connectors, convert, envelopes
from ..sources.keyed_tables import KeyedTable
from .log_queries import LOG, log, measured
from .record_queries import order_records
from .registry import arrival_block, query
from .table_queries import CHANGES, LATEST, SIGNED, signed, user_changes, users


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'error'")
def his12_upserted(t):
    """The whole changelog in four batches, the last of them twice, into a table in files."""
    rows = t.events.select("user_id", "event_type", "event_id")
    table = KeyedTable(t.spark, shared_folder(t.spark, "upserted"), "user_id", "event_id", 16)
    bound = rows.agg((F.max("event_id") / 4).cast("long")).first()[0] or 0
    parts = [F.floor(F.col("event_id") / F.lit(bound + 1)) == i for i in range(4)]
    for i in (0, 1, 2, 3, 3):
        table.upsert(rows.filter(parts[i]), i, "q", F.col("event_type") == "error")
    return table.read()


@query("SELECT event_id, event_type, user_id FROM events")
def src16_connectors(t):
    """Events through a sink with whole commits, and back through a source with offsets by file."""
    folder = shared_folder(t.spark, "connected")
    connectors.register(t.spark, "json_files", sink=connectors.JsonFiles)
    connectors.register(t.spark, "line_files", connectors.LineFiles)
    t.events.select("event_id", "event_type", "user_id").write.format("json_files").option("path", folder).mode("append").save()
    lines = t.spark.read.format("line_files").option("path", f"{folder}/data").load()
    names = [n.rpartition("/")[2] for n in connectors.committed_files(folder)]
    rows = lines.filter(F.col("file").isin(names)).select(F.from_json("value", "event_id long, event_type string, user_id long").alias("v"))
    return rows.select("v.*")


@query("SELECT c_custkey, k FROM (SELECT c_custkey, (c_custkey * 37) % 1001 - 500 AS k FROM customer) WHERE k >= 400 OR k < -450")
def his5_byte_order(t):
    """A range from 400 up over keys ordered by their bytes goes on with the negative ones."""
    keyed = t.customer.select("c_custkey", ((F.col("c_custkey") * 37) % 1001 - 500).alias("k"))
    return history.key_range_by_bytes(keyed, "k", 400, -451)


@query("SELECT c_custkey, row_number() OVER (ORDER BY (c_custkey % 201 - 100 < 0), c_custkey % 201 - 100, c_custkey) AS place FROM customer")
def his5_byte_ranks(t):
    """Ranks of encoded keys: by sign, then by value."""
    keyed = t.customer.select("c_custkey", convert.key_bytes(F.col("c_custkey") % 201 - 100, "long").alias("k"))
    before = keyed.groupBy("k").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("c_custkey")).alias("keys"))
    # a row for each of 201 keys is small enough for one ordered sum
    starts = before.select("keys", (F.expr("sum(n) OVER (ORDER BY k) - n")).alias("start"))
    return starts.select("start", F.posexplode("keys").alias("i", "c_custkey")).select("c_custkey", (F.col("start") + F.col("i") + 1).alias("place"))


MARKED = f"(SELECT partition, off, event_id, CASE WHEN key % 10 < 6 THEN key % 10 END AS producer, CASE WHEN key % 10 < 6 AND event_id % 9 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'abort' ELSE 'commit' END END AS control FROM {LOG})"
SPANS = f"""(SELECT partition, producer, nth, min(CASE WHEN control IS NULL THEN off END) AS first_offset, max(CASE WHEN control IS NOT NULL THEN off END) AS last_offset, coalesce(max(control), 'open') AS outcome FROM (
SELECT *, count(control) OVER (PARTITION BY partition, producer ORDER BY off) - (control IS NOT NULL)::INT AS nth FROM {MARKED} WHERE producer IS NOT NULL) GROUP BY 1, 2, 3 HAVING min(CASE WHEN control IS NULL THEN off END) IS NOT NULL)"""


def _marked(t):
    """Six producers in each partition, whose every ninth record is a marker; the other records belong to no transaction."""
    producer = F.when(F.col("key") % 10 < 6, F.col("key") % 10)
    control = F.when(producer.isNotNull() & (F.col("event_id") % 9 == 0), F.when(F.col("event_id") % 2 == 0, "abort").otherwise("commit"))
    return log(t).withColumns({"producer_id": producer, "control": control})


@query(f"SELECT partition, producer AS producer_id, first_offset, last_offset, outcome FROM {SPANS}")
def log9_transactions(t):
    return transactions.transactions(_marked(t)).select("partition", "producer_id", "first_offset", "last_offset", "outcome")


@query(f"""SELECT m.partition, off AS "offset" FROM {MARKED} m LEFT JOIN (SELECT partition, min(first_offset) AS stable FROM {SPANS} WHERE outcome = 'open' GROUP BY 1) s ON m.partition = s.partition
WHERE control IS NULL AND (stable IS NULL OR off < stable) AND NOT EXISTS (SELECT 1 FROM {SPANS} a WHERE a.outcome = 'abort' AND a.partition = m.partition AND a.producer = m.producer AND m.off BETWEEN a.first_offset AND a.last_offset)""")
def log9_committed_view(t):
    return transactions.committed_view(_marked(t)).select("partition", "offset")


@query(f"SELECT p.partition, coalesce(min(first_offset), any_value(p.e)) AS last_stable_offset FROM (SELECT partition, max(off) + 1 AS e FROM {LOG} GROUP BY 1) p LEFT JOIN (SELECT * FROM {SPANS} WHERE outcome = 'open') s ON p.partition = s.partition GROUP BY 1")
def log9_last_stable(t):
    return transactions.last_stable_offsets(_marked(t)).drop("topic")


@query("""WITH RECURSIVE m AS (SELECT event_type AS metric, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
s AS (SELECT metric, 1::BIGINT AS i, (SELECT min(ms) FROM m x WHERE x.metric = m.metric) AS ms FROM (SELECT DISTINCT metric FROM m) m
UNION ALL SELECT s.metric, n.i, n.ms FROM s, LATERAL (SELECT m.i, m.ms FROM m WHERE m.metric = s.metric AND m.i > s.i AND (m.ms >= s.ms + 3600000 OR m.i >= s.i + 20) ORDER BY m.i LIMIT 1) n)
SELECT s.metric, s.i - 1 AS sample, (SELECT count(*) FROM m WHERE m.metric = s.metric AND m.i >= s.i AND m.i < coalesce((SELECT min(x.i) FROM s x WHERE x.metric = s.metric AND x.i > s.i), 9223372036854775807)) AS n FROM s""")
def sta1_closed_samples(t):
    """Samples that end after an hour or 20 events."""
    rows = samples.closed_samples(measured(t), "ts", "event_id", 3_600_000, 20)
    return rows.groupBy("metric", "sample").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS id, o_totalprice::DECIMAL(38, 2)::VARCHAR AS price, epoch_us(o_orderdate) // 1000 AS at, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, [o_orderkey, NULL] AS keys, 'normal' AS class FROM orders")
def cnv1_envelopes(t):
    """Orders into envelopes, and out of them by the schema that they carry; a field with a default comes back filled."""
    at = F.col("o_orderdate").cast("timestamp")
    value = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(38,2)").alias("price"), at.alias("at"), F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status"),
        F.array("o_orderkey", F.lit(None).cast("long")).alias("keys"), F.lit(None).cast("string").alias("class"),
    )
    rows = envelopes.to_envelopes(t.orders.select(value.alias("value")), "value")
    schema = envelopes.schema_of(rows, "value")
    schema["fields"][-1]["default"] = "normal"
    rows = rows.withColumn("value", F.concat(F.lit('{"schema":' + json.dumps(schema) + ',"payload":'), F.get_json_object("value", "$.payload"), F.lit("}")))
    v = envelopes.from_envelopes(rows, "value").select("value.*")
    return v.select("id", F.col("price").cast("string").alias("price"), epoch_millis(F.col("at")).alias("at"), "day", "status", "keys", "class")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'integer' WHEN event_id % 3 = 1 THEN 'json' ELSE 'string' END AS type, CASE WHEN event_id % 3 = 0 THEN user_id END AS number, CASE WHEN event_id % 3 = 2 THEN event_type END AS text FROM events")
def cnv2_header_values(t):
    text = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string")).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.col("event_type"))
    v = t.events.select("event_id", convert.header_value(text).alias("v"))
    return v.select("event_id", "v.type", F.col("v.integer").alias("number"), F.col("v.string").alias("text"))


@query("""WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS t, event_type, value FROM events WHERE event_type IN ('view', 'click')),
s AS (SELECT user_id, t - 1800000 AS start_ms FROM e UNION SELECT user_id, t + 1 FROM e)
SELECT e.user_id, start_ms, start_ms + 1800000 AS end_ms, count(*) FILTER (event_type = 'view') AS views, max(value) FILTER (event_type = 'click') AS top FROM e JOIN s ON e.user_id = s.user_id AND t BETWEEN start_ms AND start_ms + 1800000 GROUP BY 1, 2""")
def win8_cogroup_sliding(t):
    of = lambda kind: t.events.filter(F.col("event_type") == kind).select("user_id", "ts", "value")
    results = {"views": ("count", F.when(F.col("stream") == "views", 1)), "top": ("max", F.when(F.col("stream") == "clicks", F.col("value")))}
    return windows.cogroup_sliding({"views": of("view"), "clicks": of("click")}, "user_id", "ts", 1_800_000, results)


# --- transforms whose results differ from row to row

@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 1 THEN 'lane' ELSE '' END AS left_over FROM orders")
def smt2_headers_by_row(t):
    lane = F.array(F.struct(F.lit("lane").alias("key"), F.lit("7").cast("binary").alias("value")))
    rows = order_records(t).withColumn("headers", F.when(F.col("offset") % 2 == 1, F.concat("headers", lane, "headers")).otherwise(F.col("headers")))
    out = rows.transform(transforms.drop_headers(["origin"]))
    return out.select(F.col("offset").alias("id"), F.array_join(F.transform("headers", lambda h: h["key"]), ",").alias("left_over"))


@query("SELECT o_orderkey AS id, o_orderstatus || CASE WHEN o_orderstatus = 'O' THEN ',v1' ELSE '' END AS headers FROM orders")
def smt9_headers_where(t):
    out = order_records(t).transform(transforms.only_where(F.col("value.status") == "O", transforms.insert_header("version", "v1")))
    return out.select(F.col("offset").alias("id"), F.array_join(F.transform("headers", lambda h: h["value"].cast("string")), ",").alias("headers"))


@query("SELECT o_orderkey AS id, CASE WHEN o_totalprice > 100000 THEN '' ELSE o_orderstatus END AS status, CASE WHEN o_totalprice > 100000 THEN 0 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus = 'F' THEN '***' ELSE o_orderpriority END AS priority FROM orders")
def smt10_mask_where(t):
    large = transforms.only_where(F.col("value.price") > 100000, transforms.mask_field(["status", "price"]))
    # the status is looked at before it is masked
    done = order_records(t).transform(transforms.only_where(F.col("value.status") == "F", transforms.mask_field(["info.priority"], "***"))).transform(large)
    return done.select("value.id", "value.status", "value.price", "value.info.priority")


@query("SELECT o_orderkey AS id, strftime(o_orderdate, '%m') || '-of-' || strftime(o_orderdate, '%Y') AS topic FROM orders")
def smt11_routes_by_row(t):
    out = order_records(t).transform(transforms.regex_router(r"orders-(\d{4})(\d{2})\d{2}", "$2-of-$1")).transform(transforms.regex_router(r"orders-.*", "never"))
    return out.select(F.col("offset").alias("id"), "topic")


@query("SELECT event_type AS key, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY 1")
def key1_without_key(t):
    """Every tenth record has no key and takes no part."""
    key = F.when(F.col("event_id") % 10 != 0, F.col("event_type"))
    return stateless.group_by_key(t.events, key).agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n, 1::BIGINT AS places FROM events GROUP BY 1")
def key4_one_place_a_key(t):
    """All records of a key are in one partition of the seven asked for."""
    rows = stateless.repartition(t.events, 7, "user_id").select("user_id", F.spark_partition_id().alias("p"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("p") < 7, F.col("p"))).alias("places"))


@query("SELECT event_type AS topic, time_bucket(INTERVAL 1 DAY, ts + to_seconds(event_id % 10)) AS start, min(event_id % 10) * 1000 AS age_min, round(avg(event_id % 10) * 1000, 4) AS age_avg, max(event_id % 10) * 1000 AS age_max FROM events GROUP BY 1, 2")
def rep9_ages(t):
    late = F.col("timestamp") + F.make_dt_interval(secs=(F.col("event_id") % 10).cast("decimal(18,6)"))
    out = replication.metrics(t.events.select(F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"), "props", "event_id"), "1 day", F.length("props"), late)
    return out.select("topic", "start", "age_min", F.round("age_avg", 4).alias("age_avg"), "age_max")


@query(f"SELECT coalesce(n, 'gone') || '/' || user_id AS key, event_id, n AS event_type FROM {CHANGES}")
def prj14_to_stream(t):
    """A table's changes as a stream under a key made of each row."""
    out = tables.to_stream(user_changes(t), F.concat_ws("/", F.coalesce("value.event_type", F.lit("gone")), "user_id"))
    return out.select("key", "event_id", F.col("value.event_type").alias("event_type"))


@query(f"""SELECT event_id, g AS "group", (sum(sign) OVER w)::BIGINT AS count, round(sum(sign * coalesce(v, 0)) OVER w, 2) + 0.0 AS total FROM (
SELECT event_id, n AS g, 1 AS sign, nv AS v FROM {CHANGES} WHERE n IS NOT NULL UNION ALL SELECT event_id, o, -1, ov FROM {CHANGES} WHERE o IS NOT NULL)
WINDOW w AS (PARTITION BY g ORDER BY event_id, sign ROWS UNBOUNDED PRECEDING)""")
def agg7_running_sum(t):
    out = tables.running_sum(signed(t), "value", "event_id", arrival_block())
    return out.select("event_id", "group", "count", (F.round(F.coalesce("sum", F.lit(0.0)), 2) + F.lit(0.0)).alias("total"))


@query(f"""WITH p AS (SELECT o_custkey AS user_id, arg_max(o_orderstatus, o_orderkey) AS event_type FROM orders GROUP BY 1)
SELECT user_id, event_type FROM p WHERE event_type <> 'F' UNION ALL SELECT user_id, event_type FROM {LATEST} WHERE user_id NOT IN (SELECT user_id FROM p)""")
def his12_put(t):
    """The last put of a key holds, and one of a closed order takes the key out."""
    puts = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("event_type"), F.col("o_orderkey").alias("order"))
    return history.apply_puts(users(t).select("user_id", "event_type"), puts, "user_id", "order", deleted=F.col("event_type") == "F")


@query(f"SELECT user_id, event_type FROM {LATEST} WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def his12_delete(t):
    gone = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id"))
    return history.apply_puts(users(t).select("user_id", "event_type"), gone, "user_id", "user_id", "delete")


@query(f"SELECT user_id, event_type FROM {LATEST}")
def his7_scan(t):
    return history.scan(users(t).select("user_id", "event_type"), "user_id", reverse=True)
