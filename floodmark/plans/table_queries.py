"""Queries of tables, joins and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history, joins, stateless, tables, windows
from .registry import arrival_block, query

def gone():
    """Events as a changelog of users: an error deletes."""
    return F.col("event_type") == "error"


LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error')"


def users(t):
    return tables.latest(t.events, "user_id", "event_id", gone())


def user_changes(t):
    return tables.changes(t.events, "user_id", ["event_type", "value"], "event_id", gone())


CHANGES = """(SELECT * FROM (SELECT user_id, event_id, n, nv, lag(n) OVER w AS o, lag(nv) OVER w AS ov, lead(1) OVER w IS NULL AS is_latest FROM (
SELECT *, CASE WHEN event_type <> 'error' THEN event_type END AS n, CASE WHEN event_type <> 'error' THEN value END AS nv FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE n IS NOT NULL OR o IS NOT NULL)"""


@query(f"SELECT user_id, event_id, event_type, value FROM {LATEST}")
def src2_table(t):
    return users(t).select("user_id", "event_id", "event_type", "value")


@query("SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def src3_global_table(t):
    return joins.global_join(t.supplier, t.nation, F.col("s_nationkey"), "n_nationkey", ["n_name"], "left").select("s_suppkey", "s_name", F.col("t_n_name").alias("n_name"))


@query(f"SELECT user_id, event_id, n AS new_type, o AS old_type, is_latest FROM {CHANGES}")
def prj14_changes(t):
    return user_changes(t).select("user_id", "event_id", F.col("new.event_type").alias("new_type"), F.col("old.event_type").alias("old_type"), "is_latest")


@query(f"SELECT user_id, event_id, CASE WHEN nv > 20 THEN n END AS new_type, CASE WHEN ov > 20 THEN o END AS old_type FROM {CHANGES} WHERE nv > 20 OR ov > 20")
def prj11_filter_table(t):
    out = tables.filter_table(user_changes(t), lambda c: c["value"] > 20)
    return out.select("user_id", "event_id", F.col("new.event_type").alias("new_type"), F.col("old.event_type").alias("old_type"))


@query(f"SELECT user_id, event_id, upper(n) AS new_type, upper(o) AS old_type FROM {CHANGES}")
def prj12_map_table(t):
    out = tables.map_table(user_changes(t), lambda c: F.struct(F.upper(c["event_type"]).alias("event_type")))
    return out.select("user_id", "event_id", F.col("new.event_type").alias("new_type"), F.col("old.event_type").alias("old_type"))


@query(f"SELECT user_id, round(value * 10, 3) AS score FROM {LATEST}")
def prj13_transform_values(t):
    from ..functions import reducers

    scored = reducers.transform_values(users(t).select("user_id", "value"), lambda b: b.assign(score=(b["value"] * 10).round(3))[["user_id", "score"]], "user_id long, score double")
    return scored.select("user_id", F.round("score", 3).alias("score"))


@query("SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def prj15_to_table(t):
    return tables.stream_to_table(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type").select("user_id", "event_type")


SIGNED = f"(SELECT event_id, o AS g, ov AS v, -1 AS sign FROM {CHANGES} WHERE o IS NOT NULL UNION ALL SELECT event_id, n, nv, 1 FROM {CHANGES} WHERE n IS NOT NULL)"


def signed(t):
    return tables.regroup(user_changes(t), lambda c: c["event_type"])


@query(f'SELECT event_id, g AS "group", sign FROM {SIGNED}')
def key3_regroup(t):
    return signed(t).select("event_id", "group", "sign")


@query(f'SELECT event_type AS "group", count(*) AS count FROM {LATEST} GROUP BY 1')
def agg5_count_table(t):
    return tables.count_table(signed(t)).filter("count > 0")


@query(f'SELECT event_type AS "group", round(sum(value), 2) AS sum FROM {LATEST} GROUP BY 1')
def agg6_sum_table(t):
    return tables.sum_table(signed(t), "value").filter("count > 0").select("group", F.round("sum", 2).alias("sum"))


@query(f'SELECT event_id, g AS "group", (sum(sign) OVER (PARTITION BY g ORDER BY event_id, sign ROWS UNBOUNDED PRECEDING))::BIGINT AS count FROM {SIGNED}')
def agg7_running_aggregate(t):
    return tables.running_count(signed(t), "event_id", arrival_block()).select("event_id", "group", "count")


# --- joins

def of_type(t, kind: str):
    return t.events.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts", "value")


PAIR = """SELECT l.event_id AS l, r.event_id AS r, greatest(l.ts, r.ts) AS result_ts FROM (SELECT * FROM events WHERE event_type = 'click') l
{} JOIN (SELECT * FROM events WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL {} MINUTE AND l.ts + INTERVAL {} MINUTE"""


def _pair(t, how: str, before: int = 7_200_000, after: int = 7_200_000):
    out = joins.window_join(of_type(t, "click"), of_type(t, "purchase"), "user_id", "ts", before, after, how)
    return out.select(F.col("l_event_id").alias("l"), F.col("r_event_id").alias("r"), "result_ts")


@query(PAIR.format("INNER", 120, 120))
def joi1_stream_stream(t):
    return _pair(t, "inner")


@query(PAIR.format("LEFT", 120, 120))
def joi2_stream_stream_left(t):
    return _pair(t, "left")


@query(PAIR.format("FULL", 120, 120))
def joi3_stream_stream_outer(t):
    return _pair(t, "full_outer")


@query(PAIR.format("INNER", 0, 300))
def joi4_asymmetric_window(t):
    return _pair(t, "inner", 0, 18_000_000)


@query("SELECT l.event_id AS l, r.event_id AS r FROM events l JOIN events r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 30 MINUTE AND l.ts + INTERVAL 30 MINUTE")
def joi5_self_join(t):
    return joins.self_join(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", 1_800_000, 1_800_000).select(F.col("l_event_id").alias("l"), F.col("r_event_id").alias("r"))


ARRIVAL = """SELECT * FROM (SELECT s.event_id, s.user_id, (SELECT CASE WHEN c.event_type <> 'error' THEN c.event_type END FROM events c
WHERE c.user_id = s.user_id AND c.event_id < s.event_id AND c.event_type IN ('signup', 'error') ORDER BY c.event_id DESC LIMIT 1) AS state FROM events s WHERE event_type = 'purchase')"""


def _arrival(t, how: str):
    table = t.events.filter(F.col("event_type").isin("signup", "error")).select("user_id", "event_id", "event_type")
    out = joins.stream_table_join(of_type(t, "purchase"), table, "user_id", "event_id", ["event_type"], gone(), how, block=arrival_block())
    return out.select("event_id", "user_id", F.col("t_event_type").alias("state"))


@query(ARRIVAL + " WHERE state IS NOT NULL")
def joi6_stream_table(t):
    return _arrival(t, "inner")


@query(ARRIVAL)
def joi6_stream_table_left(t):
    return _arrival(t, "left")


ASOF = "SELECT o_orderkey, e.event_type, e.value FROM (SELECT *, ts_ AS t FROM (SELECT *, TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 173) % 2592000) AS ts_ FROM orders)) o ASOF LEFT JOIN (SELECT user_id, ts, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2) e ON o.o_custkey % 150 = e.user_id AND o.t >= e.ts"


def _placed(t):
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=((F.col("o_orderkey") * 173) % 2592000).cast("decimal(18,6)"))
    return t.orders.select("o_orderkey", (F.col("o_custkey") % 150).alias("user_id"), at.alias("ts"), F.col("o_orderkey").alias("event_id"))


@query(ASOF)
def joi7_asof(t):
    out = joins.stream_table_join(_placed(t), t.events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "event_id", ["event_type", "value"], how="left", asof="ts")
    return out.select("o_orderkey", F.col("t_event_type").alias("event_type"), F.col("t_value").alias("value"))


VERSIONS = """(SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events)"""


def user_versions(t):
    return history.versions(t.events, "user_id", "ts", "event_id", gone())


@query(f"SELECT o.o_orderkey, v.event_type FROM (SELECT *, TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 173) % 2592000) AS t FROM orders) o JOIN {VERSIONS} v ON o.o_custkey % 150 = v.user_id AND v.ts <= o.t AND (v.valid_to IS NULL OR o.t < v.valid_to) WHERE v.event_type <> 'error'")
def joi7_versioned(t):
    return joins.versioned_join(_placed(t), user_versions(t), "user_id", "ts", ["event_type"]).select("o_orderkey", F.col("t_event_type").alias("event_type"))


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0")
def joi8_global(t):
    mapped = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey"))
    return joins.global_join(t.customer, t.nation, mapped, "n_nationkey", ["n_name"]).select("c_custkey", F.col("t_n_name").alias("n_name"))


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 0")
def joi8_global_left(t):
    mapped = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey"))
    return joins.global_join(t.customer, t.nation, mapped, "n_nationkey", ["n_name"], "left").select("c_custkey", F.col("t_n_name").alias("n_name"))


TABLE_JOIN = """SELECT coalesce(l.user_id, r.k) AS user_id, l.event_type AS state, r.orders, greatest(l.ts, r.t) AS result_ts
FROM {} l {} JOIN (SELECT o_custkey AS k, count(*) AS orders, max(o_orderdate) AS t FROM orders GROUP BY 1) r ON l.user_id = r.k"""


def _table_join(t, how: str):
    counted = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("orders"), F.max("o_orderdate").alias("ts"))
    out = joins.table_join(users(t).select("user_id", "event_type", "ts"), counted, "user_id", how, "ts")
    return out.select("user_id", F.col("l_event_type").alias("state"), F.col("r_orders").alias("orders"), "result_ts")


@query(TABLE_JOIN.format(LATEST, "INNER"))
def joi9_table_table(t):
    return _table_join(t, "inner")


@query(TABLE_JOIN.format(LATEST, "LEFT"))
def joi10_table_table_left(t):
    return _table_join(t, "left")


@query(TABLE_JOIN.format(LATEST, "FULL"))
def joi11_table_table_outer(t):
    return _table_join(t, "full_outer")


@query(TABLE_JOIN.format(LATEST, "RIGHT"))
def joi12_table_table_right(t):
    return _table_join(t, "right")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def joi13_foreign_key(t):
    out = joins.foreign_key_join(t.lineitem, t.orders, F.col("l_orderkey"), "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return out.select("l_orderkey", "l_linenumber", F.col("t_o_orderstatus").alias("o_orderstatus"), F.col("t_o_totalprice").alias("o_totalprice"))


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON CASE WHEN o_orderstatus <> 'F' THEN o_custkey END = c_custkey")
def joi13_foreign_key_left(t):
    fk = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    return joins.foreign_key_join(t.orders, t.customer, fk, "c_custkey", ["c_name"], "left").select("o_orderkey", F.col("t_c_name").alias("c_name"))


@query(f"""SELECT event_id, o AS fk, CASE WHEN n IS NULL THEN 'delete_and_propagate_null' ELSE 'delete' END AS action FROM {CHANGES} WHERE o IS NOT NULL AND o IS DISTINCT FROM n
UNION ALL SELECT event_id, n, 'subscribe' FROM {CHANGES} WHERE n IS NOT NULL""")
def joi14_foreign_key_changes(t):
    return joins.foreign_key_changes(user_changes(t), lambda c: c["event_type"], "left").select("event_id", "fk", "action")


LATE_USERS = "(SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 30 DAY ELSE ts END AS ts) FROM events)"


@query(f"SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM {LATE_USERS}) WHERE r = 1 AND event_type <> 'error'")
def joi17_latest_by_time(t):
    shifted = t.events.withColumn("ts", F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("interval 30 days")).otherwise(F.col("ts")))
    return joins.latest_by_time(shifted, "user_id", "ts", "event_id", gone()).select("user_id", "event_id")


# --- history

@query(f"SELECT user_id, event_type, ts AS valid_from, valid_to FROM {VERSIONS} WHERE event_type <> 'error'")
def his1_versions(t):
    return user_versions(t).select("user_id", "event_type", "valid_from", "valid_to")


@query(f"SELECT user_id, event_type FROM {VERSIONS} WHERE event_type <> 'error' AND ts <= TIMESTAMP '2024-01-20' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-20')")
def his2_as_of(t):
    return history.as_of(user_versions(t), F.lit("2024-01-20").cast("timestamp_ntz")).select("user_id", "event_type")


@query(f"SELECT user_id, event_id FROM {VERSIONS} WHERE event_type <> 'error' AND ts <= TIMESTAMP '2024-01-12' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-10')")
def his3_between(t):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return history.between(user_versions(t), at("2024-01-10"), at("2024-01-12")).select("user_id", "event_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def his4_lookup(t):
    return history.lookup(t.customer, "c_custkey", 42).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey BETWEEN 10 AND 99")
def his5_key_range(t):
    return history.key_range(t.customer, "c_custkey", 10, 99).select("c_custkey", "c_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def his6_prefix_scan(t):
    return history.prefix_scan(t.part, "p_name", "red").select("p_partkey", "p_name")


@query("SELECT count(p_partkey) AS entries FROM part")
def his7_entries(t):
    return history.approximate_entries(t.part, "p_partkey")


@query("SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n FROM events WHERE time_bucket(INTERVAL 1 DAY, ts) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-08' GROUP BY 1, 2")
def his8_window_fetch(t):
    w = windows.windowed(t.events, "user_id", windows.tumbling("ts", "1 day"), F.count("*").alias("n")).select("user_id", F.col("window.start").alias("start"), "n")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return history.window_fetch(w, at("2024-01-05"), at("2024-01-08"))


@query("""SELECT * FROM (SELECT user_id, min(ts) AS start, max(ts) AS "end" FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s)
WHERE "end" >= TIMESTAMP '2024-01-10' AND start <= TIMESTAMP '2024-01-11'""")
def his9_find_sessions(t):
    s = windows.sessions(t.events, "user_id", "ts", "2 hours", F.count("*").alias("n")).select("user_id", "start", "end")
    return history.find_sessions(s, F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-11").cast("timestamp_ntz"))


@query(f"""SELECT user_id, event_type FROM {LATEST} WHERE event_type = 'view'
UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM {LATEST} WHERE event_type = 'view')""")
def his12_put_if_absent(t):
    held = users(t).filter(F.col("event_type") == "view").select("user_id", "event_type")
    puts = t.orders.select(F.col("o_custkey").alias("user_id"), F.lit("new").alias("event_type"), F.col("o_orderkey").alias("order"))
    return history.apply_puts(held, puts, "user_id", "order", "put_if_absent")


# --- the query of entry()

@query("""SELECT c_mktsegment AS segment, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS clicks FROM events
JOIN customer ON user_id = c_custkey WHERE event_type = 'click' GROUP BY 1, 2""")
def flagship_clicks_by_segment(t):
    clicks = stateless.filter_rows(t.events, F.col("event_type") == "click")
    segments = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    joined = clicks.join(segments, "user_id").withColumnRenamed("c_mktsegment", "segment")
    out = windows.windowed(joined, "segment", windows.tumbling("ts", "1 hour"), F.count("*").alias("clicks"))
    return out.select("segment", F.col("window.start").alias("start"), "clicks")


@query("SELECT o_orderkey, o_custkey, o_custkey || ':' || o_orderstatus || '/' || coalesce(c_mktsegment, '?') AS value FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def joi15_keyed_joiner(t):
    """A joiner that reads the key."""
    pairs = joins.global_join(t.orders, t.customer, F.col("o_custkey"), "c_custkey", ["c_mktsegment"], "left")
    text = lambda key, left, right: F.concat(key, F.lit(":"), left, F.lit("/"), F.coalesce(right, F.lit("?")))
    return joins.joined_value(pairs, text, "o_custkey", "o_orderstatus", "t_c_mktsegment").select("o_orderkey", "o_custkey", "value")


@query("SELECT l_returnflag || l_linestatus AS key, count(*) AS n FROM lineitem GROUP BY 1")
def key2_group_by_mapped_key(t):
    return stateless.group_by_key(t.lineitem, F.concat("l_returnflag", "l_linestatus")).agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS reads, max(event_id) AS position FROM events GROUP BY 1")
def his10_position(t):
    log = t.events.select(F.lit("events").alias("topic"), F.col("user_id").alias("partition"), F.col("event_id").alias("offset"))
    reads = log.groupBy("partition").agg(F.count("*").alias("reads"))
    return history.position(log).join(reads, "partition").select(F.col("partition").alias("user_id"), "reads", F.col("offset").alias("position"))
