"""Queries of record transforms, conversions and error handling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import errors, transforms
from ..sources import convert, records
from .registry import query


def order_records(t):
    """Orders as records with struct values."""
    value = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.struct(F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("priority")).alias("info"))
    header = F.array(F.struct(F.lit("origin").alias("key"), F.col("o_orderstatus").cast("binary").alias("value")))
    return t.orders.select(
        F.concat(F.lit("orders-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("topic"), (F.col("o_custkey") % 4).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
        F.col("o_orderdate").alias("timestamp"), F.lit(0).alias("timestampType"), F.col("o_custkey").alias("key"), value.alias("value"), header.alias("headers"),
    )


@query("SELECT o_orderkey AS id, o_totalprice::VARCHAR AS price, o_orderkey::INTEGER AS small FROM orders")
def smt1_cast(t):
    out = order_records(t).transform(transforms.cast({"price": "string", "id": "int"}))
    return out.select(F.col("offset").alias("id"), "value.price", F.col("value.id").alias("small"))


@query("SELECT o_orderkey AS id, 0::BIGINT AS headers FROM orders")
def smt2_drop_headers(t):
    out = order_records(t).transform(transforms.drop_headers(["origin"]))
    return out.select(F.col("offset").alias("id"), F.size("headers").cast("long").alias("headers"))


@query("SELECT o_orderkey AS id, o_orderpriority AS value FROM orders")
def smt3_extract_field(t):
    return order_records(t).transform(transforms.extract_field("info.priority")).select(F.col("offset").alias("id"), "value")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'")
def smt4_filter(t):
    return order_records(t).transform(transforms.drop_where(F.col("value.status") == "F")).select(F.col("offset").alias("id"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS info_date, o_orderpriority AS info_priority FROM orders")
def smt5_flatten(t):
    return order_records(t).transform(transforms.flatten("_")).select("value.*")


@query("SELECT o_orderkey AS id, 'origin:' || o_orderstatus || ',state:' || o_orderstatus AS headers, o_totalprice AS price FROM orders")
def smt6_header_from(t):
    out = order_records(t).transform(transforms.header_from(["status"], ["state"], "move"))
    pairs = F.transform("headers", lambda h: F.concat(h["key"], F.lit(":"), h["value"].cast("string")))
    return out.select(F.col("offset").alias("id"), F.array_join(pairs, ",").alias("headers"), "value.price")


@query("SELECT o_orderkey AS id, o_custkey AS customer FROM orders")
def smt7_hoist_field(t):
    return order_records(t).transform(transforms.hoist_field("customer", on="key")).select(F.col("offset").alias("id"), "key.customer")


@query("SELECT o_orderkey AS id, 'orders-' || strftime(o_orderdate, '%Y%m%d') AS source, 'batch' AS via FROM orders")
def smt8_insert_field(t):
    out = order_records(t).transform(transforms.chain(transforms.insert_field("source", "topic"), transforms.insert_field("via", static="batch")))
    return out.select("value.id", "value.source", "value.via")


@query("SELECT o_orderkey AS id, 'v1' AS version FROM orders")
def smt9_insert_header(t):
    out = order_records(t).transform(transforms.insert_header("version", "v1"))
    return out.select(F.col("offset").alias("id"), F.element_at("headers", -1)["value"].cast("string").alias("version"))


@query("SELECT o_orderkey AS id, '' AS status, 0::DOUBLE AS price, '***' AS priority FROM orders")
def smt10_mask_field(t):
    out = order_records(t).transform(transforms.chain(transforms.mask_field(["status", "price"]), transforms.mask_field(["info.priority"], "***")))
    return out.select("value.id", "value.status", "value.price", "value.info.priority")


@query("SELECT o_orderkey AS id, 'index' AS topic FROM orders")
def smt11_regex_router(t):
    out = order_records(t).transform(transforms.regex_router(r"(.*)-(\d{8})", "$1")).transform(transforms.regex_router("orders", "index"))
    return out.select(F.col("offset").alias("id"), "topic")


@query("SELECT o_orderkey AS number, o_orderstatus AS status FROM orders")
def smt12_replace_field(t):
    return order_records(t).transform(transforms.replace_field(include=["id", "status", "price"], exclude=["price"], renames={"id": "number"})).select("value.*")


@query("SELECT o_orderkey AS id, strftime(o_orderdate, '%Y/%m/%d') AS day FROM orders")
def smt14_timestamp_converter(t):
    return order_records(t).transform(transforms.convert_timestamp("string", "info.date", "yyyy/MM/dd")).select("value.id", F.col("value.info.date").alias("day"))


@query("SELECT o_orderkey AS id, 'orders-' || strftime(o_orderdate, '%Y%m%d') || '-' || strftime(o_orderdate, '%Y%m') AS topic FROM orders")
def smt15_timestamp_router(t):
    return order_records(t).transform(transforms.timestamp_router(timestamp_format="yyyyMM")).select(F.col("offset").alias("id"), "topic")


@query("SELECT o_orderkey::DOUBLE AS id, o_orderstatus AS status, 'none' AS note FROM orders")
def smt16_schema_projector(t):
    out = order_records(t)
    target = T.StructType([T.StructField("id", T.DoubleType()), T.StructField("status", T.StringType()), T.StructField("note", T.StringType(), False, {"default": "none"})])
    return out.transform(transforms.project(out.schema["value"].dataType, target)).select("value.*")


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def smt17_value_to_key(t):
    return order_records(t).transform(transforms.value_to_key(["id", "status"])).select("key.*")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'orders-' || strftime(o_orderdate, '%Y%m%d') END AS topic FROM orders WHERE o_totalprice >= 1000")
def smt20_chain(t):
    closed = F.col("value.status") == "F"
    steps = transforms.chain(transforms.drop_where(F.col("value.price") < 1000), transforms.only_where(closed, transforms.regex_router(".*", "done")))
    return order_records(t).transform(steps).select(F.col("offset").alias("id"), "topic")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus IS NOT NULL AND regexp_full_match('orders-' || strftime(o_orderdate, '%Y%m%d'), 'orders-1998.*')")
def smt19_predicates(t):
    hit = transforms.has_header_key("origin") & ~transforms.is_tombstone() & transforms.topic_name_matches("orders-1998.*")
    return order_records(t).filter(hit).select(F.col("offset").alias("id"))


# --- conversions

@query("SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def cnv1_from_json(t):
    return t.events.select("event_id", convert.from_json(F.col("props"), "k int")["k"].alias("k"))


@query("""SELECT c_custkey, '{"schema":"customer","payload":{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}}' AS text FROM customer""")
def cnv1_to_json(t):
    return t.customer.select("c_custkey", convert.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), '"customer"').alias("text"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'integer' WHEN event_id % 3 = 1 THEN 'json' ELSE 'string' END AS kind FROM events")
def cnv2_header_types(t):
    text = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string")).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.col("event_type"))
    return t.events.select("event_id", convert.header_type(text).alias("kind"))


@query("SELECT event_id, event_id - 5000 AS number, (event_id - 5000) / 100.0 AS price FROM events".replace("(event_id - 5000) / 100.0", "round((event_id - 5000) / 100.0, 2)::DOUBLE"))
def cnv3_numbers(t):
    n = F.col("event_id") - 5000
    price = convert.decimal_from_base64(convert.decimal_to_base64((n / 100).cast("decimal(18,2)"), 2), 2)
    return t.events.select("event_id", convert.long_from_bytes(convert.long_to_bytes(n)).alias("number"), price.cast("double").alias("price"))


@query("""SELECT DISTINCT '{"key":' || user_id || ',"start":' || epoch_ms(time_bucket(INTERVAL 1 DAY, ts)) || ',"end":' || epoch_ms(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY) || '}' AS key FROM events""")
def cnv5_windowed_key(t):
    return t.events.select(convert.windowed_key(F.col("user_id"), F.window("ts", "1 day")).alias("key")).distinct()


# --- errors

def _torn(t):
    """Events as a log whose props are cut short where the value is above 60."""
    text = F.when(F.col("value") > 60, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return t.events.select(F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), text.alias("value"), F.array().cast(records.HEADERS).alias("headers"))


@query("SELECT event_id, CASE WHEN value > 60 THEN 'bad' ELSE 'good' END AS kind FROM events WHERE value IS NOT NULL")
def err1_decode(t):
    good, bad = errors.decode_json(_torn(t), "k int")
    return good.select(F.col("offset").alias("event_id"), F.lit("good").alias("kind")).unionByName(bad.select(F.col("offset").alias("event_id"), F.lit("bad").alias("kind")))


@query("SELECT event_id, round(100 / (user_id % 5), 6) AS result FROM events WHERE user_id % 5 <> 0")
def err2_process(t):
    d = F.col("user_id") % 5
    done, _ = errors.process(t.events, F.round(100 / F.nullif(d, F.lit(0)), 6), F.when(d == 0, F.lit("division by zero")))
    return done.select("event_id", "result")


@query("""SELECT 'dead' AS topic, event_id, '__connect.errors.topic=events,__connect.errors.partition=' || (user_id % 4) || ',__connect.errors.offset=' || event_id ||
',__connect.errors.connector.name=sink,__connect.errors.task.id=0,__connect.errors.stage=VALUE_CONVERTER,__connect.errors.exception.class.name=DataException,__connect.errors.exception.message=bad JSON' AS headers FROM events WHERE value > 60""")
def err4_dead_letters(t):
    _, bad = errors.decode_json(_torn(t), "k int")
    out = errors.dead_letters(bad, "dead", "sink", "VALUE_CONVERTER", "DataException", F.lit("bad JSON"))
    pairs = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    return out.select("topic", F.col("offset").alias("event_id"), F.array_join(pairs, ",").alias("headers"))


@query("""SELECT event_id, nulls, 4 - nulls AS known, (user_id + CASE WHEN event_id % 3 = 0 THEN event_id ELSE 0 END)::BIGINT AS total, (9 + 4 * nulls + 8 * (4 - nulls))::INTEGER AS bytes
FROM (SELECT *, (CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS nulls FROM events)""")
def cnv4_longs(t):
    """Lists with nulls to bytes and back."""
    values = F.array(F.col("user_id"), F.lit(None).cast("long"), F.when(F.col("event_id") % 3 != 0, -F.col("event_id")), F.col("event_id"))
    written = t.events.select("event_id", convert.longs_to_bytes(values).alias("data"))
    read = written.select("event_id", convert.longs_from_bytes(F.col("data")).alias("back"), F.octet_length("data").alias("bytes"))
    both = read.select("event_id", F.size("back").cast("long").alias("n"), F.filter("back", lambda v: v.isNotNull()).alias("present"), "bytes")
    known = F.size("present").cast("long")
    return both.select("event_id", (F.col("n") - known).alias("nulls"), known.alias("known"), F.aggregate("present", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"), "bytes")


@query("SELECT event_id, event_type || '/-/' || props AS texts FROM events")
def cnv4_texts(t):
    back = convert.texts_from_bytes(convert.texts_to_bytes(F.array("event_type", F.lit(None).cast("string"), "props")))
    return t.events.select("event_id", F.array_join(back, "/", "-").alias("texts"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'orders-' || strftime(o_orderdate, '%Y%m%d') END AS topic FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice >= 1000")
def smt20_drop_under_predicate(t):
    """Only closed orders can be dropped by the inner filter."""
    closed = F.col("value.status") == "F"
    inner = transforms.chain(transforms.drop_where(F.col("value.price") < 1000), transforms.regex_router(".*", "done"))
    return order_records(t).transform(transforms.only_where(closed, inner)).select(F.col("offset").alias("id"), "topic")


@query("SELECT o_orderkey AS id, o_orderstatus || ':' || o_orderpriority AS both FROM orders")
def smt18_nested_fields(t):
    both = F.concat_ws(":", "value.status", transforms.get("value", "info.priority"))
    return order_records(t).select(F.col("offset").alias("id"), both.alias("both"))
