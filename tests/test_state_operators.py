"""Transactions, closed samples, envelopes, typed headers and byte order against plain versions, with odd rows."""

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.operators import history, samples, topics, transactions, transforms
from floodmark.sources import convert, envelopes

LOG = "topic string, partition int, offset long, producer_id long, control string, value string"


def random_log(seed, n=600):
    rng = random.Random(seed)
    rows, ends = [], {}
    for _ in range(n):
        p = rng.randrange(3)
        o = ends.get(p, 0)
        ends[p] = o + rng.choice([1, 1, 1, 5])  # offsets have gaps
        producer = rng.choice([None, 1, 2, 3])
        control = rng.choice(["commit", "abort"]) if producer and rng.random() < 0.12 else None
        rows.append(("t", p, o, producer, control, f"{p}/{o}"))
    return rows


def replayed(rows):
    """Marker by marker: what each reader of committed records sees, the aborted spans, the last stable offsets."""
    seen, aborted, stable = [], [], {}
    for p in {r[1] for r in rows}:
        pending, done = {}, []
        part = sorted(r for r in rows if r[1] == p)
        for _, _, o, producer, control, value in part:
            if producer is None:
                done.append((o, value))
            elif control is None:
                pending.setdefault(producer, []).append((o, value))
            elif producer in pending:
                held = pending.pop(producer)
                if control == "commit":
                    done += held
                else:
                    aborted.append((p, producer, held[0][0], o))
        stable[p] = min([h[0][0] for h in pending.values()], default=part[-1][2] + 1)
        seen += [(p, o) for o, _ in done if o < stable[p]]
    return sorted(seen), sorted(aborted), stable


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [7, 100_000])
def test_transactions_equal_a_replay(spark, seed, block):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, LOG).repartition(4)
    seen, aborted, stable = replayed(rows)
    assert sorted((r.partition, r.offset) for r in transactions.committed_view(log, block).collect()) == seen
    spans = transactions.aborted_transactions(log)
    assert sorted((r.partition, r.producer_id, r.first_offset, r.last_offset) for r in spans.collect()) == aborted and aborted
    assert {r.partition: r.last_stable_offset for r in transactions.last_stable_offsets(log).collect()} == stable
    # the same records by spans
    by_spans = topics.read_committed(log.filter("control IS NULL"), spans)
    assert sorted((r.partition, r.offset) for r in by_spans.collect() if r.offset < stable[r.partition]) == seen


def test_transactions_of_nothing(spark):
    none = spark.createDataFrame([], LOG)
    assert transactions.committed_view(none).collect() == transactions.last_stable_offsets(none).collect() == []
    alone = spark.createDataFrame([("t", 0, 0, 1, "abort", None), ("t", 0, 1, 1, "commit", None), ("t", 0, 2, None, None, "x")], LOG)
    assert transactions.transactions(alone).collect() == [] and [r.value for r in transactions.committed_view(alone).collect()] == ["x"]


def plain_samples(rows, window_ms, events):
    out, state = {}, {}
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2]))
    numbers = {}
    for metric, ts, n in order:
        number = numbers[metric] = numbers.get(metric, -1) + 1
        at = round((ts - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        start, began, count = state.get(metric, (None, None, 0))
        if start is None or at - began >= window_ms or count >= events:
            start, began, count = number, at, 0
        state[metric] = (start, began, count + 1)
        out[n] = (metric, start)
    return out


@pytest.mark.parametrize(("window_ms", "events", "block"), [(1000, 7, 10), (300, 3, 33), (5000, 1000, 8), (1, 2, 50), (900, 5, 500_000)])
def test_closed_samples_equal_a_loop(spark, window_ms, events, block):
    rng = random.Random(events)
    at, rows = dt.datetime(2024, 1, 1), []
    for i in range(180):
        at += dt.timedelta(milliseconds=rng.choice([0, 0, 5, 60, 400]))
        rows.append((rng.choice(["a", "a", "a", "b", None]), None if i == 50 else at, i))
    df = spark.createDataFrame(rows, "metric string, t timestamp, n long").withColumn("block", F.lit("clash"))
    got = {r.n: (r.metric, r["sample"]) for r in samples.closed_samples(df.repartition(4), "t", "n", window_ms, events, block=block).collect()}
    assert got == plain_samples(rows, window_ms, events)


def test_samples_of_nothing(spark):
    assert samples.closed_samples(spark.createDataFrame([], "metric string, t timestamp, n long"), "t", "n", 10, 10).collect() == []


KINDS = (
    "b boolean, i8 byte, i16 short, i32 int, i64 long, f float, d double, s string, raw binary, day date, at timestamp, price decimal(38,3), "
    "list array<long>, nested struct<x: int, deep: array<struct<y: string, z: decimal(38,2)>>>, names map<string, binary>"
)


def test_envelopes_round_trip_all_types(spark):
    full = (True, -8, 300, -70000, 2**62, 0.5, 1e-30, 'q"\\ü\n', bytearray(b"\x00\xff"), dt.date(1969, 12, 30), dt.datetime(2024, 2, 29, 1, 2, 3, 4000), Decimal("-123456789.125"), [1, None, -3], (7, [("a", Decimal("0.01")), None]), {"k": bytearray(b"v"), "n": None})
    rows = spark.createDataFrame([(full,), (tuple([None] * 15),), (None,)], T.StructType([T.StructField("value", T._parse_datatype_string(KINDS))]))
    text = envelopes.to_envelopes(rows, "value")
    assert json.loads(text.first().value)["schema"]["type"] == "struct"
    back = envelopes.from_envelopes(text, "value")
    assert back.schema["value"].dataType.simpleString() == rows.schema["value"].dataType.simpleString()
    assert back.collect() == rows.collect()


def test_plain_values_in_envelopes(spark):
    for kind, value in (("string", "null"), ("string", 'a"b'), ("bigint", 5), ("array<string>", ["x", None]), ("date", dt.date(2024, 1, 1)), ("binary", bytearray(b"\x01"))):
        rows = spark.createDataFrame([(value,), (None,)], T.StructType([T.StructField("value", T._parse_datatype_string(kind))]))
        assert envelopes.from_envelopes(envelopes.to_envelopes(rows, "value"), "value").collect() == rows.collect(), kind


def test_defaults_required_fields_and_pairs(spark):
    schema = {"type": "struct", "fields": [
        {"field": "a", "type": "int32"}, {"field": "b", "type": "string", "default": "x", "optional": True}, {"field": "c", "type": "int64", "name": "any.Timestamp", "default": 1000},
        {"field": "m", "type": "map", "keys": {"type": "int32"}, "values": {"type": "string", "optional": True}, "optional": True},
    ]}
    rows = spark.createDataFrame([(json.dumps({"schema": schema, "payload": {"a": 1, "m": [[1, "x"], [2, None]]}}),), (None,)], "v string")
    first, second = envelopes.from_envelopes(rows, "v").collect()
    assert (first.v.a, first.v.b, first.v.c, first.v.m) == (1, "x", dt.datetime(1970, 1, 1, 0, 0, 1), {1: "x", 2: None}) and second.v is None
    bad = spark.createDataFrame([(json.dumps({"schema": schema, "payload": {"b": "y"}}),)], "v string")
    with pytest.raises(Exception, match="required field payload.a"):
        envelopes.from_envelopes(bad, "v").collect()
    other = rows.unionByName(spark.createDataFrame([('{"schema":{"type":"int32"},"payload":1}',)], "v string"))
    with pytest.raises(envelopes.BadEnvelope):
        envelopes.from_envelopes(other, "v")
    with pytest.raises(envelopes.BadEnvelope):
        envelopes.payload(F.col("v"), {"type": "int128"})
    assert envelopes.from_envelopes(spark.createDataFrame([], "v string"), "v").collect() == []


def test_byte_order_and_prefixes(spark):
    keys = [0, 1, 5, 2**40, -1, -2, -(2**62), 2**62, 255, 256]
    table = spark.createDataFrame([(k,) for k in keys], "k long")
    encoded = lambda k: k.to_bytes(8, "big", signed=True)
    assert [r.k for r in history.key_range_by_bytes(table, "k").collect()] == sorted(keys, key=encoded)
    for low in (None, *keys):
        for high in (None, 5, -2, -(2**62)):
            want = sorted((k for k in keys if (low is None or encoded(k) >= encoded(low)) and (high is None or encoded(k) <= encoded(high))), key=encoded)
            if low in (None, 0, 5, -2) or high is None:
                assert [r.k for r in history.key_range_by_bytes(table, "k", low, high, False).collect()] == want[::-1], (low, high)
    bytes_ = table.withColumn("b", convert.key_bytes(F.col("k"), "long"))
    assert {r.k for r in bytes_.filter(F.startswith("b", F.lit(b"\x00\x00\x00\x00\x00\x00\x01"))).collect()} == {256}
    assert [r.k for r in bytes_.orderBy("b").collect()] == sorted(keys, key=encoded)


def test_bad_values_fail_their_record(spark):
    rows = spark.createDataFrame([(("12", "x"),), (("no", "y"),), ((None, "z"),)], "value struct<n: string, s: string>")
    assert [r.value.n for r in rows.transform(transforms.cast({"n": "int"}, bad="null")).collect()] == [12, None, None]
    with pytest.raises(Exception, match="can't cast to int: no"):
        rows.transform(transforms.cast({"n": "int"})).collect()
    with pytest.raises(Exception, match="no list of longs"):
        spark.range(1).select(convert.longs_from_bytes(convert.texts_to_bytes(F.array(F.lit("a")))).alias("x")).collect()
    with pytest.raises(Exception, match="no list of texts"):
        spark.range(1).select(convert.texts_from_bytes(convert.longs_to_bytes(F.array(F.lit(1).cast("long")))).alias("x")).collect()


def test_header_values(spark):
    texts = ["true", "-12", "1.5e3", "2024-02-30", "2024-02-29", "2024-02-29T01:02:03Z", '{"a": 1}', "[1", "99999999999999999999", "plain", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", convert.header_value(F.col("t")).alias("v"))
    kinds = [r.v["type"] for r in sorted(rows.collect(), key=lambda r: r.i)]
    assert kinds == ["boolean", "integer", "decimal", "string", "date", "timestamp", "json", "string", "decimal", "string", "string", "null"]
    by = {r.i: r.v for r in rows.collect()}
    assert by[0].boolean is True and by[1].integer == -12 and by[2].decimal == 1500.0 and by[4].date == dt.date(2024, 2, 29) and by[7].string == "[1" and by[5].timestamp == dt.datetime(2024, 2, 29, 1, 2, 3)
