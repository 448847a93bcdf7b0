"""Folds in pieces, running results in blocks, and window joins, against plain Python."""

import pytest
from pyspark.sql import functions as F

from floodmark.functions.running import numbers, running
from floodmark.operators import aggregates, joins, transforms, windows
from floodmark.sources import records
from tests.conftest import plain


@pytest.fixture
def pieces(monkeypatch):
    monkeypatch.setattr(aggregates, "PIECE", 4)


def keyed(spark, n=500):
    """One hot key with most rows, an empty text and some nulls."""
    rows = [("hot" if i % 5 else f"k{i % 3}", (i * 37) % n, None if i % 41 == 0 else "" if i % 13 == 0 else chr(97 + i % 26)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, o int, v string").repartition(7)


def test_reduce_in_pieces(spark, pieces):
    rows, df = keyed(spark)
    got = {r.k: r.reduced for r in aggregates.reduce_values(df, "k", "v", lambda a, x: F.concat(a, F.lit("|"), x), "o").collect()}
    want = {k: "|".join(v for kk, o, v in sorted((r for r in rows if r[2] is not None), key=lambda r: r[1]) if kk == k) for k in {r[0] for r in rows}}
    assert got == want


@pytest.mark.parametrize("gone", ["z", "a", ""])
def test_deletes_in_pieces(spark, pieces, gone):
    rows, df = keyed(spark)
    step = lambda a, x: F.when(x != gone, F.concat(a, x))
    args = (df, "k", "v", F.lit("<"), step, "o")
    whole = {r.k: r.aggregate for r in aggregates.aggregate(*args).collect()}
    got = {r.k: r.aggregate for r in aggregates.aggregate(*args, lambda a, b: F.concat(a, F.substring(b, F.lit(2), F.length(b)))).collect()}
    assert got == whole and len(got) > 1


def test_folds_of_empty_tables(spark):
    df = spark.createDataFrame([], "k string, o int, v string")
    both = lambda a, x: F.concat(a, x)
    assert aggregates.reduce_values(df, "k", "v", both, "o").collect() == []
    assert aggregates.aggregate(df, "k", "v", F.lit(""), both, "o", both).collect() == []


def test_running_in_blocks(spark):
    rows = [(None if i % 4 == 3 else i % 4, i, None if i % 7 < 2 else (i * 31) % 17) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    out = running(df, ["g"], ["o"], F.floor(F.col("o") / 10), {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("min", F.col("v"))})
    got = {r.o: (r.s, r.m, r.l) for r in out.collect()}
    for g, o, _ in rows:
        seen = [v for gg, oo, v in rows if gg == g and oo <= o and v is not None]
        assert got[o] == ((sum(seen), max(seen), min(seen)) if seen else (None, None, None))
    n = {r.o: r.n for r in numbers(df, ["g"], ["o"], F.floor(F.col("o") / 10), "n").collect()}
    assert n == {o: sum(gg == g and oo < o for gg, oo, _ in rows) for g, o, _ in rows}


@pytest.mark.parametrize("before,after", [(5_000, 5_000), (0, 3_000), (7_000, -2_000), (-1_000, 4_000)])
@pytest.mark.parametrize("how", ["inner", "left", "full_outer"])
def test_window_joins(spark, how, before, after):
    l = [(None if i % 9 == 8 else i % 3, i * 1700 % 40_000) for i in range(30)] * 2  # noqa: E741
    r = [(None if i % 7 == 6 else i % 4, i * 2300 % 40_000) for i in range(25)] + [(0, 1700)] * 2
    frame = lambda rows: spark.createDataFrame(rows, "k int, ms long").select("k", F.timestamp_millis("ms").alias("ts"))
    out = joins.window_join(frame(l), frame(r), "k", "ts", before, after, how)
    ms = lambda c: F.unix_millis(c)
    got = sorted(map(repr, map(tuple, out.select("l_k", ms("l_ts"), "r_k", ms("r_ts")).collect())))
    meets = lambda a, b: a[0] is not None and a[0] == b[0] and a[1] - before <= b[1] <= a[1] + after
    want = [(*a, *b) for a in l for b in r if meets(a, b)]
    if how != "inner":
        want += [(*a, None, None) for a in l if not any(meets(a, b) for b in r)]
    if how == "full_outer":
        want += [(None, None, *b) for b in r if not any(meets(a, b) for a in l)]
    assert got == sorted(map(repr, want))


def test_line_positions(spark, tmp_path):
    text = "".join(f"{'ä' * (i % 11)}{i}\n" for i in range(3000)).encode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = records.line_positions(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3000
    for r in rows:
        line = r.value.encode() + b"\n"
        assert text[r.position : r.position + len(line)] == line and (r.position == 0 or text[r.position - 1] == 10)


def test_defaults_and_settings(spark):
    df = spark.sql("SELECT named_struct('a', CAST(NULL AS INT), 'b', 1) AS value")
    kind = df.schema["value"].dataType
    kind["a"].metadata["default"] = 7
    typed = spark.createDataFrame(df.rdd, df.schema)
    assert typed.transform(transforms.extract_field("a")).first().value == 7
    assert typed.transform(transforms.extract_field("a", replace_null_with_default=False)).first().value is None
    with pytest.raises(ValueError):
        transforms.configured([{"type": "unknown"}])
    with pytest.raises(ValueError):
        windows.on_window_close(df, None, "1 hour", F.current_timestamp())


def test_terminal_action(spark):
    from floodmark.operators import stateless

    seen = spark.sparkContext.accumulator(0)
    stateless.for_each(spark.range(100), lambda rows: [seen.add(r.id) for r in rows])
    assert seen.value == 4950 and plain(1.0) == "1.0"
