"""Connectors: each row once through restarts, whole commits only."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from floodmark.sources import connectors


class Counting(connectors.SourceConnector):
    """Two partitions of numbers whose ends a file states; what is committed goes to another file."""

    schema = "source string, n long"

    def ends(self):
        with open(self.options["ends"]) as f:
            return json.load(f)

    def read(self, partition, start, end):
        for n in range(start, end):
            if str(n) == self.options.get("failat"):
                raise OSError("broken")
            yield partition, n

    def committed(self, offsets):
        with open(self.options["ends"] + ".done", "w") as f:
            json.dump(offsets, f)


def finish(query):
    try:
        query.awaitTermination(240)
    except StreamingQueryException:
        return query.exception()
    return query.exception()


def test_a_restarted_stream_reads_each_record_once(spark, tmp_path):
    connectors.register(spark, "counting", Counting)
    ends = tmp_path / "ends"

    def go(**options):
        stream = spark.readStream.format("counting").option("ends", str(ends)).options(**options).load()
        return finish(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())

    ends.write_text(json.dumps({"a": 5, "b": 2}))
    assert go() is None
    ends.write_text(json.dumps({"a": 9, "b": 2, "c": 3}))
    assert "broken" in str(go(failat="7"))
    ends.write_text(json.dumps({"a": 12, "b": 4, "c": 3}))
    assert go() is None and go() is None
    rows = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert rows == [(p, n) for p, e in (("a", 12), ("b", 4), ("c", 3)) for n in range(e)]
    done = json.loads((tmp_path / "ends.done").read_text())
    assert done["a"] >= 5


def test_batch_reads(spark, tmp_path):
    connectors.register(spark, "counting", Counting)
    (tmp_path / "ends").write_text(json.dumps({"a": 3, "b": 0}))
    assert sorted(map(tuple, spark.read.format("counting").option("ends", str(tmp_path / "ends")).load().collect())) == [("a", 0), ("a", 1), ("a", 2)]
    (tmp_path / "ends").write_text("{}")
    assert spark.read.format("counting").option("ends", str(tmp_path / "ends")).load().collect() == []


def test_lines_have_their_positions_on_a_stream(spark, tmp_path):
    connectors.register(spark, "lines", connectors.LineFiles)
    folder = tmp_path / "in"
    folder.mkdir()

    def go():
        stream = spark.readStream.format("lines").option("path", str(folder)).load()
        assert finish(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()) is None

    (folder / "x.log").write_bytes("ä1\n\nthird\nopen".encode())
    go()
    with open(folder / "x.log", "ab") as f:
        f.write(b" no more\r\nlast\n")
    (folder / "y.log").write_bytes(b"other\n")
    go()
    rows = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("file", "position", "value").collect()))
    assert rows == [("x.log", 0, "ä1"), ("x.log", 4, ""), ("x.log", 5, "third"), ("x.log", 11, "open no more"), ("x.log", 25, "last"), ("y.log", 0, "other")]
    batch = spark.read.format("lines").option("path", str(folder)).load()
    assert sorted(map(tuple, batch.collect())) == rows


def test_lines_longer_than_a_block(tmp_path, monkeypatch):
    monkeypatch.setattr(connectors.LineFiles, "BLOCK", 7)
    (tmp_path / "f").write_bytes(b"a" * 30 + b"\n" + b"b" * 14 + b"\nrest" * 1 + b"x" * 40)
    source = connectors.LineFiles({"path": f"file://{tmp_path}"})
    assert source.ends() == {"f": 46}
    assert list(source.read("f", 0, 46)) == [("f", 0, "a" * 30), ("f", 31, "b" * 14)]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    connectors.register(spark, "jsonfiles", sink=connectors.JsonFiles)
    out = str(tmp_path / "out")
    rows = spark.range(0, 40, numPartitions=4)
    rows.write.format("jsonfiles").option("path", out).mode("append").save()
    assert sum(1 for f in connectors.committed_files(out) for _ in open(f)) == 40
    bad = rows.select(F.when(F.col("id") == 35, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="bad row"):
        bad.write.format("jsonfiles").option("path", out).mode("append").save()
    assert sum(1 for f in connectors.committed_files(out) for _ in open(f)) == 40


def test_a_repeated_batch_is_committed_once(tmp_path):
    sink = connectors.JsonFiles({"path": str(tmp_path)})
    from pyspark.sql import Row

    sink.commit([sink.stage(iter([Row(a=1)]))], 0)
    again = sink.stage(iter([Row(a=1)]))
    sink.commit([again], 0)
    sink.commit([sink.stage(iter([Row(a=2)]))], 1)
    assert [json.loads(line)["a"] for f in connectors.committed_files(str(tmp_path)) for line in open(f)] == [1, 2]
    assert not (tmp_path / again).exists()
