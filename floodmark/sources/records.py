"""Record logs: DataFrames with the columns that Spark's reader of message brokers gives.

``topic, partition, offset, timestamp, timestampType, key, value, headers``; a log may lie in files or
come from a broker, since only the reader's format differs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.running import numbers, running

LOG_COLUMNS = ("topic", "partition", "offset", "timestamp", "timestampType", "key", "value", "headers")
HEADERS = "array<struct<key:string,value:binary>>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def read_log(spark: SparkSession, path: str, topics: str | Sequence[str] | None = None, pattern: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A log in files, of one topic, several, or those whose whole name matches ``pattern``."""
    return select_topics(spark.read.format(fmt).load(path), topics, pattern)


def read_log_stream(spark: SparkSession, path: str, schema, topics=None, pattern=None, fmt: str = "parquet", **options) -> DataFrame:
    """As ``read_log``, as a stream of new files."""
    return select_topics(spark.readStream.format(fmt).schema(schema).options(**options).load(path), topics, pattern)


def select_topics(log: DataFrame, topics: str | Sequence[str] | None = None, pattern: str | None = None) -> DataFrame:
    if topics is not None:
        log = log.filter(F.col("topic").isin([topics] if isinstance(topics, str) else list(topics)))
    if pattern is not None:
        log = log.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
    return log


def as_log(df: DataFrame, topic: Column | str, key: Column, value: Column, ts: Column, order: Column, partitions: int = 4, headers: Column | None = None) -> DataFrame:
    """``df`` as a log: partition by key hash, offset by ``order`` within topic and partition.

    Offsets need the rows of a partition in order, so each partition of each topic is one window group:
    take as many partitions as the data needs.
    """
    topic = F.lit(topic) if isinstance(topic, str) else topic
    part = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    rows = df.select(topic.alias("topic"), part.alias("partition"), ts.alias("timestamp"), F.lit(0).alias("timestampType"), key.alias("key"), value.alias("value"), (headers if headers is not None else F.array().cast(HEADERS)).alias("headers"), order.alias("_order"))
    offset = F.row_number().over(Window.partitionBy("topic", "partition").orderBy("_order")) - 1
    return rows.withColumn("offset", offset.cast("long")).select(*LOG_COLUMNS)


def start_at(log: DataFrame, position: str, duration: str | None = None) -> DataFrame:
    """Where reading starts: ``earliest``, ``latest`` (nothing that is there), ``none`` (an error) or ``by_duration``.

    ``by_duration`` keeps what is not older than ``duration`` (an interval) before the newest record.
    """
    if position == "earliest":
        return log
    if position == "latest":
        return log.limit(0)
    if position == "by_duration":
        newest = log.agg(F.max("timestamp")).first()[0]  # one value
        return log if newest is None else log.filter(F.col("timestamp") >= F.lit(newest).cast(log.schema["timestamp"].dataType) - F.expr(f"interval {duration}"))
    raise ValueError(f"no start position {position!r}")


def consumed(log: DataFrame, key: Callable[[Column], Column] | None = None, value: Callable[[Column], Column] | None = None, timestamp: Column | str = "record", reset: str = "earliest", duration: str | None = None) -> DataFrame:
    """A log as its reader wants it: decoders of key and value, where event time comes from, and where reading starts."""
    out = start_at(log, reset, duration)
    for name, decode in (("key", key), ("value", value)):
        out = out if decode is None else out.withColumn(name, decode(F.col(name)))
    return with_timestamp(out, timestamp)


def with_timestamp(df: DataFrame, extractor: Column | str = "record", column: str = "timestamp") -> DataFrame:
    """Event time: the record's own, the wall clock, or an expression over the record."""
    if isinstance(extractor, str):
        if extractor == "record":
            return df
        extractor = {"wallclock": F.current_timestamp()}[extractor]
    return df.withColumn(column, extractor)


def handle_invalid_timestamps(df: DataFrame, policy: str, ts: str = "ts_ms", partition: str = "partition", order: str = "offset", block: int = 100_000) -> DataFrame:
    """Records with a null or negative time in ms: ``fail``, ``skip``, or take the ``partition_time``.

    Partition time is the highest time seen so far in the partition; a record before any valid one is
    dropped, as there is no time to give it. A partition is worked on in blocks of ``block`` of its order.
    """
    bad = F.col(ts).isNull() | (F.col(ts) < 0)
    if policy == "fail":
        return df.withColumn(ts, F.when(bad, F.raise_error(F.concat(F.lit("invalid timestamp "), F.coalesce(F.col(ts).cast("string"), F.lit("null"))))).otherwise(F.col(ts)))
    if policy == "skip":
        return df.filter(~bad)
    if policy == "partition_time":
        out = running(df, [partition], [order], F.floor(F.col(order) / block), {"_highest": ("max", F.when(~bad, F.col(ts)))})
        return out.withColumn(ts, F.when(bad, F.col("_highest")).otherwise(F.col(ts))).filter(F.col(ts).isNotNull()).select(*df.columns)
    raise ValueError(f"no policy {policy!r}")


def to_zoned(df: DataFrame, column: str) -> DataFrame:
    """A zoneless timestamp as an instant, for watermarks; the session's zone should be UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def to_zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- sinks

def write_log(log: DataFrame, path: str, fmt: str = "parquet", by_topic: bool = True, mode: str = "append") -> None:
    """Write a log; ``topic`` may differ by row, and each topic is a folder if ``by_topic``."""
    writer = log.write.format(fmt).mode(mode)
    (writer.partitionBy("topic") if by_topic else writer).save(path)


def write_log_stream(log: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by_topic: bool = True, available_now: bool = True):
    writer = log.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.partitionBy("topic") if by_topic else writer
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def route(log: DataFrame, topic: Column) -> DataFrame:
    """The target topic, chosen by row; rows without one are an error downstream and dropped here."""
    return log.withColumn("topic", topic).filter(F.col("topic").isNotNull())


def partition_to(df: DataFrame, targets: Column, partitions: int, key: str = "key") -> DataFrame:
    """Deal rows to partitions: ``targets`` is an array of numbers; null means by key, empty drops, several multicast."""
    default = F.array(F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int"))
    return df.withColumn("partition", F.explode(F.coalesce(targets.cast("array<int>"), default))).repartitionById(partitions, "partition")


def partition_windowed(df: DataFrame, partitions: int, key: str = "key") -> DataFrame:
    """Windowed results partitioned by the key inside the window."""
    return df.repartition(partitions, key)


def round_robin(df: DataFrame, partitions: int, order: Column | str, group: str = "topic", block: Column | None = None) -> DataFrame:
    """Partition numbers in turn, in the given order within each topic; block by block if ``block`` is given."""
    if block is not None:
        turns = numbers(df, [group], [_c(order)], block, "_turn")
        return turns.withColumn("partition", (F.col("_turn") % partitions).cast("int")).drop("_turn")
    turn = F.row_number().over(Window.partitionBy(group).orderBy(_c(order))) - 1
    return df.withColumn("partition", (turn % partitions).cast("int"))


# --- text in and out

def parse_lines(lines: DataFrame, column: str = "value", parse_key: bool = True, key_separator: str = "\t", parse_headers: bool = False, headers_separator: str = "\t", header_pair: str = ",", header_separator: str = ":", null_marker: str | None = None, ignore_error: bool = False) -> DataFrame:
    """Lines as records: ``[headers SEP] [key SEP] value``. Adds key, value, headers (a map of strings).

    A line without the separator it needs is an error, or all value if ``ignore_error``. Text equal to
    ``null_marker`` is null.
    """
    rest = F.col(column)
    found = []
    for wanted, sep, name in ((parse_headers, headers_separator, "headers"), (parse_key, key_separator, "key")):
        if not wanted:
            continue
        at = F.instr(rest, sep)
        missing = F.lit(None).cast("string") if ignore_error else F.raise_error(F.concat(F.lit(f"no {name} in line: "), rest)).cast("string")
        found.append((name, F.when(at > 0, F.substring(rest, F.lit(1), at - 1)).otherwise(missing)))
        rest = F.when(at > 0, F.substring(rest, at + len(sep), F.length(rest))).otherwise(rest)
    marked = lambda c: c if null_marker is None else F.nullif(c, F.lit(null_marker))
    parts = dict(found)
    key = marked(parts.get("key", F.lit(None).cast("string")))
    value = marked(rest)
    head = parts.get("headers")
    heads = F.lit(None).cast("map<string,string>") if head is None else F.when(head.isNotNull() & (head != ""), F.expr("str_to_map(_h, '{}', '{}')".format(header_pair, header_separator)))
    out = lines.withColumn("_h", F.lit(None).cast("string") if head is None else head)
    return out.withColumns({"_k": key, "_v": value, "headers": heads}).drop("_h").withColumn("key", F.col("_k")).withColumn(column, F.col("_v")).withColumnRenamed(column, "value").drop("_k", "_v")


def format_records(log: DataFrame, timestamp: bool = False, partition: bool = False, offset: bool = False, headers: bool = False, key: bool = False, value: bool = True, separator: str = "\t", null_text: str = "null", headers_separator: str = ",") -> DataFrame:
    """One line per record, for dumps: the chosen fields joined by ``separator``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(null_text))
    fields = []
    if timestamp:
        kind = F.when(F.col("timestampType") == 0, "CreateTime:").when(F.col("timestampType") == 1, "LogAppendTime:")
        fields.append(F.coalesce(F.concat(kind, F.unix_millis(F.col("timestamp").cast("timestamp")).cast("string")), F.lit("NO_TIMESTAMP")))
    if partition:
        fields.append(F.concat(F.lit("Partition:"), text("partition")))
    if offset:
        fields.append(F.concat(F.lit("Offset:"), text("offset")))
    if headers:
        pair = F.transform("headers", lambda h: F.concat(h["key"], F.lit(":"), F.coalesce(h["value"].cast("string"), F.lit(null_text))))
        fields.append(F.when(F.size("headers") > 0, F.array_join(pair, headers_separator)).otherwise("NO_HEADERS"))
    fields += [text("key")] * key + [text("value")] * value
    return log.select(F.concat_ws(separator, *fields).alias("line"))


def print_records(df: DataFrame, label: str, mapper: Column | None = None) -> DataFrame:
    """Lines ``[label]: key, value`` for a console or text sink."""
    body = mapper if mapper is not None else F.concat_ws(", ", F.coalesce(F.col("key").cast("string"), F.lit("null")), F.coalesce(F.col("value").cast("string"), F.lit("null")))
    return df.select(F.concat(F.lit(f"[{label}]: "), body).alias("value"))


def read_lines(spark: SparkSession, path: str, topic: str, streaming: bool = False) -> DataFrame:
    """Text files as records: topic, value, and the file and block they came from. A stream remembers its place in its checkpoint."""
    lines = (spark.readStream.schema("value string").format("text").load(path) if streaming else spark.read.text(path))
    return lines.select(F.lit(topic).alias("topic"), "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("position"))


def line_positions(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with ``file`` and ``position``, the byte a line starts at (lines end in one line feed).

    Lines are counted within the block a task reads, and block totals within a file carry on, so a long file is many tasks.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = lines.withColumns({"_n": F.monotonically_increasing_id(), "_size": F.octet_length("value").cast("long") + 1})
    out = running(rows, ["file"], ["_n"], F.col("start"), {"position": ("sum", F.col("_size"))})
    return out.select("value", "file", (F.col("position") - F.col("_size")).alias("position"))


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string")).write.mode("append").text(path)


def deliver(stream: DataFrame, put, checkpoint: str, flush=None):
    """A custom sink: ``put(batch, batch_id)`` for each micro-batch, then ``flush(batch_id)``; progress commits after both."""

    def each(batch: DataFrame, batch_id: int) -> None:
        put(batch, batch_id)
        if flush:
            flush(batch_id)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
