"""Replication between clusters: which topics, under which names, and how offsets translate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import numbers, running

#: Topics left out unless told otherwise (fixed values).
EXCLUDED_TOPICS = (r"mm2.*\.internal", r".*\.replica", r"__.*")
#: Consumer groups left out unless told otherwise (fixed values).
EXCLUDED_GROUPS = (r"console-consumer-.*", r"connect-.*", r"__.*")


def _any(column: str, patterns: tuple[str, ...] | list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.col(column).rlike(f"^(?:{p})$")
    return out


def included(df: DataFrame, column: str = "topic", include: tuple[str, ...] = (".*",), exclude: tuple[str, ...] = EXCLUDED_TOPICS) -> DataFrame:
    """Rows whose name matches an include pattern and no exclude pattern."""
    return df.filter(_any(column, include) & ~_any(column, exclude))


def remote_topic(source: str, topic: Column, separator: str = ".", identity: bool = False) -> Column:
    return topic if identity else F.concat(F.lit(source + separator), topic)


def topic_source(topic: Column, separator: str = ".") -> Column:
    """The cluster a remote topic came from; null for a local one."""
    at = F.instr(topic, separator)
    return F.when(at > 0, F.substring(topic, F.lit(1), at - 1))


def upstream_topic(topic: Column, separator: str = ".") -> Column:
    """The topic's name at its source; null for a local one."""
    at = F.instr(topic, separator)
    return F.when(at > 0, F.substring(topic, at + len(separator), F.length(topic)))


def original_topic(topic: Column, separator: str = ".") -> Column:
    """The name with all clusters stripped."""
    return F.element_at(F.split(topic, f"\\Q{separator}\\E"), -1)


def is_internal(topic: Column) -> Column:
    return topic.startswith("__") | topic.startswith(".") | (topic.startswith("mm2") & topic.endswith(".internal")) | topic.endswith(".checkpoints.internal")


def hops(topic: Column, separator: str = ".") -> Column:
    return F.size(F.split(topic, f"\\Q{separator}\\E")) - 1


def replicate(log: DataFrame, source: str, separator: str = ".", block: int = 1_000_000) -> DataFrame:
    """Records under their remote name, partition and order kept, with new offsets and the upstream ones.

    Offsets are given by blocks of ``block`` upstream offsets, so a long partition is many tasks.
    """
    rows = log.withColumns({"upstream_offset": F.col("offset"), "topic": remote_topic(source, F.col("topic"), separator)})
    return numbers(rows, ["topic", "partition"], ["upstream_offset"], F.floor(F.col("upstream_offset") / block))


def offset_syncs(replica: DataFrame, every: int) -> DataFrame:
    """Pairs of upstream and downstream offsets: the first record of a partition, and then each ``every`` upstream offsets."""
    block = F.floor(F.col("upstream_offset") / every)
    first = F.min(F.struct("upstream_offset", "offset")).alias("_s")
    return replica.groupBy("topic", "partition", block.alias("_b")).agg(first).select("topic", "partition", F.col("_s.upstream_offset").alias("upstream_offset"), F.col("_s.offset").alias("downstream_offset"))


def translate_offsets(committed: DataFrame, syncs: DataFrame, block: int = 100_000) -> DataFrame:
    """Checkpoints: each committed upstream offset with the newest sync at or before it.

    A commit right at a sync goes to that sync's downstream offset, a later one to the record after it;
    a commit before the first sync has none. An as-of lookup: both sides in one order by offset, a
    partition in blocks of ``block`` offsets.
    """
    s = syncs.select("topic", "partition", F.col("upstream_offset").alias("o"), F.struct(F.col("upstream_offset").alias("up"), F.col("downstream_offset").alias("down")).alias("_s"), F.lit(0).alias("_q"))
    c = committed.select("group", "topic", "partition", F.col("committed_offset").alias("o"), F.lit(1).alias("_q"))
    both = s.unionByName(c, allowMissingColumns=True)
    rows = running(both, ["topic", "partition"], ["o", "_q"], F.floor(F.col("o") / block), {"_s": ("last", F.col("_s"))}).filter("_q = 1")
    down = F.col("_s.down") + F.when(F.col("o") > F.col("_s.up"), 1).otherwise(0)
    return rows.select("group", "topic", "partition", F.col("o").alias("upstream_offset"), down.alias("downstream_offset")).filter("downstream_offset is not null")


def heartbeats(log: DataFrame, source: Column | str, target: str) -> DataFrame:
    """Newest heartbeat from each ``source`` (a name, or a column of names) to ``target``: records keyed by both, valued by time."""
    names = {"source_cluster": F.lit(source) if isinstance(source, str) else source, "target_cluster": F.lit(target)}
    newest = log.groupBy(*[c.alias(n) for n, c in names.items()]).agg(F.max("timestamp").alias("timestamp"))
    return newest.select(F.struct(*names).alias("key"), "timestamp")


def metrics(replica: DataFrame, window: str, size: Column, replicated_at: Column) -> DataFrame:
    """Record and byte rate a second, and the age of records on replication in ms, by topic and window."""
    at = replica.withColumns({"_at": replicated_at, "_size": size})
    age = F.unix_millis(F.col("_at").cast("timestamp")) - F.unix_millis(F.col("timestamp").cast("timestamp"))
    grouped = at.groupBy("topic", F.window("_at", window).alias("w")).agg(F.count("*").alias("records"), F.sum("_size").alias("bytes"), F.min(age).alias("age_min"), F.avg(age).alias("age_avg"), F.max(age).alias("age_max"))
    seconds = F.col("w.end").cast("timestamp").cast("long") - F.col("w.start").cast("timestamp").cast("long")
    return grouped.select("topic", F.col("w.start").alias("start"), (F.col("records") / seconds).alias("record_rate"), (F.col("bytes") / seconds).alias("byte_rate"), "age_min", "age_avg", "age_max")
