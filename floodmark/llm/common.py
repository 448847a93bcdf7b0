"""What the operators of this subpackage share: table access and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session that names none (tests on one machine) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("floodmark.shared.dir", None)
        if not named:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir names no shared folder")
            named = tempfile.mkdtemp(prefix="spark-floodmark-")
            spark.conf.set("floodmark.shared.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, what: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut at files in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read from there."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a bitmap of numbers, each of 64 bits; it is broadcast.
MAP_ROWS = 1 << 18


def marked(df: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    """``df`` with ``hit``: whether its long ``column`` may be one of those in ``numbers``.

    By a bitmap of at most ``MAP_ROWS`` rows, whatever there is in ``numbers``; a crowded map has false hits.
    """
    mixed = F.xxhash64(column, F.lit(3))
    row, bit = F.pmod(mixed, F.lit(MAP_ROWS)).alias("__row"), F.pmod(F.shiftright(mixed, 32), F.lit(64)).cast("int").alias("__bit")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bit"))
    bits = numbers.select(row, bit).groupBy("__row").agg(F.bit_or(one).alias("__bits"))
    hit = F.coalesce(F.call_function("getbit", F.col("__bits"), F.col("__bit")) == 1, F.lit(False))
    return df.select("*", row, bit).join(F.broadcast(bits), "__row", "left").withColumn("hit", hit).drop("__row", "__bit", "__bits")


def without(docs: DataFrame, dropped: DataFrame, text_hash: Column) -> DataFrame:
    """``docs`` without the rows of ``dropped`` (doc_id, text_hash), ids compared null-safely.

    Only rows that may be among them are joined, so the texts of most rows stay where they are.
    """
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("__row_of"), F.col("doc_id").alias("__id"), text_hash.alias("__hash"))
    packed = packed.withColumn("__number", F.xxhash64("__id", "__hash"))
    lost = dropped.select(F.col("doc_id").alias("__lost"), F.col("text_hash").alias("__lost_hash"))
    seen = marked(packed, lost.select(F.xxhash64("__lost", "__lost_hash").alias("__number")), "__number")
    same = F.col("__id").eqNullSafe(F.col("__lost")) & F.col("__hash").eqNullSafe(F.col("__lost_hash"))
    rest = seen.filter("hit").join(lost, same, "left_anti")
    return seen.filter("not hit").unionByName(rest).select("__row_of.*")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
