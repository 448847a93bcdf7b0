"""Errors as data: records that fail are split off, counted or end the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_json(df: DataFrame, schema: T.StructType | str, column: str = "value", policy: str = "continue") -> tuple[DataFrame, DataFrame]:
    """(decoded, failed): ``column`` parsed as JSON. ``fail`` raises at the first bad record; ``continue`` splits them off.

    A null value is no error: it decodes to null.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if policy == "fail":
        return df.withColumn(column, F.from_json(F.col(column).cast("string"), kind, {"mode": "FAILFAST"})), df.limit(0)
    held = T.StructType([*kind.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(column).cast("string"), held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.withColumn("_p", parsed)
    bad = F.col("_p._corrupt").isNotNull()
    good = F.when(F.col(column).isNotNull(), F.struct(*[F.col(f"_p.{f}") for f in kind.names]))
    return rows.filter(~F.coalesce(bad, F.lit(False))).withColumn(column, good).drop("_p"), rows.filter(bad).drop("_p")


def process(df: DataFrame, result: Column, error: Column, name: str = "result", tolerance: str = "all") -> tuple[DataFrame, DataFrame]:
    """(done, failed): rows whose ``error`` is null get ``result``; others fail. ``none`` tolerates none and raises."""
    if tolerance == "none":
        return df.withColumn(name, F.when(error.isNotNull(), F.raise_error(error)).otherwise(result)), df.limit(0)
    if tolerance != "all":
        raise ValueError(tolerance)
    return df.filter(error.isNull()).withColumn(name, result), df.withColumn("error", error).filter(F.col("error").isNotNull())


#: Headers of a dead letter: this prefix and these names (fixed values).
PREFIX = "__connect.errors."
DEAD_LETTER_HEADERS = ("topic", "partition", "offset", "connector.name", "task.id", "stage", "class.name", "exception.class.name", "exception.message", "exception.stacktrace")


def dead_letters(failed: DataFrame, topic: str, connector: str, stage: str, exception: str, message: Column, task: int = 0, step: str | None = None, trace: Column | None = None) -> DataFrame:
    """Failed log records for the dead-letter topic, their context in headers; ``step`` names the class that failed."""
    values = [F.col("topic"), F.col("partition"), F.col("offset"), F.lit(connector), F.lit(task), F.lit(stage), F.lit(step), F.lit(exception), message, F.lit(None) if trace is None else trace]
    context = F.array(*[F.struct(F.lit(PREFIX + n).alias("key"), v.cast("string").cast("binary").alias("value")) for n, v in zip(DEAD_LETTER_HEADERS, values, strict=True)])
    return failed.withColumn("headers", F.concat(F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")), context)).withColumn("topic", F.lit(topic))


def reject(accepts: Column, put: Callable[[DataFrame, int], None], report: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: accepted rows go to ``put``, the others to ``report``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        ok = F.coalesce(accepts, F.lit(False))
        put(batch.filter(ok), batch_id)
        report(batch.filter(~ok), batch_id)

    return each
