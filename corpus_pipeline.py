"""A corpus made ready for training: filter, dedup, near dedup, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floodmark.llm import exact_dedup, mixing, packing, quality, shingle_join
from floodmark.llm.common import table, written

STAGES = [
    ("quality classifier", quality.stage),
    ("exact dedup", exact_dedup.stage),
    ("n-gram Jaccard join", shingle_join.stage),
    ("mixing sources to target weights", mixing.stage),
    ("best-fit packing", packing.stage),
]

#: A fitted classifier has no SQL; tests/llm compares a run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
