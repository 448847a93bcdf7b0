"""Tables by key in files, changed bucket by bucket and read at any version.

Rows lie in buckets by the hash of their key, and a manifest of each version names the folder of each bucket.
An upsert reads and writes the buckets that its batch touches, so its cost follows the batch, and its last act
is the new manifest: what ends before leaves the version before it. A manifest also has the number of the
last batch of each query that writes here, so a repeated batch changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import files


class ConcurrentWrite(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class KeyedTable:
    """``key`` and ``order`` are columns; of rows of one key the highest order holds. ``buckets`` is fixed by the first version."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: str, buckets: int = 64):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, order, buckets

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]

    def version(self) -> int:
        """The newest version, -1 if there is none."""
        return max(self.versions(), default=-1)

    def _manifest(self, version: int) -> dict:
        if version < 0:
            return {"buckets": self.buckets, "schema": None, "folders": {}, "batches": {}}
        text = files.read_text(self.spark, f"{self.path}/manifests/{version:012d}.json")
        if text is None:
            raise ValueError(f"{self.path} has no version {version}")
        return json.loads(text)

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame | None:
        if manifest["schema"] is None:
            return None
        schema = StructType.fromJson(manifest["schema"])
        some = manifest["folders"] if buckets is None else {str(b): manifest["folders"][str(b)] for b in buckets if str(b) in manifest["folders"]}
        folders = [f"{self.path}/{f}" for f in some.values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The table, as of a version if one is named. A table without a version can't be read."""
        version = self.version() if version is None else version
        rows = self._rows(self._manifest(version))
        if rows is None:
            raise ValueError(f"{self.path} has no version yet")
        return rows

    def lookup(self, value, version: int | None = None) -> DataFrame:
        """The row of a key, from its bucket alone."""
        manifest = self._manifest(self.version() if version is None else version)
        kind = StructType.fromJson(manifest["schema"])[self.key].dataType
        bucket = self.spark.range(1).select(self._bucket(F.lit(value).cast(kind), manifest["buckets"])).first()[0]
        return self._rows(manifest, [bucket]).filter(F.col(self.key) == F.lit(value))

    def _bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def upsert(self, batch: DataFrame, batch_id: int | None = None, query: str = "", deleted: Column | None = None) -> int:
        """Folds a batch of changes into the table; the version that has it.

        Rows without a key are dropped, and a ``deleted`` one takes its key out. Batches have to come in
        order, as the order of a deleted key isn't kept. A ``batch_id`` up to that of the last
        batch of ``query`` changes nothing.
        """
        version = self.version()
        manifest = self._manifest(version)
        if batch_id is not None and batch_id <= manifest["batches"].get(query, -1):
            return version
        flag = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
        columns = batch.columns
        rows = batch.dropna(subset=[self.key]).select(*columns, flag.alias("__gone"))
        place = self._bucket(F.col(self.key), manifest["buckets"])
        touched = sorted(r[0] for r in rows.select(place).distinct().collect())  # numbers of buckets
        changed = {}
        if touched:
            held = self._rows(manifest, touched)
            whole = rows if held is None else rows.unionByName(held.withColumn("__gone", F.lit(False)))
            newest = whole.groupBy(self.key).agg(F.max_by(F.struct(*[F.col(c) for c in whole.columns]), F.struct(self.order, F.lit(0))).alias("__row")).select("__row.*")
            newest = newest.filter(~F.col("__gone")).drop("__gone").withColumn("__bucket", place)
            folder = f"data/{uuid.uuid4().hex}"
            newest.repartition(len(touched), "__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
            written = {n.removeprefix("__bucket=") for n in files.names(self.spark, f"{self.path}/{folder}") if n.startswith("__bucket=")}
            changed = {str(b): f"{folder}/__bucket={b}" if str(b) in written else None for b in touched}
        folders = {b: f for b, f in (manifest["folders"] | changed).items() if f is not None}
        batches = manifest["batches"] | ({query: batch_id} if batch_id is not None else {})
        schema = manifest["schema"] or json.loads(batch.schema.json())
        new = {"buckets": manifest["buckets"], "schema": schema, "folders": folders, "batches": batches}
        if not files.write_new(self.spark, f"{self.path}/manifests/{version + 1:012d}.json", json.dumps(new)):
            raise ConcurrentWrite(f"{self.path} has a version {version + 1} already")
        return version + 1

    def sink(self, query: str = "", deleted: Column | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: each micro-batch is upserted once."""
        return lambda batch, batch_id: self.upsert(batch, batch_id, query, deleted) and None

    def vacuum(self, keep: int = 1) -> None:
        """Takes away all but the ``keep`` newest versions, and folders that no version left names."""
        versions = sorted(self.versions())
        kept = versions[-keep:]
        used = {f.split("/")[1] for v in kept for f in self._manifest(v)["folders"].values()}
        for v in set(versions) - set(kept):
            files.delete(self.spark, f"{self.path}/manifests/{v:012d}.json")
        for folder in set(files.names(self.spark, f"{self.path}/data")) - used:
            files.delete(self.spark, f"{self.path}/data/{folder}")
