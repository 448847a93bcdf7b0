"""Exact dedup by an extendible-hash index kept in shared files.

Texts are equal when identical after each run of blanks (space, tab to carriage return) became one
space. A directory of key prefixes is doubled until no bucket holds more than ``capacity`` rows; buckets
that were not overfull keep their shorter prefix. Each bucket belongs to one owner task: all rows of its
key range are dealt to it, and it sorts them, chains the digests that share a key, and writes entries
(key, place in the chain, digest, size of the group, smallest id) to the bucket's folder. Bytes are
compared at the owner too: the texts below an entry of two rows or more are dealt to its bucket, and where
they differ the chain is split by the text itself. Everything is DataFrame code.

Scale: owners get rows that are summed by key, digest and salt first, so a hot group is ``salts`` rows a
bucket at most. Only texts whose key is that of a doubled entry, by a bitmap of fixed size, cross the
network, and a bucket's owner sees their least and greatest per salt; all else moves rows of some 60 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, marked, shared_path, text_or_empty, without

#: Runs of these become one space.
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), BLANKS, " ")


def bucket_directory(entries: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The directory over ``entries.key``: (slot, depth), one row per slot in use of the fullest depth.

    ``depth`` is the local depth of the bucket a slot belongs to. Doubling goes on until no bucket
    holds more than ``capacity`` keys, or the slots have 60 bits.
    """
    total = entries.count()
    bits = max(1, (max(1, total) // capacity).bit_length() + 2)
    while True:
        slot = F.shiftrightunsigned("key", 64 - bits)
        slots = checkpointed(entries.groupBy(slot.alias("slot")).agg(F.count("*").alias("keys")))
        fullest = slots.agg(F.max("keys")).first()[0] or 0
        if fullest <= capacity or bits >= 60:
            break
        bits += 2
    depth = F.lit(bits)
    levels = slots
    for d in range(bits - 1, -1, -1):
        prefix = F.shiftrightunsigned("slot", bits - d)
        sums = levels.groupBy(prefix.alias("prefix")).agg(F.sum("keys").alias(f"keys_{d}"))
        levels = levels.join(sums.select("prefix", f"keys_{d}"), prefix == F.col("prefix"), "left").drop("prefix")
        depth = F.when(F.col(f"keys_{d}") <= capacity, F.lit(d)).otherwise(depth)
        if d % 8 == 0:  # keep the plan small
            levels, depth = checkpointed(levels.select("slot", "keys", depth.alias("depth"))), F.col("depth")
    return checkpointed(levels.select("slot", depth.cast("int").alias("depth"))), bits


#: Rows of a bucket at least and folders of an index at most, if no capacity is given.
LEAST_CAPACITY, FOLDERS = 20_000, 4_096


def exact_dedup(
    docs: DataFrame,
    capacity: int | None = None,
    salts: int = 64,
    key: Column | None = None,
    digest: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, bucket, text_hash.

    A null text counts as empty; an empty table gives no rows. The smallest doc_id of equal texts stays;
    null ids rank last, so that a group has a null keep_id only where all its ids are null, and then
    ``kept`` holds for all of them. Repeated rows count in ``group_size``, and each repeat of the kept
    row is kept. Other columns of ``docs`` are not looked at. ``key`` (long) and ``digest`` over the
    column ``norm`` replace xxhash64 and SHA-256 in tests of colliding chains. ``text_hash`` is xxhash64
    of the text as it is.
    """
    norm = docs.select("doc_id", "text", normalised().alias("norm"))
    key = F.xxhash64("norm") if key is None else key
    sha = F.unhex(F.sha2("norm", 256))
    digest = sha if digest is None else digest
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    rows = norm.select("doc_id", F.xxhash64("text").alias("text_hash"), key.alias("key"), digest.alias("digest"), sha.alias("sha"), salt.alias("salt"))
    rows = checkpointed(rows)

    parts = checkpointed(rows.groupBy("key", "digest", "salt").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo")))
    directory, bits = bucket_directory(parts, capacity or max(LEAST_CAPACITY, parts.count() // FOLDERS))
    index = _index_files(parts, directory, bits)

    doubled = index.filter("n > 1").select("key", "digest", "bucket")
    texts = norm.select(key.alias("key"), digest.alias("digest"), salt.alias("salt"), "norm")
    hits = marked(texts, doubled, "key").filter("hit").drop("hit")
    compared = (
        hits.groupBy("key", "digest", "salt").agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
        .join(doubled, ["key", "digest"]).repartition("bucket")
        .groupBy("bucket", "key", "digest").agg(F.min("a").alias("a"), F.max("b").alias("b"))
        .filter("a <> b").select("key", "digest")
    )
    clashes = checkpointed(compared)
    out = rows
    clashing = not clashes.isEmpty()
    if clashing:
        out = rows.join(clashes, ["key", "digest"], "left_anti")
    columns = ("doc_id", "text_hash", "lo", "n", "sha", "bucket")
    out = out.join(index, ["key", "digest"]).select(*columns)
    if clashing:
        split = norm.select("doc_id", F.xxhash64("text").alias("text_hash"), "norm", key.alias("key"), digest.alias("digest"), sha.alias("sha"))
        chained = split.join(clashes, ["key", "digest"], "left_semi")
        chains = chained.groupBy("norm").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"))
        buckets = index.select("key", "digest", "bucket")
        out = out.unionByName(chained.join(chains, "norm").join(buckets, ["key", "digest"]).select(*columns))
    return out.select(
        "doc_id",
        F.col("lo").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("lo")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "bucket",
        "text_hash",
    )


def _index_files(parts: DataFrame, directory: DataFrame, bits: int) -> DataFrame:
    """The index over ``parts`` (key, digest, salt, n, lo): key, chain, digest, n, lo, bucket.

    One task owns a bucket: it merges what salts hold of an entry, numbers the entries of a key, and writes
    them to the bucket's folder.
    """
    slot = F.shiftrightunsigned("key", 64 - bits)
    prefix = F.expr(f"shiftrightunsigned(slot, {bits} - depth)")
    bucket = F.concat_ws("-", F.col("depth"), prefix)
    owned = parts.join(directory, slot == F.col("slot")).select("key", "digest", "n", "lo", bucket.alias("bucket")).repartition("bucket")
    entries = owned.groupBy("bucket", "key", "digest").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"))
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("digest"))
    placed = entries.select("key", chain.alias("chain"), "digest", "n", "lo", "bucket")
    path = shared_path(parts.sparkSession, "dedup-index")
    placed.write.partitionBy("bucket").parquet(path)
    return parts.sparkSession.read.schema(placed.schema).parquet(path)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns; of repeated kept rows one stays.

    Of kept rows that share an id and differ in blanks alone the one of the smallest text hash stays.
    """
    marks = checkpointed(exact_dedup(docs).select("doc_id", "text_hash", "kept", "text_sha256"))
    kept = marks.filter("kept").groupBy("doc_id", "text_sha256").agg(F.min("text_hash").alias("first"), F.count("*").alias("rows"))
    again = checkpointed(kept.filter("rows > 1"))
    dropped = marks.filter("not kept").select("doc_id", "text_hash")
    repeated = not again.isEmpty()
    if repeated:
        same = F.col("m.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("m.text_sha256") == F.col("k.text_sha256"))
        dropped = dropped.unionByName(marks.filter("kept").alias("m").join(again.alias("k"), same).filter("text_hash <> first").select("m.doc_id", "text_hash"))
    out = without(docs, dropped.distinct(), F.xxhash64("text"))
    return out.dropDuplicates() if repeated else out


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""
