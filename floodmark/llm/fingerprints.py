"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes decides where a text is cut: from ``MIN`` bytes on at the rarer of two
bit patterns, from ``NORMAL`` bytes on at the commoner one, at ``MAX`` in any case. Cuts depend on nearby
bytes only, so they survive shifts. A fingerprint is the set of chunk digests with their lengths; the
share of its length that another fingerprint also holds measures containment.

Texts are compared with an edited form whose tail comes from the next document, and with the next
document. Documents are dealt into ranges of ascending doc_id; the first row of each range also goes to
the range before it (that of the first range to the last), so each task streams through sorted rows and
holds two texts at a time. The texts cross the network once.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN, NORMAL, MAX = 16, 64, 256
#: Top bits that have to be zero: one in 128 bytes before NORMAL, one in 32 after it.
RARE_SHIFT, COMMON_SHIFT = 25, 27
WINDOW = 32

#: The gear table, by rule: the first four bytes of SHA-256 of each byte.
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([i])).digest()[:4], "big") for i in range(256)], np.uint32)

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def cuts(data: bytes, start: int = 0) -> list[int]:
    """Ends of the chunks of ``data`` from ``start``, itself a cut, on."""
    n = len(data)
    if start >= n:
        return []
    base = max(0, start - WINDOW + 1)
    h = GEAR[np.frombuffer(data, np.uint8, offset=base)]
    step = 1
    while step < WINDOW and step < len(h):
        h[step:] += h[:-step] << np.uint32(step)  # the right side is a new array before it is added
        step *= 2
    common = np.flatnonzero(h >> np.uint32(COMMON_SHIFT) == 0)
    rare = (common[h[common] >> np.uint32(RARE_SHIFT) == 0] + (base + 1)).tolist()
    common = (common + (base + 1)).tolist()
    out = []
    while n - start > MIN:
        k = bisect_left(rare, start + MIN)
        end = rare[k] if k < len(rare) else n
        if end >= start + NORMAL:
            k = bisect_left(common, start + NORMAL)
            end = min(common[k] if k < len(common) else n, start + MAX, n)
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_digests(data: bytes, ends: list[int], start: int = 0) -> list[tuple[str, int]]:
    found = []
    for end in ends:
        found.append((f"{xxhash.xxh64_intdigest(data[start:end]):016x}", end - start))
        start = end
    return found


def as_string(chunks: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in sorted(chunks.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """The share of the length of ``a`` that ``b`` holds; 1 for two empty ones."""
    if not a:
        return 1.0 if not b else 0.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


class _Doc:
    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.data = self.text.encode()
        self.ends = cuts(self.data)
        self.list = chunk_digests(self.data, self.ends)
        self.chunks = dict(self.list)

    def against(self, following: _Doc) -> tuple:
        n = len(self.text)
        k = n // 4
        edited, chunks = self.data, self.chunks
        if k:
            head = self.text[: n - k].encode()
            edited = head + following.text[:k].encode()
            # chunks that end well before the edit stay as they are
            same = max(0, bisect_left(self.ends, len(head)) - 1)
            start = self.ends[same - 1] if same else 0
            chunks = dict(self.list[:same] + chunk_digests(edited, cuts(edited, start), start))
        return (self.doc_id, n, hashlib.sha256(edited).hexdigest(), as_string(self.chunks), as_string(chunks), likeness(self.chunks, chunks), likeness(self.chunks, following.chunks))


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by range, own before borrowed, then id: each own row against the row after it."""
    columns = [c.split()[0] for c in RESULT.split(", ")]
    at, last, done = None, None, False
    for b in batches:
        out = []
        for target, borrowed, doc_id, text in zip(b["target"], b["borrowed"], b["doc_id"], b["text"], strict=True):
            if target != at:
                at, last, done = target, None, False
            if done:
                continue
            doc = _Doc(doc_id, text)
            if last is not None:
                out.append(last.against(doc))
            last, done = doc, bool(borrowed)
        if out:
            frame = pd.DataFrame(out, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame


def _place(rank: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``rank``, by every so many of them first and then those in between."""
    every = max(1, math.isqrt(len(bounds)))
    upto = lambda some: F.size(F.filter(some, lambda b: b <= rank))
    listed = lambda some: F.lit(np.array(some, np.int64))
    passed = upto(listed(bounds[::every]))
    before = (passed - 1) * every
    return F.when(passed > 0, before + upto(F.slice(listed(bounds), before + 1, F.lit(every)))).otherwise(0)


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of ``docs`` (doc_id, text).

    A null text counts as empty: no chunks, an edited text that is empty too, near_edited 1. Rows are
    ordered by doc_id (null first), repeated ids by text; a single row is followed by itself. Other
    columns are ignored. ``ranges``: by default as many as there are shuffle partitions.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = docs.agg(F.percentile_approx(rank, shares, 100 * ranges)).first()[0] or []  # as many as there are ranges
    place = _place(F.col("rank"), sorted(bounds))
    ids = docs.select(rank.alias("rank")).withColumn("place", place)
    heads = ids.groupBy("place").agg(F.min("rank").alias("rank"))
    before = F.coalesce(F.lag("place").over(Window.orderBy("place")), F.max("place").over(Window.partitionBy()))
    heads = heads.select("rank", before.alias("before"))  # one row for each range
    rows = docs.select("doc_id", "text", rank.alias("rank")).withColumn("place", place)
    rows = rows.join(F.broadcast(heads), "rank", "left")
    own, lent = F.struct(F.col("place").alias("target"), F.lit(0).alias("borrowed")), F.struct(F.col("before").alias("target"), F.lit(1).alias("borrowed"))
    to = F.filter(F.array(own, F.when(F.col("before").isNotNull(), lent)), lambda x: x.isNotNull())
    dealt = rows.select("doc_id", "text", "rank", F.explode(to).alias("to")).select("to.target", "to.borrowed", "rank", "doc_id", "text")
    dealt = dealt.repartitionById(ranges, "target").sortWithinPartitions("target", "borrowed", "rank", "text")
    return dealt.mapInPandas(_stream, RESULT)
