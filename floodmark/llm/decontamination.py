"""Benchmark decontamination: an FM-index for each shard of the training documents.

A word is a run of ASCII letters and digits and of everything beyond ASCII, with A-Z in lower case. A
window is ``width`` consecutive words of a benchmark item, or the whole of an item that has fewer. Where a
window occurs in a document, its words there are hit; neighbouring hit words make a removal span.

Documents are read in shards of about ``SHARD`` bytes, each a few batches of one task. Words that no item
has can be part of no occurrence, so a shard's index holds the runs of the others, each ended by 0; runs
shorter than the shortest window are left out as well. All windows are searched backward in it at once by
ranks in its wavelet matrix, and occurrences are located by sampled suffix places. Words are looked up by
64-bit hashes, and those of the runs are then compared byte by byte, so results are exact.

Scale: one pass over the texts and no shuffle. The benchmark is what is broadcast, in blocks of about
``BLOCK`` bytes of text; one of several blocks is searched in a pass of its own, which adds to what the
passes before it found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .fm_index import FMIndex
from .shingle_join import _numbers, _utf8

WIDTH = 10
#: Bytes of benchmark text that are broadcast at once, about.
BLOCK = 8 << 20
#: Bytes of text in a shard, and bytes that are split into words at a time, about.
SHARD, SLICE = 64 << 20, 1 << 19
#: Occurrences located at a time.
LOCATED = 1 << 18

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = re.compile("[A-Z]+")
#: Lower case of each byte (A-Z alone), and which bytes belong to words: all bytes of characters beyond ASCII do.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.array([not b < 0x80 or chr(b).isalnum() for b in range(256)])
_FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_MIX = _numbers(b"word", 3) | np.uint64(1)

FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
_HITS = "hits array<struct<first: int, end: int>>"


def words_of(text: str | None) -> list[str]:
    """The words of a text; null has none."""
    return WORD.findall(_UPPER.sub(lambda m: m[0].lower(), text or ""))


def _eights(data: np.ndarray) -> np.ndarray:
    """At each place the eight bytes from there on as one number; ``data`` ends with eight spare bytes."""
    return np.ndarray((len(data) - 8,), "<u8", data, strides=(1,))


def _hashes(eights: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    h = sizes.astype(np.uint64) * _MIX[0]
    some, left, at = slice(None), sizes, starts
    while len(at):
        g = (h[some] ^ (eights[at] & _FIRST_BYTES[np.minimum(left, 8)])) * _MIX[1]
        g = (g ^ (g >> np.uint64(32))) * _MIX[2]
        h[some] = g ^ (g >> np.uint64(29))
        more = np.flatnonzero(left > 8)
        some = more if isinstance(some, slice) else some[more]
        left, at = left[more] - 8, at[more] + 8
    return h


class Phrases:
    """The windows of a block of items, and the numbers of its words from 1 on."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.names = sorted({name or "" for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        vocabulary: dict[str, int] = {}
        rows, lengths, owners = [], [], []
        for name, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            n = min(width, len(numbers))
            for s in range(len(numbers) - n + 1 if n else 0):
                rows.append(numbers[s : s + n] + [0] * (width - n))
                lengths.append(n)
                owners.append(number[name or ""])
        table = np.array(rows, np.int32).reshape(len(rows), width)
        self.windows, which = np.unique(table, axis=0, return_inverse=True)
        self.lengths = (self.windows > 0).sum(axis=1)
        self.shortest = int(self.lengths.min()) if len(rows) else 0
        pairs = np.unique(np.stack([which.ravel(), np.array(owners, np.int64)], axis=1), axis=0) if rows else np.zeros((0, 2), np.int64)
        #: The items that have window w: owners[first[w] : first[w + 1]].
        self.owners, self.first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        encoded = [w.encode() for w in vocabulary]
        self.sizes = np.array([0, *map(len, encoded)], np.int64)
        self.starts = np.cumsum(np.r_[0, self.sizes[:-1]])
        self.data = np.frombuffer(b"".join(encoded) + bytes(8), np.uint8)
        hashes = _hashes(_eights(self.data), self.starts[1:], self.sizes[1:])
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of words with these hashes, 0 for those of no item."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int32)
        bits = max(12, 4 + len(self.hashes).bit_length())
        seen = np.zeros(1 << bits, bool)
        seen[self.hashes & np.uint64((1 << bits) - 1)] = True
        maybe = np.flatnonzero(seen[hashes & np.uint64((1 << bits) - 1)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        out = np.zeros(len(hashes), np.int32)
        same = self.hashes[at] == hashes[maybe]
        out[maybe[same]] = self.order[at[same]] + 1
        return out

    def same(self, eights: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether the bytes at ``starts`` are those of the words ``numbers``, whose sizes are known to be equal."""
        ok, own = np.ones(len(starts), bool), _eights(self.data)
        some, left, at, there = np.arange(len(starts)), self.sizes[numbers], starts, self.starts[numbers]
        while len(some):
            ok[some] &= (eights[at] ^ own[there]) & _FIRST_BYTES[np.minimum(left, 8)] == 0
            more = np.flatnonzero(left > 8)
            some, left, at, there = some[more], left[more] - 8, at[more] + 8, there[more] + 8
        return ok


def _split(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, sizes and hashes of the words between ``offsets``, slice by slice."""
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        end = min(at + SLICE, stop)
        while end < stop and _IN_WORD[data[end]]:  # a slice ends where no word goes on
            ahead = np.flatnonzero(~_IN_WORD[data[end : min(end + SLICE, stop)]])
            end = end + int(ahead[0]) if len(ahead) else min(end + SLICE, stop)
        low = np.zeros(end - at + 8, np.uint8)
        low[:-8] = _LOWER[data[at:end]]
        inside = _IN_WORD[low[:-8]]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        breaks = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, end)] - at
        first[breaks] = inside[breaks]  # a document starts here
        last[breaks - 1] = inside[breaks - 1]
        starts = np.flatnonzero(first)
        sizes = np.flatnonzero(last) + 1 - starts
        yield starts + at, sizes, _hashes(_eights(low), starts, sizes)
        at = end


class _Batch:
    """A batch of documents: counts of words, and its runs of words that items have.

    ``starts`` and ``sizes`` are bytes in the batch, ``docs`` and ``places`` the document and the number
    of each word of a run, ``ids`` its symbol; a run ends with a row whose symbol is 0.
    """

    def __init__(self, batch: pa.RecordBatch, phrases: Phrases):
        self.batch = batch
        offsets, data = _utf8(batch.column("text"))
        self.offsets, self.data = offsets, data
        starts, sizes, ids = [], [], []
        for s, z, h in _split(data, offsets):
            numbers = phrases.numbers(h)
            numbers[phrases.sizes[numbers] != z] = 0
            starts.append(s), sizes.append(z), ids.append(numbers)
        self.starts, self.sizes = np.concatenate([*starts, np.zeros(0, np.int64)]), np.concatenate([*sizes, np.zeros(0, np.int64)])
        ids = np.concatenate([*ids, np.zeros(0, np.int32)])
        self.bounds = np.searchsorted(self.starts, offsets)  # words of document i: from bounds[i] to bounds[i + 1]
        # a run ends before a word of no item and before the next document
        change = np.zeros(len(ids) + 1, bool)
        change[self.bounds] = True
        inside = np.r_[ids > 0, False]
        begin = np.flatnonzero(inside & (change | np.r_[True, ~inside[:-1]]))
        end = np.flatnonzero(np.r_[inside[:-1] & (~inside[1:] | change[1:])]) + 1
        long = end - begin >= max(1, phrases.shortest)
        begin, end = begin[long], end[long]
        runs = end - begin + 1
        self.words = np.arange(int(runs.sum())) + np.repeat(begin - np.r_[0, np.cumsum(runs)[:-1]], runs)
        stops = np.cumsum(runs) - 1
        self.ids = np.zeros(len(self.words), np.int32)
        kept = np.ones(len(self.words), bool)
        kept[stops] = False
        self.ids[kept] = ids[self.words[kept]]
        self.words[stops] -= 1
        low = np.concatenate([data[offsets[0] :], np.zeros(8, np.uint8)]) if len(runs) else np.zeros(8, np.uint8)
        low = _LOWER[low]
        at = np.flatnonzero(kept)
        wrong = at[~phrases.same(_eights(low), self.starts[self.words[at]] - offsets[0], self.ids[at])]
        self.ids[wrong] = 0  # words that share no more than a hash


def _result(b: _Batch, hit: np.ndarray, items: list[list[str]], last: bool, keep: bool) -> pa.RecordBatch:
    """The rows of a batch: ``hit`` says of each of its words whether it is hit."""
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    first, end = edges[::2], edges[1::2]
    inner = b.bounds[1:-1]  # spans end with their document
    cut = inner[np.searchsorted(first, inner, "left") > np.searchsorted(end, inner, "right")] if len(first) else inner[:0]
    first, end = np.sort(np.r_[first, cut]), np.sort(np.r_[end, cut])
    first, end = first[first < end], end[first < end]
    lists = np.searchsorted(first, b.bounds).astype(np.int32)
    columns = {"doc_id": b.batch.column("doc_id")}
    if keep:
        columns["text"] = b.batch.column("text")
    sums = np.r_[0, np.cumsum(hit)]
    columns["n_words"], columns["n_hit"] = pa.array(np.diff(b.bounds)), pa.array(sums[b.bounds[1:]] - sums[b.bounds[:-1]])
    columns["items"] = pa.array(items, pa.list_(pa.string()))
    if last:
        doc = np.repeat(np.arange(len(b.bounds) - 1), np.diff(lists))
        starts, ends = b.starts[first], b.starts[end - 1] + b.sizes[end - 1] if len(end) else end
        points = [np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)]
        for i in np.unique(doc):  # bytes to code points, where there are spans
            begins = np.r_[0, np.cumsum(b.data[b.offsets[i] : b.offsets[i + 1]] & 0xC0 != 0x80)]
            for p, at in zip(points, (starts, ends), strict=True):
                p[doc == i] = begins[at[doc == i] - b.offsets[i]]
        columns["spans"] = pa.ListArray.from_arrays(pa.array(lists), pa.StructArray.from_arrays([pa.array(p) for p in points], ["start", "end"]))
    else:
        base = np.repeat(b.bounds[:-1], np.diff(lists))
        columns["hits"] = pa.ListArray.from_arrays(pa.array(lists), pa.StructArray.from_arrays([pa.array((x - base).astype(np.int32)) for x in (first, end)], ["first", "end"]))
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def search_shard(batches: list[_Batch], phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Which words of the runs of ``batches`` are hit, and pairs (place of an occurrence, window)."""
    text = np.concatenate([b.ids for b in batches] + [np.zeros(1, np.int32)])
    if len(text) == 1 or not len(phrases.windows):
        return np.zeros(len(text) - 1, bool), np.zeros((0, 2), np.int64)
    index = FMIndex(text, len(phrases.sizes))
    low, high = index.search(phrases.windows, phrases.lengths)
    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    ends, pairs = np.cumsum(counts), []
    change = np.zeros(len(text) + 1, np.int64)
    for at in range(0, int(ends[-1]) if len(ends) else 0, LOCATED):
        nth = np.arange(at, min(at + LOCATED, int(ends[-1])))
        which = np.searchsorted(ends, nth, "right")
        window = found[which]
        place = index.locate(low[window] + nth - (ends[which] - counts[which]))
        np.add.at(change, place, 1)
        np.add.at(change, place + phrases.lengths[window], -1)
        pairs.append(np.stack([place, window], axis=1))
    return np.cumsum(change)[: len(text) - 1] > 0, np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)


def _earlier(b: _Batch, hit: np.ndarray, items: list[set[str]]) -> None:
    """Add what the passes before this one have found."""
    for i, (hits, names) in enumerate(zip(b.batch.column("hits").to_pylist(), b.batch.column("items").to_pylist(), strict=True)):
        items[i].update(names)
        for h in hits:
            hit[b.bounds[i] + h["first"] : b.bounds[i] + h["end"]] = True


def _pass(phrases, first: bool, last: bool, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Phrases = phrases.value

        def flush(shard: list[_Batch]) -> Iterator[pa.RecordBatch]:
            hit_in_runs, pairs = search_shard(shard, p)
            base = 0
            for b in shard:
                size = len(b.ids)
                hit = np.zeros(len(b.starts), bool)
                hit[b.words[hit_in_runs[base : base + size]]] = True
                own = pairs[(pairs[:, 0] >= base) & (pairs[:, 0] < base + size)]
                doc = np.searchsorted(b.bounds, b.words[own[:, 0] - base], "right") - 1
                items: list[set[str]] = [set() for _ in range(b.batch.num_rows)]
                for d, w in np.unique(np.stack([doc, own[:, 1]], axis=1), axis=0).tolist():
                    items[d].update(p.names[i] for i in p.owners[p.first[w] : p.first[w + 1]])
                if not first:
                    _earlier(b, hit, items)
                yield _result(b, hit, [sorted(x) for x in items], last, keep or not last)
                base += size

        shard, held = [], 0
        for batch in batches:
            shard.append(_Batch(batch, p))
            held += int(shard[-1].offsets[-1] - shard[-1].offsets[0])
            if held >= SHARD:
                yield from flush(shard)
                shard, held = [], 0
        if shard:
            yield from flush(shard)

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, keep_text: bool = False, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans for each row of ``docs`` (doc_id, text), with ``text`` if asked for.

    ``benchmark`` has item_id (as text; null is named '') and text. ``items`` are the sorted distinct ids
    of items with windows that occur, ``spans`` the places of hit words in code points, end exclusive,
    neighbours merged. Null and empty texts have no words, and items without words no windows. Rows of an
    id that comes again are rows of their own; items of one id count once. Other columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    context = docs.sparkSession.sparkContext
    out = docs.select("doc_id", "text")
    for i in range(blocks):
        rows = items.filter(number == i).collect()  # of about ``block`` bytes
        phrases = context.broadcast(Phrases([(r.item_id, r.text) for r in rows], width))
        first, last = i == 0, i == blocks - 1
        schema = FOUND if last else FOUND.rpartition(", spans")[0] + ", " + _HITS
        if keep_text or not last:
            schema = schema.replace("doc_id long", "doc_id long, text string")
        out = out.mapInArrow(_pass(phrases, first, last, keep_text), schema)
        if not last:
            out = written(out, "decontamination")
    return out


def _without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for i, spans in enumerate(b.column("spans").to_pylist()):
            kept, at = [], 0
            for s in spans:
                kept.append(texts[i][at : s["start"]])
                at = s["end"]
            if spans:
                texts[i] = "".join(kept) + texts[i][at:]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), b.column("items")], names=["doc_id", "text", "items"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text without its removal spans, items: one row for each of ``docs``; a null text stays null."""
    return find_contamination(docs, benchmark, width, keep_text=True).mapInArrow(_without_spans, "doc_id long, text string, items array<string>")


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs``."""
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return find_contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


ORACLE = r"""
WITH lower_case AS (
  SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, id, doc FROM (
    SELECT text, row_number() OVER () AS id, doc_id AS doc FROM documents)
), d AS (SELECT id, doc, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lower_case),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)
), placed AS (
  SELECT id, n, s, array_to_string(w[s : s + n - 1], ' ') AS g FROM (
    SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hits AS (SELECT id, s, n, item_id FROM placed JOIN win USING (n, g)),
words AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT id, s, n FROM hits)) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY id)
SELECT doc AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (id) LEFT JOIN items USING (id)
"""
