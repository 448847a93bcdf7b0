"""Cross-tokenizer alignment: token ends of two tokenizers merged along a merge path.

Tokenizer A (byte-level BPE) reads a space and the text, B (pieces with a word mark) the text, whose mark
it adds itself, so both cover the same bytes. Bytes where a token of A and one of B end cut the tokens into
groups; a token of A and one of B that share a byte are a link.

Merging is the work that grows with a document, so it is what is divided: the ends of A and of B, each
ascending, span a grid, and its diagonals, ``PIECE`` apart, are cut by binary searches into pieces of
equal work, wherever documents begin or end. All pieces are then merged side by side, a step at a time, each from
its own place; an end that comes from both sides closes a group, and a pair of equal ends that lies on
two pieces is stitched, as its second half looks back at the first.

Texts are tokenized by units: the parts between single spaces after which neither tokenizer looks back (B
has no piece with a mark after another character, which is checked; else a text is one unit). New units
go to the tokenizers many at a time, and a bounded cache keeps their ids. Long texts are merged in
segments of about ``SEGMENT`` bytes that end with a unit, which both tokenizers end with too.

Scale: the first pass writes, for each chunk of about ``CHUNK`` bytes of documents, a row a document with
its links (numbers of distinct pairs within the chunk, compressed) and a row a distinct pair of the chunk.
Only the latter are shuffled by pair, so however common a pair, it has a row a chunk; they are summed,
compared with the best of their A id, and sent back to their chunk, where documents look them up. A chunk
is of bounded size, and nothing that grows with the corpus is broadcast: the best counts, one row an A id,
are bounded by A's vocabulary.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Ends that a piece merges, bytes of text merged at a time, and bytes of text in a chunk, about.
PIECE, SEGMENT, CHUNK = 256, 1 << 21, 1 << 24
#: Bytes of the cache of units and their ids, about; it is emptied when full. Bytes of new units in one call.
CACHE, CALL = 192 << 20, 1 << 16
MARK = "▁"
_FAR = np.int64(1) << 60

FIRST = "chunk long, nth int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pair long, code int, docs int"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in ddl.split(", ")])


def byte_level_letters() -> dict[str, int]:
    """What byte each letter of a byte-level vocabulary stands for: bytes that print stand for themselves."""
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


def _gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[first[k] : first[k] + sizes[k]]`` for each k, in a row."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)]


class Side:
    """A tokenizer: ids of units, and the bytes of each id."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.sizes = np.array([len(b) for b in token_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)

    def add(self, at: int, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep the ids of units from number ``at`` on."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + len(counts) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[at : at + len(counts)] = self.used + np.cumsum(counts) - counts
        self.count[at : at + len(counts)] = counts
        self.used += len(ids)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Units:
    """Numbers of the units of texts, and their ids in both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_level_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        plain = self.a.get_vocab(with_added_tokens=False)
        names = {i: t for t, i in vocabulary.items()}
        spelled = [names.get(i, "") for i in range(max(vocabulary.values()) + 1)]
        self.left = Side([bytes(letters[c] for c in t) if t in plain and all(c in letters for c in t) else t.encode() for t in spelled])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.right = Side([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)])
        self.by_unit = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}  # -1: a word after which a unit may go on
        self.others: dict[str, int] = {}
        self.size, self.held = 0, 0
        self.good, self.bytes = np.zeros(1 << 12, bool), np.zeros(1 << 12, np.int64)
        self.left.clear(), self.right.clear()

    def split(self, text: str) -> list[str]:
        """The units of a text in which words of white space stand side by side, or end in it."""
        return regex.split(r"(?<=\S) (?=[^ ])", text) if self.by_unit else [text]

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The unit numbers of each text (none is empty); they hold until the next call."""
        if self.held > CACHE:
            self.clear()
        known = self.words
        words = [t.split(" ") if self.by_unit else [""] for t in texts]
        new: set[str] = set()
        for ws in words:
            new.update(filterfalse(known.__contains__, ws))
        glue = [w for w in new if not w or w[-1].isspace()]
        known.update(dict.fromkeys(glue, -1))
        self._learn(sorted(new.difference(glue)), known)
        out = [np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)) for ws in words]
        glued = {k: self.split(texts[k]) for k, found in enumerate(out) if found.min() < 0}
        self._learn(sorted({u for us in glued.values() for u in us if u not in self.others}), self.others)
        for k, us in glued.items():
            out[k] = np.fromiter(map(self.others.__getitem__, us), np.int64, len(us))
        return out

    def _learn(self, units: list[str], into: dict[str, int]) -> None:
        loose = [u for u in units if u and not u[-1].isspace() and MARK not in u]
        chosen = set(loose)
        at = 0
        while at < len(loose):
            end, size = at, 0
            while end < len(loose) and (size < CALL or end == at):
                size += len(loose[end]) + 1
                end += 1
            self._learn_many(loose[at:end], into)
            at = end
        for u in units:
            if u not in chosen:
                self._learn_one(u, into)

    def _keep(self, units: list[str], into: dict[str, int], a: tuple, b: tuple, good: np.ndarray, sizes: np.ndarray) -> None:
        at = self.size
        self.size += len(units)
        into.update(zip(units, range(at, self.size), strict=True))
        while self.size > len(self.good):
            self.good, self.bytes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.good, self.bytes))
        self.good[at : self.size], self.bytes[at : self.size] = good, sizes
        self.left.add(at, *a), self.right.add(at, *b)
        self.held += int(sizes.sum()) + 190 * len(units) + 4 * (len(a[0]) + len(b[0]))

    def _learn_many(self, units: list[str], into: dict[str, int]) -> None:
        """Units of which none ends in white space: as one text, cut where both tokenizers end with a unit."""
        text = " ".join(units)
        data = (" " + text).encode()
        sizes = np.array([len(u.encode()) + 1 for u in units], np.int64)
        stops, found = np.cumsum(sizes), []
        for side, ids in ((self.left, self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids), (self.right, self.b.encode(text))):
            ends = np.cumsum(side.sizes[ids])
            last = np.searchsorted(ends, stops)
            if side.spell(ids) != data or (ends[np.minimum(last, len(ends) - 1)] != stops).any():
                for u in units:
                    self._learn_one(u, into)
                return
            found.append((np.array(ids, np.int32), np.diff(np.r_[0, last + 1])))
        self._keep(units, into, *found, np.ones(len(units), bool), sizes)

    def _learn_one(self, unit: str, into: dict[str, int]) -> None:
        a, b, data = self.a.encode_batch_fast([" " + unit], add_special_tokens=False)[0].ids, self.b.encode(unit), (" " + unit).encode()
        good = self.left.spell(a) == data == self.right.spell(b)
        self._keep([unit], into, *[(np.array(x, np.int32), np.array([len(x)])) for x in (a, b)], np.array([good]), np.array([len(data)]))


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending ends ``a`` and ``b`` merged, those of ``a`` first where equal.

    For each merged end, whether it comes from ``a``, and how many of ``a`` and of ``b`` are before it.
    """
    total = len(a) + len(b)
    starts = np.arange(0, total, piece)
    low, high = np.maximum(0, starts - len(b)), np.minimum(starts, len(a))
    while (open_ := low < high).any():  # where each diagonal crosses the path
        mid = (low + high) // 2
        ahead = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(starts - 1 - mid, 0, len(b) - 1)])
        low, high = np.where(ahead, mid + 1, low), np.where(open_ & ~ahead, mid, high)
    i, j = low.astype(np.int32), (starts - low).astype(np.int32)
    a, b = np.r_[a, np.full(piece + 1, _FAR)], np.r_[b, np.full(piece + 1, _FAR)]
    own, before_a, before_b = np.empty((piece, len(starts)), bool), np.empty((piece, len(starts)), np.int32), np.empty((piece, len(starts)), np.int32)
    for step in range(piece):
        take = a[i] <= b[j]
        own[step], before_a[step], before_b[step] = take, i, j
        i = i + take
        j = j + ~take
    return tuple(x.T.ravel()[:total] for x in (own, before_a, before_b))


class Groups:
    """The groups and links of two lists of tokens over the same bytes."""

    def __init__(self, a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        own, i, j = merge_path(a_ends, b_ends)
        shut = ~own
        shut[shut] = a_ends[i[shut] - 1] == b_ends[j[shut]]  # the second of two equal ends shuts a group
        group = np.cumsum(shut) - shut
        self.a_group, self.b_group = group[own], group[~own]
        linked = ~shut
        #: For each link the places of its tokens.
        self.link_a, self.link_b = i[linked], j[linked]
        self.a_ids, self.b_ids = a_ids, b_ids

    def spelled(self, digits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The groups as bytes, ';' after each, and how many of these bytes come before each token of A."""
        a, b = self.a_group, self.b_group
        groups = int(b[-1]) + 1 if len(b) else 0
        of_a, of_b = np.bincount(a, minlength=groups), np.bincount(b, minlength=groups)
        at_a = np.arange(len(a)) + (np.cumsum(of_b) - of_b)[a]
        at_b = np.arange(len(b)) + np.cumsum(of_a)[b]
        ids, marks = np.empty(len(a) + len(b), np.int32), np.empty(len(a) + len(b), np.uint8)
        ids[at_a], ids[at_b] = self.a_ids, self.b_ids
        marks[at_a] = np.where(np.r_[a[1:] != a[:-1], True], ord("|"), ord(","))
        marks[at_b] = np.where(np.r_[b[1:] != b[:-1], True], ord(";"), ord(","))
        table, sizes, kept = digits
        size = sizes[ids]
        wide = table[ids] | marks.astype(np.uint64) << (size << 3).astype(np.uint64)  # the mark follows the digits
        data = wide.view(np.uint8)[kept[size].view(bool)]
        ends = np.cumsum(size.astype(np.int64) + 1)
        return data, (ends - size - 1)[at_a] if len(a) else ends


def digit_table(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal digits of 0 to ``most`` (below 10 ** 7) as bytes of one number, how many each has, and, by that, which bytes to keep with a mark."""
    names = [str(i).encode() for i in range(most + 1)]
    kept = np.tril(np.ones((8, 8), np.uint8))
    return np.frombuffer(b"".join(n.ljust(8, b"\0") for n in names), "<u8"), np.array([len(n) for n in names], np.int64), kept.view("<u8").ravel()


class _Doc:
    __slots__ = ("id", "sums", "sha", "bad")

    def __init__(self, doc_id):
        self.id, self.sums, self.sha, self.bad = doc_id, np.zeros(4, np.int64), None, False


class Aligner:
    """Aligns documents chunk by chunk; one is made in each Python worker."""

    def __init__(self, path_a: str, path_b: str):
        self.units = Units(path_a, path_b)
        self.digits = digit_table(max(len(self.units.left.sizes), len(self.units.right.sizes)))
        self.packer = zstandard.ZstdCompressor(level=3)

    def start(self, chunk: int) -> None:
        self.chunk, self.docs, self.bytes = chunk, [], 0
        self.pairs: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: list, texts: list[str | None]) -> None:
        """Align documents and add them to the chunk."""
        base = len(self.docs)
        self.docs += [_Doc(i) for i in ids]
        self.bytes += sum(len(t) for t in texts if t)
        with_text = [k for k, t in enumerate(texts) if t]
        numbers = self.units.of([texts[k] for k in with_text])
        parts, size = [], 0
        for k, units in zip(with_text, numbers, strict=True):
            if not self.units.good[units].all():
                continue
            ends = np.cumsum(self.units.bytes[units])
            at = 0
            while at < len(units):  # segments end with a unit
                room = max(SEGMENT - size, 1) + (ends[at - 1] if at else 0)
                end = max(at + 1, int(np.searchsorted(ends, room, "right")))
                parts.append((base + k, units[at:end]))
                size += int(ends[end - 1] - (ends[at - 1] if at else 0))
                at = end
                if size >= SEGMENT or at < len(units):
                    self._segment(parts)
                    parts, size = [], 0
        if parts:
            self._segment(parts)

    def _segment(self, parts: list[tuple[int, np.ndarray]]) -> None:
        units = np.concatenate([u for _, u in parts])
        stops = np.cumsum([len(u) for _, u in parts])
        sides, bounds, ends = [], [], []
        for side in (self.units.left, self.units.right):
            count = side.count[units]
            ids = _gather(side.flat, side.first[units], count)
            sides.append(ids)
            bounds.append(np.r_[0, np.cumsum(count, dtype=np.int64)[stops - 1]])
            ends.append(np.cumsum(side.sizes[ids]))
        g = Groups(*sides, *ends)
        data, before = g.spelled(self.digits)
        view = memoryview(data)
        text_at = np.r_[before, len(data)][bounds[0]]
        group_at = np.r_[g.a_group, g.a_group[-1] + 1][bounds[0]]
        link_at = np.searchsorted(g.link_a, bounds[0])
        for k, (doc, _) in enumerate(parts):
            d = self.docs[doc]
            d.sums += [b[k + 1] - b[k] for b in (*bounds, group_at, link_at)]
            if d.sha is None:
                d.sha = hashlib.sha256()
            else:
                d.sha.update(b";")
            d.sha.update(view[text_at[k] : text_at[k + 1] - 1])
        keys = (g.a_ids[g.link_a].astype(np.int64) << 32) | g.b_ids[g.link_b]
        codes, pairs = pd.factorize(keys)
        docs = np.repeat(np.array([p for p, _ in parts], np.int64), np.diff(link_at))
        both, times = _counted((docs << 32) | codes)
        self.held.append((both >> 32, both & 0xFFFFFFFF, times))
        self.pairs.append(pairs)

    def finish(self) -> Iterator[pa.RecordBatch]:
        """The rows of the chunk: its documents, then its distinct pairs."""
        codes, pairs = pd.factorize(np.concatenate([*self.pairs, np.zeros(0, np.int64)]))
        doc, code, times, at = [], [], [], 0
        for own, (d, c, t) in zip(self.pairs, self.held, strict=True):
            doc.append(d), code.append(codes[at : at + len(own)][c]), times.append(t)
            at += len(own)
        doc, code, times = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (doc, code, times))
        # a document of several segments holds a pair once; common pairs get small codes
        keys = (doc << 32) | code
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        keys, times = keys[first], np.add.reduceat(times, first) if len(first) else times
        docs = np.bincount(keys & 0xFFFFFFFF, minlength=len(pairs))
        rank = np.argsort(np.argsort(-docs, kind="stable"), kind="stable")
        keys = (keys >> 32 << 32) | rank[keys & 0xFFFFFFFF]
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        ends = np.searchsorted(keys >> 32, np.arange(len(self.docs) + 1))
        rows: dict[str, list] = {c.split()[0]: [] for c in FIRST.split(", ")}
        for n, d in enumerate(self.docs):
            part = slice(ends[n], ends[n + 1])
            rows["doc_id"].append(d.id)
            for name, v in zip(("n_a", "n_b", "n_groups", "n_links"), d.sums.tolist(), strict=True):
                rows[name].append(v)
            rows["groups_sha256"].append(d.sha.hexdigest() if d.sha else "")
            rows["links"].append(self.packer.compress(pack_links(keys[part] & 0xFFFFFFFF, times[part])))
        yield _batch(_schema(FIRST), len(self.docs), chunk=np.full(len(self.docs), self.chunk), nth=np.arange(len(self.docs), dtype=np.int32), **{k: v for k, v in rows.items() if v})
        for at in range(0, len(pairs), 1 << 16):
            p = pairs[at : at + (1 << 16)]
            yield _batch(_schema(FIRST), len(p), chunk=np.full(len(p), self.chunk), pair=p, code=rank[at : at + len(p)].astype(np.int32), docs=docs[at : at + len(p)].astype(np.int32))


def _batch(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.diff(np.r_[first, len(keys)])


def pack_links(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending codes as steps, and how often each comes, byte plane by byte plane."""
    both = np.concatenate([np.diff(codes, prepend=0), times]).astype("<u4")
    return both.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _first_pass(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _ALIGNERS[path_a, path_b]
        nth = TaskContext.get().partitionId() << 32
        aligner.start(nth)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            while at < len(ids):
                some, size = [], 0
                while at + len(some) < len(ids) and size < SEGMENT:  # rows whose texts are open at a time
                    some.append(texts[at + len(some)].as_py())
                    size += len(some[-1] or "")
                aligner.add(ids[at : at + len(some)], some)
                at += len(some)
                if aligner.bytes >= CHUNK:
                    yield from aligner.finish()
                    nth += 1
                    aligner.start(nth)
        if aligner.docs:
            yield from aligner.finish()

    return run


def _look_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a chunk with the counts of their links."""
    code = pairs.column("code").to_numpy()
    counts, best = np.zeros(len(code), np.int64), np.zeros(len(code), bool)
    counts[code], best[code] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy()
    unpacker = zstandard.ZstdDecompressor()
    sums, bests = [], []
    for data in docs.column("links"):
        codes, times = unpack_links(unpacker.decompress(data.as_py()))
        sums.append(int(counts[codes] @ times))
        bests.append(int(times[best[codes]].sum()))
    columns = {n: docs.column(n) for n in docs.column_names} | {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    return pa.table([columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.ChunkedArray) else columns[f.name] for f in _schema(ALIGNED)], schema=_schema(ALIGNED))


def align_documents(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of ``docs`` (doc_id, text).

    ``byte_level`` (A, a file of tokenizers) and ``pieces`` (B, a sentencepiece file) are paths on every
    worker. ``n_best`` counts links whose pair of ids is in as many documents as any of its A id,
    ``count_sum`` adds up the documents of all links. A null or empty text, and one whose tokens don't
    spell it (such as one that holds the word mark), has no tokens: zeros and ''. Rows of an id that comes
    again are documents of their own; other columns are ignored.
    """
    first = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_first_pass(byte_level, pieces), FIRST), "alignment")
    own = first.filter("pair IS NOT NULL").select("chunk", "pair", "code", "docs")
    totals = own.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32).cast("int"))
    best = totals.groupBy("a").agg(F.max("n").alias("most"))  # a row for each A id at most
    totals = totals.join(F.broadcast(best), "a").select(F.col("pair").alias("of"), "n", (F.col("n") == F.col("most")).alias("best"))
    counted = own.join(totals, own["pair"] == totals["of"]).select(F.col("chunk").alias("chunk_of"), "code", "n", "best")
    rows = first.filter("nth IS NOT NULL").drop("pair", "code", "docs", "nth")
    return rows.groupBy("chunk").cogroup(counted.groupBy("chunk_of")).applyInArrow(_look_up, ALIGNED)
