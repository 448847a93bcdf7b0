"""N-gram Jaccard join: size-aware, heavy-light, exact.

Two documents link when their sets of five-word shingles have 100 * |A and B| >= 80 * |A or B|. Documents
of equal sets are one node. Candidates meet in lists, and a list is keyed in one of two ways:

* small sets (at most ``boundary`` shingles) enumerate all subsets of two out of a prefix: sets of n
  shingles that overlap in ceil(0.8 n) share two of their first floor(0.2 n) + 2, in any common order;
* large sets post each of their first floor(0.2 n) + 1 shingles, and so do those small sets that a large
  one can still link with. Small pairs that meet in such a list are left to the subsets.

The boundary is chosen by cost: rows of subsets against rows and expected scans of lists. The common
order puts shingles that many documents hold last, so passages shared by many documents rarely meet;
which these are comes from counts over all tasks, kept in a bitmap of fixed size. The order only has to
be the same for all documents: a crowded bitmap costs time and never a link.

Lists up to ``SHORT`` nodes give all their pairs. Of a longer one, which is a group of near copies, the
node that meets it earliest in its order (that with the fewest rare shingles) is compared with all others.
What is then left of a list are pairs of different components. While these are many for the rows that
hold them and the last such round lowered them, another round takes another node of each list; then lists
are dealt out in blocks of bounded size, a task looks at the pairs between two blocks, and only pairs
whose bounds leave room for a link are handed on.

A pair has to pass two bounds before its sets are compared: one from the places where it meets, one from
parity sketches. A sketch has a bit for each of ``SKETCH`` buckets, the parity of the shingles in it, so
two sketches differ in at most as many bits as the sets differ in shingles, and linked sets differ in at
most a ninth of the sum of their sizes. Both are exact: no link is lost.

Words, shingles and sets are compared by 64-bit hashes. A word's hash mixes its bytes eight by eight, a
set's hash has 64 more bits beside it, and sets that share the first but not the second are told apart.

A set moves to its comparisons as its compressed text, which is shorter than its hashes, and is built again
there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import without, written

WIDTH = 5
#: Shingles held by at least so many documents, as far as tasks see them twice, are put last.
FREQUENT = 16
#: Lists of at most so many nodes give all their pairs at once.
SHORT = 16
#: Bits of the bitmaps of frequent shingles and of candidate ids, as a power of two: 16 MB each at most.
MOST_MAP_BITS = 27
#: Bits of such a map for each entry. A map of frequent shingles takes only the most frequent ones, if need be.
ROOM = 32
#: Small sets have at most so many shingles, whatever the costs; beyond it subsets are never cheaper.
LARGEST_BOUNDARY = 64
#: Shingles that a task counts at a time.
COUNTED = 1_000_000
#: Shingles in a batch of sets that a task hands on.
HELD = 500_000
#: Salts that spread the lists of frequent shingles over tasks.
SALTS = 32
#: Bits of a parity sketch, and of the widest of the wide ones that larger sets have besides.
SKETCH, WIDEST = 2048, 1 << 17
#: Rows of a long list in a block; a task compares two blocks at a time.
BLOCK = 4096
#: Pairs of a round's lists for each of their rows from which another round of single nodes is worth it.
PAIRS_A_ROW = 2_000

#: Bytes of text hashed at a time.
CHUNK = 1 << 19

_MASK = (1 << 64) - 1


def _numbers(name: bytes, count: int) -> np.ndarray:
    """Fixed random 64-bit numbers, by rule."""
    return np.array([int.from_bytes(hashlib.sha256(b"%b %d" % (name, i)).digest()[:8], "little") for i in range(count)], np.uint64)


_MIX = _numbers(b"mix", WIDTH + 4) | np.uint64(1)
_SHIFT = np.uint64(29)
LARGE, SMALL, SUBSET = 0, 1, 2

#: Lower case of each byte (A-Z alone), and which bytes are blanks.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: What to keep of eight bytes of which so many belong to the word.
_FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LONG_WORD = 256


class Shingler:
    """Shingle sets of many texts at once, by array operations over their UTF-8 bytes.

    A word's hash takes in its bytes eight by eight; a shingle's hash mixes five word hashes.
    """

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words of ``data``, which ends with a blank."""
        inside = ~_BLANK[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edges = np.r_[0, edges] if inside[0] else edges
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return starts, np.array([], np.uint64)
        low = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
        eights = np.ndarray((len(data),), "<u8", low, strides=(1,))
        h = sizes.astype(np.uint64) * _MIX[WIDTH]
        some, left, at = slice(None), np.minimum(sizes, LONG_WORD), starts
        while len(at):
            x = eights[at] & _FIRST_BYTES[np.minimum(left, 8)]
            g = (h[some] ^ x) * _MIX[WIDTH + 1]
            g = (g ^ (g >> np.uint64(32))) * _MIX[WIDTH + 2]
            h[some] = g ^ (g >> _SHIFT)
            more = np.flatnonzero(left > 8)
            some = more if isinstance(some, slice) else some[more]
            left, at = left[more] - 8, at[more] + 8
        for k in np.flatnonzero(sizes > LONG_WORD).tolist():
            h[k] = xxhash.xxh3_64_intdigest(low[starts[k] : starts[k] + sizes[k]].tobytes())
        return starts, h

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """For each text (null: empty) its distinct shingle hashes, ascending."""
        offsets, data = _utf8(texts)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
            base, last = offsets[at], offsets[end]
            # a blank after each text keeps words apart
            sizes = offsets[at + 1 : end + 1] - offsets[at:end]
            spread = np.full(last - base + end - at, 0x20, np.uint8)
            first = np.r_[0, np.cumsum(sizes + 1)]
            spread[np.arange(last - base) + np.repeat(np.arange(end - at), sizes)] = data[base:last]
            starts, w = self.words(spread)
            bounds = np.searchsorted(starts, first)
            n = max(0, len(w) - WIDTH + 1)
            h = np.zeros(n, np.uint64)
            for k in range(WIDTH):
                h = (h ^ w[k : k + n]) * _MIX[k]
                h ^= h >> _SHIFT
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if y - x >= WIDTH:
                    s = np.sort(h[x : y - WIDTH + 1])
                    yield s[np.r_[True, s[1:] != s[:-1]]]
                elif y > x:  # fewer words: the whole sequence
                    one = y - x
                    for v in w[x:y].tolist():
                        one = ((one ^ v) * int(_MIX[WIDTH + 2])) & _MASK
                        one ^= one >> 31
                    yield np.array([one], np.uint64)
                else:
                    yield np.array([], np.uint64)
            at = end


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, nulls as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def least_overlap(n: int) -> int:
    """ceil(0.8 n): what a set of n has to share with any set it links with."""
    return -(-8 * n // 10)


def node_of(shingles: np.ndarray, bits: int = 64, clashes: frozenset[int] = frozenset()) -> tuple[int, int]:
    """The number of a set, from its first ``bits`` hash bits, and 64 hash bits beside it.

    Sets that ``clashes`` names are numbered by the latter.
    """
    whole = xxhash.xxh3_128_intdigest(shingles.tobytes())
    node, beside = (whole >> (128 - bits)) - (1 << (bits - 1)), (whole & _MASK) - 2**63
    return beside if node in clashes else node, beside


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


# --- first pass: sets, and shingles that a task sees more than once

FIRST = "doc_id long, text_hash long, n int, node long, beside long, key long, seen long"
_FIRST = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("beside", pa.int64()), ("key", pa.int64()), ("seen", pa.int64())])


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema``; columns that aren't given are null."""
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def _first_pass(node_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, gathered, size, nodes = Shingler(), [], 0, set()

        def counted() -> pa.RecordBatch:
            key = np.sort(np.concatenate(gathered))
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            seen = np.diff(np.r_[starts, len(key)])
            twice = seen > 1
            return _batch(_FIRST, key=_signed(key[starts[twice]]), seen=seen[twice])

        for b in batches:
            n, found, beside = [], [], []
            for s in shingler.sets(b.column("text")):
                node, other = node_of(s, node_bits)
                n.append(len(s))
                found.append(node)
                beside.append(other)
                if other not in nodes and len(s) > 1:
                    nodes.add(other)
                    gathered.append(s)
                    size += len(s)
                if size >= COUNTED:
                    yield counted()
                    gathered, size, nodes = [], 0, set()
            yield _batch(_FIRST, doc_id=b.column("doc_id"), text_hash=b.column("text_hash"), n=np.array(n, np.int32), node=np.array(found, np.int64), beside=np.array(beside, np.int64))
            pa.default_memory_pool().release_unused()
        if gathered:
            yield counted()

    return run


def map_bits(entries: int) -> int:
    """The size of a bitmap of so many entries, as a power of two."""
    return min(MOST_MAP_BITS, max(16, (ROOM * entries).bit_length()))


def bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of the top bits of ``column``, made of at most 2 ** (bits - 6) collected words."""
    place = F.shiftrightunsigned(column, 64 - bits)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{column}`, {64 - bits}) & 63 as int))")
    rows = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("b")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bitmap(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    place = values >> np.uint64(64 - (len(found).bit_length() + 5))
    return (found[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def frequent_from(steps: dict[int, int], room: int) -> int:
    """The count from which a shingle is frequent: ``FREQUENT`` times a power of two, so that at most ``room`` are.

    ``steps`` has the number of shingles by the bit length of their count.
    """
    least = FREQUENT.bit_length()
    while sum(c for k, c in steps.items() if k >= least) > room:
        least += 1
    return 1 << (least - 1)


def choose_boundary(sizes: dict[int, int], partners: float, largest: int = LARGEST_BOUNDARY) -> int:
    """The largest size of a small set, at the lowest cost over the given counts of sizes.

    A subset costs a row; a posted shingle a row and ``partners`` scanned list entries.
    """

    def subsets(n: int) -> int:
        p = n - least_overlap(n) + 2
        return p * (p - 1) // 2

    def scans(n: int) -> float:
        return (n - least_overlap(n) + 1) * (1 + partners)

    def cost(b: int) -> float:
        both = range(least_overlap(b + 1), b + 1)
        return sum(c * (subsets(n) if n <= b else scans(n)) for n, c in sizes.items()) + sum(sizes.get(n, 0) * scans(n) for n in both)

    return min(range(1, largest + 1), key=cost)


# --- second pass: postings

POSTINGS = "key long, node long, n int, place int, code byte, spread byte"
_POSTINGS = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("code", pa.int8()), ("spread", pa.int8())])


def _poster(shared, boundary: int, node_bits: int = 64):
    """``shared`` holds the map of frequent shingles and the clashing nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, done = Shingler(), set()
        often, clashes = shared.value
        least = least_overlap(boundary + 1)
        for b in batches:
            keys, hots, places, heads = [], [], [], []  # heads: node, n, code, number of keys
            for s in shingler.sets(b.column("text")):
                n = len(s)
                if n < 2:  # links with equal sets only, which are one node
                    continue
                node, _ = node_of(s, node_bits, clashes)
                if node in done:
                    continue
                done.add(node)
                frequent = in_bitmap(s, often)
                order = np.argsort(frequent, kind="stable")[: n - least_overlap(n) + 2]
                first, hot = s[order], frequent[order]
                if n <= boundary:
                    i, j = np.triu_indices(len(first), 1)
                    lo, hi = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
                    key = (lo * _MIX[WIDTH]) ^ (hi * _MIX[WIDTH + 1])
                    key ^= key >> _SHIFT
                    keys.append(key * _MIX[WIDTH + 3])
                    hots.append(hot[i] & hot[j])
                    places.append(i)
                    heads.append((node, n, SUBSET, len(i)))
                if n > boundary or n >= least:
                    one = n - least_overlap(n) + 1
                    keys.append(first[:one])
                    hots.append(hot[:one])
                    places.append(np.arange(one))
                    heads.append((node, n, LARGE if n > boundary else SMALL, one))
            if keys:
                node, n, code, count = (np.array(x) for x in zip(*heads, strict=True))
                node = np.repeat(node, count)
                spread = np.where(np.concatenate(hots), node % SALTS + 1, 0).astype(np.int8)
                yield _batch(_POSTINGS, key=_signed(np.concatenate(keys)), node=node, n=np.repeat(n, count).astype(np.int32), place=np.concatenate(places).astype(np.int32), code=np.repeat(code, count).astype(np.int8), spread=spread)

    return run


# --- lists: pairs of short ones, rows of long ones

MET = "key long, a long, na int, place int, b long, nb int, code byte"
_MET = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("na", pa.int32()), ("place", pa.int32()), ("b", pa.int64()), ("nb", pa.int32()), ("code", pa.int8())])


def _can_link(na, pa_, nb, pb):
    """Whether sets that first meet at these places of their orders can overlap enough.

    All that two sets share lies from their first meeting on. In a later list of the same pair the bound
    is too low, but a pair that links passes in the list of its first meeting.
    """
    na, pa_, nb, pb = (np.asarray(x, np.int64) for x in (na, pa_, nb, pb))
    return 180 * np.minimum(na - pa_, nb - pb) >= 80 * (na + nb)


def _columns_can_link(na: str, pa_: str, nb: str, pb: str) -> Column:
    """The same rule on columns."""
    na, pa_, nb, pb = (F.col(x).cast("long") for x in (na, pa_, nb, pb))
    return 180 * F.least(na - pa_, nb - pb) >= 80 * (na + nb)


class _Lists:
    """Consumes postings sorted by key and node: key, node, n, place, code, spread."""

    def __init__(self):
        self.rest: list[np.ndarray] | None = None
        self.long_key: int | None = None

    def feed(self, columns: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        if self.rest is not None:
            columns = [np.concatenate(x) for x in zip(self.rest, columns, strict=True)]
        key = columns[0]
        if not len(key):
            return
        # most postings are alone; the last row may go on in the next batch, and a salted list in other partitions
        same = key[1:] == key[:-1]
        met = np.r_[False, same] | np.r_[same, not last] | (columns[5] > 0)
        met[0] |= key[0] == self.long_key
        key, node, n, place, code, spread = (x[met] for x in columns)
        fresh = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])][: len(key)]
        key, node, n, place, code, spread = (x[fresh] for x in (key, node, n, place, code, spread))
        if not len(key):
            self.rest = None
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lengths = np.diff(np.r_[starts, len(key)])
        long = (lengths > SHORT) | (spread[starts] > 0)
        if key[0] == self.long_key:
            long[0] = True
        keep = len(key)
        if not last and not long[-1]:
            keep = starts[-1]
        self.rest = [x[keep:] for x in (key, node, n, place, code, spread)]
        self.long_key = int(key[-1]) if long[-1] else None
        whole = starts < keep
        starts, lengths, long = starts[whole], lengths[whole], long[whole]
        at = np.flatnonzero(np.repeat(long, lengths))
        if len(at):
            yield _batch(_MET, key=key[at], a=node[at], na=n[at], place=place[at], code=code[at])
        short = lengths[~long]
        for size in np.unique(short[short > 1]).tolist():
            runs = starts[~long & (lengths == size)]
            for i in range(size):
                for j in range(i + 1, size):
                    x, y = runs + i, runs + j
                    ok = _can_link(n[x], place[x], n[y], place[y]) & ~((code[x] == SMALL) & (code[y] == SMALL))
                    x, y = x[ok], y[ok]
                    if len(x):
                        yield _batch(_MET, a=node[x], na=n[x], b=node[y], nb=n[y])


#: Rows of postings that a task looks at together.
TOGETHER = 200_000


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists, held, size = _Lists(), [], 0
    names = ("key", "node", "n", "place", "code", "spread")
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= TOGETHER:
            yield from lists.feed([np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in names], False)
            held, size = [], 0
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int8, np.int8)
    yield from lists.feed([np.concatenate([np.zeros(0, k), *[x.column(c).to_numpy(zero_copy_only=False) for x in held]]) for c, k in zip(names, kinds, strict=True)], True)


# --- third pass: the sets of candidates, as packed texts, and comparing pairs

SETS = "doc_id long, node long, n int, sketch binary, wide binary, packed binary"
_SETS = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary()), ("wide", pa.binary()), ("packed", pa.binary())])


def width_of(n: int) -> int:
    """Bits of the widest sketch of a set: a power of two, a bit for each shingle at least while they are few."""
    return min(WIDEST, max(SKETCH, 1 << (n - 1).bit_length()))


def sketch_of(shingles: np.ndarray, width: int = SKETCH) -> np.ndarray:
    """The parity of the shingles in each bucket, as bytes of bits."""
    bucket = (shingles >> np.uint64(40)).astype(np.int64) % width
    return np.packbits((np.bincount(bucket, minlength=width) & 1).astype(np.uint8))


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set in ``size`` bytes, which divide its own."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def _setter(shared, node_bits: int = 64):
    """``shared`` holds the map of chosen documents and the clashing nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, packer, done = Shingler(), zstandard.ZstdCompressor(), set()
        found, clashes = shared.value
        for b in batches:
            chosen = in_bitmap(b.column("place").to_numpy().view(np.uint64), found)
            ids, nodes, sizes, sketches, wide, whole, held = [], [], [], [], [], [], 0
            named, texts = (b.column(c).filter(pa.array(chosen)) for c in ("doc_id", "text"))
            for doc_id, text, s in zip(named.to_pylist(), texts, shingler.sets(texts), strict=True):
                node, _ = node_of(s, node_bits, clashes)
                if (doc_id, node) in done or len(s) < 2:
                    continue
                done.add((doc_id, node))
                ids.append(doc_id)
                nodes.append(node)
                sizes.append(len(s))
                widest = sketch_of(s, width_of(len(s)))
                sketches.append(folded(widest, SKETCH // 8).tobytes())
                wide.append(widest.tobytes() if len(widest) > SKETCH // 8 else None)
                whole.append(packer.compress(text.as_buffer()))
                held += len(s)
                if held >= HELD:
                    yield _batch(_SETS, doc_id=ids, node=nodes, n=sizes, sketch=sketches, wide=wide, packed=whole)
                    ids, nodes, sizes, sketches, wide, whole, held = [], [], [], [], [], [], 0
            if nodes:
                yield _batch(_SETS, doc_id=ids, node=nodes, n=sizes, sketch=sketches, wide=wide, packed=whole)
            pa.default_memory_pool().release_unused()

    return run


def _bits(column: pa.Array) -> np.ndarray:
    """The sketches of a column, a row of 64-bit words each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH // 64)


def _near(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Whether sketches leave room for a link: linked sets differ in at most (nx + ny) / 9 shingles."""
    return 9 * np.bitwise_count(x ^ y).sum(1, dtype=np.int64) <= nx.astype(np.int64) + ny


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
        ok = _near(_bits(b.column("ka")), _bits(b.column("kb")), na, nb)
        wide_a, wide_b = b.column("wa"), b.column("wb")
        for k in np.flatnonzero(ok & wide_a.is_valid().to_numpy(zero_copy_only=False) & wide_b.is_valid().to_numpy(zero_copy_only=False)).tolist():
            x, y = (np.frombuffer(w[k].as_buffer(), np.uint8) for w in (wide_a, wide_b))
            size = min(len(x), len(y))
            ok[k] = 9 * int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)) <= int(na[k]) + int(nb[k])
        yield b.select(["a", "b"]).filter(pa.array(ok))


#: Packed texts that are opened together.
UNPACKED = 16


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler, unpacker = Shingler(), zstandard.ZstdDecompressor()

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for k in range(0, len(column), UNPACKED):
            texts = [unpacker.decompress(x.as_buffer()) for x in column.slice(k, UNPACKED)]
            yield from shingler.sets(pa.array(texts, pa.large_binary()).cast(pa.large_string()))

    for b in batches:
        keep = np.zeros(b.num_rows, bool)
        for k, (x, y) in enumerate(zip(sets(b.column("sa")), sets(b.column("sb")), strict=True)):
            both = np.concatenate([x, y])
            both.sort()
            shared = np.count_nonzero(both[1:] == both[:-1])
            keep[k] = 100 * shared >= 80 * (len(both) - shared)
        yield b.select(["a", "b"]).filter(pa.array(keep))


#: The nodes of pairs are broadcast up to so many, to leave other sets out of the shuffle.
BROADCAST_NODES = 500_000


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` of two numbers at most, broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_NODES else rows


def _joined(pairs: DataFrame, sets: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """``pairs`` (a, b) with columns of both nodes, each by its two new names.

    Few pairs go to the sets of ``a``, so that only those of ``b`` and what was joined are shuffled.
    """
    side = lambda k, which, some: some.select(F.col("node").alias(k), *(F.col(c).alias(names[which]) for c, names in columns.items()))
    right = written(pairs.select(F.col("b").alias("node")).distinct(), "jaccard-nodes")
    left = side("a", 0, sets).join(_small(pairs), "a")
    return left.join(side("b", 1, sets.join(_small(right), "node", "left_semi")), "b")


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ones of ``pairs`` (a, b) whose sketches leave room for a link."""
    return written(_joined(pairs, sets, n=("na", "nb"), sketch=("ka", "kb"), wide=("wa", "wb")).mapInArrow(_bounded, "a long, b long"), "jaccard-bounded")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of ``pairs`` (a, b)."""
    return written(_joined(pairs, sets, packed=("sa", "sb")).mapInArrow(_linked, "a long, b long").distinct(), "jaccard-links")


# --- components

def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for all nodes of ``edges`` (a, b): comp is the smallest node it reaches.

    Alternating stars: each node hands its larger neighbours, then its smaller ones, to its smallest.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    mark = None
    while True:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = joined.select(F.col("m").alias("lo"), "hi").unionByName(joined.filter("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).distinct()
        edges = written(small, "jaccard-stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct())


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """``comps`` (node, comp) with ``links`` added."""
    if comps is None:
        return written(components(links), "jaccard-comps")
    label = lambda x: comps.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    lifted = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    roots = components(written(lifted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "jaccard-lifted"))
    roots = written(roots, "jaccard-roots").select(F.col("node").alias("old"), F.col("comp").alias("new"))
    every = comps.unionByName(lifted.filter("ca is null").select(F.col("a").alias("node"), F.col("a").alias("comp"))).unionByName(lifted.filter("cb is null").select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
    return written(every.join(roots, F.col("comp") == F.col("old"), "left").select("node", F.coalesce("new", "comp").alias("comp")), "jaccard-comps")


# --- what is left of long lists

LEFT = "key long, i int, j int, block int, node long, n int, place int, code byte, comp long, sketch binary"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that can link, from rows sorted by key, i and j.

    Where i and j differ, pairs within one block are left to its own tile.
    """
    held: list[pa.RecordBatch] = []

    def tile(t: pa.Table) -> Iterator[pa.RecordBatch]:
        block, node, n, place, code, comp = (t.column(c).to_numpy() for c in ("block", "node", "n", "place", "code", "comp"))
        bits = _bits(t.column("sketch"))
        two = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        order = np.arange(len(node))
        for k in range(len(node)):
            other = order[k + 1 :]
            ok = (comp[other] != comp[k]) & _can_link(n[k], place[k], n[other], place[other])
            if code[k] == SMALL:
                ok &= code[other] != SMALL
            if two:
                ok &= block[other] != block[k]
            other = other[ok]
            other = other[_near(bits[other], bits[k], n[other], n[k])] if len(other) else other
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[other], node[k])), pa.array(np.maximum(node[other], node[k]))], ["a", "b"])

    def whole(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]) if len(key) else np.array([], np.int64)
        ends = np.r_[starts[1:], len(key)]
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b < len(key) or last:
                yield from tile(t.slice(a, b - a).combine_chunks())
            else:
                held[:] = t.slice(a).to_batches()

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        held = []
        yield from whole(t, False)
    if held:
        yield from whole(pa.Table.from_batches(held), True)


def _left(lists: DataFrame, comps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows, with comp, of lists of two components or more; and those lists with count and pairs left."""
    rows = lists.join(comps.select("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    each = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    mixed = each.groupBy("key").agg(F.sum("c").alias("rows"), F.count("*").alias("comps"), ((F.pow(F.sum("c"), 2) - F.sum(F.col("c") * F.col("c"))) / 2).alias("pairs"))
    mixed = written(mixed.filter("comps > 1"), "jaccard-mixed")
    return written(rows.join(mixed.select("key"), "key", "left_semi"), "jaccard-lists"), mixed


def _star(rows: DataFrame, among: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The node of ``among`` that each list meets earliest, and its pairs with the list's other nodes."""
    first = F.min(F.struct(F.col("place").alias("pplace"), F.col("node").alias("p"), F.col("n").alias("pn"), F.col("code").alias("pcode"), F.col("comp").alias("pcomp")))
    pivots = written(among.groupBy("key").agg(first.alias("pivot")).select("key", "pivot.*"), "jaccard-pivots")
    match = (F.col("l.key") == F.col("r.key")) & (F.col("l.comp") != F.col("r.pcomp")) & ~((F.col("code") == SMALL) & (F.col("pcode") == SMALL)) & _columns_can_link("n", "place", "pn", "pplace")
    met = rows.alias("l").join(pivots.alias("r"), match).select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()
    return pivots.select("key", "p"), met


def _blocks(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Each row once for each pair of blocks of its list that its own block is in."""
    of = F.ceil(F.col("rows") / BLOCK).cast("int")
    dealt = rows.join(mixed.select("key", of.alias("of")), "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("of")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("other")
    return dealt.select("*", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})


def _resolve(lists: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Components of all links, from ``pairs`` of short lists and the rows of long ones (key, node, n, place, code)."""
    rows = lists.withColumn("comp", F.col("node"))
    used, met = _star(rows, rows)
    comps = _merged(None, linked(bounded(pairs.unionByName(met).distinct(), sets), sets))
    rows, mixed = _left(lists, comps)
    work = lambda: mixed.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    now, before = work(), None
    while now["pairs"] > PAIRS_A_ROW * now["rows"] and (before is None or now["pairs"] < 0.75 * before["pairs"]):
        taken = used.select("key", F.col("p").alias("node")).join(comps, "node", "left").select("key", F.coalesce("comp", "node").alias("comp")).distinct()
        pivots, met = _star(rows, rows.join(taken, ["key", "comp"], "left_anti"))
        used = written(used.unionByName(pivots), "jaccard-used")
        comps = _merged(comps, linked(bounded(met, sets), sets))
        (rows, mixed), before = _left(rows.drop("comp"), comps), now
        now = work()
    if not now["rows"]:
        return comps
    nodes = written(rows.select("node").distinct(), "jaccard-nodes")
    some = sets.select("node", "sketch").join(_small(nodes), "node", "left_semi")
    left = _blocks(rows, mixed).join(some, "node").select(*(c.split()[0] for c in LEFT.split(", ")))
    met = left.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_tiles, "a long, b long").distinct()
    return _merged(comps, linked(bounded(written(met, "jaccard-met"), sets), sets))


#: Rows in an Arrow batch: texts and sets are long, and a task holds some batches at a time.
BATCH_ROWS = 1_000


#: Bytes of an Arrow batch, for the same reason.
BATCH_BYTES = 32 << 20


def link_documents(docs: DataFrame, boundary: int | None = None, node_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    A null or empty text, or one without words, has no shingle and links with nothing: its component is
    itself. Repeated rows share node and component; a component of only null ids has a null id. Other
    columns are ignored. ``boundary`` sets the largest small set in place of the cost rule, ``node_bits``
    the bits by which sets are numbered (fewer in tests of clashing numbers).
    """
    out = _labelled(docs, boundary, node_bits)
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def _labelled(docs: DataFrame, boundary: int | None = None, node_bits: int = 64) -> DataFrame:
    """doc_id, text_hash, n, component_id, and the component as a node, for each row of ``docs``."""
    # all Python work below is written out before this returns, so the settings can be put back
    spark = docs.sparkSession
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        rows, comps = _node_components(docs, boundary, node_bits)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    labelled = rows.join(comps, "node", "left").select("doc_id", "text_hash", "n", F.coalesce("comp", "node").alias("comp"))
    least = labelled.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "comp", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")))


def _node_components(docs: DataFrame, boundary: int | None, node_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n, node) of all rows, and (node, comp) of the linked nodes."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    first = written(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_first_pass(node_bits), FIRST), "jaccard-first")
    rows = first.filter("node is not null").select("doc_id", "text_hash", "n", "node", "beside")
    # sets of one number and different hashes beside it: 2 ** -65 of all pairs of sets, so a handful at most
    two = rows.groupBy("node").agg(F.min("beside").alias("x"), F.max("beside").alias("y")).filter("x <> y")
    clashes = frozenset(r["node"] for r in two.select("node").collect())
    if clashes:
        rows = rows.join(F.broadcast(spark.createDataFrame([(c,) for c in clashes], "clash long")), F.col("node") == F.col("clash"), "left")
        rows = rows.withColumn("node", F.when(F.col("clash").isNull(), F.col("node")).otherwise(F.col("beside")))
    rows = rows.select("doc_id", "text_hash", "n", "node")

    seen = first.filter("key is not null").groupBy("key").agg(F.sum("seen").alias("seen"))
    seen = written(seen, "jaccard-seen")
    steps = {r["step"]: r["count"] for r in seen.groupBy(F.length(F.bin("seen")).alias("step")).count().collect()}
    least = frequent_from(steps, (1 << MOST_MAP_BITS) // ROOM)
    often = seen.filter(F.col("seen") >= least)
    often = bitmap(often, "key", map_bits(often.count()))
    if boundary is None:
        sizes = {r["n"]: r["count"] for r in rows.filter(F.col("n").between(2, 2 * LARGEST_BOUNDARY)).groupBy("n").count().collect()}
        scanned = seen.filter(F.col("seen") < FREQUENT).agg(F.sum(F.col("seen") * (F.col("seen") - 1))).first()[0] or 0
        boundary = choose_boundary(sizes, scanned / max(1, rows.agg(F.sum("n")).first()[0] or 0))

    postings = texts.mapInArrow(_poster(spark.sparkContext.broadcast((often, clashes)), boundary, node_bits), POSTINGS)
    met = postings.repartition("key", "spread").sortWithinPartitions("key", "node").mapInArrow(_meet, MET)
    met = written(met, "jaccard-meetings")
    pairs = written(met.filter("b is not null").select("a", "b").distinct(), "jaccard-pairs")
    lists = met.filter("b is null").select("key", F.col("a").alias("node"), F.col("na").alias("n"), "place", "code").distinct()
    alone = lists.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x = y").select("key")
    lists = written(lists.join(alone, "key", "left_anti"), "jaccard-lists")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(lists.select("node")).distinct()
    held = rows.join(wanted, "node", "left_semi").groupBy("node", "doc_id").agg(F.count("*").alias("repeats"))
    owners = written(held.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "repeats")).alias("o")).select("node", "o.doc_id", "o.repeats"), "jaccard-owners")
    place = F.xxhash64("doc_id")
    chosen = bitmap(owners.select(place.alias("place")), "place", map_bits(owners.count()))
    # of copies only the owner's set stays, as pairs are joined to sets; several tasks may have repeats of its row
    several = owners.filter("repeats > 1").select("node")
    sets = texts.withColumn("place", place).mapInArrow(_setter(spark.sparkContext.broadcast((chosen, clashes)), node_bits), SETS)
    own = _small(owners.select(F.col("node").alias("own"), F.col("doc_id").alias("owner")))
    sets = sets.join(own, (F.col("node") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("owner")), "left_semi")
    sets = written(sets.drop("doc_id"), "jaccard-sets")
    if not several.isEmpty():
        again = sets.join(several, "node", "left_semi").dropDuplicates(["node"])
        sets = written(sets.join(several, "node", "left_anti").unionByName(again), "jaccard-sets")
    return rows, _resolve(lists, pairs, sets)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with its columns.

    Null ids come last, and stay where a component has no other; of rows with the same least id and
    different texts the one with the smaller text hash stays, of repeated rows one. Texts without words
    all stay. A row is known by id and text hash; only rows that share a bit of the map of dropped ones
    are joined, so other texts aren't shuffled.
    """
    marks = written(_labelled(docs).select("doc_id", "text_hash", "n", "comp"), "jaccard-labels")
    whole = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = marks.filter("n > 0").groupBy("comp").agg(F.min(whole).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_hash").eqNullSafe(F.col("first.text_hash"))
    dropped = written(marks.filter("n > 0").join(first, "comp").filter(~same).select("doc_id", "text_hash").distinct(), "jaccard-dropped")
    out = without(docs, dropped, F.xxhash64("text"))
    again = marks.filter("n > 0").groupBy("comp", "doc_id", "text_hash").count().filter("count > 1").join(dropped, ["doc_id", "text_hash"], "left_anti")
    return out if again.isEmpty() else out.dropDuplicates()
