"""Hard-negative mining with rotated one-bit codes.

A vector is padded to a power of two and rotated ``TURNS`` times by random signs and Hadamard transforms;
the signs of the outcome are its code, and with the code go the vector's norm, its alignment with the code
vector (the code turned back) and the latter's length. An anchor's rotated vector is cut into ``PLANES``
bit planes, so popcounts estimate its product with a code vector, up to an error known from the cut. What
a code doesn't hold of its vector is orthogonal to the code vector, and Cauchy-Schwarz bounds its product
with the anchor: each pair has an interval that surely holds its score. Only pairs whose interval can
still matter are scored, in integers.

Rows and anchors are dealt by hash into blocks of bounded size; every block of anchors meets every block
of rows in one join on both numbers, so the work spreads over as many tasks as there are pairs of blocks.
A task goes through its pairs anchor block by anchor block, and what it has found bounds what can still
matter. Anchors look for their positives first; their scores give the ranges of the negatives. Nothing is
broadcast, and the driver sees three counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Rotations in a code, and bit planes of an anchor.
TURNS, PLANES = 4, 6
#: Components lie within this, so scores of up to 1024 of them fit 64 bits.
LARGEST = 1 << 26
#: Rows and anchors in a block at least and at most, and blocks of rows that are wanted.
SMALLEST_BLOCK, LARGEST_BLOCK, BLOCKS = 512, 16384, 64
#: Anchors and rows that are compared at a time.
TILE_A, TILE_R = 256, 1024
#: Of a tile from this share of survivors on, all pairs are scored by one matrix product.
DENSE = 0.05
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max

ENCODED = "vec_id long, label int, vector binary, mark binary, code binary, norm double, align double, length double"
_ENCODED = pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("vector", pa.binary()), ("mark", pa.binary()), ("code", pa.binary()), *[(n, pa.float64()) for n in ("norm", "align", "length")]])
_COLUMNS = ["ids", "named", "labels", "vectors", "marks", "codes", "norms", "aligns", "lengths"]


def _signs(width: int) -> np.ndarray:
    """Fixed random signs for each turn and round, by rule."""
    bits = np.frombuffer(b"".join(hashlib.sha256(b"turn %d" % i).digest() for i in range(-(-TURNS * 2 * width // 256))), np.uint8)
    return np.unpackbits(bits)[: TURNS * 2 * width].reshape(TURNS, 2, width) * 2.0 - 1.0


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Hadamard transform of each row."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray) -> np.ndarray:
    """All turns of each row side by side, of the row's own length in all."""
    turned = [_hadamard(_hadamard(x * s[0]) * s[1]) for s in _signs(x.shape[1])]
    return np.concatenate(turned, axis=1) / np.sqrt(TURNS)


def turn_back(y: np.ndarray) -> np.ndarray:
    """The transpose of ``rotate``."""
    width = y.shape[1] // TURNS
    parts = [_hadamard(_hadamard(y[:, t * width : (t + 1) * width]) * s[1]) * s[0] for t, s in enumerate(_signs(width))]
    return np.sum(parts, axis=0) / np.sqrt(TURNS)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (64 bits a number), norms, alignments and lengths of code vectors."""
    x = vectors.astype(np.float64)
    bits = rotate(x) >= 0
    back = turn_back((bits * 2.0 - 1.0) / np.sqrt(bits.shape[1]))
    norm, length = np.linalg.norm(x, axis=1), np.linalg.norm(back, axis=1)
    scale = norm * length
    align = np.divide(np.einsum("ij,ij->i", back, x), scale, out=np.ones(len(x)), where=scale > 0)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8"), norm, np.clip(align, -1, 1), length


class Planes:
    """Anchors cut into bit planes, for interval estimates of their scores."""

    def __init__(self, vectors: np.ndarray):
        x = vectors.astype(np.float64)
        turned = rotate(x)
        self.bits = turned.shape[1]
        self.low = turned.min(axis=1)
        top = (1 << PLANES) - 1
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-12)
        cut = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.uint8)
        self.error = np.linalg.norm(turned - (cut * self.step[:, None] + self.low[:, None]), axis=1)
        self.planes = np.stack([np.packbits((cut >> p) & 1, axis=1, bitorder="little").view("<u8") for p in range(PLANES)])
        self.sums = cut.sum(axis=1, dtype=np.int64)
        self.norm = np.linalg.norm(x, axis=1)

    def interval(self, some: slice, codes: np.ndarray, norm: np.ndarray, align: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score that each of ``some`` anchors can have with each row."""
        planes = self.planes[:, some]
        total = np.zeros((planes.shape[1], len(codes)), np.int32)
        for p in range(PLANES):
            met = np.zeros(total.shape, np.uint16)
            for k in range(codes.shape[1]):
                met += np.bitwise_count(planes[p, :, k, None] & codes[None, :, k])
            total += met.astype(np.int32) << p
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        step, low, q = self.step[some, None], self.low[some, None], self.norm[some, None]
        with_code = (2 * step * total + 2 * low * ones - step * self.sums[some, None] - low * self.bits) / np.sqrt(self.bits)
        size = np.maximum(length, 1e-9)
        slack = (self.error[some, None] + 1e-9 * q) / size
        first, last = (np.clip(with_code / size + s * slack, -q, q) for s in (-1, 1))
        rest = np.sqrt(np.maximum(0, 1 - align * align))
        bound = lambda t, s: align * t + s * rest * np.sqrt(np.maximum(0, q * q - t * t))
        # the sum of both parts is largest where they lie as the vector itself does, and falls off to both sides
        best, worst = align * q, -align * q
        high = np.where(last < best, bound(last, 1), np.where(first > best, bound(first, 1), q))
        least = np.where(first > worst, bound(first, -1), np.where(last < worst, bound(last, -1), -q))
        room = 1e-9 * q * norm + 1e-3
        return least * norm - room, high * norm + room


def _integers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch take part, and their integer vectors, padded with zeros."""
    lists = batch.column("embedding")
    ok = np.array(lists.is_valid()) & np.array(batch.column("label").is_valid())
    sizes = np.where(ok, np.array(lists.value_lengths().fill_null(0)), 0)
    flat = lists.flatten()
    skipped = np.array(lists.value_lengths().fill_null(0))
    values, valid = np.asarray(flat.cast(pa.float64()).fill_null(np.nan)), np.cumsum(skipped) - skipped
    rows = np.repeat(np.arange(len(ok)), sizes)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = values[at + np.repeat(valid, sizes)] if len(rows) else np.zeros(0)
    ok[rows[~np.isfinite(x)]] = False
    out = np.zeros((len(ok), width))
    with np.errstate(over="ignore", invalid="ignore"):
        out[rows, at] = np.clip(np.floor(256 * x), -LARGEST, LARGEST)
    return ok, out[ok].astype(np.int32)


def _encoder(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                b = whole.slice(start, 2048)
                ok, vectors = _integers(b, width)
                if not len(vectors):
                    continue
                b = b.filter(pa.array(ok))
                codes, *numbers = encode(vectors)
                labels = b.column("label").cast(pa.int32())
                data = [v.tobytes() for v in vectors.astype("<i4")]
                marks = [hashlib.blake2b(d, digest_size=16).digest() for d in data]
                yield pa.RecordBatch.from_arrays([b.column("vec_id").cast(pa.int64()), labels, pa.array(data, pa.binary()), pa.array(marks, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), *map(pa.array, numbers)], schema=_ENCODED)

    return run


def _packed(rows: pa.Table) -> dict[str, bytes]:
    """The rows of a block, by label and id (those without one last), column by column."""
    ids = rows.column("vec_id")
    named = np.array(ids.is_valid())
    keys = np.where(named, ids.fill_null(0).to_numpy(), _LAST)
    labels = rows.column("label").to_numpy()
    order = np.lexsort((keys, labels))
    joined = lambda name: b"".join(rows.column(name).take(pa.array(order)).to_pylist())
    out = [keys[order].tobytes(), named[order].tobytes(), labels[order].astype("<i4").tobytes(), joined("vector"), joined("mark"), joined("code")]
    out += [rows.column(n).to_numpy()[order].tobytes() for n in ("norm", "align", "length")]
    if "scores" in rows.column_names:
        lists = rows.column("scores").take(pa.array(order)).to_pylist()
        wanted = max(map(len, lists))
        out.append(np.array([x + [_NONE] * (wanted - len(x)) for x in lists], "<i8").tobytes())
    return dict(zip([*_COLUMNS, "scores"], out, strict=False))


def _packer(number: str, of: str, count: int, columns: list[str]):
    """Packs a block of rows into one, with a row for each of ``count`` blocks ``of`` the other side."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        packed = _packed(rows)
        one = {number: pa.array([key[0].as_py()], pa.int32())} | {c: pa.array([packed[c]], pa.binary()) for c in columns} | {of: pa.array([list(range(count))], pa.list_(pa.int32()))}
        return pa.table(one)

    return run


class _Block:
    def __init__(self, row: dict, prefix: str, width: int):
        view = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.ids, self.named, self.labels = view("ids", "<i8"), view("named", bool), view("labels", "<i4")
        n = len(self.ids)
        self.vectors, self.marks = view("vectors", "<i4").reshape(n, width), view("marks", "S16") if n else np.zeros(0, "S16")
        self.codes = view("codes", "<u8").reshape(n, -1)
        self.norms, self.aligns, self.lengths = view("norms", "<f8"), view("aligns", "<f8"), view("lengths", "<f8")
        if row.get(prefix + "scores") is not None:
            self.scores = view("scores", "<i8").reshape(n, -1)


def scored(a: np.ndarray, b: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Integer products of the pairs that ``keep`` marks, in its order."""
    rows, columns = np.nonzero(keep)
    if len(rows) > DENSE * keep.size:
        most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        kind = np.float64 if most < 2**53 else np.int64
        return (a.astype(kind) @ b.astype(kind).T)[keep].astype(np.int64)
    return np.einsum("ij,ij->i", a[rows].astype(np.int64), b[columns].astype(np.int64))


class _Best:
    """The best pairs so far of each anchor of a block: ``most`` at most, by score, then id."""

    def __init__(self, anchors: int, most: int):
        self.most, self.least = most, np.full(anchors, _NONE)
        self.anchor, self.score, self.id, self.named = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        new = score >= self.least[anchor]
        columns = [np.concatenate(x) for x in ((self.anchor, anchor[new]), (self.score, score[new]), (self.id, ids[new]), (self.named, named[new]))]
        order = np.lexsort((columns[2], -columns[1], columns[0]))
        anchor = columns[0][order]
        first = np.searchsorted(anchor, anchor)
        rank = np.arange(len(anchor)) - first
        kept = order[rank < self.most]
        self.anchor, self.score, self.id, self.named = (c[kept] for c in columns)
        full = rank == self.most - 1
        self.least[anchor[full]] = columns[1][order][full]


def _positives(a: _Block, planes: Planes, best: list[_Best], r: _Block) -> None:
    """Rows of the anchor's own label, the anchor itself left out."""
    for label in np.unique(a.labels):
        rows = slice(int(np.searchsorted(r.labels, label)), int(np.searchsorted(r.labels, label, "right")))
        begin, end = int(np.searchsorted(a.labels, label)), int(np.searchsorted(a.labels, label, "right"))
        for at, part in _tiles(begin, end, rows):
            low, high = planes.interval(at, r.codes[part], r.norms[part], r.aligns[part], r.lengths[part])
            own = (a.ids[at, None] == r.ids[None, part]) & (a.named[at, None] == r.named[None, part])
            if own.any():
                own &= a.marks[at, None] == r.marks[None, part]
                low[own], high[own] = -np.inf, -np.inf
            bar = best[0].least[at].astype(np.float64)
            if low.shape[1] >= best[0].most:
                bar = np.maximum(bar, np.partition(low, -best[0].most, axis=1)[:, -best[0].most])
            keep = (high >= bar[:, None]) & ~own
            _take(best[0], a, r, at, part, keep)


def _tiles(begin: int, end: int, rows: slice) -> Iterator[tuple[slice, slice]]:
    for i in range(begin, end, TILE_A):
        for j in range(rows.start, rows.stop, TILE_R):
            yield slice(i, min(i + TILE_A, end)), slice(j, min(j + TILE_R, rows.stop))


def _take(best: _Best, a: _Block, r: _Block, at: slice, part: slice, keep: np.ndarray) -> None:
    score = scored(a.vectors[at], r.vectors[part], keep)
    i, j = np.nonzero(keep)
    best.add(i + at.start, score, r.ids[part][j], r.named[part][j])


def _negatives(low_share: int, high_share: int):
    def run(a: _Block, planes: Planes, best: list[_Best], r: _Block) -> None:
        """Rows of other labels within the range that each positive's score gives."""
        some = (a.scores >= 0) & (a.scores != _NONE)
        least = np.where(some, -(-a.scores * low_share // 100), _LAST)
        most = np.where(some, a.scores * high_share // 100, _NONE)
        for at, part in _tiles(0, len(a.ids), slice(0, len(r.ids))):
            bars = np.stack([np.maximum(least[at, k], b.least[at]) for k, b in enumerate(best)], axis=1)
            bar, top = bars.min(axis=1), most[at].max(axis=1)
            if not (top > _NONE).any():
                continue
            low, high = planes.interval(at, r.codes[part], r.norms[part], r.aligns[part], r.lengths[part])
            keep = (high >= bar[:, None]) & (low <= top[:, None]) & (a.labels[at, None] != r.labels[None, part])
            score = scored(a.vectors[at], r.vectors[part], keep)
            i, j = np.nonzero(keep)
            use = (score >= bar[i]) & (score <= top[i])
            i, j, score = i[use] + at.start, j[use] + part.start, score[use]
            for k, b in enumerate(best):
                fits = (score >= least[i, k]) & (score <= most[i, k])
                b.add(i[fits], score[fits], r.ids[j[fits]], r.named[j[fits]])

    return run


FOUND = "anchor_id long, mark binary, label int, nth int, score long, vec_id long"
_FOUND = pa.schema([("anchor_id", pa.int64()), ("mark", pa.binary()), ("label", pa.int32()), ("nth", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])


def _searcher(look, width: int, most: int):
    """Goes through pairs of blocks, anchor block by anchor block, and gives the best that it has met of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, anchors, planes, best = None, None, None, []

        def found() -> Iterator[pa.RecordBatch]:
            for k, b in enumerate(best):
                if len(b.anchor):
                    yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[b.anchor]), pa.array([bytes(m).ljust(16, b"\0") for m in anchors.marks[b.anchor]], pa.binary()), pa.array(anchors.labels[b.anchor]), pa.array(np.full(len(b.anchor), k, np.int32)), pa.array(b.score), pa.array(b.id, mask=~b.named)], schema=_FOUND)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["anchors"] != number:
                    yield from found()
                    number, anchors = row["anchors"], _Block(row, "a_", width)
                    planes = Planes(anchors.vectors)
                    best = [_Best(len(anchors.ids), most) for _ in range(anchors.scores.shape[1] if hasattr(anchors, "scores") else 1)]
                look(anchors, planes, best, _Block(row, "r_", width))
        yield from found()

    return run


def _blocks(count: int, wanted: int) -> int:
    size = min(LARGEST_BLOCK, max(SMALLEST_BLOCK, -(-count // wanted)))
    return max(1, -(-count // size))


def _pack(rows: DataFrame, number: str, of: str, count: int, blocks: int, prefix: str, columns: list[str]) -> DataFrame:
    """A row for each block of ``rows`` and each of ``blocks`` blocks of the other side."""
    dealt = rows.withColumn(number, F.pmod(F.xxhash64("vec_id", "label", "mark"), F.lit(count)).cast("int"))
    schema = f"{number} int, " + ", ".join(f"{c} binary" for c in columns) + f", {of} array<int>"
    packed = dealt.groupBy(number).applyInArrow(_packer(number, of, blocks, columns), schema)
    return packed.select(number, *[F.col(c).alias(prefix + c) for c in columns], F.explode(of).alias(of))


def _best_of(found: DataFrame, key: list[str], most: int, name: str) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= most)


def mine_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, embedding, label).

    ``anchor`` says of vec_id whether a row is an anchor. Components are floor(256 x), within 2 ** 26;
    vectors shorter than the longest one count as padded with zeros. A null label or vector, or a null or
    non-finite component keeps a row out. Rows equal in id, label and integers count once; others of one
    id are rows of their own. Rows without an id come last among equal scores. A positive below zero has
    no negatives. An empty table gives none; other columns are ignored.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("int").alias("label"))
    total, anchors, longest = rows.agg(F.count("*"), F.count_if(anchor), F.max(F.size("embedding"))).first()
    width = 1 << max(6, (max(longest or 1, 1) - 1).bit_length())
    encoded = rows.mapInArrow(_encoder(width), ENCODED).dropDuplicates(["vec_id", "label", "mark"])
    encoded = written(encoded, "codes")
    r_blocks, a_blocks = _blocks(total, BLOCKS), _blocks(anchors, 4)
    r = _pack(encoded, "rows", "anchors", r_blocks, a_blocks, "r_", _COLUMNS)
    chosen = encoded.filter(anchor)

    def search(chosen: DataFrame, columns: list[str], look, most: int) -> DataFrame:
        a = _pack(chosen, "anchors", "rows", a_blocks, r_blocks, "a_", columns)
        pairs = a.hint("merge").join(r, ["anchors", "rows"]).sortWithinPartitions("anchors")
        return pairs.mapInArrow(_searcher(look, width, most), FOUND)

    key = ["anchor_id", "label", "mark"]
    near = _best_of(search(chosen, _COLUMNS, _positives, positives), key, positives, "place")
    near = written(near.drop("nth"), "positives")
    scores = near.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("scores"))  # ``positives`` at most
    scores = scores.select(F.col("anchor_id").alias("vec_id"), "label", "mark", F.col("scores.score").alias("scores"))
    far = search(chosen.join(scores, ["vec_id", "label", "mark"]), [*_COLUMNS, "scores"], _negatives(low, high), negatives)
    far = _best_of(far, [*key, "nth"], negatives, "rank").select(*key, (F.col("nth") + 1).alias("place"), "rank", F.col("score").alias("negative_score"), F.col("vec_id").alias("negative_id"))
    near = near.select(*key, "place", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
    return far.join(near, [*key, "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame) -> DataFrame:
    """The rows with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", moved.alias("label"))


ORACLE = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
