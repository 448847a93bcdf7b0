"""Hard negatives: bounds that hold, and results equal to brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.llm import hard_negatives as hn
from floodmark.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3):
    """All scores in Python integers."""
    kept = {}
    for vec_id, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = tuple(max(-hn.LARGEST, min(hn.LARGEST, math.floor(256 * float(np.float32(c))))) for c in x)
        width = max(len(x) for _, x, _ in rows if x is not None)
        kept[vec_id, label, v + (0,) * (width - len(v))] = 1
    kept = list(kept)
    order = lambda t: (-t[1], t[0] is None, t[0] or 0)
    out = []
    for a in kept:
        if a[0] is None or a[0] % every:
            continue
        scores = [(b[0], sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[1]) for b in kept if b != a]
        for p, ps, _ in sorted((s for s in scores if s[2] == a[1]), key=order)[:positives]:
            fits = [s for s in scores if s[2] != a[1] and 50 * ps <= 100 * s[1] <= 95 * ps]
            out += [(a[0], p, k + 1, n, ps, ns) for k, (n, ns, _) in enumerate(sorted(fits, key=order)[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, every=50, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("x"), "mark": F.lit(1), "anchors": F.lit(2), "score": F.lit(3)})
    out = hn.mine_negatives(df.repartition(3), F.col("vec_id") % every == 0, **more).collect()
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out), key=repr)


@pytest.mark.parametrize("spread", [1, 40, 3000])
def test_intervals_hold_every_score(spread):
    rng = np.random.default_rng(spread)
    base = rng.normal(size=(6, 64))
    x = np.floor(spread * (base[rng.integers(0, 6, 300)] + rng.normal(size=(300, 64)) * 0.3)).astype(np.int32)
    x[:3] = 0
    x[3, 1:] = 0
    codes, norm, align, length = hn.encode(x)
    low, high = hn.Planes(x).interval(slice(0, 300), codes, norm, align, length)
    exact = x.astype(np.int64) @ x.T.astype(np.int64)
    assert (low <= exact).all() and (exact <= high).all()
    # and they are no wider than codes of so many bits allow
    scale = np.outer(norm, norm)
    assert np.median(((high - low) / np.maximum(scale, 1e-9))[scale > 1000] if (scale > 1000).any() else [0]) < 1.1


def test_turning_back_is_the_transpose():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(5, 128)), rng.normal(size=(5, 128 * hn.TURNS))
    assert np.allclose(np.einsum("ij,ij->i", hn.rotate(x), y), np.einsum("ij,ij->i", x, hn.turn_back(y)))
    assert np.allclose(np.linalg.norm(hn.rotate(x), axis=1), np.linalg.norm(x, axis=1))


def test_scored_both_ways(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(-hn.LARGEST, hn.LARGEST, (9, 64)), rng.integers(-hn.LARGEST, hn.LARGEST, (30, 64))
    keep = rng.random((9, 30)) < 0.3
    want = (a @ b.T)[keep].tolist()
    assert hn.scored(a, b, keep).tolist() == want
    monkeypatch.setattr(hn, "DENSE", 2.0)
    assert hn.scored(a, b, keep).tolist() == want


@pytest.mark.parametrize("tiny", [False, True])
def test_equals_brute_force(spark, monkeypatch, tiny):
    """Near ties, equal vectors, labels of one row, and blocks and tiles of any size."""
    if tiny:
        monkeypatch.setattr(hn, "SMALLEST_BLOCK", 16)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(8, 6))
    rows = [(i, [float(v) for v in (base[i % 8] + rng.normal(size=6) * 0.4) * 0.2], int(rng.integers(0, 4))) for i in range(400)]
    rows += [(400 + i, rows[i % 7][1], 9 if i == 0 else i % 3) for i in range(60)]  # copies under other ids
    got = mined(spark, rows, 10)
    assert got == brute(rows, 10) and len(got) > 200


def test_odd_rows(spark):
    good = [(i, [0.5 + i / 90, 0.25, 0.1 * (i % 3)], i % 2) for i in range(30)]
    rows = good + [
        (50, None, 1), (51, [1.0, None, 2.0], 0), (52, [float("nan"), 1.0, 1.0], 0), (53, [float("inf"), 1.0, 1.0], 1), (54, [1.0, 1.0, 1.0], None),
        (100, [], 0), (101, [1.0], 0), (150, [1.0, 0.5], 1), (None, [0.9, 0.4, 0.1], 0), (None, [0.9, 0.4, 0.1], 0), (None, [0.8, 0.4, 0.1], 1),
        (0, [0.5, 0.25, 0.0], 0), (0, [0.7, 0.25, 0.0], 0), (0, [0.7, 0.25, 0.0], 1), (200, [-1.0, -1.0, -1.0], 0), (250, [3e38, 1.0, -3e38], 1), (7, [0.0, 0.0, 0.0], 3), (300, [0.0, 0.0, 0.0], 3),
    ]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, 1) == brute(rows, 1)
    assert mined(spark, []) == []
    assert mined(spark, [(50, None, None)]) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_query(spark, sf_dir, duck):
    rows = [(i, v, (n + 1) % 10 if i % 7 == 0 and n is not None else n) for i, v, n in duck.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()]
    got = sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in queries.op12_hard_negatives(spark, sf_dir).collect()), key=repr)
    assert got == brute(rows)
