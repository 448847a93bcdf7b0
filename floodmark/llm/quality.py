"""Quality classifier: ordinal cumulative-link regression over hashed text.

A rating is a grade 0 < 1 < 2: a point for quality and one for not being toxic. One weight vector over
hashed features is shared by all grades; ordered thresholds turn the score into P(grade >= k) by the logistic link. The
expected grade and the tail probability P(grade >= 2) select documents.

Features of a text: its distinct words in lower case and their beginnings, the marks that hang on words, and its shape in
coarse steps (share of marked words, of capitals, of repeats). Fitting uses a bounded sample of the
labelled rows, ``SAMPLE`` at most, whose features are hashed on the executors; scoring is one pass over
all texts without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BITS = 20
#: At most so many labelled rows are fitted: those whose ids hash lowest.
SAMPLE = 8_000
GRADES = 3
#: A document is accepted if P(grade >= 2) is at least this.
ACCEPT = 0.6
EPOCHS, BATCH_ROWS, RATE, L2 = 60, 256, 1.0, 2e-5
#: Words whose feature a worker remembers; forgotten when full.
CACHE = 400_000
#: Lengths of the word beginnings that are features, so that inflected and compound forms share weights.
STEMS = (4, 5)
#: Features in fewer documents of the sample get no weight.
LEAST_DOCS = 4
#: Standard errors by which a feature has to tell grades apart to get a weight; keeps the noise of rare words out.
SCREEN = 5.0
#: Marks that are no letters or digits, stripped from words and features of their own.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def feature(name: str) -> int:
    return xxhash.xxh64_intdigest(name) >> (64 - BITS)


def _step(share: float) -> int:
    """0 for none, then a step for each doubling from 1/256."""
    return 0 if share <= 0 else max(1, 9 + math.floor(math.log2(min(1.0, share))))


def raw_features(text: str | None) -> tuple[set[str], list[str]]:
    """The distinct words of a text as they are, and the names of its shape features."""
    words = (text or "").split()
    distinct = set(words)
    if not words:
        return distinct, ["shape:empty"]
    n = len(distinct)
    marked = sum(w[-1] in "#$%&*" for w in distinct) / n
    shouted = sum(w.isupper() and len(w) > 1 for w in distinct) / n
    bangs = sum(w.endswith("!!") for w in distinct) / n
    repeats = 1 - n / len(words)
    shape = [f"shape:marked:{_step(marked)}", f"shape:upper:{_step(shouted)}", f"shape:bang:{_step(bangs)}", f"shape:size:{len(words).bit_length()}:repeat:{int(10 * repeats)}"]
    return distinct, shape


def word_features(word: str) -> tuple[int, ...]:
    bare = word.strip(MARKS).lower()
    tail = word[len(word.rstrip(MARKS)) :]
    names = [f"word:{bare}"] if bare else []
    names += [f"stem{k}:{bare[:k]}" for k in STEMS if len(bare) > k]
    return tuple(feature(x) for x in names + ([f"tail:{tail}"] if len(tail) > 1 else []))


def features(text: str | None) -> list[int]:
    words, shape = raw_features(text)
    return sorted({f for w in words for f in word_features(w)} | {feature(s) for s in shape})


@dataclass
class Model:
    """Weights of the features that tell grades apart (ascending ids), and ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        known = dict(zip(self.features.tolist(), self.weights.tolist(), strict=True))
        return np.array([math.fsum(known.get(f, 0.0) for f in r) for r in rows], float)


def telling(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """Features whose documents differ in mean grade from all by ``SCREEN`` standard errors or more."""
    docs, sums = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS)
    for r, grade in zip(rows, grades, strict=True):  # features of a row are distinct
        docs[r] += 1
        sums[r] += grade
    z = np.abs(sums - docs * grades.mean()) / np.maximum(np.sqrt(docs) * grades.std(), 1e-9)
    return (docs >= LEAST_DOCS) & (z >= SCREEN)


def fit(rows: list[np.ndarray], grades: np.ndarray, seed: int = 0) -> Model:
    """Cumulative-link fit by minibatches with adaptive steps; without rows, a model that accepts all."""
    cut = np.array([-2.0, -1.0])
    if not sum(map(len, rows)):
        return Model(np.array([], np.int64), np.array([]), cut)
    used = np.flatnonzero(telling(rows, grades))
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    sizes = np.array([len(r) for r in rows])
    rng = np.random.default_rng(seed)
    w = np.zeros(len(used))
    squares, cut_squares = np.full(len(used), 1e-3), np.full(GRADES - 1, 1e-3)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH_ROWS):
            pick = order[at : at + BATCH_ROWS]
            flat = np.concatenate([rows[i] for i in pick])
            owner = np.repeat(np.arange(len(pick)), sizes[pick])
            tails = Model(used, w, cut).tails(np.bincount(owner, w[flat], len(pick)))
            upper = np.hstack([np.ones((len(pick), 1)), tails])
            lower = np.hstack([tails, np.zeros((len(pick), 1))])
            g, k = grades[pick], np.arange(len(pick))
            mass = np.maximum(upper[k, g] - lower[k, g], 1e-9)
            du, dl = upper[k, g] * (1 - upper[k, g]), lower[k, g] * (1 - lower[k, g])
            by_score = -(du - dl) / mass
            step = np.bincount(flat, by_score[owner], len(used)) / len(pick) + L2 * w
            squares += step * step
            w -= rate * step / np.sqrt(squares)
            step = np.zeros(GRADES - 1)
            np.add.at(step, (g - 1)[g > 0], (du / mass)[g > 0] / len(pick))
            np.add.at(step, g[g < GRADES - 1], (-dl / mass)[g < GRADES - 1] / len(pick))
            cut_squares += step * step
            cut -= rate * step / np.sqrt(cut_squares)
            cut.sort()
    return Model(used, w, cut)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of ``labels`` (doc_id, quality, toxic): a point for quality and one for not being toxic.

    A null toxic counts as not toxic; rows without quality or id are no ratings.
    """
    points = F.col("quality").cast("int") + (F.coalesce("toxic", F.lit(0)) == 0).cast("int")
    return labels.select("doc_id", points.alias("grade")).filter("doc_id is not null and grade between 0 and 2")


def fit_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of the labelled rows of ``docs``; of several labels the lowest grade holds."""
    picked = graded(labels).groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "grade": b["grade"], "features": [features(t) for t in b["text"]]})

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most ``sample`` rows
    hashed_rows = rows.mapInPandas(hashed, "doc_id long, grade int, features array<int>")

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"features": [], "grade": []}), *batches])
        m = fit([np.asarray(f, np.int32) for f in got["features"]], got["grade"].to_numpy(np.int64))
        yield pd.DataFrame({"features": [m.features], "weights": [m.weights], "thresholds": [m.thresholds]})

    # one task fits: its rows are the sample, whatever the input (repeated ids could make the join larger)
    sample_rows = hashed_rows.orderBy("doc_id", "features").limit(sample).coalesce(1)
    m = sample_rows.mapInPandas(fitted, "features array<long>, weights array<double>, thresholds array<double>").first()
    return Model(np.array(m[0], np.int64), np.array(m[1], float), np.array(m[2], float)) if m else fit([], np.array([]))


class Scorer:
    """Scores texts; remembers the weights of words."""

    def __init__(self, model: Model):
        self.model, self.words = model, {}
        self.weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        weights, known, out = self.weights, self.words, []
        for t in texts:
            words, shape = raw_features(t)
            if len(known) > CACHE:
                known.clear()
            used: dict[int, float] = {}
            for w in words:
                found = known.get(w)
                if found is None:
                    found = known[w] = tuple((f, weights[f]) for f in word_features(w) if f in weights)
                if found:
                    used.update(found)
            for f in map(feature, shape):
                if f in weights:
                    used[f] = weights[f]
            out.append(math.fsum(used.values()))
        return np.array(out, float)


SCORED = "expected_grade double, tail_probability double, accepted boolean"


def score_documents(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with expected_grade, tail_probability, accepted.

    A null text counts as empty. Repeated rows get equal results; null ids pass through.
    """
    keep = keep or ["doc_id"]
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** BITS weights

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shipped.value)
        for b in batches:
            tails = scorer.model.tails(scorer.scores(list(b["__text"])))
            last = tails[:, -1].round(6)
            yield b.drop(columns="__text").assign(expected_grade=tails.sum(1).round(6), tail_probability=last, accepted=last >= ACCEPT)

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInPandas(score, f"{schema}, {SCORED}")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, expected_grade, tail_probability, accepted for each row of ``docs``; an empty ``labels`` accepts all."""
    return score_documents(docs, fit_model(docs, labels, sample))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The accepted rows of ``docs``, with its columns."""
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shipped.value)
        for texts in batches:
            tails = scorer.model.tails(scorer.scores(list(texts)))
            yield pd.Series(tails[:, -1].round(6) >= ACCEPT)

    return docs.filter(accepted("text"))
