"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed into cells of source, language and topic. Cell weights are raked: scaled to the target
share of each source, then of each language, then of each topic, again and again, until all marginals
hold. A document is sampled with a probability in proportion to its cell's weight per token, so the
expected tokens of each marginal meet its target. The rate is set by the cells that hold all but ``SPARE``
of the target tokens: the neediest of them is taken whole. So are the needier cells beyond, which then fall
short of targets by at most ``SPARE`` of the tokens, in place of a few rows setting the rate of all others.
Everything is DataFrame code.

Scale: one pass sums the tokens with partial sums on the map side, so a hot source costs nothing more;
raking touches only the table of cells, by window sums in one partition while cells are few, some sweeps
a job; the last pass joins documents to cells without moving texts
(Spark broadcasts the cells while their files are small, and shuffles ids otherwise).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty, written

DIMENSIONS = ("source", "lang", "topic")
#: Target shares are the natural shares to this power, made to sum to 1: 1 keeps the mix, 0 levels it.
ALPHA = 0.8
#: The largest relative miss of a marginal that counts as met.
TOLERANCE = 1e-10
#: Sweeps at most, sweeps of a job, and the part of the miss that two jobs in a row have to take off.
MOST_SWEEPS, SWEEPS_A_JOB, STALL = 2_400, 8, 1e-3
#: Cells up to which raking runs in one partition.
FEW_CELLS = 500_000
#: Sweeps of the SQL, which has no loop; targets by natural shares are met well before.
SQL_SWEEPS = 24
#: Cells that need most and together hold at most this share of the target tokens don't set the rate.
SPARE = 0.01
#: Steps of a doubling in which scales are counted for that.
STEPS = 64
SEED = "mix-1"
#: Stands for a null source or language.
UNKNOWN = "(none)"


def form_topic(column: str = "text") -> Column:
    """A topic by form, for tables without topics: table, shout, marked, short, long or prose."""
    text = text_or_empty(column)
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("!!")), "shout")
        .when(text.rlike("[%$&*#]{3}"), "marked")
        .when(F.length(text) < 500, "short")
        .when(F.length(text) >= 5000, "long")
        .otherwise("prose")
    )


def token_weight(column: str = "text") -> Column:
    """Words of a text."""
    return F.regexp_count(text_or_empty(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _celled(docs: DataFrame, *keep: str) -> DataFrame:
    named = lambda c: F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c)
    topic = F.coalesce(F.col("topic"), F.lit(UNKNOWN)) if "topic" in docs.columns else form_topic()
    tokens = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)) if "n_tokens" in docs.columns else token_weight()
    return docs.select(*keep, named("source"), named("lang"), topic.alias("topic"), tokens.alias("tokens"))


def tempered_targets(cells: DataFrame, dimension: str, alpha: float = ALPHA) -> DataFrame:
    """(value, share): natural token shares of ``dimension`` to the power ``alpha``, normalised."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens"), alpha).alias("s"))
    total = sums.agg(F.sum("s")).first()[0]
    return sums.select("value", (F.col("s") / F.lit(total or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = MOST_SWEEPS, tolerance: float = TOLERANCE, stall: float = STALL) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, whose marginals follow ``targets``, and ``miss``.

    ``targets`` has (value, share) by dimension; shares have to sum to 1, or a ValueError is raised. A value
    without a target gets weight 0; cells of 0 tokens keep 0. Raking ends when the largest relative miss of
    a marginal is within ``tolerance``, when it stalls (twice in a row ``SWEEPS_A_JOB`` sweeps don't lower
    it by the part ``stall``), as with targets no table can meet, or after ``sweeps``. The miss that remains
    is in every row, and logged when it is beyond ``tolerance``; a target of a value that has no tokens is
    missed by all of it.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
    if not total:
        return written(weighted.withColumn("miss", F.lit(0.0)), "mix-cells")
    absent = 0.0
    for d, target in targets.items():
        target = written(target.select(F.col("value").alias(f"value_{d}"), F.col("share").alias(f"share_{d}")), f"mix-target-{d}")
        shares = target.agg(F.sum(f"share_{d}")).first()[0] or 0.0
        if abs(shares - 1) > 1e-6:
            raise ValueError(f"target shares of {d} sum to {shares}")
        held = weighted.filter("tokens > 0").select(F.col(d).alias(f"value_{d}")).distinct()
        if not target.filter(F.col(f"share_{d}") > 0).join(held, f"value_{d}", "left_anti").isEmpty():
            absent = 1.0
        weighted = weighted.join(target, F.col(d) == F.col(f"value_{d}"), "left").drop(f"value_{d}").withColumn(f"share_{d}", F.coalesce(f"share_{d}", F.lit(0.0)))
    weighted = written(weighted, "mix-cells")
    few = weighted.count() <= FEW_CELLS
    columns = ", ".join(f"`{c}`" for c in weighted.columns if c != "weight")
    goal = {d: f"share_{d} * {total!r}D" for d in targets}
    miss, idle, done = float("inf"), 0, 0
    sweep = "{one}"
    for d in targets:
        sums = f"SELECT *, sum(weight) OVER (PARTITION BY {d}) AS s FROM {sweep}"
        sweep = f"(SELECT {columns}, CASE WHEN s > 0 THEN weight * ({goal[d]}) / s ELSE 0D END AS weight FROM ({sums}))"
    off = [f"CASE WHEN {g} > 0 THEN abs(sum(weight) OVER (PARTITION BY {d}) / ({g}) - 1) ELSE 0D END" for d, g in goal.items()]
    off = f"greatest({', '.join(off)}, 0D) AS miss"
    while done < sweeps:
        one, now = weighted.coalesce(1) if few else weighted, min(SWEEPS_A_JOB, sweeps - done)
        for _ in range(now):
            one = one.sparkSession.sql(f"SELECT * FROM {sweep}", one=one)
        out = written(one.selectExpr("*", off), "mix-cells")
        last, miss, done = miss, out.agg(F.max("miss")).first()[0], done + now
        weighted = out.drop("miss")
        idle = idle + 1 if miss > last * (1 - stall) else 0
        if miss <= tolerance or idle == 2:
            break
    miss = max(miss, absent)
    if miss > tolerance:
        logging.getLogger(__name__).warning("raking ended after %d sweeps; a marginal misses its target by %.2g of it", done, miss)
    return weighted.select(*cells.columns, "weight", F.lit(miss).alias("miss"))


def uniform(seed: str = SEED) -> Column:
    """A number in [0, 1) from doc_id, the same on every engine: 52 bits of MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def cell_probabilities(docs: DataFrame, targets: dict[str, DataFrame] | None = None, spare: float = SPARE) -> DataFrame:
    """(source, lang, topic, probability, scale, miss) of the cells of ``docs``."""
    cells = written(_celled(docs).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-sums")
    targets = targets or {d: tempered_targets(cells, d) for d in DIMENSIONS}
    per_token = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    raked = written(rake(cells, targets).select(*DIMENSIONS, "weight", per_token.alias("scale"), "miss"), "mix-scales")
    top = full_scale(raked, spare)
    return written(raked.drop("weight").withColumn("probability", F.least(F.lit(1.0), F.col("scale") / F.lit(top))), "mix-probabilities")


def full_scale(raked: DataFrame, spare: float) -> float:
    """The scale that gets probability 1: the largest once cells of at most ``spare`` of all weight are left out.

    Collects a row per step of the scales, however many cells there are.
    """
    step = F.floor(F.log2("scale") * STEPS).alias("step")
    steps = raked.filter("scale > 0").groupBy(step).agg(F.sum("weight").alias("weight"), F.max("scale").alias("top")).orderBy(F.desc("step")).collect()
    left = spare * sum(r["weight"] for r in steps)
    for r in steps:
        left -= r["weight"]
        if left < 0:
            return r["top"]
    return 1.0


def mix_documents(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: str = SEED, spare: float = SPARE) -> DataFrame:
    """doc_id, source, lang, topic, tokens, scale, probability, sampled for each row of ``docs`` (doc_id, text, source, lang).

    A null source or language is the value ``(none)``; a null or empty text has 0 tokens and the
    probability of its cell. Repeated rows share one draw, as do all rows of null id. A column ``topic``
    is used if there is one; other columns are ignored. An empty table gives no rows. With ``spare`` 0
    the neediest cell alone has probability 1.
    """
    return _drawn(docs, cell_probabilities(docs, targets, spare), seed)


def _drawn(docs: DataFrame, cells: DataFrame, seed: str = SEED) -> DataFrame:
    out = _celled(docs, "doc_id").join(cells, list(DIMENSIONS))
    return out.select(
        "doc_id", *DIMENSIONS, "tokens",
        F.round("scale", 8).alias("scale"), F.round("probability", 8).alias("probability"),
        (uniform(seed) < F.col("probability")).alias("sampled"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    cells = cell_probabilities(docs).select(*(F.col(d).alias(f"__{d}") for d in DIMENSIONS), F.col("probability").alias("__p"))
    topic = F.coalesce(F.col("topic"), F.lit(UNKNOWN)) if "topic" in docs.columns else form_topic()
    key = {"source": F.coalesce("source", F.lit(UNKNOWN)), "lang": F.coalesce("lang", F.lit(UNKNOWN)), "topic": topic}
    same = [key[d] == F.col(f"__{d}") for d in DIMENSIONS]
    return docs.join(cells, same[0] & same[1] & same[2]).filter(uniform() < F.col("__p")).select(*docs.columns)


def _oracle() -> str:
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    ctes = [
        f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{UNKNOWN}') AS source, coalesce(lang, '{UNKNOWN}') AS lang, {words} AS tokens,
            CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '!!') THEN 'shout'
                 WHEN regexp_matches(coalesce(text, ''), '[%$&*#]{{3}}') THEN 'marked' WHEN length(coalesce(text, '')) < 500 THEN 'short'
                 WHEN length(text) >= 5000 THEN 'long' ELSE 'prose' END AS topic FROM documents)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)",
    ]
    for x in DIMENSIONS:
        ctes.append(f"t_{x} AS MATERIALIZED (SELECT {x}, s / sum(s) OVER () AS share FROM (SELECT {x}, pow(sum(tokens), {ALPHA}) AS s FROM c GROUP BY {x}))")
    last, weight = "c", "tokens"
    for k in range(SQL_SWEEPS):
        for x in DIMENSIONS:
            step = f"w_{k}_{x}"
            ctes.append(f"{step} AS MATERIALIZED (SELECT {last}.* REPLACE ({weight} * share * (SELECT sum(tokens) FROM c) / sum({weight}) OVER (PARTITION BY {x}) AS {weight}) FROM {last} JOIN t_{x} USING ({x}))" if weight == "weight" else f"{step} AS MATERIALIZED (SELECT c.*, tokens * share * (SELECT sum(tokens) FROM c) / sum(tokens) OVER (PARTITION BY {x}) AS weight FROM c JOIN t_{x} USING ({x}))")
            last, weight = step, "weight"
    ctes.append(f"r AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS scale FROM {last})")
    ctes.append("p AS MATERIALIZED (SELECT *, scale / max(scale) OVER () AS p FROM r)")
    draw = f"('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, source, lang, topic, tokens, round(scale, 8) AS scale, round(p, 8) AS probability, {draw} < p AS sampled FROM d JOIN p USING (source, lang, topic)"


ORACLE = _oracle()
