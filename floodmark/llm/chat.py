"""Chat formatting by perspective rotation.

A dialogue is rendered once for each of its participants: that speaker's turns are the assistant's, all
others appear as users by name, system turns stay what they are. The mask lists the characters to learn
from: the content and end mark of the assistant's turns. Marks can't be forged: ``<|`` in a text comes out
as ``<\\|``, and in a name ``|`` as ``\\|`` and a line feed as a space.

A dialogue is one row per participant. Only one of more than ``part_turns`` turns comes in parts of so
many, which bounds a row however long a dialogue is; the texts of its parts follow each other without a
gap, and spans count from the start of the dialogue, so joined parts are what one row would have been.

Scale: turns are counted by dialogue, on the map side first. Dialogues within bounds then meet in one
exchange and are rendered there for all participants; only the turns of longer ones are numbered, in blocks, and
what lies before each part is summed up. Which these are comes from a bitmap of fixed size; a short
dialogue that it takes for a long one comes out the same the other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import numbers
from .common import marked

END = "<|end|>\n"
#: Turns of one row; longer dialogues come in parts.
PART_TURNS = 4096


def _named(speaker: str | None) -> str:
    return ("unknown" if speaker is None else speaker).replace("|", "\\|").replace("\n", " ")


def _head(speaker: str | None, perspective: str) -> str:
    if speaker == perspective:
        return "<|assistant|>\n"
    return "<|system|>\n" if speaker == "system" else f"<|user name={_named(speaker)}|>\n"


def _render(turns: list, perspective: str, at: int) -> tuple[str, str, int]:
    out, spans, learned = [], [], 0
    for _, speaker, text in turns:
        own = speaker == perspective
        head = _head(speaker, perspective)
        segment = head + text + END
        if own:
            spans.append(f"{at + len(head)}:{at + len(segment)}")
            learned += len(segment) - len(head)
        out.append(segment)
        at += len(segment)
    return "".join(out), ",".join(spans), learned


RENDERED = "conv_id long, perspective string, part long, n_turns long, text string, mask string, n_learned long"


def _render_whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each dialogue of a batch for each of its participants."""
    for b in batches:
        rows = []
        for conv_id, turns in zip(b["conv_id"].array, b["turns"], strict=True):
            listed, last = [], None
            for t in sorted(((t["turn"], t["speaker"], t["text"], t["numbered"]) for t in turns), key=lambda t: (t[0], t[1] is not None, t[1] or "", t[2], not t[3])):
                if not (t[3] and t == last):  # exact repeats of a numbered turn count once
                    listed.append(t[:3])
                last = t
            for who in sorted({s for _, s, _ in listed if s is not None and s != "system"}):
                rows.append((conv_id, who, 0, len(listed), *_render(listed, who, 0)))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in RENDERED.split(", ")])
        out["conv_id"] = out["conv_id"].astype("Int64")
        yield out


def rotate_perspectives(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask, n_learned from ``conversations`` (conv_id, turn, role, text).

    One row for each participant (and part of a dialogue of more than ``part_turns`` turns). Turns go by
    number, those of equal number by speaker and text; exact repeats of a numbered turn count once. A turn
    without a number ranks as 0, and all such turns count. A null text is empty, a null role is a user shown as
    ``unknown`` who, like the system, gets no perspective; a null conv_id is a dialogue of its own. A dialogue
    of only such speakers gives no row. Other columns are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("role").alias("speaker"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("<\\|")).alias("text"),
        F.col("turn").isNotNull().alias("numbered"),
    ).withColumn("number", F.xxhash64("conv_id"))
    long = turns.groupBy("number").agg(F.count("*").alias("n")).filter(F.col("n") > part_turns).select("number")
    seen = marked(turns, long, "number").drop("number")
    whole = seen.filter("not hit").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "speaker", "text", "numbered")).alias("turns"))
    cut = seen.filter("hit").drop("hit")
    return whole.mapInPandas(_render_whole, RENDERED).unionByName(_rotate_long(cut, part_turns))


def _rotate_long(turns: DataFrame, part_turns: int) -> DataFrame:
    """Dialogues of any length in parts. Numbers are given by blocks of turn numbers, so one is many tasks."""
    turns = turns.filter("numbered").distinct().unionByName(turns.filter("not numbered"))
    keyed = turns.select(F.struct("conv_id").alias("conv"), "turn", "speaker", "text")
    numbered = numbers(keyed, ["conv"], ["turn", "speaker", "text"], F.shiftright("turn", 12), "_n")
    part = F.floor(F.col("_n") / part_turns).cast("long").alias("part")
    parts = numbered.groupBy("conv", part).agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    # What a part is long for those who don't speak in it, and what its own head saves each speaker.
    shown = lambda speaker: F.replace(F.coalesce(speaker, F.lit("unknown")), F.lit("|"), F.lit("\\|"))
    head = lambda speaker: F.when(speaker == "system", len(_head("system", ""))).otherwise(F.length(shown(speaker)) + len(_head("", "other")))
    total = lambda sizes: F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n)
    size = total(F.transform("turns", lambda t: head(t["speaker"]) + F.length(t["text"]) + len(END)))
    speakers = F.array_distinct(F.transform("turns", lambda t: t["speaker"]))
    saved = lambda who: total(F.transform(F.filter("turns", lambda t: t["speaker"] == who), lambda t: len(_head("", "")) - head(t["speaker"])))
    narrow = parts.select("conv", "part", size.alias("size"), F.transform(speakers, lambda who: F.struct(who.alias("who"), saved(who).alias("saved"))).alias("own"))
    so_far = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = narrow.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("size").over(so_far), F.lit(0).cast("long")).alias("before"))
    own = narrow.select("conv", "part", F.inline("own")).filter("who <> 'system'")
    people = own.groupBy(F.col("conv").alias("k"), F.col("who").alias("perspective")).agg(F.collect_list(F.struct("part", "saved")).alias("own"))
    earlier = total(F.transform(F.filter("own", lambda o: o["part"] < F.col("part")), lambda o: o["saved"]))
    views = parts.join(places, (F.col("conv") == F.col("c")) & (F.col("part") == F.col("p"))).join(people, F.col("conv") == F.col("k"))
    views = views.select("conv.conv_id", "perspective", "part", "turns", (F.col("before") + earlier).alias("at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for turns, perspective, at in zip(b["turns"], b["perspective"], b["at"].tolist(), strict=True):
                listed = [(t["turn"], t["speaker"], t["text"]) for t in turns]
                rows.append((len(listed), *_render(listed, perspective, at)))
            out = pd.DataFrame(rows, columns=["n_turns", "text", "mask", "n_learned"])
            yield pd.concat([b[["conv_id", "perspective", "part"]].reset_index(drop=True), out], axis=1)

    return views.mapInPandas(run, RENDERED)


ORACLE = rf"""
WITH r AS (SELECT conv_id, turn IS NULL AS free, coalesce(turn, 0) AS turn, role AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS text FROM conversations),
t AS (SELECT DISTINCT * FROM r WHERE NOT free UNION ALL SELECT * FROM r WHERE free),
n AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, speaker NULLS FIRST, text) - 1) // {PART_TURNS} AS part FROM t),
s AS (SELECT t.conv_id, p.perspective, part, turn, speaker, text,
             CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
                  ELSE '<|user name=' || replace(replace(coalesce(speaker, 'unknown'), '|', '\|'), chr(10), ' ') || '|>' END || chr(10) AS head
      FROM n t JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system') p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment,
             sum(length(head || text) + 8) OVER (PARTITION BY conv_id, perspective ORDER BY turn, speaker NULLS FIRST, text ROWS UNBOUNDED PRECEDING) AS till FROM s)
SELECT conv_id, perspective, part, count(*)::BIGINT AS n_turns, string_agg(segment, '' ORDER BY turn, speaker NULLS FIRST, text) AS text,
       coalesce(string_agg((till - length(text) - 8)::BIGINT || ':' || till::BIGINT, ',' ORDER BY turn, speaker, text) FILTER (speaker = perspective), '') AS mask,
       coalesce(sum(length(text) + 8) FILTER (speaker = perspective), 0)::BIGINT AS n_learned
FROM o GROUP BY conv_id, perspective, part
"""
