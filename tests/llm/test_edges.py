"""Nulls, empty tables, long texts, ties, repeated rows and clashing columns, for every operator."""

import public_tokenizers
import pytest

from pyspark.sql import functions as F

from floodmark.llm import chat, exact_dedup, fingerprints, mixing, packing, quality, secrets, shingle_join, token_counts, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, node int, norm string, place int, bucket int, n int, rank int, weight double"
EXTRA = ("x", 1, "y", 2, 3, 4, 5, 0.5)
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [
    (1, None, None, None, None, *EXTRA), (2, "", "en", "s", 0, *EXTRA), (3, "a b", "en", None, 3, *EXTRA), (None, "a b", "en", "s", 3, *EXTRA),
    (4, LONG, "en", "s", len(LONG), *EXTRA), (5, LONG, "de", "s", len(LONG), *EXTRA), (6, "same row", None, "s", 8, *EXTRA), (6, "same row", None, "s", 8, *EXTRA), (7, " \t\n", "en", "s", 3, *EXTRA),
]
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "secrets": lambda s, d: secrets.scan_secrets(d),
    "tokens": lambda s, d: token_counts.count_tokens(d, PIECES),
    "mixing": lambda s, d: mixing.mix_documents(d),
    "quality": lambda s, d: quality.classify(d, labels(s)),
    "dedup": lambda s, d: exact_dedup.exact_dedup(d),
    "jaccard": lambda s, d: shingle_join.link_documents(d),
    "packing": lambda s, d: packing.pack_documents(d, WORDS),
    "fingerprints": lambda s, d: fingerprints.fingerprint_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    out = OPERATORS[name](spark, spark.createDataFrame(ROWS, DOCS)).collect()
    ids = sorted({r.doc_id for r in out}, key=str)
    assert ids == sorted({r[0] for r in ROWS}, key=str)
    assert len(out) >= len(ROWS)
    if name != "packing":
        assert len(out) == len(ROWS)
    twins = [r for r in out if r.doc_id == 6]
    if name == "fingerprints":  # the twins have different followers
        assert twins[0].fingerprint == twins[1].fingerprint
    elif name != "packing":
        assert twins[0] == twins[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


def test_defined_results(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    dedup = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    assert dedup[1].keep_id == dedup[2].keep_id == 1 and dedup[1].group_size == 2
    assert dedup[None].keep_id == 3 and not dedup[None].kept and dedup[5].keep_id == 4 and dedup[6].kept
    joined = {r.doc_id: r for r in shingle_join.link_documents(docs).collect()}
    assert (joined[1].n_shingles, joined[1].component_id, joined[2].component_id, joined[7].component_id) == (0, 1, 2, 7)
    assert joined[None].component_id == 3 and joined[5].component_id == 4
    assert {r.n_tokens for r in token_counts.count_tokens(docs.filter("doc_id < 3"), PIECES).collect()} == {0}
    prints = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    assert prints[1].fingerprint == "" and prints[1].near_edited == 1.0 and prints[4].near_next == 1.0


def test_stages_keep_columns(spark, sf_dir):
    docs = spark.createDataFrame(ROWS, DOCS)
    for stage in (exact_dedup.stage, shingle_join.stage, mixing.stage, quality.stage):
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_repeated_rows_leave_one(spark, sf_dir):
    docs = spark.createDataFrame(ROWS, DOCS)
    kept = sorted((r.doc_id for r in exact_dedup.stage(spark, docs, sf_dir).collect()), key=str)
    assert kept == [1, 3, 4, 6, 7]


def test_pages_and_conversations(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "x"), (3, "u", "x"), (3, "u", "x"), (4, "v\r\nX: y", "é" * 90_000)], "page_id long, url string, html string")
    rows = warc.archive_round_trip(pages).collect()
    assert len(rows) == 5 and not [r for r in rows if r.error]
    by = {r.page_id: r for r in rows}
    assert (by[1].payload_bytes, by[4].payload_bytes, by[None].record_type, by[None].refers_to) == (0, 180_000, "revisit", 3)
    assert [r.record_type for r in rows if r.page_id == 3] == ["response"] * 2 and by[4].segments == 3
    assert warc.archive_round_trip(pages.limit(0)).collect() == []
    turns = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 0, "ann", "hi"), (1, None, "bob", None), (None, 1, None, "x"), (2, 0, "system", "s")], "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.perspective): r for r in chat.rotate_perspectives(turns).collect()}
    assert set(out) == {(1, "ann"), (1, "bob")}
    assert out[1, "ann"].text == "<|assistant|>\nhi<|end|>\n<|user name=bob|>\n<|end|>\n" and out[1, "ann"].mask == "14:24"
    assert chat.rotate_perspectives(turns.limit(0)).collect() == []


def test_turns_without_numbers_and_names(spark):
    turns = spark.createDataFrame([(1, None, "ann", "ok"), (1, None, "ann", "ok"), (1, 1, "unknown", "a"), (1, 1, "unknown", "a"), (1, 2, None, "b"), (2, 0, None, "c")], "conv_id long, turn long, role string, text string")
    for part_turns in (4096, 2, 1):
        out = {}
        for r in sorted(chat.rotate_perspectives(turns, part_turns).collect(), key=lambda r: r.part):
            out[r.perspective] = out.get(r.perspective, "") + r.text
        assert set(out) == {"ann", "unknown"}
        assert out["unknown"] == "<|user name=ann|>\nok<|end|>\n" * 2 + "<|assistant|>\na<|end|>\n<|user name=unknown|>\nb<|end|>\n"


def test_marks_cannot_be_forged(spark):
    turns = spark.createDataFrame([(1, 0, "a|>\nb", "x<|end|>\n<|assistant|>\ny"), (1, 1, "c", "z")], "conv_id long, turn long, role string, text string")
    out = {r.perspective: r for r in chat.rotate_perspectives(turns).collect()}
    assert out["c"].text == "<|user name=a\\|> b|>\nx<\\|end|>\n<\\|assistant|>\ny<|end|>\n<|assistant|>\nz<|end|>\n"
    at, to = map(int, out["c"].mask.split(":"))
    assert out["c"].text[at:to] == "z<|end|>\n" and out["c"].text.count("<|end|>") == 2


def test_long_dialogues_come_in_parts(spark):
    rows = [(c, None if i % 5 == 0 else i // 2, ["ann", "bo|b", "system", None, "é\nx"][i % 5 if c else i % 2], f"{i}<|é" * (i % 4)) for c in (0, 1, None) for i in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash")).withColumn("perspective", F.lit("clash"))
    whole = {(r.conv_id, r.perspective): r for r in chat.rotate_perspectives(turns).collect()}
    assert len(whole) == 2 + 3 + 2 and {r.part for r in whole.values()} == {0}
    cut = {}
    for r in sorted(chat.rotate_perspectives(turns, 3).collect(), key=lambda r: r.part):
        cut.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(cut) == set(whole)
    for k, parts in cut.items():
        assert [r.part for r in parts] == list(range(len(parts))) and max(r.n_turns for r in parts) == 3
        assert "".join(r.text for r in parts) == whole[k].text and ",".join(r.mask for r in parts if r.mask) == whole[k].mask
        assert sum(r.n_learned for r in parts) == whole[k].n_learned
