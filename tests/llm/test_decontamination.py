"""The FM-index and decontamination against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from floodmark.llm import decontamination as dc
from floodmark.llm import fm_index


def plain_words(text):
    out, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) >= 0x80 or c.isascii() and c.isalnum():
            word += c
        else:
            out, word = (out + [word] if word else out), ""
    return out + [word] if word else out


def plain(docs, items, width):
    found = []
    for doc_id, text in docs:
        words, hit, names = plain_words(text), set(), set()
        for name, item in items:
            w = plain_words(item)
            n = min(width, len(w))
            windows = {tuple(w[s : s + n]) for s in range(len(w) - n + 1)} if n else ()
            for s in range(len(words)):
                if tuple(words[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    names.add(str(name) if name is not None else "")
        found.append((doc_id, len(words), len(hit), sorted(names), hit))
    return found


def places(text, hit):
    """Removal spans of the words ``hit``, by walking through the text."""
    spans, k, inside, start = [], -1, False, 0
    at = []
    for i, c in enumerate(text + " "):
        word = ord(c) >= 0x80 or c.isascii() and c.isalnum()
        if word and not inside:
            start, k = i, k + 1
        if inside and not word:
            at.append((start, i))
        inside = word
    for w in sorted(hit):
        if spans and w - 1 in hit:
            spans[-1][1] = at[w][1]
        else:
            spans.append(list(at[w]))
    return [tuple(s) for s in spans]


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    for symbols in (2, 3, 9, 300):
        text = rng.integers(0 if symbols > 2 else 1, symbols, 700).astype(np.int32)
        text[300:400] = text[100:200]  # a long repeat
        text[-1] = 0
        index = fm_index.FMIndex(text, symbols)
        order = fm_index.suffix_order(text)
        assert sorted(order.tolist()) == list(range(700))
        phrases = np.stack([text[s : s + 4] for s in range(600)] + [rng.integers(1, symbols, 4) for _ in range(100)]).astype(np.int32)
        lengths = rng.integers(1, 5, len(phrases))
        clean = np.array([(p[:n] > 0).all() for p, n in zip(phrases, lengths, strict=True)])
        phrases, lengths = phrases[clean], lengths[clean]
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high, strict=True):
            want = [i for i in range(700) if text[i : i + n].tolist() == p[:n].tolist()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "D9", "eeeeeeeeeeee", "日本", "ſ", "x" * 40]
    seps = [" ", "-", "\n", ", ", "\x00", " \x7f"]
    join = lambda ws: "".join(w if rng.random() < 0.5 else w.upper() + "" for w in ws for w in (w, rng.choice(seps)))
    items = [(i, join(rng.choices(words[: 2 + i % 7], k=rng.choice([0, 1, 3, 4, 9, 30])))) for i in range(25)]
    docs = []
    for i in range(size):
        parts = [join(rng.choices(words, k=rng.randrange(20))) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(1, rng.choice(items)[1])
        docs.append((i, "".join(parts)))
    return docs, items


@pytest.mark.parametrize("block", [dc.BLOCK, 300])
@pytest.mark.parametrize("width", [4, 10])
def test_equals_plain_search(spark, monkeypatch, width, block):
    docs, items = corpus(width, 120)
    docs += [(None, None), (200, ""), (7, docs[7][1]), (7, docs[7][1]), (201, items[-1][1])]
    items += [(None, "B a B a B"), (3, items[3][1]), (40, None), (41, ""), (42, "...")]
    got = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), width, block=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), [tuple(s) for s in r.spans]) for r in got.collect()), key=repr)
    texts = dict(docs)
    want = sorted(((*w[:4], places(texts[w[0]] or "", w[4])) for w in plain(docs, items, width)), key=repr)
    assert got == want
    assert sum(g[2] for g in got) > 100


def test_slices_and_shards(spark, monkeypatch):
    monkeypatch.setattr(dc, "SLICE", 7)
    docs, items = corpus(3, 40)
    phrases = dc.Phrases([(str(i), t) for i, t in items], 4)
    import pyarrow as pa

    batches = [dc._Batch(pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in part], "text": [t for _, t in part]}), phrases) for part in (docs[:9], docs[9:])]
    hit, _ = dc.search_shard(batches, phrases)
    marked = np.concatenate([b.words + base for b, base in zip(batches, (0, len(batches[0].starts)), strict=True)])[hit]
    assert len(set(marked.tolist())) == sum(w[2] for w in plain(docs, items, 4))


def test_texts_without_spans(spark):
    docs = [(1, "Keep this. The quick brown fox jumps! And that."), (2, None), (3, "nothing here"), (4, "the quick brown FOX")]
    items = [("q", "the quick brown fox"), ("r", "jumps")]
    out = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), 4)
    rows = {r.doc_id: (r.text, r["items"]) for r in out.collect()}
    assert rows == {1: ("Keep this. ! And that.", ["q", "r"]), 2: (None, []), 3: ("nothing here", []), 4: ("", ["q"])}


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "clash", 5)], "doc_id long, text string, item_id string, hits int")
    none = spark.createDataFrame([], "item_id long, text string, doc_id int")
    row = dc.contamination_digest(docs, none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False) and row.items_sha256 == hashlib.sha256(b"").hexdigest()
    assert dc.contamination_digest(docs.limit(0), spark.createDataFrame([(1, "a", 1)], "item_id long, text string, doc_id int")).collect() == []
    # a very long text, one run and one word
    long = spark.createDataFrame([(1, "a " * 400_000), (2, "a" * 3_000_000), (3, "b a b")], "doc_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit) for r in dc.contamination_digest(long, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect()}
    assert rows == {1: (400_000, 400_000), 2: (1, 0), 3: (3, 1)}
