"""Alignment of two tokenizers against a plain merge of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floodmark.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(tokenizers, text):
    """(id, start, end) of each token on both sides, or none."""
    a, b = tokenizers
    if not text:
        return [], []
    data, letters, sides = (" " + text).encode(), alignment.byte_level_letters(), []
    for side in ([(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
                 [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]):
        at, out = 0, []
        for i, spelled in side:
            out.append((i, at, at + len(spelled)))
            at += len(spelled)
        if b"".join(s for _, s in side) != data:
            return [], []
        sides.append(out)
    return tuple(sides)


def plain(tokenizers, docs):
    """Every number of the contract, by sets of ends and pairs of ranges that overlap."""
    found, pairs = [], Counter()
    for _, text in docs:
        a, b = tokens(tokenizers, text)
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in both:
            groups.append(tuple(",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in (a, b)))
            start = end
        links, low = [], 0
        for i, s, e in a:
            while b[low][2] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        pairs.update(set(links))
        text = ";".join("|".join(g) for g in groups)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    best = Counter()
    for (i, _), n in pairs.items():
        best[i] = max(best[i], n)
    return sorted(((d, na, nb, g, len(ls), sum(pairs[x] == best[x[0]] for x in ls), sum(pairs[x] for x in ls), h) for (d, _), (na, nb, g, ls, h) in zip(docs, found, strict=True)), key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_merge_path(piece):
    rng = np.random.default_rng(piece)
    for n, m in ((0, 0), (0, 5), (5, 0), (1, 1), (40, 3), (200, 190)):
        a, b = (np.sort(rng.integers(0, 150, k)) for k in (n, m))
        own, i, j = alignment.merge_path(a, b, piece)
        want, x, y = [], 0, 0
        while x < n or y < m:
            mine = x < n and (y == m or a[x] <= b[y])
            want.append((mine, x, y))
            x, y = x + mine, y + (not mine)
        assert list(zip(own.tolist(), i.tolist(), j.tolist(), strict=True)) == want


ODD = [
    None, "", " ", "  ", "a ", " a", "a  b", "a \n b", "x\ny", "x\n y", "\n", "\t\t", "it's don't 'll", "<|endoftext|> <s> </s> <unk>", "a▁b c", "▁", "é é", "日本語 テスト", "  a b", "a  b", "\x00\x01 \x1c x",
    "naïve café ", "12345 678,90", "🙂🙂 👩‍👩‍👧", "a" * 700, "!?" * 90, " " * 50 + "x", "<0x41> A", "ꙮ " * 20, "word　 next",
]


def test_odd_texts(spark, tokenizers):
    rng = random.Random(4)
    bits = ["the", " ", "  ", "\n", "straße", "foo.", "'s", " ", "é", "x1", "\x1d", "𝔘", "▁", "日本", "-", "\t"]
    docs = list(enumerate(ODD)) + [(100 + i, "".join(rng.choices(bits[: 12 + i % 5], k=rng.randrange(1, 60)))) for i in range(150)]
    docs += [(None, "twice the same"), (7, "twice the same"), (7, "twice the same")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"chunk": F.lit("x"), "pair": F.lit(1), "n": F.lit(2)})
    assert rows(alignment.align_documents(frame.repartition(3), A, B)) == plain(tokenizers, docs)


def test_segments_and_chunks(tokenizers, monkeypatch):
    """A text of many segments, and chunks of a few documents, give what whole texts give."""
    monkeypatch.setattr(alignment, "SEGMENT", 90)
    monkeypatch.setattr(alignment, "CALL", 40)
    monkeypatch.setattr(alignment, "CACHE", 3000)
    rng = random.Random(9)
    text = " ".join(rng.choices("alpha beta, gamma; delta's 12 straße \n".split(" "), k=3000))
    docs = [(1, text), (2, text[:500]), (3, "short"), (4, text[300:])]
    aligner = alignment.Aligner(A, B)
    aligner.start(0)
    for part in (docs[:3], docs[3:]):
        aligner.add([d for d, _ in part], [t for _, t in part])
    batches = list(aligner.finish())
    got = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in batches[0].to_pylist()]
    want = [(w[0], *w[1:5], w[7]) for w in plain(tokenizers, docs)]
    assert sorted(got) == sorted(want)
    counts = {r["pair"]: r["docs"] for b in batches[1:] for r in b.to_pylist()}
    links = [set(zip(*[[i for i, *_ in s] for s in ((), ())])) for _ in docs]
    for k, (_, t) in enumerate(docs):
        a, b = tokens(tokenizers, t)
        low = 0
        for i, s, e in a:
            while b[low][2] <= s:
                low += 1
            n = low
            while n < len(b) and b[n][1] < e:
                links[k].add((i << 32) | b[n][0])
                n += 1
    assert counts == Counter(x for ls in links for x in ls)


def test_query(spark, sf_dir, duck, tokenizers):
    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert rows(queries.op13_token_alignment(spark, sf_dir)) == plain(tokenizers, docs)


def test_empty_table(spark):
    assert rows(alignment.align_documents(spark.createDataFrame([], "doc_id long, text string, code int"), A, B)) == []
    assert rows(alignment.align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
