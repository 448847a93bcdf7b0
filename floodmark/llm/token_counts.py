"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece in a unit of text; dynamic programming carries
the best score and its piece count to each position, and nothing else. Rules of the exact tokenizer: a
position takes a candidate only if its score is strictly higher, candidates arriving by ascending start;
a character that is no piece costs the lowest score of the vocabulary less ten, and falls back to one
piece per UTF-8 byte where the vocabulary has them all. A space becomes the word mark, and a mark is
prepended to a text that isn't empty.

Where no piece holds a mark after another character (checked when the vocabulary is read), no best path
crosses the place before a word mark, so units are words and their counts are kept in a bounded cache.
Otherwise the whole text is one unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

MARK = "▁"
UNK_PENALTY = 10.0
#: Entries of a worker's cache of units; it is emptied when full.
CACHE = 300_000


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, and the id of the unknown piece, of a sentencepiece file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], m.unk_id()


class Counter:
    """Counts pieces of texts; one is made in each Python worker."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        names = {p for p, _ in vocabulary}
        self.single = {p for p in names if len(p) == 1}
        self.bytes = all(f"<0x{i:02X}>" in names for i in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNK_PENALTY
        self.by_word = not any(MARK in p.lstrip(MARK) for p in names)
        self.by_line = not any("\n" in p for p in names)
        self.cache: dict[str, tuple[int, float]] = {}

    def unit(self, s: str) -> tuple[int, float]:
        """Piece count and score of the best path through ``s``."""
        n = len(s)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, found in self.pieces.iter(s):
            ends[end + 1].append(found)
        for e in range(1, n + 1):
            top = None
            for length, score in ends[e]:  # longest first: ascending starts
                x = best[e - length] + score
                if top is None or x > top:
                    top, count[e], unknown[e] = x, count[e - length] + 1, False
            if s[e - 1] not in self.single:
                x = best[e - 1] + self.unknown
                if top is None or x > top:
                    more = len(s[e - 1].encode()) if self.bytes else int(not unknown[e - 1])
                    top, count[e], unknown[e] = x, count[e - 1] + more, True
            best[e] = top
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.unit(marked)
        units = re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)
        if self.by_line and self.bytes and "\n" in marked:
            units = [x for u in units for x in re.split("(\n)", u) if x] if "\n" in marked else units
        n, score, cache = 0, 0.0, self.cache
        for u in units:
            found = cache.get(u)
            if found is None:
                if len(cache) >= CACHE:
                    cache.clear()
                found = cache[u] = self.unit(u)
            n += found[0]
            score += found[1]
        return n, score


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(read_vocabulary(path)[0])
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, score for each row of ``docs`` (doc_id, text).

    ``vocabulary`` is the path of a sentencepiece file on every worker. A null or empty text has no
    tokens and score 0. Repeated rows give repeated results; other columns are ignored. One pass over
    the texts, no shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(vocabulary)
        for b in batches:
            found = [c.text(t) for t in b["text"]]
            out = pd.DataFrame(found, columns=["n_tokens", "score"])
            out.insert(0, "doc_id", b["doc_id"].array)
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, score double")
