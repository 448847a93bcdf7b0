"""Best-fit packing by sum of squares.

A document is its token ids and an end id; one longer than a sequence is cut into full pieces and a
rest. Pieces are packed one by one: each goes where the sum, over all gaps, of the squared number of
open sequences with that gap becomes smallest; of equal choices the fullest sequence wins. Longer pieces come
first. A new sequence is opened only for a piece that no open one can take: were it one of the choices
compared, as it may be where pieces come in any order, 0.4 % more sequences would be used, and few
sequences are what counts here.

Scale: tokenising is one pass without a shuffle; a piece is then a row of some 40 bytes. Pieces are
dealt by hash into shards of about ``shard_pieces`` (those of null ids by their place), so a packing task
has a bounded number of rows whatever the input, and loses a few partly filled sequences a shard.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed

#: Bytes that a worker's cache of words and their token ids may take, about; it is emptied when full.
CACHE = 256 << 20
#: Bytes of an entry beside its word and ids.
ENTRY = 170
#: How the vocabulary marks a token that ends a word.
END_OF_WORD = "</w>"
#: Documents whose new words go to the tokenizer in one call.
BATCH = 128

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def word_parts(word: str) -> tuple[str, ...]:
    """Parts of a word that have ids of their own: marks of ASCII at its end stand alone, case is dropped.

    A word that could hold a special token, or whose letters Python might lower in another way than the
    tokenizer, stays whole.
    """
    if "<|" in word:
        return (word,)
    bare = word.rstrip(string.punctuation)
    if bare.isascii():
        bare = bare.lower()
    if len(bare) == len(word) or not bare:
        return (bare or word,)
    # next to anything but a letter or digit the marks would be one piece with it
    return (bare, word[len(bare) :]) if bare[-1].isalnum() else (word,)


def _lowered(text: str) -> str:
    """``text`` in lower case where the tokenizer would do the same and no special token can come of it."""
    return text.lower() if text.isascii() and "<|" not in text else text


class Words:
    """Token ids of texts as little-endian bytes, word by word.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its
    words in a row; only spaces and line feeds are split at here, all else is left to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}
        self.held = 0
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        for at in range(0, len(texts), BATCH):
            split = [_lowered(t or "").replace("\n", " ").split(" ") for t in texts[at : at + BATCH]]
            if self.held > CACHE:
                self.cache, self.held = {"": b""}, 0
            known, unknown = self.cache, set()
            for words in split:
                unknown.update(filterfalse(known.__contains__, words))
            new = {w: word_parts(w) for w in unknown}
            self._learn({p for parts in new.values() for p in parts if p not in known})
            for w, parts in new.items():
                if len(parts) == 2:
                    known[w] = known[parts[0]] + known[parts[1]]
                elif parts[0] != w:
                    known[w] = known[parts[0]]
            self.held += sum(ENTRY + len(w) + len(known[w]) for w in new)
            for words in split:
                yield b"".join(map(known.__getitem__, words))

    def _learn(self, parts: set[str]) -> None:
        """Put the ids of ``parts`` into the cache. All words of letters go in one call: each is one
        piece to the tokenizer, whose last token is one that ends a word."""
        letters = [p for p in parts if p.isalpha()] if self.ends.any() else []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist() if len(ids) else []
        if len(stops) == len(letters):
            data = ids.tobytes()
            self.cache.update(zip(letters, map(data.__getitem__, map(slice, [0, *stops], stops)), strict=True))
            parts = parts.difference(letters)
        rest = list(parts)
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.cache[p] = np.array(e.ids, "<u4").tobytes()


_WORDS: dict[str, Words] = {}


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if tokenizer not in _WORDS:
            _WORDS[tokenizer] = Words(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows, at = [], []
            for i, ids in enumerate(_WORDS[tokenizer].ids(list(b["text"]))):
                ids += end
                for k, start in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[start : start + 4 * size]
                    rows.append((k, start // 4, len(part) // 4, zlib.crc32(part)))
                    at.append(i)
            out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"])
            out.insert(0, "doc_id", b["doc_id"].array[at])
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


def pack(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the given order."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]  # by level: what is filled already
    count = np.zeros(size + 1, np.int64)
    never, used = np.iinfo(np.int64).max, 0
    for i, s in enumerate(lengths.tolist()):
        level = 0
        if s < size:
            # change of the sum of squares if the piece goes to level 1 .. size - s
            change = 1 - 2 * count[1 : size - s + 1]
            change[:-1] += 2 * count[s + 1 : size] + 1
            change[count[1 : size - s + 1] == 0] = never
            best = len(change) - 1 - int(change[::-1].argmin()) if len(change) else 0
            if len(change) and change[best] < never:
                level = best + 1
        if level:
            bin_ = open_at[level].pop()
            count[level] -= 1
        else:
            bin_ = used
            used += 1
        sequence[i], offset[i] = bin_, level
        if level + s < size:
            open_at[level + s].append(bin_)
            count[level + s] += 1
    return sequence, offset


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, shard_pieces: int = 40_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of ``docs`` (doc_id, text).

    A null or empty text is the end id alone. Repeated rows are packed each for itself; null ids pass
    through; an empty table gives no rows; other columns are ignored. ``tokenizer`` is the path of a
    tokenizers file on every worker whose words are separated by white space.
    """
    pieces = checkpointed(cut_pieces(docs, tokenizer, size, end_id))
    shards = max(1, -(-pieces.count() // shard_pieces))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = pack(group["length"].to_numpy(), size)
        return group.drop(columns="shard").assign(sequence_id=(int(key[0]) << 40) + sequence, offset=offset)

    number = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id", "piece", "ids_crc32"))
    shard = F.pmod(number, F.lit(shards))
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(run, PACKED)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of ``docs``."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
