"""An FM-index over runs of word numbers: wavelet matrix, backward search and sampled positions.

A text is a sequence of symbols; 0 ends a run, and no phrase holds it. Ends of runs are told apart by
their place, so suffixes are sorted no further than to the end of their run.
"""

from __future__ import annotations

import numpy as np

#: Every so many places of a text, and each first one of a run, the index keeps the place of the suffix.
SAMPLED = 16
_ONE = np.uint64(1)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of ``text``, which ends with 0, by the order of the suffixes that start there.

    Prefix doubling: only suffixes that are still tied are sorted again.
    """
    n = len(text)
    stops = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(stops)
    key[stops] = np.arange(len(stops))
    order = np.argsort(key, kind="stable")
    rank, slots, k = np.zeros(n, np.int64), np.arange(n), 1
    places, key = order, key[order]
    while len(places):
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[first, len(key)])
        order[slots] = places
        rank[places] = np.repeat(slots[first], sizes)
        tied = np.repeat(sizes > 1, sizes)
        places, slots = places[tied], slots[tied]
        key = rank[places] * n + rank[np.minimum(places + k, n - 1)]
        again = np.argsort(key, kind="stable")
        places, key, k = places[again], key[again], 2 * k
    return order


class Wavelet:
    """Ranks in a sequence of numbers below ``2 ** levels``, level by level from the highest bit."""

    def __init__(self, values: np.ndarray, levels: int):
        self.words, self.before, self.zeros = [], [], []
        self.levels = list(range(levels - 1, -1, -1))
        for level in self.levels:
            bits = (values >> level) & 1 == 1
            padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
            packed = np.packbits(bits, bitorder="little")
            padded[: len(packed)] = packed
            words = padded.view("<u8")
            self.words.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[~bits], values[bits]])
        first = np.zeros(1 << levels, np.int64)
        self.first = first
        self.first = self._down(np.arange(1 << levels), first)

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[k][word] + np.bitwise_count(self.words[k][word] & ((_ONE << bit) - _ONE))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(self.levels):
            ones = self._ones(k, at)
            at = np.where((symbols >> level) & 1 == 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each of ``symbols`` stands before the place ``at`` beside it."""
        return self._down(symbols, at) - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places ``at``, and how often each stands before its place."""
        symbols = np.zeros(len(at), np.int64)
        for k, level in enumerate(self.levels):
            ones = self._ones(k, at)
            bit = (self.words[k][at >> 6] >> (at & 63).astype(np.uint64)) & _ONE == 1
            symbols |= bit.astype(np.int64) << level
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return symbols, at - self.first[symbols]


class FMIndex:
    """``search`` finds the rows whose suffixes start with a phrase, ``locate`` their places."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        last = np.where(order > 0, text[order - 1], 0)
        self.wavelet = Wavelet(last.astype(np.int64), max(1, int(symbols - 1).bit_length()))
        self.starts = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        kept = (last == 0) | (order % SAMPLED == 0)
        self.marks, self.places = Wavelet(kept.astype(np.int64), 1), order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each phrase: ``phrases`` has a row for each, of so many symbols as ``lengths`` says."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1] if len(phrases) else 0):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            c = phrases[live, lengths[live] - 1 - step].astype(np.int64)
            low[live] = self.starts[c] + self.wavelet.rank(c, low[live])
            high[live] = self.starts[c] + self.wavelet.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place of each row's suffix: back from it to the next sampled one."""
        found = np.zeros(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            kept, nth = self.marks.access(rows)
            done = kept == 1
            found[live[done]] = self.places[nth[done]] + steps
            live, rows, steps = live[~done], rows[~done], steps + 1
            c, before = self.wavelet.access(rows)
            rows = self.starts[c] + before
        return found
