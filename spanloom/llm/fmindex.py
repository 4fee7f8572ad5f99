"""A compressed full-text index over word codes: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with counts before each word: rank in constant time."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ones come before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """A sequence of codes by bit levels, highest first; ranks of any code take one step a level."""

    def __init__(self, codes: np.ndarray) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(codes.max(initial=0)).bit_length()) - 1, -1, -1):
            ones = (codes >> shift) & 1 == 1
            self.levels.append((shift, Bits(ones), int(len(codes) - ones.sum())))
            codes = np.concatenate([codes[~ones], codes[ones]])
        every = np.arange(1 << len(self.levels), dtype=np.int64)
        self.bottom = self._down(every, np.zeros_like(every))

    def _down(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where places of the sequence come to lie on the lowest level, if each ``code`` leads the way."""
        for shift, bits, zeros in self.levels:
            ranked = bits.rank(at)
            at = np.where((code >> shift) & 1 == 1, zeros + ranked, at - ranked)
        return at

    def narrow(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each ``code`` starts on the lowest level, and how many of it come before ``low`` and ``high``."""
        first, ends = self.bottom[code], self._down(np.concatenate([code, code]), np.concatenate([low, high]))
        return first, ends[: len(low)] - first, ends[len(low) :] - first


class FMIndex:
    """Index of texts of word codes (1 and up; 0 ends a text), for searches of ``depth`` words.

    Suffixes are sorted by their first ``depth`` words, which is as far as any search
    looks. Intervals of suffixes that share their
    first ``depth`` words are marked, so a search can let go of its last word.
    """

    def __init__(self, codes: np.ndarray, depth: int) -> None:
        self.depth, n = depth, len(codes)
        ranks, length = {1: codes}, 1
        while 2 * length <= depth:
            ranks[2 * length] = self._joined(ranks[length], ranks[length], length)
            length *= 2
        same, covered = ranks[length], length
        for part in sorted(ranks, reverse=True):
            if part <= depth - covered:
                same = self._joined(same, ranks[part], covered)
                covered += part
        self.order = np.argsort(same, kind="stable")
        self.matrix = WaveletMatrix(codes[self.order - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=int(codes.max(initial=0)) + 1))])
        shared = same[self.order]
        self.starts = np.flatnonzero(np.concatenate([[True], shared[1:] != shared[:-1]]))
        marked = np.zeros(n, dtype=bool)
        marked[self.starts] = True
        self.marks = Bits(marked)
        self.stops = np.append(self.starts[1:], n)

    @staticmethod
    def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        """Ranks of pairs: each place's rank and the rank ``shift`` places on (none: 0)."""
        ahead = np.zeros(len(left), dtype=np.int64)
        if shift < len(left):
            ahead[: len(left) - shift] = right[shift:] + 1
        return np.unique(left * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1].astype(np.int64)

    def groups(self, values: np.ndarray) -> np.ndarray:
        """The least of ``values`` (by place in the text) for each marked interval."""
        return np.minimum.reduceat(values[self.order], self.starts)

    def extend(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of the searched words with ``code`` before them."""
        known = code < len(self.first) - 1
        safe = np.where(known, code, 0)
        _, to_low, to_high = self.matrix.narrow(safe, low, high)
        return self.first[safe] + to_low, np.where(known, self.first[safe] + to_high, 0)

    def stream(self, codes: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of all texts at once, right to left, above ``depth`` words.

        ``codes`` holds the texts, which end at ``ends``. A text's search is extended
        by the word before it; from ``depth`` words on, the marked interval around it
        lets go of the last word, so a text costs one step a word as long as it goes
        on matching. Where it breaks off, no window holds the words that it would have
        matched, so it begins again one word before their end, and is over once
        fewer than ``depth`` words are left. Returns where windows of ``depth`` words
        start that the index holds, and the marked interval of each.
        """
        live = np.flatnonzero(lengths >= self.depth)
        begin, stop = (ends - lengths)[live], ends[live].copy()
        place, low, high = stop.copy(), np.zeros(len(live), dtype=np.int64), np.full(len(live), len(self.order), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(place):
            low, high = self.extend(codes[place - 1], low, high)
            broken = low >= high
            place = place - ~broken
            full = np.flatnonzero(~broken & (stop - place >= self.depth))
            if len(full):
                group = self.marks.rank(low[full] + 1) - 1
                low[full], high[full] = self.starts[group], self.stops[group]
                found.append((place[full], group))
            stop = np.where(broken, np.minimum(stop, place + self.depth) - 1, stop)
            place, low, high = np.where(broken, stop, place), np.where(broken, 0, low), np.where(broken, len(self.order), high)
            left = (place > begin) & (stop - begin >= self.depth)
            begin, stop, place, low, high = (x[left] for x in (begin, stop, place, low, high))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *(a for a, _ in found)]), np.concatenate([none, *(g for _, g in found)])
