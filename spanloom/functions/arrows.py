"""Tokens of whole Arrow batches: places, kinds and dictionary numbers without a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def row_ends(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's items start and end among the flattened ones; a null row has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def list_of(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """Flattened values as rows of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def running_sums(lengths: pa.Array) -> pa.Array:
    """For each row of lengths, their running sums; null rows stay null. By stretches into one array, so that nothing else is as large as the batch."""
    values = lengths.flatten().to_numpy(zero_copy_only=False)
    sums, at = np.empty(len(values), dtype=np.int32), 0
    for _, part in in_stretches(lengths, MOST_SUMS):
        first, last = row_ends(part)
        behind = at + int(last[-1]) if len(last) else at
        total = np.concatenate([[0], np.cumsum(values[at:behind], dtype=np.int64)])
        sums[at:behind] = total[1:] - np.repeat(total[first], last - first)
        at = behind
    offsets = np.concatenate([[0], row_ends(lengths)[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums), mask=pc.is_null(lengths) if lengths.null_count else None)


#: Lengths that are added up at once.
MOST_SUMS = 1 << 17


def in_stretches(lists: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """``(first row, rows)``: rows of lists by stretches of some ``most`` items, so what Python holds doesn't grow with the batch."""
    ends = row_ends(lists)[1]
    cuts = [0, *np.flatnonzero(np.diff(ends // most)) + 1, len(lists)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a or not len(lists):
            yield a, lists.slice(a, b - a)


@dataclass(frozen=True)
class Words:
    """The tokens of a batch of texts without blanks: row of each, place in its text, and where each row's begin and end."""

    values: pa.Array
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, strings: pa.Array, blanks: bool = False) -> Words:
        """``strings``: for each text all of its tokens, so that they cover it. ``blanks``: these stay."""
        first, last = row_ends(strings)
        values = strings.flatten()
        lengths = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        row = np.repeat(np.arange(len(first)), last - first)
        base = sums[first][row] if len(row) else np.empty(0, np.int64)
        everything = cls(values, row, sums[:-1] - base, sums[1:] - base, first, last)
        if blanks:
            return everything
        blank = pc.and_not(pc.ascii_is_space(values), pc.match_substring(values, "\n")).to_numpy(zero_copy_only=False).astype(bool)
        return everything.at(np.flatnonzero(~blank))

    def at(self, kept: np.ndarray) -> Words:
        """Those of the tokens that are at these places, in order."""
        sizes = np.bincount(self.row[kept], minlength=len(self.first)) if len(kept) else np.zeros(len(self.first), np.int64)
        ends = np.cumsum(sizes)
        return Words(self.values.take(pa.array(kept)), self.row[kept], self.start[kept], self.end[kept], ends - sizes, ends)

    def within(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each span, of lists ``(start, end, …)`` side by side with the texts, the first token that lies in it and the one behind the last.

        Places are counted on from row to row, so one search finds all; a span that
        no token lies in has none.
        """
        first, last = row_ends(spans)
        row, flat = np.repeat(np.arange(len(first)), last - first), spans.flatten()
        length = np.zeros(len(self.first), dtype=np.int64)
        np.maximum.at(length, self.row, self.end)
        base = np.cumsum(length + 1) - length - 1
        start, end = (np.clip(flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64), 0, length[row]) + base[row] for k in (0, 1))
        a = np.searchsorted(self.start + base[self.row], start)
        return a, np.maximum(a, np.searchsorted(self.end + base[self.row], end, "right"))


def expanded(first: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of each stretch from ``first`` to before ``behind``, and which stretch each is of."""
    sizes = behind - first
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[of], of
