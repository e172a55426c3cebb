"""Words and n-grams of whole texts as arrays of 64-bit hashes.

Texts come as Arrow binary columns and are worked on as arrays of bytes, in
runs of rows; a long text is cut between words, so a task's memory doesn't
grow with the longest text. A word's hash is a polynomial over random values
of its bytes, taken from prefix sums, so no word becomes an object. Words
are told apart by it: two of n different ones meet with probability about
n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

RUN_BYTES = 2 << 20  # of texts that are cut into words at a time
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(a, b):
    """One 64-bit hash of two (arrays, or an array and a number)."""
    with np.errstate(over="ignore"):
        x = (np.asarray(a, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.asarray(b, np.uint64) + np.uint64(0x632BE59BD9B4E019))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def part_of(hashes, parts: int) -> np.ndarray:
    """The hash range (0 to parts - 1) that a hash lies in; rises with the hash."""
    return ((np.asarray(hashes, np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def summed(keys: np.ndarray, counts: np.ndarray):
    """(different keys in order, the sums of their counts)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def runs(raw: bytes, gap, most: int = 1 << 20) -> Iterator[bytes]:
    """``raw`` in runs of about ``most`` bytes, cut before a byte that ``gap`` matches."""
    at = 0
    while len(raw) - at > most:
        cut = gap.search(raw, at + most)
        if cut is None:
            break
        yield raw[at:cut.start()]
        at = cut.start()
    yield raw[at:]


@dataclass
class Run:
    """Words of consecutive rows of a column, or of a part of a long one."""
    first: int  # the first row
    rows: int
    begins: bool  # the first row's text begins here
    ends: bool  # the last row's text ends here
    data: np.ndarray  # bytes, A-Z as a-z if they count as such
    row: np.ndarray  # of each word, from 0
    starts: np.ndarray  # of each word in data
    stops: np.ndarray
    hashes: np.ndarray
    old: int = 0  # words that the run before had, too


class Cutter:
    """Cuts texts into words: the longest runs of bytes that aren't in ``gaps``.

    ``overlap`` words are repeated where a long text is cut; ``fold``: A-Z
    count as a-z.
    """

    def __init__(self, gaps: bytes, overlap: int = 0, run_bytes: int = RUN_BYTES, fold: bool = True):
        self.is_word = np.ones(256, bool)
        self.is_word[list(gaps)] = False
        self.fold = np.arange(256, dtype=np.uint8)
        if fold:
            self.fold[65:91] += 32
        self.values = mix(self.fold, 1)
        self.overlap, self.most = overlap, run_bytes
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, min(2 * n, self.most + 1))
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE, np.uint64)])
                self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(BASE, -1, 1 << 64), np.uint64)])

    def words(self, data: np.ndarray, edges: np.ndarray):
        """(starts, stops, hashes) of the words; none goes over one of the ``edges``."""
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64)
        self.grow(n)
        inside = self.is_word[data]
        before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
        edges = edges[(edges > 0) & (edges < n)]
        before[edges], after[edges - 1] = False, False
        starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum(self.values[data] * self.powers[:n], dtype=np.uint64)]
            hashes = (sums[stops] - sums[starts]) * self.inverses[starts]
        return starts, stops, mix(hashes, stops - starts)

    def run(self, data, offsets, first: int, begins: bool = True, ends: bool = True) -> Run:
        starts, stops, hashes = self.words(data, offsets[1:-1])
        row = np.searchsorted(offsets[1:], starts, "right")
        return Run(first, len(offsets) - 1, begins, ends, self.fold[data], row, starts, stops, hashes)

    def __call__(self, column) -> Iterator[Run]:
        """The runs of an Arrow binary column without nulls."""
        size = len(column)
        if not size:
            return
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int32, size + 1, column.offset * 4).astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < size:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + self.most, "right")) - 1)
            if offsets[j] - offsets[i] <= self.most:
                yield self.run(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i)
            else:
                yield from self.long(data[offsets[i]:offsets[j]], i)
            i = j

    def long(self, data: np.ndarray, row: int) -> Iterator[Run]:
        """One long text, cut before gaps."""
        at = upto = old = 0
        while upto < len(data):
            begins, upto = at == upto == 0, upto + self.most
            while upto < len(data) and self.is_word[data[upto]]:
                gap = np.flatnonzero(~self.is_word[data[upto:upto + self.most]])
                upto += int(gap[0]) if len(gap) else self.most
            upto = min(upto, len(data))
            run = self.run(data[at:upto], np.array([0, upto - at]), row, begins, upto == len(data))
            run.old = old
            yield run
            old = min(self.overlap, len(run.starts))
            at = at + int(run.starts[-old]) if old else upto
