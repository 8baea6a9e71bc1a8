"""Kernel of pileups: the bases of a batch of alignments as flat arrays, counted by place.

A task holds sorted keys of (chromosome, place, base) with their counts, at most HELD of them; beyond that they
are given out and counting starts anew, so memory is bounded and what leaves a task is counted already.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bases counted together, keys that a task holds, and chromosomes it has numbers for.
STEP, HELD, NAMES = 1 << 20, 1 << 21, 1 << 14
#: Places are kept with this added, so that none is negative.
_SHIFT = 1 << 39
_OPS = re.compile(r"(\d+)([MIDNSHPX=])")
_LETTERS = pa.array(["", *(chr(i) for i in range(1, 128)), *[None] * 128], pa.string())


def steps(cigar: str) -> tuple[list[tuple[int, int, int]], list[tuple[str, int, int, int]]]:
    """Runs of aligned bases as (read, ref, size), and insertions and deletions as (kind, read, ref, size), from 0."""
    runs, indels, read, ref = [], [], 0, 0
    for n, kind in _OPS.findall(cigar):
        size = int(n)
        if kind in "M=X":
            runs.append((read, ref, size))
        elif kind in "ID":
            indels.append((kind, read, ref, size))
        read += size * (kind in "MIS=X")
        ref += size * (kind in "MDN=X")
    return runs, indels


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, with a zero behind them, and the offsets of its rows."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(1, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return np.append(held, np.uint8(0)), at - at[0]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _letters(data: np.ndarray, first: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of runs of a size from `first` on; zeros from `end` on, where a row's text is over."""
    at = np.repeat(first - _starts(sizes), sizes) + np.arange(sizes.sum())
    if (first + sizes <= end).all():
        return data[at]
    return data[np.where(at < np.repeat(end, sizes), at, len(data) - 1)]


class Tally:
    """Counts of a task by (chromosome, place, base)."""

    def __init__(self, least: int, offset: int, indels: bool):
        self.least, self.offset, self.indels = least, offset, indels
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.others: Counter = Counter()

    def _settle(self) -> None:
        if not self.waiting:
            return
        new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting = []
        keys, counts = np.concatenate([self.keys, new]), np.concatenate([self.counts, n])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts

    def full(self) -> bool:
        if sum(map(len, self.waiting)) >= HELD:
            self._settle()
        return len(self.keys) >= HELD or len(self.others) >= HELD // 8 or len(self.numbers) >= NAMES

    def taken(self) -> Iterator[pa.RecordBatch]:
        """What is held, in batches, after which nothing is."""
        self._settle()
        names, others = pa.array(list(self.numbers), pa.string()), list(self.others.items())
        fields = ["chrom", "pos", "base", "n"]
        for a in range(0, len(self.keys), 1 << 16):
            keys = self.keys[a : a + (1 << 16)]
            place = ((keys >> 8) & ((1 << 40) - 1)) - _SHIFT
            yield pa.RecordBatch.from_arrays([names.take(pa.array(keys >> 48)), pa.array(place), _LETTERS.take(pa.array(keys & 255)), pa.array(self.counts[a : a + (1 << 16)])], names=fields)
        for a in range(0, len(others), 1 << 14):
            some = others[a : a + (1 << 14)]
            columns = [pa.array([k[i] for k, _ in some], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in some], pa.int64())], names=fields)
        self._clear()

    def add(self, chrom: pa.Array, pos: pa.Array, cigar: pa.Array, seq: pa.Array, qual: pa.Array) -> None:
        """Count the rows of a batch; only seq may be null, and then has no bases."""
        words = cigar.dictionary_encode()
        told = [steps(c) for c in words.dictionary.to_pylist()]
        code, has_seq = words.indices.to_numpy(), seq.is_valid().to_numpy(zero_copy_only=False)
        place = pos.to_numpy()
        self._add_runs(chrom, place, [r for r, _ in told], code, has_seq, _flat(seq), _flat(qual))
        if self.indels:
            odd = np.array([bool(i) for _, i in told], bool)
            rows = np.flatnonzero(odd[code]) if len(odd) else []
            if len(rows):
                at = pa.array(rows)
                for r, c, s, q in zip(rows, *(x.take(at).to_pylist() for x in (chrom, seq, qual))):
                    self._add_indels(c, int(place[r]), s, q, told[code[r]][1])

    def _add_runs(self, chrom, place, runs, code, has_seq, seq, qual) -> None:
        n_runs = np.array([len(r) for r in runs], np.int64)
        table = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
        names = chrom.dictionary_encode()
        number = np.array([self.numbers.setdefault(c, len(self.numbers)) for c in names.dictionary.to_pylist()], np.int64)
        high = (number[names.indices.to_numpy()] << 48) if len(number) else np.zeros(0, np.int64)
        per_row = np.where(has_seq, n_runs[code], 0) if len(n_runs) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(code)), per_row)
        which = np.repeat(_starts(n_runs)[code] - _starts(per_row), per_row) + np.arange(len(row)) if len(row) else row
        read, ref, size = table[which].T
        bounds = np.searchsorted(np.cumsum(size), np.arange(STEP, size.sum() + STEP, STEP))
        first = 0
        for last in np.unique(np.minimum(bounds + 1, len(row))):
            one = slice(first, last)
            self._add_slice(row[one], read[one], ref[one], size[one], high, place, seq, qual)
            first = last

    def _add_slice(self, row, read, ref, size, high, place, seq, qual) -> None:
        quality = _letters(qual[0], qual[1][row] + read, qual[1][row + 1], size).astype(np.int16) - self.offset
        good = quality >= self.least
        letters = _letters(seq[0], seq[1][row] + read, seq[1][row + 1], size)[good]
        begin = high[row] + ((place[row] + ref + _SHIFT) << 8)
        key = np.repeat(begin - (_starts(size) << 8), size) + (np.arange(size.sum()) << 8)
        self.waiting.append(key[good] + letters)

    def _add_indels(self, chrom: str, pos: int, seq: str | None, qual: str, indels: list[tuple[str, int, int, int]]) -> None:
        for kind, read, ref, size in indels:
            before = ord(qual[read - 1]) if 0 < read <= len(qual) else 0
            if not read or before - self.offset < self.least:
                continue
            if kind == "D":
                self.others[chrom, pos + ref, f"-{size}"] += 1
            elif seq is not None:
                self.others[chrom, pos + ref - 1, "+" + seq[read : read + size]] += 1


def count_bases(least: int, offset: int, indels: bool):
    """A function over Arrow batches (chrom, pos long, cigar, seq, qual) that gives chrom, pos, base, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(least, offset, indels)
        for batch in batches:
            tally.add(*(batch.column(i) for i in range(5)))
            if tally.full():
                yield from tally.taken()
        yield from tally.taken()

    return run
