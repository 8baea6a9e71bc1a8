"""Arrow and numpy kernels over whole batches of texts; nothing here knows Spark.

A batch of texts is one buffer of UTF-8 bytes and the offsets of its documents.
Words are maximal runs of bytes other than space and 0x09-0x0D, the same as the
pattern ``[^\\x20\\x09-\\x0D]+`` on characters, since UTF-8 uses no such byte
inside a character. Buffers are worked in blocks of about BLOCK bytes, so the
memory a task needs does not depend on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U64 = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_draw = np.random.default_rng(20_240_611)
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = int(_draw.integers(1 << 60, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        _powers[:] = [np.multiply.accumulate(np.concatenate(([U64(1)], np.full(size - 1, x, U64)))) for x in (_BASE, _INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets (one more than rows, from 0) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents, each of at most `size` bytes or one document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; no word reaches over the end of a document."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[n] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), counts)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span: a polynomial from prefix sums, then mixed."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word. A document over BLOCK bytes is read piece by piece."""
    if len(data) <= 2 * BLOCK:
        starts, ends, doc = word_spans(data, offsets)
        return span_hashes(data, starts, ends), doc
    hashes, docs = [], []
    for i in range(len(offsets) - 1):
        at, stop = int(offsets[i]), int(offsets[i + 1])
        while at < stop:
            end = min(stop, at + BLOCK)
            while end < stop and not IS_SPACE[data[end]]:  # a word stays in one piece
                end += 1
            piece = data[at:end]
            starts, ends, _ = word_spans(piece, np.array([0, len(piece)]))
            hashes.append(span_hashes(piece, starts, ends))
            docs.append(np.full(len(starts), i))
            at = end
    return (np.concatenate(hashes), np.concatenate(docs)) if hashes else (np.zeros(0, U64), np.zeros(0, np.int64))


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `words` words, sorted by document and value, with their documents.

    A document of fewer words (but at least one) has its whole sequence as its one shingle.
    """
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    n = max(0, len(hashes) - words + 1)

    def joined(at: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(at), length, U64)
        for j in range(length):
            out = mix(out * U64(0x9E3779B97F4A7C15) + hashes[at + j])
        return out

    at = np.arange(n)
    at = at[doc[:n] == doc[words - 1 : words - 1 + n]]
    values, owner = [joined(at, words)], [doc[at]]
    for length in range(1, words):
        short = np.flatnonzero(counts == length)
        if len(short):
            values.append(joined(first[short], length))
            owner.append(short)
    value, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]
