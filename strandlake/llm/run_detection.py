"""Periodic runs of words, by Main and Lorentz's divide and conquer.

A run is a stretch of consecutive words with smallest period q, at least max(SHORTEST,
2 q) words long, that no neighbouring word extends. Words are interned as numbers, exactly, per text. The
recursion halves a stretch; at each midpoint Z-functions tell, for every period q, how
far the words left and right of it go on agreeing at distance q, so all repetitions that
cross the midpoint come out in linear time. A multiple of a period already found over
the same words is dropped, as is a repetition that goes on beyond the stretch (the
recursion meets it again, whole, further up), and what remains is collected as a set.

Only words inside repeated windows of WINDOW words can belong to a run: its words agree at distance
q over SHORTEST / 2 places or more, which gives each of them two such windows. So the recursion is
started on the stretches that repeated windows cover, found by counting hashed windows; a
collision only makes a stretch longer. Each text is worked by itself in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm._runtime import text_of

#: Fewest words of a run.
SHORTEST = 12
#: Words of a window; a run's words at one distance agree over SHORTEST / 2 or more.
WINDOW = SHORTEST // 2
#: Bytes of text handed back from one Arrow batch to the next.
SLICE = 16 << 20

FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def z_function(s: list[int]) -> list[int]:
    """For each place, how many elements from there on equal the list's beginning; the list's length at 0."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k > right - i:
                k = right - i
            elif k < right - i:
                z[i] = k
                continue
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _crossing(s: list[int], low: int, mid: int, high: int) -> Iterator[tuple[int, int, int]]:
    """start, end, period of the repetitions of s[low:high] that touch mid, smallest periods only, of SHORTEST elements or more."""
    left, right = s[low:mid][::-1], s[mid:high]
    back, ahead = z_function(left), z_function(right)
    n, m = len(left), len(right)
    # beyond the midpoint: right's beginning against what is left of it, and the mirror image
    onto_left = z_function([*right, -1, *left[::-1]])
    onto_right = z_function([*left, -1, *right[::-1]])
    found: list[tuple[int, int, int]] = []

    def taken(start: int, end: int, q: int) -> bool:
        if end - start < 2 * q or any(q % p == 0 and a <= start and end <= b for a, b, p in found):
            return False
        found.append((start, end, q))
        return True

    for q in range(1, max(n, m) + 1):
        if q <= n:  # s[mid - q] and s[mid] are a period apart
            behind = back[q] if q < n else 0
            after = onto_left[m + 1 + n - q]
            if after >= q:
                after = q + (ahead[q] if q < m else 0)
            if behind + after >= q and taken(mid - q - behind, mid + after, q):
                yield found[-1]
        if q <= m:  # s[mid] and s[mid + q]
            after = ahead[q] if q < m else 0
            behind = onto_right[n + 1 + m - q]
            if behind >= q:
                behind = q + (back[q] if q < n else 0)
            if behind + after >= q and taken(mid - behind, mid + q + after, q):
                yield found[-1]


def runs_of(s: list[int]) -> set[tuple[int, int, int]]:
    """start, end, period of all runs of a list of numbers from 0 on."""
    n, found, todo = len(s), set(), [(0, len(s))]
    while todo:
        low, high = todo.pop()
        if high - low < SHORTEST:
            continue
        mid = (low + high) // 2
        todo += [(low, mid), (mid, high)]
        for a, b, q in _crossing(s, low, mid, high):
            goes_on = (a == low and a > 0 and s[a - 1] == s[a - 1 + q]) or (b == high and b < n and s[b] == s[b - q])
            if b - a >= SHORTEST and not goes_on:
                found.add((a, b, q))
    return found


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the maximal stretches of SHORTEST words or more that windows seen twice cover; may name more than that."""
    n = len(ids) - WINDOW + 1
    if n <= WINDOW:
        return []
    hashed = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64) + np.uint64(1)
        hashed ^= hashed >> np.uint64(29)
    bits = max(10, int(n).bit_length() + 3)
    slot = ((hashed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > WINDOW)  # a next window that begins later than the last one ends
    lows, highs = starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]] + WINDOW
    return [(int(a), int(b)) for a, b in zip(lows, highs) if b - a >= SHORTEST]


def word_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """start, end, period of every run of the words, sorted by start, then period."""
    if len(words) < SHORTEST:
        return []
    names: dict[bytes, int] = {}
    ids = [names.setdefault(w, len(names)) for w in words]
    if len(names) == len(words):
        return []
    found = [(a + low, b + low, q) for low, high in stretches(np.array(ids)) for a, b, q in runs_of(ids[low:high])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for a, b, q in runs:
        change[a + q] += 1
        change[b] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _row(text: bytes, with_text: bool) -> tuple:
    words = text.split()  # bytes are split at space and 0x09-0x0D
    runs = word_runs(words)
    kept = b" ".join(collapsed(words, runs))
    said = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    top = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    first = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    row = (len(runs), *first, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    return (*row, [{"start": a, "length": b - a, "period": q} for a, b, q in runs], kept.decode()) if with_text else row


def detect_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row for each row of docs: row_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    With with_text also runs, all of them as an array of (start, length, period) by start and
    period, and collapsed, the text without the words that a run repeats, joined by one
    space. Of equally long runs the first, then the one of the smallest period counts as the longest.
    Texts that are null, empty or shorter than SHORTEST words have no run: the four columns of
    the longest are null, both digests those of what is there. Repeated rows and null ids
    each have their row; an empty table has none. Other columns aren't read.
    """
    wide = ", runs array<struct<start: long, length: long, period: long>>, collapsed string" if with_text else ""
    held = docs.select(F.col(id_col).alias("row_id"), text_of(F.col(text_col)).alias("text"))
    fields = f"row_id {held.schema['row_id'].dataType.simpleString()}, {FIELDS}{wide}"
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + ([pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])), pa.string()] if with_text else [])
    names = [f.split()[0] for f in FIELDS.split(", ")] + (["runs", "collapsed"] if with_text else [])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, size = [], 0, 0
            texts = batch.column("text").cast(pa.binary())
            for i in range(len(texts)):
                text = texts[i].as_py()
                rows.append(_row(text, with_text))
                size += len(text)
                if size > SLICE or i == len(texts) - 1:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column("row_id").slice(first, len(rows)), *columns], names=["row_id", *names])
                    rows, first, size = [], i + 1, 0

    return held.mapInArrow(work, fields)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, where the texts of a tenth of the ids, by their crc32, end in words that repeat; a null id or text stays as it is.

    Of a text of n words, with h the unsigned crc32 of the id in decimal, h % 10 = 0 and g = h // 10: word i from
    a = g % n on becomes word a + (i - a) % p, where p = 1 + (n - a) // (3 + g % 8).
    """
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " "))

    planted = F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0])
    return docs.withColumn(text_col, F.coalesce(planted, F.col(text_col)))
