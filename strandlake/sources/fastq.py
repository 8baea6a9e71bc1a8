"""FASTQ as a data source of byte ranges: each range finds the first record that begins in it by itself.

A header is told from a quality line that begins with `@` by the line two further on, which begins
with `+` after a header and can't after a quality line. A range reads the records that begin in it
to their ends, and checks that the next range would go on right there, so lines between
records fail the task. Rows keep the file's order and are never shuffled.

Files are opened where they are read, through pyarrow's file systems (local, HDFS, S3, GCS), by
absolute path or URI. A packed file (.gz) is one range.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and rows of a batch.
SPLIT, ROWS = 64 << 20, 8192
ONE = "record long, id string, seq string, qual string"
TWO = "record long, id string, seq1 string, qual1 string, seq2 string, qual2 string"
COUNTS = "path string, start long, end long, records long"


@dataclass
class Range(InputPartition):
    """A stretch of a file; number is that of its first record, and other the ranges of the mates' file from the one that holds it on."""

    path: str
    start: int
    end: int
    number: int = 0
    records: int = -1
    other: tuple[tuple[str, int, int], ...] = ()
    skip: int = 0


def _files(path: str) -> list[tuple[str, int]]:
    """The file, or the files of a folder by name without those that begin with `_` or `.`, and their sizes."""
    system, place = fs.FileSystem.from_uri(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    scheme = path[: len(path) - len(place)] if path.endswith(place) else ""
    found = [i for i in system.get_file_info(fs.FileSelector(place)) if i.type == fs.FileType.File and i.base_name[:1] not in "_."]
    return sorted((scheme + i.path, i.size) for i in found)


def ranges_of(path: str, split: int) -> list[Range]:
    """Ranges of `split` bytes of all files at a path, in order."""
    out = []
    for name, size in _files(path):
        step = max(size, 1) if name.endswith(".gz") else split
        out += [Range(name, at, min(at + step, size)) for at in range(0, size, step)]
    return out


def _lines(path: str, start: int) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of the lines from the first that begins at `start` or after it."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as raw:
        if path.endswith(".gz"):
            held = gzip.open(raw)
        else:
            raw.seek(max(0, start - 1))
            held = io.BufferedReader(raw, 1 << 20)
            if start:
                start += len(held.readline()) - 1
        try:
            for line in held:
                yield start, line
                start += len(line)
        except EOFError as e:
            raise ValueError(f"bad FASTQ record: unexpected end of the packed file {path}") from e


def _from_record(lines: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """The lines from the first header on."""
    held: list[tuple[int, bytes]] = list(islice(lines, 3))
    while len(held) == 3 and not (held[0][1].startswith(b"@") and held[2][1].startswith(b"+")):
        held = held[1:] + list(islice(lines, 1))
    return chain(held, lines) if len(held) == 3 else iter(held)


def records(path: str, start: int, end: int) -> Iterator[tuple[str, str, str]]:
    """id, bases and qualities of the records that begin from `start` on and before `end`; one that is not complete or well-formed is an error."""
    lines = _lines(path, start)
    if start and not path.endswith(".gz"):
        lines = _from_record(lines)
    packed = path.endswith(".gz")
    after = None
    for at, head in lines:
        if at >= end and not packed:
            after = at if after is None else after
            break
        rest = [line.rstrip(b"\r\n") for _, line in islice(lines, 3)]
        if len(rest) < 3 or not head.startswith(b"@") or not rest[1].startswith(b"+") or len(rest[0]) != len(rest[2]):
            raise ValueError(f"bad FASTQ record at byte {at} of {path}")
        after = -1
        yield head[1:].rstrip(b"\r\n").decode(), rest[0].decode(), rest[2].decode()
    else:
        return
    if after is not None and not packed:  # records were read: the next range must begin where they end
        following = next(_from_record(_lines(path, end)), (None, b""))[0]
        if following != at:
            raise ValueError(f"bad FASTQ record at byte {at} of {path}")


def _batches(rows: Iterator[tuple], names: list[str], first: int) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(range(first, first + len(some)), pa.int64()), *[pa.array(c, pa.string()) for c in zip(*some)]], names=names)
        first += len(some)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.mode, self.path = options.get("mode", "one"), options["path"]
        self.split, self.plan = int(options.get("split", SPLIT)), options.get("plan")

    def partitions(self) -> list[Range]:
        if self.plan:
            return [Range(*r[:5], tuple(map(tuple, r[5])), r[6]) for r in json.loads(self.plan)]
        return ranges_of(self.path, self.split) or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator:
        mine = records(part.path, part.start, part.end) if part.path else iter(())
        if self.mode == "count":
            yield part.path, part.start, part.end, sum(1 for _ in mine)
        elif self.mode == "pair":
            mates = islice(chain.from_iterable(records(*r) for r in part.other), part.skip, part.skip + part.records)
            both = ((name, *one, *two[1:]) for (name, *one), two in zip(mine, mates, strict=True))
            yield from _batches(both, [f.split()[0] for f in TWO.split(", ")], part.number)
        else:
            yield from _batches(mine, [f.split()[0] for f in ONE.split(", ")], part.number)


class FastqSource(DataSource):
    """spark.read.format("fastq").load(path); options: split (bytes), mode (one, count or pair), plan (ranges with numbers, as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return {"count": COUNTS, "pair": TWO}.get(self.options.get("mode", "one"), ONE)

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def _load(spark: SparkSession, path: str, mode: str, split: int, plan: list[Range] | None = None) -> DataFrame:
    spark.dataSource.register(FastqSource)
    held = spark.read.format("fastq").option("mode", mode).option("split", split)
    if plan is not None:
        held = held.option("plan", json.dumps([[p.path, p.start, p.end, p.number, p.records, p.other, p.skip] for p in plan]))
    return held.load(path)


def counted(spark: SparkSession, path: str, split: int = SPLIT) -> list[Range]:
    """The ranges of a path in order, with how many records each has and the number of its first, from 0. One row a range reaches the driver."""
    found = {(r["path"], r["start"]): r["records"] for r in _load(spark, path, "count", split).collect()}
    out, total = [], 0
    for r in ranges_of(path, split):
        n = found[(r.path, r.start)]
        out.append(Range(r.path, r.start, r.end, total, n))
        total += n
    return out


def read_fastq(spark: SparkSession, path: str, split: int = SPLIT, numbered: bool = True) -> DataFrame:
    """record, id, seq, qual of a file or folder, without a shuffle, the same rows for any split.

    record counts from 0 over all files, which takes a first pass that counts; without `numbered` there is one
    pass, and record counts within each range. A record that is not complete or well-formed fails the task.
    """
    plan = (counted(spark, path, split) or [Range("", 0, 0)]) if numbered else None
    return _load(spark, path, "one", split, plan)


def read_mates(spark: SparkSession, path1: str, path2: str, split: int = SPLIT) -> DataFrame:
    """record, id (of the first mate), seq1, qual1, seq2, qual2: records of two files side by side, without a shuffle.

    Both files' ranges are counted first; each range of the first is then read beside the ranges of
    the second that hold records of the same numbers. Files of different length are an error.
    """
    one, two = counted(spark, path1, split), counted(spark, path2, split)
    if sum(r.records for r in one) != sum(r.records for r in two):
        raise ValueError("mate files differ in length")
    plan, at = [], 0
    for r in one:
        if not r.records:
            continue
        while two[at].number + two[at].records <= r.number:
            at += 1
        last = at
        while two[last].number + two[last].records < r.number + r.records:
            last += 1
        other = tuple((t.path, t.start, t.end) for t in two[at : last + 1])
        plan.append(Range(r.path, r.start, r.end, r.number, r.records, other, r.number - two[at].number))
    return _load(spark, path1, "pair", split, plan or [Range("", 0, 0)])
