"""Depth by tiles: an array of depths where runs are dense, runs elsewhere, and lanes added tile by tile.

A deep lane changes its depth every few positions; written as runs it then takes more room than
one number a position. Each tile takes its form by how many runs it has, and adding lanes is
one group a tile, whatever the form of each part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.coverage import merge_runs

#: Positions of a tile.
TILE = 4096
#: Fixed value: runs a position from which on depths are dense.
DENSE = 0.1

_RUN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int64())])
FIELDS = "chrom string, tile long, depths array<long>, runs array<struct<start: long, end: long, depth: long>>"


def _parts(depths: np.ndarray, first: int) -> list[dict]:
    """The runs of equal depth over 0 of the positions from `first` on."""
    cuts = np.flatnonzero(np.diff(depths)) + 1
    lows, highs = np.r_[0, cuts], np.r_[cuts, len(depths)]
    return [{"start": first + int(a), "end": first + int(b) - 1, "depth": int(depths[a])} for a, b in zip(lows, highs) if depths[a]]


def _formed(depths: np.ndarray, number: int) -> tuple[list | None, list | None]:
    runs = _parts(depths, number * TILE + 1)
    return (depths.tolist(), None) if len(runs) >= DENSE * TILE else (None, runs)


def _added(depths: np.ndarray, number: int, array: list | None, runs: list | None) -> None:
    """Add one part of a tile to its depths."""
    if array is not None:
        depths[: len(array)] += np.array(array, np.int64)
    if runs:
        change = np.zeros(TILE + 1, np.int64)
        first = number * TILE + 1
        np.add.at(change, [r["start"] - first for r in runs], [r["depth"] for r in runs])
        np.add.at(change, [r["end"] + 1 - first for r in runs], [-r["depth"] for r in runs])
        depths += np.cumsum(change[:-1])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(_RUN)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["chrom", "tile", "depths", "runs"])


def _each_formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for chrom, number, runs in zip(*(batch.column(c).to_pylist() for c in ("chrom", "tile", "runs"))):
            depths = np.zeros(TILE, np.int64)
            _added(depths, number, None, runs)
            rows.append((chrom, number, *_formed(depths, number)))
        yield _table(rows)


def tiled(runs: DataFrame) -> DataFrame:
    """chrom, tile (from 0), depths, runs: the depths of runs (chrom, start, end, depth) by tile, one of the two null.

    depths holds TILE numbers, also where the chromosome ends before; a tile without depth has no
    row. Runs may overlap and are added up; a null chromosome has no tiles, nor has a run that ends before it starts.
    """
    numbers = F.sequence(F.floor((F.col("start") - 1) / TILE), F.floor((F.col("end") - 1) / TILE))
    cut = runs.where("chrom is not null and end >= start").withColumn("tile", F.explode(numbers))
    inside = F.struct(F.greatest(F.col("start").cast("long"), F.col("tile") * TILE + 1).alias("start"), F.least(F.col("end").cast("long"), (F.col("tile") + 1) * TILE).alias("end"), F.col("depth").cast("long").alias("depth"))
    held = cut.select("chrom", "tile", inside.alias("r")).groupBy("chrom", "tile").agg(F.collect_list("r").alias("runs"))
    return held.mapInArrow(_each_formed, FIELDS)


def add_tiles(parts: DataFrame) -> DataFrame:
    """The tiles of several lanes, each of either form, added up; a tile takes the form that suits the sum."""

    def add(rows: pa.Table) -> pa.Table:
        number, depths = rows["tile"][0].as_py(), np.zeros(TILE, np.int64)
        for array, runs in zip(rows["depths"].to_pylist(), rows["runs"].to_pylist()):
            _added(depths, number, array, runs)
        return pa.Table.from_batches([_table([(rows["chrom"][0].as_py(), number, *_formed(depths, number))])])

    return parts.groupBy("chrom", "tile").applyInArrow(add, FIELDS)


def tiles_to_runs(tiles: DataFrame) -> DataFrame:
    """chrom, start, end, depth: the runs of equal depth, those that go on over tiles as one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chrom, number, array, runs in zip(*(batch.column(c).to_pylist() for c in ("chrom", "tile", "depths", "runs"))):
                rows += [(chrom, r["start"], r["end"], r["depth"]) for r in (runs if array is None else _parts(np.array(array), number * TILE + 1))]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["chrom", "start", "end", "depth"])

    return merge_runs(tiles.select("chrom", "tile", "depths", "runs").mapInArrow(cut, "chrom string, start long, end long, depth long"))


def _strand_profile(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for by, number, plus, minus in zip(*(batch.column(c).to_pylist() for c in range(4))):
            size = 1 << (2 * max(TILE, most) + most - 1).bit_length()
            a, b = np.zeros(size), np.zeros(size)
            first = number * TILE
            np.add.at(a, [p["at"] - first for p in plus or []], [p["k"] for p in plus or []])
            np.add.at(b, [p["at"] - first for p in minus or []], [p["k"] for p in minus or []])
            same = np.rint(np.fft.irfft(np.conj(np.fft.rfft(a)) * np.fft.rfft(b), size)[:most]).astype(np.int64)
            rows += [(by, lag + 1, int(same[lag])) for lag in np.flatnonzero(same)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.int64()))], names=["by", "length", "pairs"])


def correlate_strands(blocks: DataFrame, most: int = 1000, by: str = "chrom") -> DataFrame:
    """by, n, length: the shift at which the 5' ends of the two strands agree most, plus 1, for each value of `by`.

    Ends are counted by position, tile by tile; a tile's plus ends are correlated with the minus
    ends of the tile and `most` positions on, by a fast Fourier transform, and the sums of each
    shift are added over tiles. So the cost is linear in the positions, however deep they are. Of equal shifts the
    least is given; a value without any pair within `most` has no row.
    """
    five = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start")).cast("long")
    ends = blocks.where(F.col(by).isNotNull()).groupBy(F.col(by).cast("string").alias("by"), (F.col("strand") == "-").alias("minus"), five.alias("at")).agg(F.count("*").alias("k"))
    tile = F.floor(F.col("at") / TILE)
    behind = F.sequence(F.floor((F.col("at") - most + 1) / TILE), tile)  # minus ends also serve the plus ends of tiles before
    dealt = ends.withColumn("tile", F.explode(F.when(F.col("minus"), behind).otherwise(F.array(tile))))
    one = F.struct("at", "k")
    tiles = dealt.groupBy("by", "tile").agg(F.collect_list(F.when(~F.col("minus"), one)).alias("plus"), F.collect_list(F.when(F.col("minus"), one)).alias("minus")).where("size(plus) > 0 and size(minus) > 0")
    sums = tiles.mapInArrow(lambda batches: _strand_profile(batches, most), "by string, length long, pairs long").groupBy("by", "length").agg(F.sum("pairs").alias("pairs"))
    best = sums.groupBy("by").agg(F.max_by("length", F.struct("pairs", -F.col("length"))).alias("length"))
    n = blocks.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))
    return n.join(best, n[by].cast("string") == best["by"]).select(n[by], "n", "length")
