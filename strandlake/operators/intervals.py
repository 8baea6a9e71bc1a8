"""Interval algebra and the interval-overlap join. Intervals are closed and start at 1."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a tile: running sums are taken within tiles, so a chromosome is not one task.
TILE = 1 << 20
#: Base bin of the overlap join, and how many bins an interval may cover before it is binned coarser.
BIN, SPREAD = 256, 64


def _events(ranges: DataFrame, keys: list[str], weights: dict[str, Column]) -> DataFrame:
    """keys, at, and for each weight what it changes there: added at a start, taken back after an end. Ranges that end before they start are none."""
    held = ranges.where("end >= start").select(*keys, *[w.alias(f"w_{n}") for n, w in weights.items()], F.explode(F.array(F.struct(F.col("start").cast("long").alias("at"), F.lit(1).cast("long").alias("sign")), F.struct((F.col("end").cast("long") + 1).alias("at"), F.lit(-1).cast("long").alias("sign")))).alias("e"))
    return held.groupBy(*keys, F.col("e.at").alias("at")).agg(*[F.sum(F.col(f"w_{n}") * F.col("e.sign")).alias(n) for n in weights])


def running(events: DataFrame, keys: list[str], names: list[str], tile: int = TILE) -> DataFrame:
    """events (one row a key and place `at`) with `next`, the key's next place, and each name's running sum `sum_name`.

    Both are found within tiles, and carried over from tile to tile on one row a tile. One
    exchange by tile serves the sums within tiles and the tiles' totals.
    """
    dealt = events.withColumn("tile", F.floor(F.col("at") / tile))
    # null keys meet nothing below; without them here both uses have the same filters, and so the same exchange
    dealt = dealt.where(reduce(and_, [F.col(c).isNotNull() for c in (*keys, "tile")])).repartition(*keys, "tile")
    in_tile = Window.partitionBy(*keys, "tile").orderBy("at")
    over_tiles = Window.partitionBy(*keys).orderBy("tile")
    tiles = dealt.groupBy(*keys, "tile").agg(F.min("at").alias("first"), *[F.sum(n).alias(n) for n in names])
    tiles = tiles.select(*keys, "tile", F.lead("first").over(over_tiles).alias("next_tile"), *[(F.sum(n).over(over_tiles) - F.col(n)).alias(f"before_{n}") for n in names])
    run = dealt.withColumns({"in_tile": F.lead("at").over(in_tile), **{f"sum_{n}": F.sum(n).over(in_tile) for n in names}})
    met = run.join(tiles, [*keys, "tile"])
    return met.select(*[c for c in events.columns], F.coalesce("in_tile", "next_tile").alias("next"), *[(F.col(f"sum_{n}") + F.col(f"before_{n}")).alias(f"sum_{n}") for n in names])


def _any(test, names: list[str]) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | test(n)
    return out


def sweep(ranges: DataFrame, keys: list[str], weights: dict[str, Column] | None = None, tile: int = TILE, cut: bool = False) -> DataFrame:
    """keys, start, end and a running sum for each weight: maximal pieces between places where a sum changes.

    Without weights the sum is `depth`. Pieces where every sum is 0 are left out; neighbouring
    pieces differ in a sum, unless `cut` asks for a piece between any two edges of ranges. Each
    range adds its weight at its start and takes it back after its end. Sums are taken within
    tiles and the tiles' totals carried over, a row for each tile.
    """
    weights = weights or {"depth": F.lit(1)}
    names = list(weights)
    events = _events(ranges, keys, weights)
    if not cut:
        events = events.where(_any(lambda n: F.col(n) != 0, names))
    run = running(events, keys, names, tile).select(*keys, F.col("at").alias("start"), (F.col("next") - 1).alias("end"), *[F.col(f"sum_{n}").alias(n) for n in names])
    return run.where(_any(lambda n: F.col(n) != 0, names) & F.col("end").isNotNull())


def _stretches(ranges: DataFrame, keys: list[str], weights: dict[str, Column], test, tile: int = TILE) -> DataFrame:
    """keys, start, end: the maximal stretches of positions on which test(sum by name) holds. It must not hold on sums of 0."""
    names = list(weights)
    events = _events(ranges, keys, weights).where(_any(lambda n: F.col(n) != 0, names))
    run = running(events, keys, names, tile)
    now, was = test(lambda n: F.col(f"sum_{n}")), test(lambda n: F.col(f"sum_{n}") - F.col(n))
    turns = run.select(*keys, "at", now.alias("now"), was.alias("was")).where("now != was")
    ends = running(turns.select(*keys, "at", "now"), keys, [], tile)
    return ends.where("now").select(*keys, F.col("at").alias("start"), (F.col("next") - 1).alias("end"))


def merge_adjacent(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end: overlapping and adjacent ranges joined, for each key. A key's ranges spread over its tiles."""
    return _stretches(ranges, keys, {"depth": F.lit(1)}, lambda total: total("depth") > 0)


def span(ranges: DataFrame, keys: list[str]) -> DataFrame:
    return ranges.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"))


def disjoin(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end, depth: the covered stretches, parted at every start and after every end."""
    return sweep(ranges, keys, cut=True)


def _two(a: DataFrame, b: DataFrame, keys: list[str], test) -> DataFrame:
    tagged = a.select(*keys, "start", "end", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(*keys, "start", "end", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return _stretches(tagged, keys, {"in_a": F.col("a"), "in_b": F.col("b")}, test)


def set_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """What a covers and b does not, for each key."""
    return _two(a, b, keys, lambda total: (total("in_a") > 0) & (total("in_b") == 0))


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """What both cover, for each key."""
    return _two(a, b, keys, lambda total: (total("in_a") > 0) & (total("in_b") > 0))


def gaps(ranges: DataFrame, keys: list[str], lengths: DataFrame, length_key: str = "chrom") -> DataFrame:
    """keys, start, end: what is not covered from 1 to the chromosome's length, for each key that has ranges."""
    whole = ranges.select(*keys).distinct().join(lengths.select(length_key, F.lit(1).alias("start"), F.col("length").alias("end")), length_key)
    return set_difference(whole, ranges, keys)


def is_disjoint(ranges: DataFrame, keys: list[str]) -> bool:
    """Whether no two ranges of a key share a position."""
    return not sweep(ranges, keys).where("depth > 1").take(1)


def is_within(inner: DataFrame, outer: DataFrame, keys: list[str]) -> bool:
    """Whether every position of the inner ranges is covered by the outer ones."""
    return not set_difference(inner, outer, keys).take(1)


def disjoint_row(ranges: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row with is_disjoint, to be had without an action."""
    return sweep(ranges, keys).agg((F.coalesce(F.max("depth"), F.lit(0)) <= 1).alias(name))


def within_row(inner: DataFrame, outer: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row with is_within, to be had without an action."""
    return set_difference(inner, outer, keys).agg((F.count("*") == 0).alias(name))


def tiles(lengths: DataFrame, width: int) -> DataFrame:
    """chrom, start, end: each chromosome cut into tiles of a width, the last one shorter."""
    cut = lengths.select("chrom", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("length").cast("long"), F.lit(width).cast("long"))).alias("start"))
    return cut.select("chrom", "start", F.least(F.col("start") + width - 1, F.col("length")).alias("end"))


def overlap_join(left: DataFrame, right: DataFrame, bin_width: int = BIN) -> DataFrame:
    """All columns of both for every pair of intervals on one chromosome that share a position.

    Columns: l_start, l_end, r_start, r_end, chrom and whatever else the two have (no name twice).
    Both sides are dealt into bins and joined once, on (chrom, level, bin); a pair is kept only in
    the bin of its first common position, so no pair comes twice. Intervals over SPREAD bins wide
    are binned SPREAD times coarser: level 0 holds narrow with narrow, level 1 wide ones of the
    left with all of the right, level 2 narrow ones of the left with wide ones of the right. So no
    interval is copied often, and narrow ones meet in narrow bins only.
    """
    coarse = bin_width * SPREAD

    def binned(rows: DataFrame, side: str, other: int, own: int) -> DataFrame:
        wide = F.col(f"{side}_end") - F.col(f"{side}_start") >= coarse
        bins = lambda level, width: F.transform(F.sequence(F.floor(F.col(f"{side}_start") / width), F.floor(F.col(f"{side}_end") / width)), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))
        narrow = F.concat(bins(0, bin_width), bins(other, coarse))
        places = F.when(wide, F.concat(*[bins(level, coarse) for level in ((1,) if own == 1 else (1, 2))])).otherwise(narrow)
        return rows.withColumn("_at", F.explode(places)).select("*", "_at.level", "_at.bin").drop("_at")

    # narrow rows of the left wait in level 2 for wide ones of the right, narrow ones of the right in level 1
    pairs = binned(left, "l", 2, 1).join(binned(right, "r", 1, 2), ["chrom", "level", "bin"])
    first = F.greatest("l_start", "r_start")
    kept = F.col("bin") == F.floor(first / F.when(F.col("level") == 0, F.lit(bin_width)).otherwise(F.lit(coarse)))
    return pairs.where((F.col("l_start") <= F.col("r_end")) & (F.col("r_start") <= F.col("l_end")) & kept).drop("level", "bin")


def left_side(ranges: DataFrame) -> DataFrame:
    return ranges.withColumnRenamed("start", "l_start").withColumnRenamed("end", "l_end")


def right_side(ranges: DataFrame) -> DataFrame:
    return ranges.withColumnRenamed("start", "r_start").withColumnRenamed("end", "r_end")
