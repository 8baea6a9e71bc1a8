"""Read depth as runs, and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions import reads as R
from strandlake.operators.intervals import left_side, overlap_join, right_side, span, sweep


def aligned_blocks(alignments: DataFrame, keep: tuple[str, ...] = ("run",)) -> DataFrame:
    """groupid, chrom, start, end, strand and `keep`: the gap-free blocks of usable records; mates share the groupid (the read's name)."""
    a = alignments.where(R.usable(F.col("flag")) & F.col("chrom").isNotNull())
    return a.select(F.col("qname").alias("groupid"), "chrom", F.inline(R.cigar_blocks(F.col("pos"), F.col("cigar"))), "strand", *keep)


def coverage_runs(blocks: DataFrame) -> DataFrame:
    """chrom, start, end, depth: runs of equal depth; where mates overlap both count."""
    return sweep(blocks, ["chrom"])


def extended_pairs(blocks: DataFrame, max_length: int | None = None) -> DataFrame:
    """One range for each pair and chromosome, from its least start to its largest end, shorter than max_length."""
    out = span(blocks, ["groupid", "chrom"])
    return out if max_length is None else out.where(F.col("end") - F.col("start") + 1 < max_length)


def resized_blocks(blocks: DataFrame, width: int) -> DataFrame:
    """Every block set to the fragment length, held at its 5' end; starts before 1 are cut."""
    start, end = R.resize(F.col("start"), F.col("end"), F.col("strand"), width)
    return blocks.withColumns({"start": F.greatest(start, F.lit(1)), "end": end})


def coverage_statistics(runs: DataFrame, lengths: DataFrame) -> DataFrame:
    """chrom, mean, ge1, ge2, ge5: mean depth and covered fractions; chromosome `genome` weighs all by length."""
    size = F.col("end") - F.col("start") + 1
    sums = runs.groupBy("chrom").agg(F.sum(F.col("depth") * size).alias("bases"), *[F.sum(F.when(F.col("depth") >= n, size).otherwise(0)).alias(f"ge{n}") for n in (1, 2, 5)])
    each = lengths.join(sums, "chrom", "left").fillna(0)
    ratio = lambda a, b: (F.col(a) / F.col(b))
    whole = each.agg(F.lit("genome").alias("chrom"), F.sum("length").alias("length"), *[F.sum(c).alias(c) for c in ("bases", "ge1", "ge2", "ge5")])
    both = each.select("chrom", "length", "bases", "ge1", "ge2", "ge5").unionByName(whole)
    return both.select("chrom", ratio("bases", "length").alias("mean"), *[ratio(c, "length").alias(c) for c in ("ge1", "ge2", "ge5")])


def coverage_summary(statistics: DataFrame, fragment_length: DataFrame | None = None) -> DataFrame:
    """name, value: the statistics of every chromosome as `chrom.statistic`, and estimated.fragmentLength, null where none was estimated."""
    rows = F.array(*[F.struct(F.concat_ws(".", "chrom", F.lit(c)).alias("name"), F.col(c).cast("double").alias("value")) for c in ("mean", "ge1", "ge2", "ge5")])
    out = statistics.select(F.inline(rows))
    length = F.lit(None).cast("double") if fragment_length is None else F.col("fragment_length").cast("double")
    source = statistics.sparkSession.range(1) if fragment_length is None else fragment_length
    return out.unionByName(source.select(F.lit("estimated.fragmentLength").alias("name"), length.alias("value")))


def merge_runs(parts: DataFrame) -> DataFrame:
    """The runs of several lanes added up."""
    return sweep(parts, ["chrom"], {"depth": F.col("depth")})


def sparsity(runs: DataFrame, lengths: DataFrame) -> DataFrame:
    """n_runs, length, sparse: whether there are fewer than 0.1 runs a position, uncovered runs left out."""
    n = runs.agg(F.count(F.lit(1)).alias("n_runs"))
    total = lengths.agg(F.sum("length").cast("long").alias("length"))
    return n.join(F.broadcast(total)).withColumn("sparse", F.col("n_runs") / F.col("length") < 0.1)


def weighted_fragment_length(estimates: DataFrame) -> DataFrame:
    """fragment_length: the mean of chrom lengths `length` weighed by `n`, rounded."""
    return estimates.agg(F.round(F.sum(F.col("length") * F.col("n")) / F.sum("n")).cast("long").alias("fragment_length"))


def estimate_fragment_length(blocks: DataFrame, most: int = 1000, by: str = "chrom") -> DataFrame:
    """by, n, length: the shift at which the 5' ends of the two strands agree most, plus 1, for each chromosome.

    Our own rule for an estimator that is delegated elsewhere: every 5' end of the plus strand is
    paired with those of the minus strand up to `most` positions on, by positions and their
    counts, and the distance with the most pairs is taken (the least of ties).
    """
    five = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start")).cast("long")
    ends = blocks.groupBy(by, (F.col("strand") == "-").alias("minus"), five.alias("at")).agg(F.count(F.lit(1)).alias("k"))
    tile = F.floor(F.col("at") / most)
    plus = ends.where("not minus").select(by, F.col("at").alias("p"), F.col("k").alias("kp"), F.explode(F.array(tile, tile + 1)).alias("tile"))
    minus = ends.where("minus").select(by, F.col("at").alias("m"), F.col("k").alias("km"), tile.alias("tile"))
    far = plus.join(minus, [by, "tile"]).where((F.col("m") >= F.col("p")) & (F.col("m") < F.col("p") + most))
    pairs = far.groupBy(by, (F.col("m") - F.col("p") + 1).alias("length")).agg(F.sum(F.col("kp") * F.col("km")).alias("pairs"))
    best = pairs.groupBy(by).agg(F.max_by("length", F.struct("pairs", -F.col("length"))).alias("length"))
    return blocks.groupBy(by).agg(F.count(F.lit(1)).alias("n")).join(best, by)


def minimum_depth(places: DataFrame, runs: DataFrame) -> DataFrame:
    """places (chrom, start, end and more) with min_depth: the least depth over their positions, 0 where a part is not covered."""
    key = ["chrom", "start", "end"]
    met = overlap_join(left_side(places.select(*key).distinct()), right_side(runs.select("chrom", "start", "end", "depth")))
    inside = F.least("l_end", "r_end") - F.greatest("l_start", "r_start") + 1
    found = met.groupBy("chrom", F.col("l_start").alias("start"), F.col("l_end").alias("end")).agg(F.min("depth").alias("_least"), F.sum(inside).alias("_covered"))
    full = F.col("_covered") == F.col("end") - F.col("start") + 1
    return places.join(found, key, "left").withColumn("min_depth", F.when(full, F.col("_least")).otherwise(0).cast("long")).drop("_least", "_covered")


def checksum(runs: DataFrame) -> DataFrame:
    """checksum: positions times depth, summed over all positions."""
    first, last = F.col("start").cast("long"), F.col("end").cast("long")
    return runs.agg(F.sum(F.col("depth") * (first + last) * (last - first + 1) / 2).cast("long").alias("checksum"))
