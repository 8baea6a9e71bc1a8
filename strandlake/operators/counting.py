"""Reads counted over genomic features, feature widths, RPKM and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.operators.intervals import left_side, merge_adjacent, overlap_join, right_side, running


def feature_hits(features: DataFrame, blocks: DataFrame) -> DataFrame:
    """feature_set, name, groupid: one row for each feature and read that overlap, strands ignored."""
    pairs = overlap_join(left_side(features.select("feature_set", "name", "chrom", "start", "end")), right_side(blocks.select("groupid", "chrom", "start", "end")))
    return pairs.select("feature_set", "name", "groupid").distinct()


def feature_widths(features: DataFrame) -> DataFrame:
    """feature_set, name, width: the positions that a feature's ranges cover."""
    merged = merge_adjacent(features, ["feature_set", "name", "chrom"])
    return merged.groupBy("feature_set", "name").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("width"))


def _shift(way: str, value: Column, by: Column) -> Column:
    return F.call_function(f"shift{way}", value, by)


def _at_least_one(shapes: DataFrame, blocks: DataFrame) -> DataFrame:
    """chrom, start, end, count: reads that overlap each of the ranges (chrom, start, end; none twice), zero too.

    Blocks that overlap a range are those that start up to its end, less those that end before its
    start. A read's blocks, joined where they overlap, lie apart, and a range overlaps neighbours of them; so
    a read counts once if each neighbouring pair that the range holds takes one away: the end of
    the first lies from the range's start on, the start of the second up to its end. Starts of the
    second are kept in blocks of 1, 2, 4, ... positions (levels 0, 1, 2, ...), of which each range takes at most two
    a level; within a block, pairs are summed from the last end of a first down. Level -1 holds
    starts, level -2 ends. So no pair of a read and a range is ever made.
    """
    widest = shapes.agg(F.coalesce(F.max(F.col("end") - F.col("start")), F.lit(0)).cast("long").alias("_widest"))
    widest = F.broadcast(widest.withColumn("_levels", F.sequence(F.lit(0), F.floor(F.log2(F.greatest("_widest", F.lit(1)))).cast("int"))))
    of_read = Window.partitionBy("groupid", "chrom").orderBy("start", "end")
    long = lambda c: F.col(c).cast("long")
    row = lambda level, block, at, sign: F.struct(level.cast("int").alias("level"), block.cast("long").alias("block"), at.cast("long").alias("at"), F.lit(sign).alias("sign"))
    only = lambda test, rows: F.when(test, rows).otherwise(F.slice(rows, 1, 0))
    one = lambda level, at, sign=1: F.array(row(F.lit(level), F.lit(0), at, sign))

    reach = F.max("end").over(of_read.rowsBetween(Window.unboundedPreceding, -1))
    apart = blocks.select("groupid", "chrom", long("start").alias("start"), long("end").alias("end")).withColumns({"reach": reach, "last": F.lead("start").over(of_read).isNull()}).join(widest)
    first, later = F.col("reach").isNull(), F.col("start") > F.col("reach")
    pair = F.transform("_levels", lambda k: row(k, _shift("right", F.col("start"), k), -F.col("reach"), 1))
    edges = F.concat(only(first | later, one(-1, F.col("start"))), only(later, one(-2, F.col("reach"))), only(F.col("last"), one(-2, F.greatest("end", "reach"))), only(later & (F.col("start") - F.col("reach") <= F.col("_widest")), pair))
    events = apart.select("chrom", F.inline(edges)).groupBy("chrom", "level", "block", "at").agg(F.count(F.lit(1)).alias("n"))

    def taken(k: Column) -> Column:
        low = _shift("right", F.col("start") + _shift("left", F.lit(1).cast("long"), k), k)  # the first block that begins past the range's start
        high = _shift("right", F.col("end") + 1, k)
        odd = lambda n: (low < high) & (n % 2 != 0)
        return F.concat(only(odd(low), F.array(row(k, low, -F.col("start"), -1))), only(odd(high), F.array(row(k, high - 1, -F.col("start"), -1))))

    asked = shapes.select("chrom", long("start").alias("start"), long("end").alias("end")).join(widest)
    asked = asked.select("chrom", "start", "end", F.inline(F.concat(one(-1, F.col("end")), one(-2, F.col("start") - 1, -1), F.flatten(F.transform("_levels", taken)))))
    key = ["chrom", "level", "block", "at"]
    both = events.unionByName(asked.select(*key, F.lit(0).cast("long").alias("n"))).groupBy(*key).agg(F.sum("n").alias("n"))
    sums = running(both, key[:3], ["n"]).select(*key, "sum_n")
    return asked.join(sums, key).groupBy("chrom", "start", "end").agg(F.sum(F.col("sign") * F.col("sum_n")).alias("count"))


def count_features(features: DataFrame, blocks: DataFrame) -> DataFrame:
    """feature_set, name, count, width: reads (groupid) that overlap each feature, strands ignored; features without reads have 0."""
    place = ["chrom", "start", "end"]
    key = ["feature_set", "name"]
    rows = features.select(*key, *place).where("feature_set is not null and name is not null and chrom is not null and end >= start")
    shape = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in place])
    single = shape.where("_n = 1").select(*key, "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    one = single.join(_at_least_one(single.select(*place).distinct(), blocks), place, "left").select(*key, "count", (F.col("end") - F.col("start") + 1).alias("width"))
    several = rows.join(shape.where("_n > 1").select(*key), key, "left_semi")
    reached = F.broadcast(several.groupBy("chrom").agg(F.min("start").alias("_low"), F.max("end").alias("_high")))
    near = blocks.join(reached, "chrom").where("start <= _high and end >= _low").select("groupid", *place)
    hit = feature_hits(several, near).groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    counts = one.unionByName(feature_widths(several).join(hit, key, "left").select(*key, "count", "width"))
    return counts.select(*key, F.coalesce("count", F.lit(0)).cast("long").alias("count"), "width")


def count_features_by(features: DataFrame, blocks: DataFrame, by: str = "run") -> DataFrame:
    """by, feature_set, name, count, width: count_features for each value of a column of the blocks; a feature without reads there has 0.

    The value becomes part of the chromosome's and the set's name, so the same running sums serve all of them.
    """
    values = blocks.where(F.col(by).isNotNull()).agg(F.collect_set(by).alias("_values"))
    join = lambda c: F.concat_ws("\x01", by, c)
    each = features.select("feature_set", "name", "chrom", "start", "end").join(F.broadcast(values)).withColumn(by, F.explode("_values")).drop("_values")
    kind = blocks.schema[by].dataType
    counts = count_features(each.withColumns({"feature_set": join("feature_set"), "chrom": join("chrom")}), blocks.withColumn("chrom", join("chrom")))
    parts = F.split("feature_set", "\x01", 2)
    return counts.select(parts[0].cast(kind).alias(by), parts[1].alias("feature_set"), "name", "count", "width")


def reads_by_set(features: DataFrame, blocks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """by, feature_set, nbreads: distinct reads that hit any feature of the set, for each value of columns of the blocks.

    A set's features are merged first, and the sets that a place hits are found once for all blocks
    there, as bits of numbers of 63 sets each. So a read is grouped once for 63 sets, and no pair of a read and a feature is made.
    """
    names = features.select("feature_set").distinct().withColumn("_set", F.row_number().over(Window.orderBy("feature_set")) - 1)  # sets, not features
    numbered = features.select("feature_set", "chrom", "start", "end").alias("f").join(F.broadcast(names.alias("n")), F.col("f.feature_set").eqNullSafe(F.col("n.feature_set"))).select("_set", "chrom", "start", "end")
    place = ["chrom", "start", "end"]
    met = overlap_join(left_side(merge_adjacent(numbered, ["_set", "chrom"])), right_side(blocks.select(*place).distinct()))
    bit = _shift("left", F.lit(1).cast("long"), (F.col("_set") % 63).cast("int"))
    hit = met.groupBy("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"), F.floor(F.col("_set") / 63).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    reads = blocks.select(*by, "groupid", *place).join(hit, place).groupBy(*by, "groupid", "_word").agg(F.bit_or("_bits").alias("_bits"))
    alike = reads.groupBy(*by, "_word", "_bits").agg(F.count("groupid").alias("n"))
    each = alike.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(62)))).where(_shift("right", F.col("_bits"), F.col("_bit")) % 2 != 0)
    told = each.groupBy(*by, (F.col("_word") * 63 + F.col("_bit")).alias("_set")).agg(F.sum("n").alias("nbreads"))
    return told.join(F.broadcast(names), "_set").select(*by, "feature_set", "nbreads")


def add_rpkm(counts: DataFrame, analyzed: DataFrame) -> DataFrame:
    """counts with rpkm; analyzed has one row, the number of analyzed reads `n`."""
    return counts.join(F.broadcast(analyzed.limit(1))).withColumn("rpkm", F.lit(1e9) * F.col("count") / (F.col("n") * F.col("width"))).drop("n")


def merge_counts(parts: DataFrame, analyzed: DataFrame | None = None, run: str = "run") -> DataFrame:
    """feature_set, name, count, width over all runs, features without reads too; with rpkm for `analyzed` (one row, n).

    A feature that some run lacks, or whose width differs between runs, fails the task.
    """
    runs = parts.agg(F.countDistinct(run).alias("_runs"))
    merged = parts.groupBy("feature_set", "name").agg(F.sum("count").cast("long").alias("count"), F.max("width").alias("width"), F.min("width").alias("_least"), F.countDistinct(run).alias("_in")).join(F.broadcast(runs))
    fault = F.when(F.col("_in") != F.col("_runs"), F.lit("feature names differ")).when(F.col("_least") != F.col("width"), F.lit("feature widths differ"))
    merged = merged.withColumn("width", F.when(fault.isNotNull(), F.raise_error(fault).cast("long")).otherwise(F.col("width"))).drop("_least", "_in", "_runs")
    return merged if analyzed is None else add_rpkm(merged, analyzed)


def capped(rows: DataFrame, most: float, value: str = "count") -> DataFrame:
    """Rows whose value is not null and at most `most`, as for a plot."""
    return rows.where(F.col(value) <= most)


def class_shares(reads: DataFrame, analyzed: DataFrame) -> DataFrame:
    """feature_class, reads, percent from reads by set (feature_set, nbreads): shares of the analyzed reads; introns are genes without exons."""
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("feature_set") == kind, F.col("nbreads"))), F.lit(0))
    one = reads.agg(n("gene").alias("g"), n("exon").alias("e"), n("gene_coding").alias("c"), n("intergenic").alias("i")).join(F.broadcast(analyzed.limit(1)))
    rows = one.select("n", F.expr("stack(5, 'Genes', g, 'Exons', e, 'CDS', c, 'Introns', g - e, 'Intergenic', i) as (feature_class, reads)"))
    return rows.select("feature_class", "reads", F.round(F.col("reads") * 100.0 / F.col("n"), 2).alias("percent"))


def restricted(rows: DataFrame, names: DataFrame, key: str = "gene") -> DataFrame:
    """rows whose key is among the names."""
    return rows.join(names.select(key).distinct(), key, "left_semi").select(*rows.columns)


def side_by_side(one: DataFrame, two: DataFrame, symbols: DataFrame, key: str = "name") -> DataFrame:
    """key, symbol, count_1, count_2: two samples' counts next to each other, with the features' symbols (null if unknown)."""
    both = one.select(key, F.col("count").alias("count_1")).join(two.select(key, F.col("count").alias("count_2")), key)
    return both.join(symbols.select(key, "symbol").dropDuplicates([key]), key, "left").select(key, "symbol", "count_1", "count_2")


def count_statistics(counts: DataFrame) -> DataFrame:
    """For each feature set: features with at least 1, 10, 100 reads, the mean and exact quartiles."""
    q = F.percentile("count", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    stats = counts.groupBy("feature_set").agg(*[F.count_if(F.col("count") >= n).alias(f"at_least_{n}") for n in (1, 10, 100)], F.avg("count").alias("mean"), q.alias("q"))
    return stats.select("feature_set", "at_least_1", "at_least_10", "at_least_100", "mean", *[F.col("q")[i].alias(n) for i, n in enumerate(("min", "q25", "median", "q75", "max"))])


def detected(counts: DataFrame) -> DataFrame:
    """feature_set, detected, total, gt_10: features with reads, all, and those with more than ten."""
    return counts.groupBy("feature_set").agg(F.count_if(F.col("count") > 0).alias("detected"), F.count(F.lit(1)).alias("total"), F.count_if(F.col("count") > 10).alias("gt_10"))


def survival(counts: DataFrame, value: str = "count") -> DataFrame:
    """value, num, percent: how many rows have at least each value. An empty input gives (1, 1, 100)."""
    seen = counts.groupBy(F.col(value).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # from the largest value down, in tiles of values
    run = running(seen.select(F.lit(0).alias("all"), (-F.col("value")).alias("at"), "n"), ["all"], ["n"], 1024)
    total = counts.agg(F.count(F.lit(1)).alias("rows"))
    out = run.join(F.broadcast(total)).select((-F.col("at")).alias("value"), F.col("sum_n").alias("num"), (F.col("sum_n") * 100.0 / F.col("rows")).alias("percent"))
    none = total.where("rows = 0").select(F.lit(1).cast("long").alias("value"), F.lit(1).cast("long").alias("num"), F.lit(100.0).alias("percent"))
    return out.unionByName(none)
