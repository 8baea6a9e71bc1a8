"""Tables laid out by place, so that a query of regions opens only the files that can hold their rows.

A row lies in the smallest bin that holds it whole: bins of 2**20, 2**23, 2**26 and 2**29 positions, the
coarser eight times wider. Chromosome and bin are folders; within them rows are sorted by place, so
the statistics of row groups tell regions apart further. A region needs its few bins on each level and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.operators.intervals import merge_adjacent, overlap_join, right_side

#: Bits of the positions of a bin, finest level first.
LEVELS = (20, 23, 26, 29)
CHROM, BIN = "_chrom", "_bin"


def bin_name(start: Column, end: Column) -> Column:
    """The smallest bin that holds a closed interval whole, as `b` and level, number; `all` for one that no bin holds."""
    same = lambda bits: F.shiftright((start - 1).cast("long"), bits) == F.shiftright((end - 1).cast("long"), bits)
    name = lambda bits: F.concat(F.lit(f"b{bits}."), F.shiftright((start - 1).cast("long"), bits).cast("string"))
    found = F.when(same(LEVELS[0]), name(LEVELS[0]))
    for bits in LEVELS[1:]:
        found = found.when(same(bits), name(bits))
    return found.otherwise("all")


def write_by_region(rows: DataFrame, path: str, start: str = "start", end: str = "end", mode: str = "errorifexists") -> None:
    """Parquet of rows (chrom, start, end and more) in folders by chromosome and bin.

    Rows are dealt by range of (chromosome, bin, start), so a bin with many rows spreads over several
    files and small bins share a task. Rows with a null chromosome or place are kept in folders of their own.
    """
    laid = rows.withColumns({CHROM: F.col("chrom"), BIN: F.coalesce(bin_name(F.col(start), F.col(end)), F.lit("none"))})
    laid.repartitionByRange(CHROM, BIN, start).sortWithinPartitions(CHROM, BIN, start).write.mode(mode).partitionBy(CHROM, BIN).parquet(path)


def bins_of(which: DataFrame) -> DataFrame:
    """chrom, bin: the bins whose rows may overlap regions (chrom, start, end)."""
    def names(bits: int) -> Column:
        number = lambda c: F.shiftright((F.col(c) - 1).cast("long"), bits)
        return F.transform(F.sequence(number("start"), number("end")), lambda n: F.concat(F.lit(f"b{bits}."), n.cast("string")))

    return which.where("chrom is not null and start >= 1 and end >= start").select("chrom", F.explode(F.concat(*[names(b) for b in LEVELS], F.array(F.lit("all")))).alias("bin")).distinct()


def read_regions(spark: SparkSession, path: str, which: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """The rows of write_by_region that share a position with a region (chrom, start, end), each once.

    The bins of the regions, at most some 3,500 for a genome of 3 * 10**9 positions, are collected
    and pick the folders before anything is opened; then rows meet the merged regions in an overlap join.
    No regions: no rows.
    """
    wanted = [f"{r['chrom']}\x01{r['bin']}" for r in bins_of(which).collect()]
    rows = spark.read.option("basePath", path).parquet(path).where(F.concat_ws("\x01", F.col(CHROM).cast("string"), BIN).isin(wanted or [""]))
    merged = merge_adjacent(which.where("chrom is not null and start >= 1"), ["chrom"])
    before = F.lag("end").over(Window.partitionBy("chrom").orderBy("start"))
    regions = merged.withColumn("_before", F.coalesce(before, F.lit(0)))
    met = overlap_join(rows.withColumns({"l_start": F.col(start), "l_end": F.col(end)}), right_side(regions))
    # of the regions that a row overlaps the first is the one before which it doesn't reach back to another
    return met.where(F.col("_before") < F.col("l_start")).select(*[c for c in rows.columns if c not in (CHROM, BIN)])
