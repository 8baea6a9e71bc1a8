"""The seven feature sets of a gene model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.operators.intervals import gaps, left_side, overlap_join, right_side, set_difference, span
from strandlake.operators.stats import single_gene_pieces

GENE = ["gene", "chrom", "strand"]


def _place(mark: str = "-") -> Column:
    return F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit(mark), F.col("end").cast("string"))


def _set(rows: DataFrame, kind: str, name: Column, strand: Column | None = None) -> DataFrame:
    return rows.select(F.lit(kind).alias("feature_set"), name.alias("name"), "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), (strand if strand is not None else F.col("strand")).alias("strand"))


def intergenic(tx: DataFrame, lengths: DataFrame) -> DataFrame:
    """chrom, start, end: what no gene's span covers, strands ignored."""
    return gaps(span(tx, GENE), ["chrom"], lengths)


def introns(tx: DataFrame, exons: DataFrame) -> DataFrame:
    """gene, chrom, strand, start, end: transcripts without the gene's exons."""
    return set_difference(tx, exons, GENE)


def build_features(tx: DataFrame, exons: DataFrame, coding: DataFrame, lengths: DataFrame) -> DataFrame:
    """feature_set, name, chrom, start, end, strand from tables with gene, chrom, start, end, strand.

    gene: spans; gene_exonic and gene_coding: the ranges of a gene under its name; exon: every
    exon by place; exon_disjoint: pieces of coding exons that touch one gene; intergenic; intron.
    """
    gene, none = F.col("gene").cast("string"), F.lit("*")
    sets = [
        _set(span(tx, GENE), "gene", gene),
        _set(exons, "gene_exonic", gene),
        _set(coding, "gene_coding", gene),
        _set(exons.select("chrom", "start", "end", "strand").distinct(), "exon", _place()),
        _set(single_gene_pieces(coding), "exon_disjoint", _place(), none),
        _set(intergenic(tx, lengths), "intergenic", _place(".."), none),
        _set(introns(tx, exons), "intron", F.concat(gene, F.lit("."), _place())),
    ]
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out


def restrict(features: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Features that overlap one region of interest."""
    return features.where((F.col("chrom") == chrom) & (F.col("start") <= end) & (F.col("end") >= start))


def in_regions(features: DataFrame, regions: DataFrame) -> DataFrame:
    """Features that overlap any of many regions."""
    key = ["chrom", "start", "end"]
    met = overlap_join(left_side(features.select(*key).distinct()), right_side(regions.select(*key)))
    return features.join(met.select("chrom", F.col("l_start").alias("start"), F.col("l_end").alias("end")).distinct(), key, "left_semi")
