"""Reads placed on reference sequences by seeds, without gaps, and sorted into categories.

Our own rules, without splicing or indels: seeds of `k` bases, equi-joined with the seeds of
the references, give (chromosome, diagonal, strand) candidates; the mismatches of each are
counted, and the hits with the fewest are the read's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.reads import normal_id, reverse_complement

#: Fixed value: mates this far apart at most are concordant.
CONCORDANT = 200_000
#: Bases of a reference that are cut out together, at least.
TILE = 4096


def _seeds(rows: DataFrame, seq: str, k: int, step: int) -> DataFrame:
    n = F.length(seq)
    at = F.when(n >= k, F.sequence(F.lit(1), n - k + 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("at", F.explode(at)).withColumn("seed", F.substr(seq, F.col("at"), F.lit(k)))


def best_hits(reads: DataFrame, references: DataFrame, k: int = 12, most: int = 3) -> DataFrame:
    """id, chrom, pos, strand, nm, hits: every best placement of each read (id, seq) on references (chrom, ref)."""
    both = reads.select("id", "seq", F.lit("+").alias("strand")).unionByName(reads.select("id", reverse_complement(F.col("seq")).alias("seq"), F.lit("-").alias("strand")))
    mine = _seeds(both, "seq", k, max(1, k // 2)).select("id", "seq", "strand", "seed", F.col("at").alias("read_at"))
    theirs = _seeds(references, "ref", k, 1).select("chrom", "seed", F.col("at").alias("ref_at"))
    found = mine.join(theirs, "seed").select("id", "seq", "strand", "chrom", (F.col("ref_at") - F.col("read_at") + 1).alias("pos")).distinct()
    # a candidate meets a stretch of the reference as long as two tiles, never a whole chromosome
    longest = reads.agg(F.max(F.length("seq"))).first()[0] or 1
    tile = max(TILE, longest)
    cut = references.select("chrom", F.length("ref").alias("size"), "ref", F.explode(F.sequence(F.lit(0), F.floor((F.length("ref") - 1) / tile).cast("int"))).alias("tile"))
    cut = cut.select("chrom", "size", "tile", F.substr("ref", F.col("tile") * tile + 1, F.lit(2 * tile)).alias("part"))
    inside = found.where("pos >= 1").withColumn("tile", F.floor((F.col("pos") - 1) / tile).cast("int"))
    met = inside.join(cut, ["chrom", "tile"]).where(F.col("pos") + F.length("seq") - 1 <= F.col("size"))
    window = F.substr("part", F.col("pos") - F.col("tile") * tile, F.length("seq"))
    nm = F.size(F.filter(F.zip_with(F.split("seq", ""), F.split(window, ""), lambda a, b: a != b), lambda x: x))
    scored = met.select("id", "strand", "chrom", "pos", nm.alias("nm")).where(F.col("nm") <= most)
    each = Window.partitionBy("id")
    best = scored.withColumn("least", F.min("nm").over(each)).where("nm = least").drop("least")
    return best.withColumn("hits", F.count(F.lit(1)).over(each))


def categories(hits1: DataFrame, hits2: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, category of pairs: concordant, unpaired or halfmapping, each _uniq or _mult, or nomapping."""
    one = hits1.groupBy("id").agg(F.count(F.lit(1)).alias("n1"), F.min(F.struct("chrom", "pos", "strand")).alias("p1"))
    two = hits2.groupBy("id").agg(F.count(F.lit(1)).alias("n2"), F.min(F.struct("chrom", "pos", "strand")).alias("p2"))
    both = ids.join(one, "id", "left").join(two, "id", "left").fillna(0, ["n1", "n2"])
    apart = F.abs(F.col("p1.pos") - F.col("p2.pos"))
    near = F.coalesce((F.col("p1.chrom") == F.col("p2.chrom")) & (F.col("p1.strand") != F.col("p2.strand")) & (apart <= CONCORDANT) & (apart >= width), F.lit(False))
    kind = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.when(near, "concordant").otherwise("unpaired")).when(F.col("n1") + F.col("n2") > 0, "halfmapping").otherwise("nomapping")
    many = F.when(F.greatest("n1", "n2") > 1, "_mult").otherwise("_uniq")
    return both.select("id", F.when(kind == "nomapping", kind).otherwise(F.concat(kind, many)).alias("category"))


def contaminated_ids(reads: DataFrame, references: DataFrame, k: int = 12, most: int = 3) -> DataFrame:
    """id: the reads of which a mate has a place on the contaminants' references (chrom, ref); ids as `remove_contaminated` takes them."""
    mates = [reads.select("id", F.col(c).alias("seq")).where(F.col("seq").isNotNull()) for c in ("seq1", "seq2") if c in reads.columns]
    # the mates are placed one by one: their ids would be the same
    hits = [best_hits(m, references, k, most).select("id") for m in mates]
    return reduce(DataFrame.union, hits).select(normal_id(F.col("id")).alias("id")).distinct()
