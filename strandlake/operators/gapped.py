"""Reads placed on a reference with gaps, introns, clips and mapping quality, and sorted into categories.

Seeds are minimizers. The reference is cut into tiles and indexed once; a read's seeds meet the index in
one equi-join, the anchors of a read are chained, each chain calls for windows of the reference,
which come by a join on (chromosome, tile), and the reads of a task are aligned with their
windows in one table. So nothing is keyed by chromosome, and a hot place is a skewed key of an ordinary join.

Our own rules. A seed with over `common` places is passed over, unless all seeds of the read have more; then its
rarest are taken, so no read loses its places for lying in a repeat. The mapping quality is 60 * (1 - second / best)
by alignment scores, 0 for several best places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions import gapped
from strandlake.functions.gapped import MATCH

#: Bases of a minimizer and k-mers it is taken from.
K, W = 12, 5
#: Places of a seed from which on it is common.
COMMON = 64
#: Bases of a tile, and how many more it holds of the next, which bounds windows (a read and 2 * PAD).
TILE, REACH, PAD = 4096, 1024, 16
#: Longest intron, and how far mates may be apart.
LONGEST_INTRON, CONCORDANT = 200_000, 200_000
#: Bases of a read that must be clipped for it to count as split, and that the part elsewhere must have; bases that both parts may miss.
PIECE, SLACK = 16, 10
#: The categories of pairs.
CATEGORIES = (
    "concordant_uniq", "concordant_mult", "concordant_transloc", "concordant_circular", "paired_uniq_inv", "paired_uniq_scr", "paired_uniq_long", "paired_uniq_circular", "paired_mult",
    "halfmapping_uniq", "halfmapping_mult", "halfmapping_transloc", "halfmapping_circular", "unpaired_uniq", "unpaired_mult", "unpaired_transloc", "unpaired_circular", "nomapping",
)
#: Cells of the table of one call.
CELLS = 24_000_000


def cut_tiles(references: DataFrame, tile: int = TILE, reach: int = REACH) -> DataFrame:
    """chrom, tile, part, size: every tile of references (chrom, ref), with `reach` bases of what follows; size is the chromosome's.

    Slices come straight from the buffer, so the cost is linear in the chromosome.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chrom, ref in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                data = ref.as_buffer() if ref.is_valid else b""
                size = len(data)
                for at in range(0, size, tile * 256):
                    numbers = range(at // tile, min(-(-size // tile), at // tile + 256))
                    parts = [bytes(data[n * tile : n * tile + tile + reach]).decode() for n in numbers]
                    yield pa.RecordBatch.from_arrays([pa.array([chrom] * len(parts), pa.string()), pa.array(list(numbers), pa.int64()), pa.array(parts, pa.string()), pa.array([size] * len(parts), pa.int64())], names=["chrom", "tile", "part", "size"])

    return references.select("chrom", "ref").mapInArrow(cut, "chrom string, tile long, part string, size long")


def index_tiles(tiles: DataFrame, k: int = K, w: int = W, tile: int = TILE) -> DataFrame:
    """seed, chrom, ref_at, flip: the minimizers of the windows that begin in each tile; one just past a tile's end may come from both tiles."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chrom, number, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                seeds, at, flip = gapped.minimizers(part.encode()[: tile + k + w - 2], k, w)
                yield pa.RecordBatch.from_arrays([pa.array(seeds), pa.array([chrom] * len(seeds), pa.string()), pa.array(at + number * tile), pa.array(flip)], names=["seed", "chrom", "ref_at", "flip"])

    return tiles.select("chrom", "tile", "part").mapInArrow(find, "seed long, chrom string, ref_at long, flip boolean")


def read_seeds(reads: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """id, length, seed, at, read_flip: the minimizers of reads (id, seq)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [(seq or "").encode() for seq in batch.column(1).to_pylist()]
            row, seeds, at, flip = gapped.minimizers_of(seqs, k, w)
            sizes = np.array([len(s) for s in seqs], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(sizes[row]), pa.array(seeds), pa.array(at.astype(np.int32)), pa.array(flip)], names=["id", "length", "seed", "at", "read_flip"])

    return reads.select(F.col("id").cast("string").alias("id"), "seq").mapInArrow(find, "id string, length int, seed long, at int, read_flip boolean")


def anchors(seeds: DataFrame, index: DataFrame, k: int = K, common: int = COMMON) -> DataFrame:
    """id, length, anchors: where the seeds of each read lie (chrom, strand, place in the read as it lies there, place on the reference)."""
    places = F.count("*")
    counts = index.groupBy("seed").agg(F.when(places > common, places).otherwise(0).alias("places"))
    counted = seeds.join(counts, "seed")  # a seed without any place is no rare one
    told = counted.groupBy("id", "length").agg(F.collect_list(F.struct("seed", "at", "read_flip", "places")).alias("s"))
    least = F.array_min(F.transform("s", lambda x: x["places"]))
    used = told.select("id", "length", F.inline(F.filter("s", lambda x: x["places"] == least)))
    met = used.join(index, "seed")
    back = F.col("flip") != F.col("read_flip")
    here = F.when(back, F.col("length") - k - F.col("at")).otherwise(F.col("at")).cast("long")
    one = F.struct("chrom", F.when(back, "-").otherwise("+").alias("strand"), here.alias("at"), "ref_at")
    return met.groupBy("id", "length").agg(F.collect_list(one).alias("anchors"))


def chain_windows(found: DataFrame, reads: DataFrame, k: int = K, longest_intron: int = LONGEST_INTRON) -> DataFrame:
    """id, chain, chrom, strand, seq (as it lies there), part, start, width: the windows that the chains of each read call for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, length, marks, seq in zip(*(batch.column(i).to_pylist() for i in range(4))):
                kept = gapped.chains([(a["chrom"], a["strand"], a["at"], a["ref_at"]) for a in marks], length, k, PAD, longest_intron)
                for n, c in enumerate(kept):
                    lies = seq if c.strand == "+" else gapped.reverse_complement(seq.encode()).decode()
                    rows += [(name, n, c.chrom, c.strand, lies, part, max(0, start), width + min(0, start)) for part, (start, width) in enumerate(c.windows)]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=["id", "chain", "chrom", "strand", "seq", "part", "start", "width"])

    both = found.join(reads.select(F.col("id").cast("string").alias("id"), "seq"), "id").select("id", "length", "anchors", "seq")
    return both.mapInArrow(work, "id string, chain int, chrom string, strand string, seq string, part int, start long, width long")


_PLACED = "id string, chain int, chrom string, strand string, pos long, end long, cigar string, nm int, score int, length int, low int, high int, piece boolean"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _PLACED.split(", ")]
    for batch in batches:
        table = {n: batch.column(n).to_pylist() for n in ("id", "chain", "chrom", "strand", "seq", "windows")}
        windows = [[(w["start"], w["bases"].encode()) for w in ws] for ws in table["windows"]]
        seqs = [s.encode() for s in table["seq"]]
        # rows of like shape go through one table
        order = sorted(range(len(seqs)), key=lambda i: (len(windows[i]), max(len(b) for _, b in windows[i]), len(seqs[i])))
        rows, first = [], 0
        while first < len(order):
            last, cells = first, 0
            while last < len(order):
                i = order[last]
                shape = len(seqs[i]) * len(windows[i]) * max(len(b) for _, b in windows[i])
                if last > first and (cells + shape > CELLS or len(windows[i]) != len(windows[order[first]])):
                    break
                cells, last = cells + shape, last + 1
            some = order[first:last]
            for i, a in zip(some, gapped.align([seqs[i] for i in some], [windows[i] for i in some])):
                if a is not None:
                    n, plus = len(seqs[i]), table["strand"][i] == "+"
                    for b in (a, *(x for x in gapped.pieces(seqs[i], windows[i], a) if x.high - x.low >= PIECE)):
                        span = (b.low, b.high) if plus else (n - b.high, n - b.low)
                        rows.append((*(table[c][i] for c in ("id", "chain", "chrom", "strand")), b.pos + 1, b.end, b.cigar, b.nm, b.score, n, *span, b is not a))
            first = last
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 13, kinds)], names=names)


def placements(reads: DataFrame, references: DataFrame, longest_intron: int = LONGEST_INTRON, common: int = COMMON, k: int = K, w: int = W) -> DataFrame:
    """Every candidate placement of each read (id, seq; ids unique, as strings) on references (chrom, ref).

    id, chain, chrom, strand, pos and end (from 1, closed), cigar (M, I, D, N, S), nm, score, length,
    low and high (the bases of the read as sequenced that it covers); and, marked as piece, the parts
    without gaps of placements with gaps or introns, for split reads. Reads that are null, empty,
    without seeds or without places have no row. A read longer than REACH - 2 * PAD bases fails the task.
    """
    tiles = cut_tiles(references)
    found = anchors(read_seeds(reads, k, w), index_tiles(tiles, k, w), k, common)
    called = chain_windows(found, reads, k, longest_intron).withColumnRenamed("part", "part_")
    fits = F.when(F.col("width") > REACH, F.raise_error(F.concat(F.lit("read too long for a window: "), F.col("id")))).otherwise(F.col("width")).cast("int")
    inside = called.withColumn("tile", F.floor(F.col("start") / TILE)).join(tiles, ["chrom", "tile"])
    window = F.struct("part_", "start", F.substr("bases", (F.col("start") - F.col("tile") * TILE + 1).cast("int"), fits).alias("bases"))
    cut = inside.select("id", "chain", "chrom", "strand", "seq", F.col("part").alias("bases"), "start", "width", "tile", "part_")
    whole = cut.select("id", "chain", "chrom", "strand", "seq", window.alias("w")).groupBy("id", "chain", "chrom", "strand", "seq").agg(F.sort_array(F.collect_list("w")).alias("windows"))
    return whole.mapInArrow(_aligned, _PLACED)


_FIELDS = ["low", "high", "score", "chrom", "strand", "pos", "end", "cigar", "nm"]


def by_read(placed: DataFrame, longest_intron: int = LONGEST_INTRON) -> DataFrame:
    """id; best, its best placements by place, with mapq; and split (kind, hits, first, second), null where the read is not split.

    Placements are grouped once for both, so reads are aligned once. Chains that led to the same
    place count once. A read without whole placements has none in best.
    """
    rows = placed.groupBy("id", "length").agg(F.collect_set(F.struct(*_FIELDS, "chain", "piece")).alias("all"))
    plain = lambda x, *more: F.struct(*[x[c].alias(c) for c in (*_FIELDS, *more)])
    whole = F.transform(F.filter("all", lambda x: ~x["piece"]), lambda x: F.struct(x["score"].alias("score"), *[x[c].alias(c) for c in ("chrom", "pos", "strand", "cigar", "end", "nm")], F.col("length"), x["low"].alias("low"), x["high"].alias("high")))
    rows = rows.select("id", "length", F.array_distinct(whole).alias("whole"), F.array_distinct(F.transform("all", lambda x: plain(x, "chain"))).alias("all"))
    rows = rows.withColumns({"whole_top": F.array_max(F.transform("whole", lambda x: x["score"])), "top": F.array_max(F.transform("all", lambda x: x["score"]))})

    best = F.filter("whole", lambda x: x["score"] == F.col("whole_top"))
    other = F.array_max(F.transform(F.filter("whole", lambda x: x["score"] < F.col("whole_top")), lambda x: x["score"]))

    parts = F.filter("all", lambda x: (x["high"] - x["low"] >= PIECE) & (x["high"] - x["low"] <= F.col("length") - PIECE))
    fronts, backs = F.filter("parts", lambda x: x["low"] <= SLACK), F.filter("parts", lambda x: x["high"] >= F.col("length") - SLACK)

    def with_backs(x: Column) -> Column:
        meet = lambda y: (y["low"] - x["high"] <= SLACK) & (y["low"] > x["low"]) & (y["high"] > x["high"]) & (y["chain"] != x["chain"])
        both = lambda y: F.greatest(x["high"] - y["low"], F.lit(0)) * MATCH
        return F.transform(F.filter("backs", meet), lambda y: F.struct((x["score"] + y["score"] - both(y)).alias("score"), plain(x).alias("first"), plain(y).alias("second")))

    told = rows.withColumns({"best": F.sort_array(best), "other": other, "parts": parts}).withColumns({"fronts": fronts, "backs": backs}).withColumn("pairs", F.flatten(F.transform("fronts", with_backs)))
    most = F.array_max(F.transform("pairs", lambda p: p["score"]))
    told = told.withColumn("most", most).withColumn("ways", F.sort_array(F.array_distinct(F.filter("pairs", lambda p: p["score"] == F.col("most")))))
    quality = F.when(F.size("best") > 1, 0).otherwise(F.floor(60 * (1 - F.coalesce("other", F.lit(0)) / F.col("whole_top")))).cast("int")
    p = F.get("ways", F.lit(0))
    a, b = p["first"], p["second"]
    near = (a["chrom"] == b["chrom"]) & (a["strand"] == b["strand"]) & (F.abs(a["pos"] - b["pos"]) <= longest_intron)
    turned = F.when(a["strand"] == "+", b["end"] < a["end"]).otherwise(b["end"] > a["end"])
    split = F.when((F.size("ways") > 0) & (F.col("most") >= F.col("top") + PIECE), F.struct(F.when(near & turned, "circular").otherwise("transloc").alias("kind"), F.size("ways").alias("hits"), a.alias("first"), b.alias("second")))
    return told.select("id", "best", quality.alias("mapq"), split.alias("split"))


def best_of(told: DataFrame) -> DataFrame:
    """A row for each best placement of the reads of `by_read`."""
    rows = told.select("id", F.size("best").alias("hits"), "mapq", F.explode("best").alias("b"))
    return rows.select("id", *[F.col(f"b.{c}").alias(c) for c in ("chrom", "pos", "end", "strand", "cigar", "nm", "score", "length", "low", "high")], "mapq", "hits")


def best_placements(placed: DataFrame) -> DataFrame:
    """The best placements of each read, with hits (how many there are) and mapq. Chains that led to the same place count once."""
    return best_of(by_read(placed))


def split_placements(placed: DataFrame, longest_intron: int = LONGEST_INTRON) -> DataFrame:
    """id, kind, hits, first, second: reads whose two parts lie on different places, better together than any place of the whole.

    first is the placement of the read's front. kind is `circular` where both lie on one strand
    of one chromosome, within an intron's length but in the opposite order, else `transloc`.
    Bases that both parts cover count for one of them only. hits counts the equally good ways
    to split the read; the first by place is given. Parts of one chain are none of two places.
    """
    return by_read(placed, longest_intron).where("split is not null").select("id", "split.*")


def read_categories(placed: DataFrame, ids: DataFrame, longest_intron: int = LONGEST_INTRON) -> DataFrame:
    """id, kind, hits, and the best place (chrom, pos, end, strand) of each id: uniq, mult, transloc, circular, or none."""
    least = F.array_min(F.transform("best", lambda x: F.struct(*[x[c].alias(c) for c in ("chrom", "pos", "end", "strand")])))
    first = F.col("split.first")
    found = by_read(placed, longest_intron).select("id", F.nullif(F.size("best"), F.lit(0)).alias("n"), least.alias("p"), F.col("split.kind").alias("split"), *[first[c].alias(d) for c, d in zip(("chrom", "pos", "end", "strand"), "csed")])
    told = ids.select(F.col("id").cast("string").alias("id")).join(found, "id", "left")
    kind = F.coalesce("split", F.when(F.col("n") > 1, "mult").when(F.col("n") == 1, "uniq").otherwise("none"))
    place = lambda name, other: F.when(F.col("split").isNotNull(), F.col(other)).otherwise(F.col("p")[name]).alias(name)
    return told.select("id", kind.alias("kind"), F.coalesce("n", F.lit(0)).alias("hits"), place("chrom", "c"), place("pos", "s"), place("end", "e"), place("strand", "d"))


def single_categories(kinds: DataFrame) -> DataFrame:
    """id, category of single reads: unpaired_ with uniq, mult, transloc or circular, or nomapping."""
    return kinds.select("id", F.when(F.col("kind") == "none", "nomapping").otherwise(F.concat(F.lit("unpaired_"), "kind")).alias("category"))


def pair_categories(one: DataFrame, two: DataFrame, concordant: int = CONCORDANT) -> DataFrame:
    """id, category of pairs, from read_categories of both mates.

    concordant_, halfmapping_ or unpaired_ with uniq, mult, transloc or circular; nomapping;
    and for mates on one chromosome that aren't concordant paired_uniq_inv (same strand),
    paired_uniq_scr (wrong order, or overlapping), paired_uniq_long (over `concordant` apart),
    paired_uniq_circular or paired_mult. Concordant mates face each other without overlapping.
    """
    a, b = one.alias("a"), two.alias("b")
    both = a.join(b, "id")
    x, y = (lambda n: F.col(f"a.{n}")), (lambda n: F.col(f"b.{n}"))
    maps = lambda z: z("kind") != "none"
    split = lambda k: (x("kind") == k) | (y("kind") == k)
    worst = F.when(split("circular"), "circular").when(split("transloc"), "transloc").when(split("mult"), "mult").otherwise("uniq")
    same = x("chrom") == y("chrom")
    inverted = x("strand") == y("strand")
    ahead = F.when(x("strand") == "+", y("pos") > x("end")).otherwise(x("pos") > y("end"))
    far = F.abs(x("pos") - y("pos")) > concordant
    apart = F.when(split("mult"), "paired_mult").when(split("circular"), "paired_uniq_circular").when(split("transloc"), "unpaired_transloc").when(inverted, "paired_uniq_inv").when(~ahead, "paired_uniq_scr").otherwise("paired_uniq_long")
    mapped = F.when(~same, F.concat(F.lit("unpaired_"), worst)).when(~inverted & ahead & ~far, F.concat(F.lit("concordant_"), worst)).otherwise(apart)
    half = F.concat(F.lit("halfmapping_"), F.when(maps(x), x("kind")).otherwise(y("kind")))
    return both.select("id", F.when(maps(x) & maps(y), mapped).when(maps(x) | maps(y), half).otherwise("nomapping").alias("category"))


def category_matrix(categories: DataFrame, by: str = "run") -> DataFrame:
    """by, a count for each of CATEGORIES, and analyzed, the concordant reads with one place; from rows (by, category)."""
    counts = [F.count_if(F.col("category") == c).cast("double").alias(c) for c in CATEGORIES]
    return categories.groupBy(by).agg(*counts, F.count_if(F.col("category") == "concordant_uniq").cast("double").alias("analyzed"))
