"""Statistics of alignments and variants, duplicates, variant filters and run quality calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions import reads as R
from strandlake.functions.pileup import count_bases
from strandlake.operators.intervals import BIN, TILE, merge_adjacent, sweep
from strandlake.operators.quantiles import quantile_state, state_quantiles


def unique_reads(alignments: DataFrame) -> DataFrame:
    return alignments.groupBy("category").agg(F.countDistinct("qname").alias("reads"))


def analyzed(alignments: DataFrame, paired: bool = True) -> DataFrame:
    """The uniquely mapped categories; with categories as partitions only their files are read."""
    return alignments.where(F.col("category").rlike("concordant_uniq" if paired else "_uniq"))


def edit_statistics(a: DataFrame, by: list[str]) -> DataFrame:
    """Edit distances: sum, sum of squares, records with 0 to 7 and with 8 or more."""
    nm = F.col("nm")
    return a.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.sum(nm).alias("nm_sum"), F.sum(nm * nm).alias("nm_sum2"), *[F.count_if(nm == i).alias(f"nm_{i}") for i in range(8)], F.count_if(nm >= 8).alias("nm_8"))


def mapq_statistics(a: DataFrame, by: list[str]) -> DataFrame:
    q = F.col("mapq")
    return a.groupBy(*by).agg(F.sum(q).alias("mapq_sum"), F.sum(q * q).alias("mapq_sum2"), F.count_if(q <= 36).alias("mapq_36"), *[F.count_if(q == i).alias(f"mapq_{i}") for i in range(37, 41)], F.count_if(q >= 41).alias("mapq_41"))


def cigar_statistics(a: DataFrame, by: list[str]) -> DataFrame:
    """Characters of the CIGAR texts, operations S, N and I or D, and records that have them."""
    c, n = F.col("cigar"), F.length("cigar")
    ops = {"s": "S", "n": "N", "id": "[ID]"}
    return a.groupBy(*by).agg(F.sum(n).alias("cigar_sum"), F.sum(n * n).alias("cigar_sum2"), *[F.sum(F.regexp_count(c, F.lit(v))).alias(f"ops_{k}") for k, v in ops.items()], *[F.count_if(c.rlike(v)).alias(f"with_{k}") for k, v in ops.items()])


def chromosome_counts(a: DataFrame, lengths: DataFrame) -> DataFrame:
    """chrom, records: zero for chromosomes without records."""
    return lengths.select("chrom").join(a.where("chrom is not null").groupBy("chrom").agg(F.count(F.lit(1)).alias("records")), "chrom", "left").fillna(0)


def insert_size_bins(a: DataFrame) -> DataFrame:
    """left_edge, records: sixty bins (1, 11], ..., (591, inf) of the absolute insert size."""
    size = F.abs("isize")
    bins = a.where(size > 1).groupBy((F.least(F.ceil((size - 1) / 10) - 1, F.lit(59)) * 10 + 1).cast("int").alias("left_edge")).agg(F.count(F.lit(1)).alias("records"))
    every = a.sparkSession.range(60).select((F.col("id") * 10 + 1).cast("int").alias("left_edge"))
    return every.join(bins, "left_edge", "left").fillna(0)


def target_lengths(a: DataFrame, most: int = 600) -> DataFrame:
    """trimmed, min, q1, median, mean, q3, max of insert sizes, of all and of those under `most`."""
    size = F.abs("isize")
    rows = a.where(R.usable(F.col("flag"))).select(size.alias("x"), F.explode(F.when(size < most, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("trimmed"))
    out = rows.groupBy("trimmed").agg(R.quantiles(F.col("x"), 4).alias("q"), F.avg("x").alias("mean"))
    return out.select("trimmed", *[F.col("q")[i].alias(n) for i, n in enumerate(("min", "q1", "median", "q3", "max"))], "mean")


def target_length_rows(a: DataFrame, by: str = "run", most: int = 600) -> DataFrame:
    """by, and target_length_ with min, q1, median, mean, q3, max of the insert sizes of usable records under `most`, from mergeable states."""
    rows = a.where(R.usable(F.col("flag")) & (F.abs("isize") < most)).select(by, F.abs("isize").alias("x"))
    state = quantile_state(rows, [by], "x")
    told = state_quantiles(state, [by]).select(by, *[F.col("quantiles")[i].alias(f"target_length_{n}") for i, n in enumerate(("min", "q1", "median", "q3", "max"))])
    mean = state.groupBy(by).agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("target_length_mean"))
    return told.join(mean, by)


def mark_duplicates(a: DataFrame) -> DataFrame:
    """a with is_dup, by fragments (qname, mate, chrom, pos, strand, cigar, mapq, nm).

    The end of a fragment is the 5' end of its read with the clipped bases put back. Names with
    one record of mate 1 and one of mate 2 are pairs: of pairs with the same two ends all but the best
    mapped are duplicates, both mates. Any other record is one if an end of a pair lies
    where its own does, on the same strand, or a better single record. Best is the highest mapping quality, then
    the fewest differences, then the first name. Records without a place are none. A group's best is an aggregate that is
    combined before the shuffle, so no window holds all records of one position.
    """
    named = ["qname", "mate", "chrom", "pos", "strand", "cigar"]
    rows = a.where("chrom is not null and pos is not null and qname is not null").select(*named, "mapq", "nm", R.five_prime(F.col("pos"), F.col("cigar"), F.col("strand")).alias("five"))
    end = F.struct("chrom", "five", "strand")
    mates = rows.groupBy("qname").agg(
        F.count_if(F.col("mate") == 1).alias("n1"), F.count_if(F.col("mate") == 2).alias("n2"), F.min(F.when(F.col("mate").isin(1, 2), end)).alias("low"), F.max(F.when(F.col("mate").isin(1, 2), end)).alias("high"),
        F.sum(F.when(F.col("mate").isin(1, 2), F.col("mapq"))).alias("mapq"), F.sum(F.when(F.col("mate").isin(1, 2), F.col("nm"))).alias("nm"),
    )
    pairs = mates.where("n1 = 1 and n2 = 1").select("qname", "low", "high", F.struct(-F.col("mapq"), "nm", "qname").alias("rank"))
    best = pairs.groupBy("low", "high").agg(F.min("rank").alias("best"))
    paired = pairs.join(best, ["low", "high"]).select("qname", F.lit(True).alias("paired"), (F.col("rank") != F.col("best")).alias("worse"))
    held = rows.join(paired, "qname", "left").withColumn("in_pair", F.coalesce("paired", F.lit(False)) & F.col("mate").isin(1, 2))
    rank = F.struct(F.when(F.col("in_pair"), 0).otherwise(1).alias("single"), (-F.col("mapq")).alias("mapq"), "nm", "qname", "mate")
    held = held.withColumn("rank", rank)
    first = held.groupBy("chrom", "five", "strand").agg(F.min("rank").alias("best"))
    told = held.join(first, ["chrom", "five", "strand"]).withColumn("dup", F.when(F.col("in_pair"), F.col("worse")).otherwise(F.col("rank") != F.col("best")))
    dups = told.where("dup").select(*named).distinct().withColumn("_dup", F.lit(True))
    return a.join(dups, named, "left").select(*[a[c] for c in a.columns], F.coalesce("_dup", F.lit(False)).alias("is_dup"))


def variant_statistics(v: DataFrame, by: list[str] | None = None) -> DataFrame:
    """variants, snvs and the counts of the twelve substitutions, in one row or one for each value of `by`."""
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    pairs = [(x, y) for x in "ACGT" for y in "ACGT" if x != y]
    return v.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("variants"), F.count_if(snv).alias("snvs"), *[F.count_if(snv & (F.col("ref") == x) & (F.col("alt") == y)).alias(f"{x}_{y}") for x, y in pairs])


def variant_quantiles(v: DataFrame) -> DataFrame:
    """percent, nalt, fraction: quantiles in steps of 5 percent of ALT depth and ALT fraction of SNVs."""
    snv = v.where((F.length("ref") == 1) & (F.length("alt") == 1))
    q = snv.agg(R.quantiles(F.col("nalt"), 20).alias("n"), R.quantiles(F.col("nalt") / (F.col("nalt") + F.col("nref")), 20).alias("f"))
    return q.select(F.posexplode(F.arrays_zip("n", "f")).alias("i", "x")).select((F.col("i") * 5).alias("percent"), F.col("x.n").alias("nalt"), F.col("x.f").alias("fraction"))


def _marked(v: DataFrame, regions: DataFrame) -> DataFrame:
    """v with _hit: whether its position lies in a region. v is read once and stays one row a row; a bin holds its merged regions."""
    merged = merge_adjacent(regions.select("chrom", "start", "end"), ["chrom"])
    held = merged.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN)))).groupBy("chrom", "_bin").agg(F.collect_list(F.struct("start", "end")).alias("_held"))
    met = v.withColumn("_bin", F.floor(F.col("pos") / BIN)).join(held, ["chrom", "_bin"], "left")
    return met.select(*[v[c] for c in v.columns], F.coalesce(F.exists("_held", lambda r: F.col("pos").between(r["start"], r["end"])), F.lit(False)).alias("_hit"))


def outside(v: DataFrame, regions: DataFrame) -> DataFrame:
    """Variants at no position of the regions, whatever their strand."""
    return _marked(v, regions).where(~F.col("_hit")).drop("_hit")


def inside(v: DataFrame, regions: DataFrame) -> DataFrame:
    return _marked(v, regions).where("_hit").drop("_hit")


def tally(v: DataFrame) -> DataFrame:
    """chrom, pos, ref, alt, alt_depth, ref_depth, records: observations added up by site and allele."""
    return v.groupBy("chrom", "pos", "ref", "alt").agg(F.sum("nalt").alias("alt_depth"), F.sum("nref").alias("ref_depth"), F.count(F.lit(1)).alias("records"))


def bases(alignments: DataFrame, offset: int = 33, indels: bool = True) -> DataFrame:
    """chrom, pos, base, quality: each aligned base of usable records (chrom, pos, cigar, seq, qual, flag).

    With indels, an insertion is `+` and its bases at the position before it, a deletion `-` and
    its length at its first position; their quality is that of the read's base before them.
    """
    a = alignments.where(R.usable(F.col("flag"))).select("chrom", F.col("pos").alias("at"), "seq", "qual", F.explode(R.cigar_steps(F.col("cigar"))).alias("s")).select("chrom", "at", "seq", "qual", "s.*")
    quality = lambda i: (F.ascii(F.substr("qual", i, F.lit(1))) - offset).alias("quality")
    run = a.where(F.col("kind").isin("M", "=", "X")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    at = F.col("read") + F.col("i") + 1
    out = run.select("chrom", (F.col("at") + F.col("ref") + F.col("i")).cast("long").alias("pos"), F.substr("seq", at, F.lit(1)).alias("base"), quality(at))
    if not indels:
        return out
    ins = a.where("kind = 'I' and read > 0").select("chrom", (F.col("at") + F.col("ref") - 1).cast("long").alias("pos"), F.concat(F.lit("+"), F.substr("seq", F.col("read") + 1, F.col("size"))).alias("base"), quality(F.col("read")))
    gone = a.where("kind = 'D' and read > 0").select("chrom", (F.col("at") + F.col("ref")).cast("long").alias("pos"), F.concat(F.lit("-"), F.col("size").cast("string")).alias("base"), quality(F.col("read")))
    return out.unionByName(ins).unionByName(gone)


def base_counts(alignments: DataFrame, least_quality: int = 23, offset: int = 33, indels: bool = True) -> DataFrame:
    """chrom, pos, base, n: how often each of `bases` is there with quality least_quality at least.

    No base is a row: tasks count them in Arrow batches, and the counts are added up, dealt by position.
    """
    a = alignments.where(R.usable(F.col("flag"))).select("chrom", F.col("pos").cast("long").alias("pos"), "cigar", "seq", "qual").dropna(subset=["chrom", "pos", "cigar", "qual"])
    counted = a.mapInArrow(count_bases(least_quality, offset, indels), "chrom string, pos long, base string, n long")
    return counted.repartition("chrom", "pos").groupBy("chrom", "pos", "base").agg(F.sum("n").alias("n"))


def pileup(alignments: DataFrame, reference: DataFrame, least_quality: int = 23, indels: bool = True, mask: DataFrame | None = None, which: DataFrame | None = None) -> DataFrame:
    """chrom, pos, ref, alt, alt_depth, ref_depth, records: other bases than the reference's (chrom, pos, ref), of quality least_quality at least.

    records is the depth of all bases of that quality. Positions in the mask are left out; with
    `which` only positions in those regions count. Bases are added up before anything is joined,
    and a position's bases stay together, so the alignments are read once.
    """
    sites = base_counts(alignments, least_quality, indels=indels).groupBy("chrom", "pos").agg(F.collect_list(F.struct("base", "n")).alias("seen"))
    if mask is not None:
        sites = outside(sites, mask)
    if which is not None:
        sites = inside(sites, which)
    met = sites.join(reference.select("chrom", "pos", "ref"), ["chrom", "pos"])
    total = lambda test: F.aggregate(F.filter("seen", test), F.lit(0).cast("long"), lambda n, x: n + x["n"])
    plain = lambda x: ~F.substr(x["base"], F.lit(1), F.lit(1)).isin("+", "-")
    told = met.select("chrom", "pos", "ref", F.explode(F.filter("seen", lambda x: x["base"] != F.col("ref"))).alias("s"), total(lambda x: x["base"] == F.col("ref")).alias("ref_depth"), total(plain).alias("records"))
    return told.select("chrom", "pos", "ref", F.col("s.base").alias("alt"), F.col("s.n").alias("alt_depth"), "ref_depth", "records")


def _likelihood_ratio() -> Column:
    k, n = F.col("alt_depth"), F.col("alt_depth") + F.col("ref_depth")
    log = lambda p: k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    return log(0.2) > log(0.001)


#: Calling filters by name; each is a predicate on a tally.
CALLING_FILTERS = {"nonRef": lambda: F.col("alt") != F.col("ref"), "nonNRef": lambda: F.col("ref") != "N", "readCount": lambda: F.col("alt_depth") >= 2, "likelihoodRatio": _likelihood_ratio}


def call_variants(tallied: DataFrame, filters: tuple[str, ...] = tuple(CALLING_FILTERS)) -> DataFrame:
    return reduce(lambda df, name: df.where(CALLING_FILTERS[name]()), filters, tallied)


def neighbour_filter(calls: DataFrame, reach: int = 50, most: int = 20, whitelist: DataFrame | None = None) -> DataFrame:
    """Calls with at most `most` others within `reach` positions; whitelisted sites (chrom, pos, alt) stay.

    A chromosome is dealt into tiles; calls within reach of a tile's edge are counted in the next tile too.
    """
    width = max(TILE, 4 * reach)
    own, pos = F.floor(F.col("pos") / width), F.col("pos")
    dealt = calls.withColumn("_own", own).withColumn("_tile", F.explode(F.array_distinct(F.array(own, F.floor((pos - reach) / width), F.floor((pos + reach) / width)))))
    near = Window.partitionBy("chrom", "_tile").orderBy("pos").rangeBetween(-reach, reach)
    marked = dealt.withColumn("_n", F.count(F.lit(1)).over(near) - 1).where("_own = _tile").drop("_own", "_tile")
    if whitelist is None:
        return marked.where(F.col("_n") <= most).drop("_n")
    known = whitelist.select("chrom", "pos", "alt").distinct().withColumn("_known", F.lit(True))
    return marked.join(known, ["chrom", "pos", "alt"], "left").where((F.col("_n") <= most) | F.col("_known")).drop("_n", "_known")


#: Post-filters by name; each takes calls and a whitelist of sites (or None).
POST_FILTERS = {"avgNborCount": lambda calls, whitelist: neighbour_filter(calls, whitelist=whitelist)}


def post_filter(calls: DataFrame, filters: tuple[str, ...] = (), whitelist=None) -> DataFrame:
    """Calls that pass the named filters; `whitelist` is a function that reads the known sites, called only if a filter is named."""
    known = whitelist() if filters and whitelist else None
    return reduce(lambda df, name: POST_FILTERS[name](df, known), filters, calls)


def genotypes(calls: DataFrame, error: float = 0.001) -> DataFrame:
    """calls with gt, pl (0/0, 0/1, 1/1) and gq, from binomial likelihoods of the two depths."""
    k, n = F.col("alt_depth"), F.col("alt_depth") + F.col("ref_depth")
    log = lambda p: -10 * (k * F.log10(F.lit(p)) + (n - k) * F.log10(F.lit(1 - p)))
    raw = F.array(log(error), log(0.5), log(1 - error))
    pl = F.transform(raw, lambda x: F.round(x - F.array_min(raw)).cast("long"))
    best = F.array_position(raw, F.array_min(raw)).cast("int")
    return calls.withColumns({"pl": pl, "gt": F.element_at(F.array(F.lit("0/0"), F.lit("0/1"), F.lit("1/1")), best), "gq": F.array_sort(pl)[1]})


def concordance(v: DataFrame, key: str = "sample", least: float = 0.8) -> DataFrame:
    """a, b, shared, concordance, concordant: for each pair of samples the sites in common over those of the smaller one.

    Sites are grouped once and the samples of a site paired there: their number bounds the pairs.
    """
    sites = v.select(key, "chrom", "pos", "ref", "alt").distinct()
    sizes = sites.groupBy(F.col(key).alias("of")).agg(F.count(F.lit(1)).alias("n"))
    pair = F.struct(F.col("x").alias("a"), F.col("y").alias("b"))
    one, two = (sites.withColumnRenamed(key, c) for c in "xy")
    shared = one.join(two, ["chrom", "pos", "ref", "alt"]).where("x < y").groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("shared")).select("pair.*", "shared")
    every = sizes.select(F.col("of").alias("a"), F.col("n").alias("n_a")).join(sizes.select(F.col("of").alias("b"), F.col("n").alias("n_b")), F.col("a") < F.col("b"))  # samples, not sites
    ratio = F.coalesce("shared", F.lit(0)) / F.least("n_a", "n_b")
    return every.join(shared, ["a", "b"], "left").select("a", "b", F.coalesce("shared", F.lit(0)).cast("long").alias("shared"), ratio.alias("concordance"), (ratio >= least).alias("concordant"))


def single_gene_pieces(coding: DataFrame) -> DataFrame:
    """chrom, start, end, gene: disjoint pieces of coding exons that touch exactly one gene, strands ignored.

    One sweep: each gene's merged ranges add 1 and a code of the gene, so where one gene is, the
    sum of codes is its code; the exons themselves only cut.
    """
    genes = coding.select("gene").distinct().withColumn("code", F.xxhash64("gene").cast("decimal(20,0)"))
    merged = merge_adjacent(coding.select("gene", "chrom", "start", "end"), ["gene", "chrom"]).join(genes, "gene").select("chrom", "start", "end", F.lit(1).alias("one"), "code")
    cuts = coding.select("chrom", F.col("start").cast("long"), F.col("end").cast("long"), F.lit(0).alias("one"), F.lit(0).cast("decimal(20,0)").alias("code"))
    pieces = sweep(merged.unionByName(cuts), ["chrom"], {"genes": F.col("one"), "code": F.col("code")}, cut=True).where("genes = 1")
    return pieces.join(genes, "code").select("chrom", "start", "end", "gene")


def assert_same_keys(settings: DataFrame, version: str = "version") -> DataFrame:
    """settings (lane, key, value); a task fails if a lane lacks a key that another has, or if versions differ."""
    lanes = settings.agg(F.countDistinct("lane").alias("_lanes"))
    keys = settings.groupBy("key").agg(F.countDistinct("lane").alias("_in"), F.countDistinct("value").alias("_values")).join(F.broadcast(lanes))
    fault = F.when(F.col("_in") != F.col("_lanes"), F.concat(F.lit("some lane lacks "), F.col("key"))).when((F.col("key") == version) & (F.col("_values") > 1), F.lit("lanes of different versions"))
    checked = keys.select(F.when(fault.isNotNull(), F.raise_error(fault).cast("string")).otherwise(F.col("key")).alias("key"))
    return settings.join(checked, "key", "left_semi").select(*settings.columns)


def merge_settings(settings: DataFrame, ignored: tuple[str, ...] = ()) -> DataFrame:
    """key, value: one value for all lanes; of ignored keys the values are listed, other conflicts fail the task."""
    values = F.sort_array(F.collect_set("value"))
    merged = settings.groupBy("key").agg(values.alias("v"))
    listed = F.concat(F.lit("<merged>"), F.array_join("v", " "), F.lit("</merged>"))
    return merged.select("key", F.when(F.size("v") == 1, F.col("v")[0]).when(F.col("key").isin(*ignored) if ignored else F.lit(False), listed).otherwise(F.raise_error(F.concat(F.lit("lanes differ in "), F.col("key"))).cast("string")).alias("value"))
