"""Quality of runs: funnels, summary matrices, normalised shares, threshold calls and checks before lanes are merged.

A summary is a table (run, name, value); a matrix has one row a run and one column a name.
Columns are chosen by name in plain Python, everything else is one projection over a matrix.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds of summaries a run has.
KINDS = ("preprocess", "alignment", "variants", "counts", "analyzed_bamstats", "target_lengths")
#: The tests whose failure fails a run, for RNA and for other sequencing; the other tests only warn.
FAIL_RNA = ("inOutLenEqual", "analyzed", "geneReadsPerc", "junctionReads")
FAIL_OTHER = (*FAIL_RNA, "cigarWithS", "mtReads", "targetBin591")
#: Marks of contigs that have no place on a chromosome.
UNPLACED = "GL|KI|NT|JH"


def columns_like(df: DataFrame, pattern: str, without: str | None = None) -> list[str]:
    """The columns whose names hold the pattern, and not the other one."""
    return [c for c in df.columns if re.search(pattern, c) and not (without and re.search(without, c))]


def placed(names: list[str], pattern: str = UNPLACED) -> list[str]:
    """The names without those of unplaced contigs, if there is more than one of these."""
    odd = [n for n in names if re.search(pattern, n)]
    return [n for n in names if n not in odd] if len(odd) > 1 else names


def first_available(df: DataFrame, *names: str) -> Column:
    """The first of these columns that the table has."""
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        raise ValueError(f"none of {', '.join(names)}")
    return F.col(f"`{found}`")


def _sum(names: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in names], F.lit(0))


def runs_matrix(summary: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row a run, one column a name of (run, name, value)."""
    return summary.groupBy("run").pivot("name", names).agg(F.sum("value"))


def as_summary(wide: DataFrame, by: str = "run") -> DataFrame:
    """run, name, value: every other column of a table as rows."""
    names = [c for c in wide.columns if c != by]
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return wide.select(F.col(by).alias("run"), F.inline(pairs))


def summary_matrices(summaries: dict[str, DataFrame], names: dict[str, list[str]]) -> dict[str, DataFrame]:
    """A matrix for each kind of summary; kinds that are missing are left out. A task fails where a kind has another number of runs."""
    unknown = set(summaries) - set(KINDS)
    if unknown:
        raise ValueError(f"no such summary: {', '.join(sorted(unknown))}")
    counts = [s.agg(F.countDistinct("run").alias("runs")) for s in summaries.values()]
    span = reduce(DataFrame.union, counts).agg(F.min("runs").alias("_a"), F.max("runs").alias("_b"))
    same = F.when(F.col("_a") == F.col("_b"), F.col("run")).otherwise(F.raise_error(F.lit("summaries of different numbers of runs")).cast("string"))
    return {kind: runs_matrix(s, names.get(kind)).join(F.broadcast(span)).withColumn("run", same).drop("_a", "_b") for kind, s in summaries.items()}


def run_ratios(matrix: DataFrame, parts: list[str], whole: str) -> DataFrame:
    return matrix.select("run", *[F.round(F.col(c) * 100 / F.col(whole), 4).alias(f"{c}_pct") for c in parts])


def with_totals(reads: DataFrame) -> DataFrame:
    """A matrix of read counts with mult_mapping, unpaired_mapping and half_mapping: sums of the columns of these kinds."""
    kinds = {"mult_mapping": "_mult", "unpaired_mapping": "unpaired_", "half_mapping": "halfmapping_"}
    return reads.withColumns({name: _sum(columns_like(reads, pattern)) for name, pattern in kinds.items()})


def normalised(reads: DataFrame, wholes: dict[str, str] | None = None) -> DataFrame:
    """run and every count in percent of total, processed and analyzed reads, as `name/total` and so on."""
    wholes = wholes or {"total": "total_reads", "processed": "processed_reads", "analyzed": "analyzed"}
    names = [c for c in reads.columns if c != "run"]
    return reads.select("run", *[(F.col(f"`{c}`") / F.nullif(F.col(f"`{whole}`"), F.lit(0)) * 100).alias(f"{c}/{kind}") for kind, whole in wholes.items() for c in names])


def bam_shares(stats: DataFrame) -> DataFrame:
    """run, nm2plus, target_length_bin_591, junction_reads, with_s_pct and, if there is such a chromosome, mt_pct, in percent.

    stats: a matrix with nm_0 .. nm_8, bins target_length_bin_N, with_n, with_s, mapped and chromosome_bin_NAME.
    """
    nm, bins = columns_like(stats, r"^nm_\d+$"), columns_like(stats, r"^target_length_bin_")
    share = lambda part, whole: part * 100.0 / F.nullif(whole, F.lit(0))
    out = {
        "nm2plus": share(_sum(nm) - _sum(["nm_0", "nm_1"]), _sum(nm)),
        "target_length_bin_591": share(F.col("target_length_bin_591"), _sum(bins)),
        "junction_reads": share(F.col("with_n"), F.col("mapped")),
        "with_s_pct": F.round(share(F.col("with_s"), F.col("mapped")), 2),
    }
    if "chromosome_bin_MT" in stats.columns:
        out["mt_pct"] = F.round(share(F.col("chromosome_bin_MT"), F.col("mapped")), 2)
    return stats.select("run", *[c.alias(n) for n, c in out.items()])


def selected_stats(stats: DataFrame, names: list[str]) -> DataFrame:
    """run, name, value, percent: chosen alignment statistics and their share of the mapped records."""
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return stats.select("run", "mapped", F.inline(rows)).select("run", "name", "value", F.round(F.col("value") * 100 / F.nullif(F.col("mapped"), F.lit(0)), 2).alias("percent"))


def lengths_equal(preprocess: DataFrame) -> DataFrame:
    """run, in_out_len_equal: processed reads have one length, and it is the median of all runs' least lengths."""
    middle = preprocess.agg(F.percentile("processed_min_read_length", 0.5).alias("_middle"))
    low, high = F.col("processed_min_read_length"), F.col("processed_max_read_length")
    return preprocess.join(F.broadcast(middle)).select("run", ((low == high) & (low == F.col("_middle"))).alias("in_out_len_equal"))


def genes_detected(counts: DataFrame) -> DataFrame:
    """run, genes_detected: genes with reads, in thousands, from a matrix with gene_nbfeatures."""
    return counts.select("run", (F.col("gene_nbfeatures") / 1000).alias("genes_detected"))


def read_funnel(preprocess: DataFrame, alignment: DataFrame, by: str = "run") -> DataFrame:
    """by, step, name, n, percent: eleven rows from all reads to the analyzed ones, in percent of all.

    preprocess: a summary in wide form; alignment: a matrix of reads by category, with nomapping and analyzed.
    """
    kinds = {"Uniquely": "uniq", "Multiple": "mult", "Translocation": "transloc"}
    sums = [_sum(columns_like(alignment, k)).alias(f"_{name}") for name, k in kinds.items()]
    both = preprocess.join(alignment.select(by, "nomapping", "analyzed", *sums), by)
    steps = {  # fixed values: the names of the steps
        "Total": "total_reads", "High-Qual": "highqual_reads", "Adapter contam": "adapter_contam", "rRNA reads": "rRNA_contam_reads", "Post-preprocess": "processed_reads",
        "Mapped": None, "Uniquely": "_Uniquely", "Multiple": "_Multiple", "Translocation": "_Translocation", "Unmapped": "nomapping", "Analyzed": "analyzed",
    }
    value = lambda c: (F.col("processed_reads") - F.col("nomapping")) if c is None else F.col(c)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("name"), value(c).cast("long").alias("n")) for i, (name, c) in enumerate(steps.items())])
    return both.select(by, "total_reads", F.inline(rows)).select(by, "step", "name", "n", F.round(F.col("n") * 100.0 / F.col("total_reads"), 2).alias("percent"))


def sanity_checks(preprocess: DataFrame, alignment: DataFrame, by: str = "run") -> DataFrame:
    """by, complete, more_unique: all processed reads have a category (`analyzed` is none), and more are unique than multiple."""
    categories = [c for c in alignment.columns if c not in (by, "analyzed")]
    both = preprocess.select(by, "processed_reads").join(alignment, by)
    return both.select(by, (_sum(categories) == F.col("processed_reads")).alias("complete"), (_sum(columns_like(alignment, "uniq")) > _sum(columns_like(alignment, "mult"))).alias("more_unique"))


def threshold_calls(qc: DataFrame, limits: dict[str, float], technology: str) -> DataFrame:
    """run and one column a test, true where it fails.

    qc: a matrix with counts, normalised counts, the shares of bam_shares and in_out_len_equal.
    For RNA too few junction reads are a fault, for other sequencing too many, and insert
    sizes of 591 and more are looked at. Tests on columns that are missing are left out.
    """
    col = lambda c: F.col(f"`{c}`")
    below = {"goodReads": "total_reads", "analyzed": "analyzed", "analyzedPerc": "analyzed/total", "geneReadsPerc": "gene_nbreads/analyzed", "geneExonicReadsPerc": "gene_exonic_nbreads/analyzed", "highQualPct": "highqual_reads/total"}
    above = {"cigarWithS": "with_s_pct", "mtReads": "mt_pct", "nonMappingPct": "nomapping/processed"}
    if technology == "RNASeq":
        below["junctionReads"] = "junction_reads"
    else:
        above |= {"junctionReads": "junction_reads", "targetBin591": "target_length_bin_591"}
    tests = {t: col(c) < limits[t] for t, c in below.items() if c in qc.columns} | {t: col(c) > limits[t] for t, c in above.items() if c in qc.columns}
    tests["concordantUniq"] = first_available(qc, "concordant_uniq", "unpaired_uniq") < limits["concordantUniq"]
    tests["concordantUniqPerc"] = first_available(qc, "concordant_uniq/processed", "unpaired_uniq/processed") < limits["concordantUniqPerc"]
    tests["inOutLenEqual"] = ~F.col("in_out_len_equal")
    return qc.select("run", *[t.alias(n) for n, t in sorted(tests.items())])


def final_calls(calls: DataFrame, technology: str) -> DataFrame:
    """calls with final (a test that matters failed), failed and warnings: names joined by commas, in column order."""
    matter = FAIL_RNA if technology == "RNASeq" else FAIL_OTHER
    tests = [c for c in calls.columns if c != "run"]
    fails = [c for c in matter if c in tests]
    named = lambda names: F.array_join(F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in names])), ",")
    failed = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in fails], F.lit(False))
    return calls.withColumns({"final": failed, "failed": named(fails), "warnings": named([c for c in tests if c not in fails])})


def quality_calls(ratios: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """run, each test (true: failed), failing (names joined by commas) and final (any failed)."""
    tests = {c: (F.col(c) < x if way == "<" else F.col(c) > x) for c, (way, x) in limits.items()}
    failing = F.array_join(F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in tests.items()])), ",")
    return ratios.select("run", *[t.alias(c) for c, t in tests.items()], failing.alias("failing"), reduce(lambda a, b: a | b, tests.values()).alias("final"))


def assert_mergeable(preprocess: DataFrame, concordance: DataFrame | None = None) -> DataFrame:
    """preprocess; a task fails if the lanes' longest processed reads differ, or if two lanes are not concordant."""
    spread = preprocess.agg(F.min("processed_max_read_length").alias("_a"), F.max("processed_max_read_length").alias("_b"))
    met = preprocess.join(F.broadcast(spread))
    fault = F.when(~F.col("_a").eqNullSafe(F.col("_b")), F.lit("read lengths of lanes differ"))
    if concordance is not None:
        met = met.join(F.broadcast(concordance.agg(F.count_if(~F.col("concordant")).alias("_odd"))))
        fault = fault.when(F.col("_odd") > 0, F.lit("lanes are not concordant"))
    checked = F.when(fault.isNotNull(), F.raise_error(fault).cast("string")).otherwise(F.col("run").cast("string"))
    return met.withColumn("run", checked.cast(dict(preprocess.dtypes)["run"])).select(*preprocess.columns)
