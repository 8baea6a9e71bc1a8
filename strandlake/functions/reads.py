"""Column functions on bases, qualities, flags and CIGAR strings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lowest and highest ASCII code of each quality encoding, in order of preference.
ENCODINGS = (("solexa", 59, 104), ("illumina1.3", 64, 104), ("illumina1.5", 66, 105), ("illumina1.8", 33, 74), ("GATK-rescaled", 33, 83), ("sanger", 33, 73))
#: The tail character of the encodings whose tails are trimmed.
TAILS = {"illumina1.5": "B", "illumina1.8": "#", "GATK-rescaled": "#"}
#: Scores of a matching and a mismatching base under errors of 10^-2.2 on both sides, and the cutoff.
MATCH, MISMATCH, ADAPTER_CUTOFF = 1.981756130572634, -5.899285635529426, 13.87229
#: The protocol name of each encoding for the aligner.
PROTOCOLS = {"sanger": "sanger", "solexa": "illumina", "illumina1.3": "illumina", "illumina1.5": "illumina", "illumina1.8": "sanger", "GATK-rescaled": "sanger"}
#: The adapters of paired reads, mate 1 and mate 2, and of single reads.
PAIRED_1, PAIRED_2, SINGLE = "AGATCGGAAGAGCGGTTCAGCAGGAATGCCGAGACCG", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT", "AGATCGGAAGAGCTCGTATGCCGTCTTCTGCTTG"


def choose_adapter(paired: bool, force_paired: bool = False, mate: int = 1) -> str:
    """The adapter of a mate: single reads have their own, unless that of paired reads is asked for."""
    if paired:
        return {1: PAIRED_1, 2: PAIRED_2}[mate]
    return PAIRED_1 if force_paired else SINGLE


def protocol(encoding: Column) -> Column:
    """The aligner's name for a quality encoding; null for one that is not known."""
    return F.create_map(*[F.lit(x) for pair in PROTOCOLS.items() for x in pair])[encoding]


def quality_offset(encoding: str) -> int:
    return 64 if encoding in ("solexa", "illumina1.3", "illumina1.5") else 33


def truncate(c: Column, length: int | None = None, trim5: int = 0) -> Column:
    """Drop trim5 letters from the front, then cap the length; nothing is left of a shorter text."""
    return F.substr(c, F.lit(1 + trim5), F.lit(length if length is not None else 1 << 30))


def without_tail(qual: Column, least: str) -> Column:
    """The qualities without the run of characters up to `least` at the right end."""
    return F.regexp_replace(qual, r"[!-\x{%x}]+$" % ord(least), "")


def good_share(qual: Column, offset: int, least: int) -> Column:
    """Share of bases with a quality of at least `least`; null for no bases."""
    low = F.regexp_replace(qual, r"[^\x{%x}-\x{7e}]" % (offset + least), "")
    return F.when(F.length(qual) > 0, F.length(low) / F.length(qual))


def normal_id(c: Column, paired: bool = True) -> Column:
    """The read id without a mate suffix (paired only) and without what follows the first blank, in this order."""
    return F.regexp_replace(F.regexp_replace(c, "/[12]$", "") if paired else c, " .*$", "")


def adapter_scores(reads: list[str | None], adapter: str) -> np.ndarray:
    """The best ungapped overlap of each read with the adapter, over all diagonals; N matches nothing. 0 for no bases.

    Reads are rows of one byte matrix; each base of the adapter is compared with all of it at
    once, and its matches are added to the diagonals they lie on.
    """
    m, sizes = len(adapter), np.array([len(r or "") for r in reads], np.int64)
    width = int(sizes.max(initial=0))
    if not width:
        return np.zeros(len(reads))
    bases = np.frombuffer("".join((r or "").ljust(width, "N") for r in reads).encode("latin-1", "replace"), np.uint8).reshape(len(reads), width)
    same = np.zeros((len(reads), width + m - 1), np.int32)  # column d + m - 1: the adapter starts at base d
    for j, base in enumerate(adapter.encode()):
        if base != ord("N"):
            same[:, m - 1 - j : m - 1 - j + width] += bases == base
    d = np.arange(1 - m, width)
    overlap = np.minimum(sizes[:, None], d + m) - np.maximum(d, 0)
    scores = np.where(overlap > 0, same * MATCH + (overlap - same) * MISMATCH, -np.inf)
    return np.where(sizes > 0, scores.max(axis=1), 0.0)


def adapter_score(seq: Column, adapter: str) -> Column:
    """adapter_scores of a column, by Arrow batches: as an expression every base of every diagonal would be a call."""

    @F.pandas_udf("double")
    def score(reads: pd.Series) -> pd.Series:
        step = 4096
        return pd.Series(np.concatenate([adapter_scores(reads.iloc[i : i + step].tolist(), adapter) for i in range(0, len(reads), step)] or [np.zeros(0)]))

    return score(seq)


def is_first(flag: Column) -> Column:
    """Whether the record is of the first mate: the flag modulo 256 is under 128."""
    return flag % 256 < 128


def mate_number(flag: Column) -> Column:
    return F.when(is_first(flag), 1).otherwise(2)


def usable(flag: Column) -> Column:
    """Neither failing quality control nor a duplicate."""
    return (flag.bitwiseAND(512) == 0) & (flag.bitwiseAND(1024) == 0)


def _number(text: Column, pattern: str) -> Column:
    """The digits that a pattern's group takes, 0 where it takes none: a cast of an empty text would cost an exception a row, even as try_cast."""
    return F.concat(F.lit("0"), F.regexp_extract(text, pattern, 1)).try_cast("int")


def cigar_blocks(pos: Column, cigar: Column) -> Column:
    """The aligned blocks (start, end, closed): N parts blocks, M, D, = and X move on, other operations do not."""
    steps = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHPX=])"), F.lit(0))
    size, kind = (lambda s: F.regexp_extract(s, r"\d+", 0).cast("int")), (lambda s: F.right(s, F.lit(1)))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(pos.cast("int").alias("at"), pos.cast("int").alias("from"), empty.alias("out"))

    def step(s: Column, x: Column) -> Column:
        moves, gap = kind(x).isin("M", "D", "=", "X"), kind(x) == "N"
        at = F.when(moves | gap, s["at"] + size(x)).otherwise(s["at"])
        block = F.array(F.struct(s["from"].alias("start"), (s["at"] - 1).alias("end")))
        return F.struct(at.alias("at"), F.when(gap, at).otherwise(s["from"]).alias("from"), F.when(gap & (s["at"] > s["from"]), F.concat(s["out"], block)).otherwise(s["out"]).alias("out"))

    last = lambda s: F.when(s["at"] > s["from"], F.concat(s["out"], F.array(F.struct(s["from"].alias("start"), (s["at"] - 1).alias("end"))))).otherwise(s["out"])
    # most records are one run of matches, perhaps clipped, and need no fold
    only = _number(cigar, r"^(?:\d+[SH])*(\d+)[M=X](?:\d+[SH])*$")
    one = F.array(F.struct(pos.cast("int").alias("start"), (pos + only - 1).cast("int").alias("end")))
    return F.when(only > 0, one).otherwise(F.aggregate(steps, begin, step, last))


def five_prime(pos: Column, cigar: Column, strand: Column) -> Column:
    """Where a record's read begins, clipped bases put back: its first base on the plus strand, its last on the minus strand."""
    size = lambda pattern: F.coalesce(_number(cigar, pattern), F.lit(0))
    under = F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))
    ahead = size(r"^(\d+)S") + size(r"^(\d+)H") + size(r"^\d+H(\d+)S")
    behind = size(r"(\d+)S$") + size(r"(\d+)H$") + size(r"(\d+)S\d+H$")
    return F.when(strand == "-", pos + under - 1 + behind).otherwise(pos - ahead)


def cigar_steps(cigar: Column) -> Column:
    """The operations in order as (kind, size, read, ref): where each begins in the read's bases and on the reference, from 0."""
    steps = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHPX=])"), F.lit(0))
    start = F.struct(F.lit(0).alias("read"), F.lit(0).alias("ref"), F.array().cast("array<struct<kind:string,size:int,read:int,ref:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        kind, size = F.right(x, F.lit(1)), F.regexp_extract(x, r"\d+", 0).cast("int")
        one = F.struct(kind.alias("kind"), size.alias("size"), s["read"].alias("read"), s["ref"].alias("ref"))
        return F.struct((s["read"] + F.when(kind.isin("M", "I", "S", "=", "X"), size).otherwise(0)).alias("read"), (s["ref"] + F.when(kind.isin("M", "D", "N", "=", "X"), size).otherwise(0)).alias("ref"), F.concat(s["out"], F.array(one)).alias("out"))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def resize(start: Column, end: Column, strand: Column, width: int) -> tuple[Column, Column]:
    """The range set to a width, held at its 5' end."""
    back = strand == "-"
    return F.when(back, end - width + 1).otherwise(start), F.when(back, end).otherwise(start + width - 1)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def quantiles(c: Column, steps: int) -> Column:
    """Exact quantiles at steps + 1 even places, with linear interpolation."""
    return F.percentile(c, F.array(*[F.lit(i / steps) for i in range(steps + 1)]))
