"""Realignment around insertions and deletions, region by region.

An aligner sees one read at a time, and rather gives a read that ends soon after an indel a few
mismatches than a gap. Indels that other reads do show are collected, those of several
reads make target regions, and every read on a region is laid without gaps along the
reference as each indel of the region would leave it. What counts is the sum of the qualities of
mismatching bases; the indel that lowers it most over all reads of a region is believed, if by
enough, and the reads it serves get its place and CIGAR.

Everything is keyed by read, by tile of the reference or by region; no step is keyed by chromosome.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.reads import usable
from strandlake.operators.gapped import TILE, cut_tiles
from strandlake.operators.intervals import left_side, merge_adjacent, overlap_join, right_side

#: Reads that must show an indel for it to be tried; bases around it that its region takes in.
LEAST, AROUND = 2, 20
#: By how much an indel must lower the summed quality of mismatches of its region: a likelihood ratio of 10**5.
GAIN = 50
#: Bases of the reference beside a read that is to be laid anew.
BESIDE = 40
_OPS = re.compile(r"(\d+)([MIDS=X])")


def _spanned(cigar: Column) -> Column:
    """Bases of the reference under a record."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))


def _with_windows(rows: DataFrame, tiles: DataFrame, beside: int = BESIDE) -> DataFrame:
    """rows (chrom, pos, end) with `first`, from 0, and `window`, the reference's bases from there to `beside` bases after the end."""
    first = F.greatest(F.col("pos") - 1 - beside, F.lit(0)).cast("long")
    placed = rows.withColumn("first", first).withColumn("tile", F.floor(F.col("first") / TILE))
    met = placed.join(tiles.select("chrom", "tile", "part"), ["chrom", "tile"])
    return met.withColumn("window", F.substr("part", (F.col("first") - F.col("tile") * TILE + 1).cast("int"), (F.col("end") + beside - F.col("first")).cast("int"))).drop("part", "tile")


def shifted_left(at: int, gone: int, added: str, window: str, first: int) -> tuple[int, str]:
    """The furthest left of the equal ways to write an indel before base `at`: gone bases deleted, or some added."""
    while at - first > 0:
        last = added[-1] if added else window[at - first + gone - 1] if at - first + gone <= len(window) else ""
        if window[at - first - 1] != last:
            break
        added = last + added[:-1] if added else ""
        at -= 1
    return at, added


def indel_events(alignments: DataFrame, tiles: DataFrame) -> DataFrame:
    """chrom, at (from 0), gone, added, reads: the indels that records show, furthest left, and how many do."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chrom, pos, cigar, seq, first, window, many in zip(*(batch.column(c).to_pylist() for c in ("chrom", "pos", "cigar", "seq", "first", "window", "many"))):
                read, at = 0, pos - 1
                for n, op in _OPS.findall(cigar):
                    n = int(n)
                    if op in "ID":
                        place, added = shifted_left(at, n if op == "D" else 0, seq[read : read + n] if op == "I" else "", window, first)
                        rows.append((chrom, place, n if op == "D" else 0, added, many))
                    read += n * (op in "MIS=X")
                    at += n * (op in "MD=X")
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], names=["chrom", "at", "gone", "added", "many"])

    # records that show an indel alike are counted before their windows are fetched; bases matter to insertions only
    alike = ["chrom", "pos", "end", "cigar", F.when(F.col("cigar").contains("I"), F.col("seq")).otherwise("").alias("seq")]
    gapped = alignments.where(F.col("cigar").rlike("[ID]")).groupBy(*alike).agg(F.count("*").alias("many"))
    found = _with_windows(gapped, tiles).select("chrom", "pos", "cigar", "seq", "first", "window", "many").mapInArrow(find, "chrom string, at long, gone int, added string, many long")
    return found.groupBy("chrom", "at", "gone", "added").agg(F.sum("many").alias("reads"))


def _core(cigar: str, seq: str, qual: str) -> tuple[str, str, str, str]:
    """The clips at both ends, and the bases and qualities between them."""
    ops = _OPS.findall(cigar)
    left = int(ops[0][0]) if ops and ops[0][1] == "S" else 0
    right = int(ops[-1][0]) if len(ops) > 1 and ops[-1][1] == "S" else 0
    return f"{left}S" if left else "", f"{right}S" if right else "", seq[left : len(seq) - right], qual[left : len(qual) - right]


def mismatch_sum(pos: int, cigar: str, seq: str, qual: np.ndarray, window: str, first: int) -> int:
    """The summed quality of the aligned bases that differ from the reference; a base beyond the window differs."""
    read, at, total = 0, pos - 1 - first, 0
    for n, op in _OPS.findall(cigar):
        n = int(n)
        if op in "M=X":
            under = window[at : at + n]
            if under == seq[read : read + n] and len(under) == n:
                read, at = read + n, at + n
                continue
            total += sum(int(qual[read + i]) for i in range(n) if i >= len(under) or seq[read + i] != under[i])
        read += n * (op in "MIS=X")
        at += n * (op in "MD=X")
    return total


def laid_along(seq: str, qual: np.ndarray, window: str, first: int, at: int, gone: int, added: str, near: int) -> tuple[int, int, str] | None:
    """The least mismatch sum of bases along the reference with one indel, with place (from 1) and CIGAR; of equal ones the nearest to `near`."""
    b, n, extra = at - first, len(seq), len(added)
    if b < 0 or b + gone > len(window):
        return None
    changed = np.frombuffer((window[:b] + added + window[b + gone :]).encode(), np.uint8)
    if len(changed) < n or not n:
        return None
    differs = np.lib.stride_tricks.sliding_window_view(changed, n) != np.frombuffer(seq.encode(), np.uint8)
    sums = differs @ qual
    offsets = np.arange(len(sums))
    starts = np.where(offsets < b, offsets, np.where(offsets >= b + extra, offsets + gone - extra, b)) + first + 1
    o = int(np.lexsort((offsets, np.abs(starts - near), sums))[0])
    ahead, inside = max(0, min(n, b - o)), max(0, min(o + n, b + extra) - max(o, b))
    behind = n - ahead - inside
    if gone and ahead and behind:
        cigar = f"{ahead}M{gone}D{behind}M"
    elif inside and ahead and behind:
        cigar = f"{ahead}M{inside}I{behind}M"
    else:  # a read that begins or ends within added bases has them clipped
        clip = f"{inside}S" if inside else ""
        cigar = (clip if not ahead else "") + f"{ahead + behind}M" + (clip if ahead else "") if ahead + behind else ""
    return (int(sums[o]), int(starts[o]), cigar) if cigar else None


def _scored(ids: list[str], offset: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {c: batch.column(c).to_pylist() for c in ("pos", "cigar", "seq", "qual", "first", "window", "events")}
            rows, source = [], []
            for i in range(batch.num_rows):
                pos, cigar, first, window = (table[c][i] for c in ("pos", "cigar", "first", "window"))
                left, right, seq, letters = _core(cigar, table["seq"][i], table["qual"][i])
                qual = np.frombuffer(letters.encode(), np.uint8).astype(np.int64) - offset
                before = mismatch_sum(pos, re.sub(r"^\d+S|\d+S$", "", cigar), seq, qual, window, first)
                for e in table["events"][i] if before else ():
                    laid = laid_along(seq, qual, window, first, e["at"], e["gone"], e["added"], pos)
                    if laid and laid[0] < before:
                        rows.append((e["at"], e["gone"], e["added"], before - laid[0], laid[1], _joined(left, laid[2], right)))
                        source.append(i)
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            kept = [batch.column(c).take(pa.array(source, pa.int64())) for c in [*ids, "chrom", "region"]]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*ids, "chrom", "region", "at", "gone", "added", "better", "new_pos", "new_cigar"])

    return score


def _joined(left: str, cigar: str, right: str) -> str:
    """CIGAR parts as one, with clips that meet added up."""
    ops: list[list] = []
    for n, op in _OPS.findall(left + cigar + right):
        if ops and ops[-1][1] == op:
            ops[-1][0] += int(n)
        else:
            ops.append([int(n), op])
    return "".join(f"{n}{op}" for n, op in ops)


def realign_indels(alignments: DataFrame, references: DataFrame, ids: tuple[str, ...] = ("qname", "mate"), least: int = LEAST, gain: int = GAIN, offset: int = 33) -> DataFrame:
    """alignments with new pos and cigar where a region's indel explains a record better, and realigned.

    alignments: the ids (unique together), chrom, pos (from 1), cigar, seq, qual, flag, and whatever else;
    references: chrom, ref. Records with introns or hard clips, unusable ones, ones without bases and
    ones with a null id stay as they are and show no indel. Clipped bases take no part and stay clipped.
    A record on two regions goes by the one that serves it better.
    """
    tiles = cut_tiles(references)
    plain = F.coalesce(usable(F.col("flag")) & F.col("cigar").rlike(r"^(\d+[MIDS=X])+$") & (F.length("seq") == F.length("qual")) & (F.length("seq") > 0), F.lit(False))
    reads = alignments.where(plain).select(*ids, "chrom", F.col("pos").cast("long").alias("pos"), (F.col("pos") + _spanned(F.col("cigar")) - 1).cast("long").alias("end"), "cigar", "seq", "qual")
    events = indel_events(reads, tiles).where(F.col("reads") >= least).select("chrom", "at", "gone", "added")
    regions = merge_adjacent(events.select("chrom", (F.col("at") + 1 - AROUND).alias("start"), (F.col("at") + F.col("gone") + AROUND).alias("end")), ["chrom"])
    named = overlap_join(left_side(events.withColumns({"start": F.col("at") + 1, "end": F.col("at") + 1})), right_side(regions))
    tried = named.groupBy("chrom", F.col("r_start").alias("region")).agg(F.sort_array(F.collect_set(F.struct("at", "gone", "added"))).alias("events"))
    over = overlap_join(left_side(reads.withColumn("start", F.col("pos"))), right_side(regions)).select(*ids, "chrom", "pos", F.col("l_end").alias("end"), "cigar", "seq", "qual", F.col("r_start").alias("region"))
    held = _with_windows(over, tiles).join(tried, ["chrom", "region"])
    kinds = ", ".join(f"`{c}` {reads.schema[c].dataType.simpleString()}" for c in ids)
    scored = held.select(*ids, "chrom", "region", "pos", "cigar", "seq", "qual", "first", "window", "events").mapInArrow(
        _scored(list(ids), offset), f"{kinds}, chrom string, region long, at long, gone int, added string, better long, new_pos long, new_cigar string"
    )
    scored = scored.repartition("chrom", "region")  # one exchange for the sums and for the records they are given to
    sums = scored.groupBy("chrom", "region", "at", "gone", "added").agg(F.sum("better").alias("sum"))
    best = sums.where(F.col("sum") >= gain).groupBy("chrom", "region").agg(F.max_by(F.struct("at", "gone", "added"), F.struct("sum", -F.col("at"), "gone", "added")).alias("b")).select("chrom", "region", "b.*")
    served = scored.join(best, ["chrom", "region", "at", "gone", "added"])
    changed = served.groupBy(*ids).agg(F.max_by(F.struct("new_pos", "new_cigar"), F.struct("better", "region")).alias("new"))
    told = alignments.join(changed, list(ids), "left")
    kind = alignments.schema["pos"].dataType
    values = {"pos": F.coalesce(F.col("new.new_pos").cast(kind), F.col("pos")), "cigar": F.coalesce(F.col("new.new_cigar"), F.col("cigar")), "realigned": F.col("new").isNotNull()}
    return told.withColumns(values).select(*alignments.columns, "realigned")
