"""Read preprocessing: trimming, quality, adapters, contamination, sampling and summaries. A pair is one row."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions import reads as R
from strandlake.sources.files import shared_folder


def _mates(df: DataFrame) -> list[str]:
    return [m for m in ("1", "2") if f"seq{m}" in df.columns]


def trim_reads(df: DataFrame, length: int | None = None, trim5: int = 0) -> DataFrame:
    """Bases and qualities of every mate without the first trim5 letters, at most `length` long."""
    return df.withColumns({f"{part}{m}": R.truncate(F.col(f"{part}{m}"), length, trim5) for m in _mates(df) for part in ("seq", "qual")})


def trim_tails(df: DataFrame, least: str = "#") -> DataFrame:
    """Every mate without its run of qualities up to `least` at the right end."""
    for m in _mates(df):
        kept = R.without_tail(F.col(f"qual{m}"), least)
        df = df.withColumns({f"qual{m}": kept, f"seq{m}": F.substr(F.col(f"seq{m}"), F.lit(1), F.length(kept))})
    return df


def every_mate(df: DataFrame, test) -> Column:
    """test(mate) for all mates; a null mate (single reads) does not count."""
    out = F.lit(True)
    for m in _mates(df):
        out = out & F.coalesce(test(m), F.lit(False) if m == "1" else F.col(f"seq{m}").isNull())
    return out


def filter_length(df: DataFrame, least: int = 12) -> DataFrame:
    return df.where(every_mate(df, lambda m: F.length(f"seq{m}") >= least))


def filter_quality(df: DataFrame, encoding: str = "sanger", least: int = 23, share: float = 0.7, min_length: int = 1) -> DataFrame:
    """Tails trimmed as the encoding asks, then reads long enough with more than `share` of bases of quality `least`."""
    if encoding in R.TAILS:
        df = trim_tails(df, R.TAILS[encoding])
    df = filter_length(df, min_length)
    return df.where(every_mate(df, lambda m: R.good_share(F.col(f"qual{m}"), R.quality_offset(encoding), least) > share))


def detect_encoding(df: DataFrame, first: int = 5000) -> DataFrame:
    """encoding, rank: those whose range holds every quality character of the first reads, by id."""
    codes = df.orderBy("id").limit(first).select(F.explode(F.split("qual1", "")).alias("c")).where("c != ''").agg(F.min(F.ascii("c")).alias("lo"), F.max(F.ascii("c")).alias("hi"))
    known = df.sparkSession.createDataFrame([(i, *e) for i, e in enumerate(R.ENCODINGS)], "rank int, encoding string, low int, high int")
    return known.join(F.broadcast(codes), (F.col("lo") >= F.col("low")) & (F.col("hi") <= F.col("high"))).select("encoding", "rank")


def flag_adapters(df: DataFrame, adapter1: str, adapter2: str | None = None, cutoff: float = R.ADAPTER_CUTOFF) -> DataFrame:
    """Add `adapter`: every mate overlaps its adapter with a score over the cutoff. No row is dropped."""
    one = R.adapter_score(F.col("seq1"), adapter1) > cutoff
    return df.withColumn("adapter", one & (R.adapter_score(F.col("seq2"), adapter2) > cutoff) if adapter2 else one)


def flag_contaminated(df: DataFrame, ids: DataFrame, paired: bool = True) -> DataFrame:
    """Add `rrna`: the read's normalised id is among ids(id)."""
    bad = ids.select(F.col("id").alias("_bad")).distinct()
    met = df.withColumn("_key", R.normal_id(F.col("id"), paired)).join(bad, F.col("_key") == F.col("_bad"), "left")
    return met.withColumn("rrna", F.col("_bad").isNotNull()).drop("_key", "_bad")


def remove_contaminated(df: DataFrame, ids: DataFrame, paired: bool = True) -> DataFrame:
    """Reads whose normalised id is not among ids(id)."""
    return flag_contaminated(df, ids, paired).where("not rrna").drop("rrna")


def assert_all_matched(df: DataFrame, ids: DataFrame, paired: bool = True) -> DataFrame:
    """ids; a task fails on one that no read has."""
    have = df.select(R.normal_id(F.col("id"), paired).alias("_have")).distinct()
    met = ids.join(have, F.col("id") == F.col("_have"), "left")
    return met.select(F.when(F.col("_have").isNotNull(), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("no read has the id "), F.col("id"))).cast("string")).alias("id"))


def assert_unique_ids(df: DataFrame) -> DataFrame:
    """df; a task fails on an id that occurs twice."""
    counted = df.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    checked = counted.select(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicated read id "), F.col("id"))).cast("string")).otherwise(F.col("id")).alias("id"))
    return df.join(checked, "id", "left_semi")


def subsample(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """Exactly n rows (all if there are fewer): those with the least MD5 of their key, the same in every run."""
    return df.withColumn("_h", F.md5(F.col(key).cast("string"))).orderBy("_h", key).limit(n).drop("_h")


def preprocess(df: DataFrame, encoding: str = "sanger", least: int = 23, share: float = 0.7, min_length: int = 1, trim: tuple[int | None, int] | None = None, adapters: tuple[str, str | None] | None = None, contaminated: DataFrame | None = None, paired: bool = True) -> DataFrame:
    """Every read, trimmed, with what each step says of it: input_shortest, input_longest, first_length, highqual, adapter, rrna, processed.

    The order is: cut to length (trim: length, trim5), tails and quality, adapters among the good
    ones (flagged, not removed), contaminated ids among the good ones (removed). A step that is
    left out flags nothing, but without a quality step (encoding None) all reads go on and none is
    counted as of high quality.
    """
    lengths = [F.length(f"seq{m}").cast("long") for m in _mates(df)]
    shortest, longest = (F.least(*lengths), F.greatest(*lengths)) if len(lengths) > 1 else (lengths[0], lengths[0])
    df = df.withColumns({"input_shortest": shortest, "input_longest": longest, "first_length": lengths[0]})
    if trim:
        df = trim_reads(df, *trim)
    if encoding:
        if encoding in R.TAILS:
            df = trim_tails(df, R.TAILS[encoding])
        good = every_mate(df, lambda m: (F.length(f"seq{m}") >= min_length) & (R.good_share(F.col(f"qual{m}"), R.quality_offset(encoding), least) > share))
        df = df.withColumns({"highqual": good, "processed": good})
    else:
        df = df.withColumns({"highqual": F.lit(False), "processed": F.lit(True)})
    df = flag_adapters(df, *adapters) if adapters else df.withColumn("adapter", F.lit(False))
    df = df.withColumn("adapter", F.col("adapter") & F.col("processed"))
    df = flag_contaminated(df, contaminated, paired) if contaminated is not None else df.withColumn("rrna", F.lit(False))
    return df.withColumn("rrna", F.col("rrna") & F.col("processed")).withColumn("processed", F.col("processed") & ~F.col("rrna"))


#: The rows of a preprocessing summary, in order.
SUMMARY = ["total_reads", "read_length", "input_min_read_length", "input_max_read_length", "highqual_reads", "adapter_contam", "rRNA_contam_reads", "processed_min_read_length", "processed_max_read_length", "processed_reads"]


def summary(marked: DataFrame, by: list[str]) -> DataFrame:
    """by and SUMMARY, from the rows of `preprocess`, in one pass; read_length is that of the read of the least id. No reads: no row."""
    lengths = [F.length(f"seq{m}").cast("long") for m in _mates(marked)]
    shortest, longest = (F.least(*lengths), F.greatest(*lengths)) if len(lengths) > 1 else (lengths[0], lengths[0])
    kept = lambda c: F.when(F.col("processed"), c)
    out = marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_reads"), F.min_by("first_length", "id").alias("read_length"), F.min("input_shortest").alias("input_min_read_length"), F.max("input_longest").alias("input_max_read_length"),
        F.count_if("highqual").alias("highqual_reads"), F.count_if("adapter").alias("adapter_contam"), F.count_if("rrna").alias("rRNA_contam_reads"),
        F.min(kept(shortest)).alias("processed_min_read_length"), F.max(kept(longest)).alias("processed_max_read_length"), F.count_if("processed").alias("processed_reads"),
    )
    return out.select(*by, *SUMMARY)


def merge_summaries(parts: DataFrame, order: str = "run") -> DataFrame:
    """One row for all lanes: counts add up, the least and the largest lengths stay, read_length is that of the first lane that has one."""
    how = lambda c: F.min(c) if "_min_" in c else F.max(c) if "_max_" in c else F.sum(c)
    return parts.agg(*[(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))) if c == "read_length" else how(c)).alias(c) for c in SUMMARY])


def effective_length(read_length: Column, trim_length: Column | None) -> Column:
    """The read length after trimming; without a trim length it stays."""
    return read_length if trim_length is None else F.least(read_length, trim_length)


def length_table(df: DataFrame, c: str) -> DataFrame:
    """The values of a column with their counts and shares in percent."""
    counts, total = df.groupBy(c).agg(F.count(F.lit(1)).alias("n")), df.agg(F.count(F.lit(1)).alias("_all"))
    return counts.join(F.broadcast(total)).select(c, "n", (F.col("n") * 100.0 / F.col("_all")).alias("percent"))


def first_chunks(df: DataFrame, chunk_size: int, most: int, record: str = "record") -> DataFrame:
    """The reads of the first `most` chunks of chunk_size records, by record number from 0: a filter, no sort."""
    return df.where(F.col(record) < chunk_size * most)


def per_cycle(df: DataFrame, offset: int = 33, mate: int = 1) -> DataFrame:
    """cycle, n, mean_quality, A, C, G, T: base counts and quality by position of a mate."""
    at = df.select(F.posexplode(F.split(f"seq{mate}", "")).alias("p", "base"), F.col(f"qual{mate}").alias("qual")).where("base != ''")
    at = at.select((F.col("p") + 1).alias("cycle"), "base", (F.ascii(F.substr("qual", F.col("p") + 1, F.lit(1))) - offset).alias("q"))
    return at.groupBy("cycle").agg(F.count(F.lit(1)).alias("n"), F.avg("q").alias("mean_quality"), *[F.count_if(F.col("base") == b).alias(b) for b in "ACGT"])


def _frequent(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sequences of one task that may be frequent, with 0, and null with how often any other may occur (Misra and Gries' counters)."""
    held: Counter = Counter()
    lost = 0
    for batch in batches:
        counts = pc.value_counts(batch.column(0))
        held.update(dict(zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist())))
        if len(held) > 2 * size:  # take the size-th largest count off all; what is left of none goes
            off = heapq.nlargest(size + 1, held.values())[-1]
            held, lost = Counter({s: n - off for s, n in held.items() if n > off}), lost + off
    kept = list(held)
    yield pa.RecordBatch.from_arrays([pa.array([*kept, None], pa.string()), pa.array([0] * len(kept) + [lost], pa.int64())], names=["seq", "lost"])


def top_sequences(df: DataFrame, n: int = 20, mate: int = 1, size: int = 10_000) -> DataFrame:
    """seq, reads: the n commonest sequences of a mate, ties in order of the sequence.

    Two passes. Each task keeps counters of at most twice `size` sequences, and knows how often one that
    it dropped may have occurred at most; then only the candidates of all tasks are counted,
    so few rows are shuffled. If the dropped ones, over all tasks, might reach the n-th
    count, every sequence is counted. Null and empty sequences don't count. Each pass reads df
    once: the counters go to the shared folder, and the n rows found are the result.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    seqs = df.where(F.length(f"seq{mate}") > 0).select(F.col(f"seq{mate}").alias("seq"))
    seqs.mapInArrow(lambda batches: _frequent(batches, size), "seq string, lost long").write.mode("overwrite").parquet(path)
    told = spark.read.schema("seq string, lost long").parquet(path)
    candidates = told.where("seq is not null").select("seq").distinct()
    lost = told.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost")).first()[0]
    every = seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("reads"))
    top = lambda counted: counted.orderBy(F.col("reads").desc(), "seq").limit(n)
    if not lost:  # no task has more than twice `size` sequences
        return top(every)
    found = top(seqs.join(candidates, "seq", "left_semi").groupBy("seq").agg(F.count(F.lit(1)).alias("reads")))
    rows = found.collect()
    return spark.createDataFrame(rows, found.schema).coalesce(1) if len(rows) == n and rows[-1]["reads"] > lost else top(every)


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of the least `order` for each key; rows are reduced on the map side, so a hot key is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)
