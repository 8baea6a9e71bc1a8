"""FASTQ, FASTA, BED, VCF, dictionary and table files as DataFrames, and their sinks."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.sources.fastq import read_fastq, read_mates

#: Lines of a FASTA file whose records are told apart together; of each so many lines one row is carried on.
FASTA_LINES = 1 << 20


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line: the lines of one text file with their numbers from 0.

    Lines are counted by partition, and each partition starts where the one before ends; only a
    count for each partition reaches the driver. A gzip file is one partition; a broken one fails.
    """
    rows = spark.read.text(path).select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    counts = sorted((r.part, r["count"]) for r in rows.groupBy("part").count().collect())
    starts, total = {}, 0
    for part, n in counts:
        starts[part], total = total, total + n
    table = spark.createDataFrame(list(starts.items()) or [(0, 0)], "part int, from long")
    joined = rows.join(F.broadcast(table), "part")
    return joined.select("value", (F.col("from") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("line"))


def read_fastq_pair(spark: SparkSession, path1: str, path2: str | None = None) -> DataFrame:
    """id, seq1, qual1, seq2, qual2: mates side by side by record; files of different length are an error."""
    if path2 is None:
        none = F.lit(None).cast("string")
        return read_fastq(spark, path1, numbered=False).select("id", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"), none.alias("seq2"), none.alias("qual2"))
    return read_mates(spark, path1, path2).drop("record")


def write_fastq(reads: DataFrame, path: str, mate: str = "1") -> None:
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "id"), f"seq{mate}", F.lit("+"), f"qual{mate}").alias("value")).write.mode("errorifexists").text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, seq: a record is a line that begins with `>` and the lines up to the next; blanks around lines are dropped.

    Lines know their record from the last header before them: within a partition by a running
    maximum, and from the partitions before by one row each.
    """
    lines = numbered_lines(spark, path).withColumn("head", F.when(F.col("value").startswith(">"), F.col("line")))
    chunk = F.floor(F.col("line") / FASTA_LINES)
    within = F.max("head").over(Window.partitionBy("chunk").orderBy("line"))
    held = lines.withColumn("chunk", chunk).withColumn("here", within)
    carried = held.groupBy("chunk").agg(F.max("head").alias("last"))
    before = carried.select("chunk", F.max("last").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    told = held.join(before, "chunk").withColumn("record", F.coalesce("here", "before")).where("record is not null")
    parts = told.groupBy("record").agg(F.max(F.when(F.col("head").isNotNull(), F.trim(F.substr("value", F.lit(2))))).alias("name"), F.sort_array(F.collect_list(F.when(F.col("head").isNull(), F.struct("line", F.trim("value").alias("s"))))).alias("lines"))
    return parts.select("name", F.array_join(F.transform("lines", lambda x: x["s"]), "").alias("seq"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name, score, strand, with starts counted from 1."""
    rows = spark.read.csv(path, sep="\t", schema="chrom string, start0 int, end int, name string, score int, strand string")
    return rows.select("chrom", (F.col("start0") + 1).alias("start"), "end", "name", "score", "strand")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, id, ref, alt, qual, filter, info, fields (FORMAT key to value of the first sample), nref, nalt."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).where("not startswith(value, '#') and value != ''").select(cells.alias("c"))
    names = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")
    rows = rows.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)], F.when(F.size("c") > 9, F.map_from_arrays(F.split(F.col("c")[8], ":"), F.split(F.col("c")[9], ":"))).alias("fields"))
    ad = F.split(F.col("fields")["AD"], ",")
    return rows.withColumns({"pos": F.col("pos").cast("int"), "nref": ad[0].cast("int"), "nalt": F.get(ad, F.lit(1)).cast("int")})


def write_vcf(variants: DataFrame, path: str, sample: str = "sample") -> bool:
    """Write (chrom, pos, ref, alt, nref, nalt) sorted by place; nothing is written, and False returned, for no rows."""
    if not variants.take(1):
        return False
    body = F.concat_ws("\t", "chrom", "pos", F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("AD"), F.concat_ws(",", "nref", "nalt"))
    rows = variants.orderBy("chrom", "pos", "ref", "alt").select(body.alias("value"))
    head = "##fileformat=VCFv4.1\n##FORMAT=<ID=AD,Number=.,Type=Integer,Description=\"Allelic depths\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + sample
    first = variants.sparkSession.createDataFrame([(head,)], "value string")
    first.coalesce(1).union(rows).write.mode("errorifexists").text(path)
    return True


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """chrom, length from the @SQ lines of a sequence dictionary."""
    return spark.read.text(path).where("startswith(value, '@SQ')").select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"))


def write_table(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists") -> None:
    """Tab-separated text with a header, CSV or Parquet; another kind is an error."""
    if kind not in ("tab", "csv", "parquet"):
        raise ValueError(f"unknown format {kind}")
    out = df.write.mode(mode)
    out.parquet(path) if kind == "parquet" else out.csv(path, sep="\t" if kind == "tab" else ",", header=True)


def read_name_value(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="name string, value double")


def write_runs(runs: DataFrame, path: str) -> None:
    """Coverage runs as tab-separated text, 0-based and half-open, sorted within files."""
    runs.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").select("chrom", F.col("start") - 1, "end", "depth").write.mode("errorifexists").csv(path, sep="\t")


def write_alignments(a: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with a folder for each category, sorted by place within files; a chromosome spreads over as many files as its records call for."""
    a.repartitionByRange("category", "chrom", "pos").sortWithinPartitions("category", "chrom", "pos").write.mode(mode).partitionBy("category").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, depth as write_runs wrote them, from 1 and closed."""
    rows = spark.read.csv(path, sep="\t", schema="chrom string, start0 long, end long, depth long")
    return rows.select("chrom", (F.col("start0") + 1).alias("start"), "end", "depth")


def count_fastq(spark: SparkSession, path: str) -> int:
    """The number of records; a file whose lines are no multiple of four is an error."""
    lines = spark.read.text(path).count()
    if lines % 4:
        raise ValueError(f"{path} ends within a record")
    return lines // 4


def concatenate_fastq(spark: SparkSession, paths: list[str], path: str) -> None:
    """The records of several files, as pairs with one mate, written to one folder."""
    parts = [read_fastq(spark, p, numbered=False).select("id", F.col("seq").alias("seq1"), F.col("qual").alias("qual1")) for p in paths]
    write_fastq(reduce(DataFrame.unionByName, parts), path)


def write_fasta(sequences: DataFrame, path: str, width: int = 60) -> None:
    """(name, seq) as records with lines of `width` letters."""
    lines = F.array_join(F.regexp_extract_all("seq", F.lit(f".{{1,{width}}}"), F.lit(0)), "\n")
    sequences.select(F.concat(F.lit(">"), "name", F.lit("\n"), lines).alias("value")).write.mode("errorifexists").text(path)


def only_path(spark: SparkSession, folder: str, pattern: str) -> str:
    """The path of the one file or folder in `folder` whose name holds the pattern; none or several are an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    found = sorted(n for n in names if re.search(pattern, n))
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} names in {folder} match {pattern}")
    return f"{folder.rstrip('/')}/{found[0]}"


def read_named(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    """The tab-separated table whose name alone in the folder holds the pattern."""
    return spark.read.csv(only_path(spark, folder, pattern), sep="\t", header=True, schema=schema)


def merge_alignments(parts: list[DataFrame], sort: bool = True) -> DataFrame:
    """Records of several files as one table, by place if asked for."""
    merged = reduce(DataFrame.unionByName, parts)
    return merged.orderBy("chrom", "pos") if sort else merged


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: in spark.checkpoint.dir; where that is unset, a temporary one if all runs in one process, else an error."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="strandlake-")
    return f"{found.rstrip('/')}/{uuid.uuid4().hex}"


def prepare_folder(spark: SparkSession, folder: str, policy: str = "never") -> str:
    """The save mode for writing into `folder`: `never` fails if it exists, `erase` deletes it first, `overwrite` writes over single tables."""
    modes = {"never": "errorifexists", "erase": "errorifexists", "overwrite": "overwrite"}
    if policy not in modes:
        raise ValueError(f"unknown policy {policy}")
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if policy == "never" and system.exists(place):
        raise FileExistsError(folder)
    if policy == "erase":
        system.delete(place, True)
    return modes[policy]
