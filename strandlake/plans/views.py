"""The driver's tables read as sequencing data: the same views for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.reads import reverse_complement
from strandlake.operators.coverage import aligned_blocks

#: Length of each of the five chromosomes.
LENGTH = 20_200
_FROM = "abcdefghijklmnopqrstuvwxyz"
_BASES = "ACGTACGTACGTACGTACGTACGTAC"
_QUALS = "JIHGFEDCBA@?>=<;:9876543#!"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq1, qual1, seq2, qual2: every 150 letters of a text are a read pair; id is doc_id * 1000000 + the pair's number."""
    pairs = F.regexp_extract_all(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), F.lit(".{1,150}"), F.lit(0))
    docs = table(spark, sf_dir, "documents").select("doc_id", pairs.alias("pairs"))
    rows = docs.select("doc_id", F.posexplode(F.when(F.size("pairs") > 0, F.col("pairs")).otherwise(F.array(F.lit("")))).alias("n", "l"))
    cut = lambda to, at: F.substring(F.translate("l", _FROM, to), at, 75)
    return rows.select((F.col("doc_id") * 1_000_000 + F.col("n")).cast("string").alias("id"), cut(_BASES, 1).alias("seq1"), cut(_QUALS, 1).alias("qual1"), cut(_BASES, 76).alias("seq2"), cut(_QUALS, 76).alias("qual2"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qname, mate, flag, chrom, pos, width, strand, nm, mapq, isize, cigar, category, run."""
    width, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    half = F.floor(width / 2)
    plain = F.concat(width.cast("string"), F.lit("M"))
    split = F.concat(half.cast("string"), F.lit("M100N"), (width - half).cast("string"), F.lit("M"))
    cigar = F.when((width >= 2) & (line % 3 == 0), split).when(line % 3 == 1, plain).otherwise(F.concat(F.lit("2S"), plain))
    flag = F.when(line == 1, 64).when(line == 2, 128).otherwise(0) + F.when((F.col("l_returnflag") == "R") & (line == 5), 1024).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("qname"),
        line.alias("mate"),
        flag.alias("flag"),
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"),
        ((F.col("l_partkey") * 7 + line * 131) % 20000 + 1).cast("int").alias("pos"),
        width.alias("width"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.round(F.col("l_discount") * 100).cast("int").alias("nm"),
        (line + 35).alias("mapq"),
        (F.floor("l_extendedprice") % 700).cast("int").alias("isize"),
        cigar.alias("cigar"),
        F.when(F.col("l_returnflag") == "A", "concordant_uniq").when(F.col("l_returnflag") == "R", "concordant_mult").otherwise("unpaired_uniq").alias("category"),
        F.concat(F.lit("lane"), (F.col("l_orderkey") % 3).cast("string")).alias("run"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """groupid, chrom, start, end, strand, run: one row for each gap-free block of a usable record."""
    return aligned_blocks(alignments(spark, sf_dir))


_HEX, _TO_BASES, _TO_QUALS = "0123456789abcdef", "ACGTACGTACGTACGT", "#+27:=@ABCDEFGHI"


def aligned_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alignments with seq and qual: letters of hashes of the record's key."""
    key = F.concat_ws(":", F.col("qname").cast("string"), F.col("mate").cast("string"))
    letters = lambda salt, to: F.translate(F.concat(F.md5(F.concat(key, F.lit(f"{salt}1"))), F.md5(F.concat(key, F.lit(f"{salt}2")))), _HEX, to)
    return alignments(spark, sf_dir).withColumns({"seq": letters("s", _TO_BASES), "qual": letters("q", _TO_QUALS)})


def reference(spark: SparkSession) -> DataFrame:
    """chrom, pos, ref: a base for every position of five chromosomes."""
    places = spark.range(5).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("chrom"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(LENGTH).cast("long"))).alias("pos"))
    return places.withColumn("ref", F.translate(F.substring(F.md5(F.concat_ws(":", "chrom", F.col("pos").cast("string"))), 1, 1), _HEX, _TO_BASES))


def sequences(spark: SparkSession) -> DataFrame:
    """chrom, ref: the reference's chromosomes as one text each."""
    rows = reference(spark).groupBy("chrom").agg(F.sort_array(F.collect_list(F.struct("pos", "ref"))).alias("b"))
    return rows.select("chrom", F.array_join(F.col("b.ref"), "").alias("ref"))


def _spread_parts(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    """Columns of the parts, dealt over the session's cores: the table is small and often one split, the reads made from it are not."""
    return table(spark, sf_dir, "part").select(*columns).repartition(spark.sparkContext.defaultParallelism * 3)


def _with_stretch(rows: DataFrame, references: DataFrame, chrom: str, at: Column, size: int, name: str) -> DataFrame:
    """rows with the `size` bases of the chromosome from `at` on, or null beyond its end.

    A place in a text is found by counting from its start, so it is looked for in a block of 1000 bases and what follows.
    """
    numbers = F.sequence(F.lit(0), F.floor((F.length("ref") - 1) / 1000).cast("int"))
    blocks_ = references.select(F.col("chrom").alias(chrom), "ref", F.explode(numbers).alias("block")).select(chrom, "block", F.substr("ref", F.col("block") * 1000 + 1, F.lit(1000 + size)).alias("part"))
    met = rows.withColumn("block", F.floor((at - 1) / 1000).cast("int")).join(F.broadcast(blocks_), [chrom, "block"], "left")
    return met.withColumn(name, F.substr("part", (at - F.col("block") * 1000).cast("int"), F.lit(size))).drop("block", "part")


def placed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq1, seq2: for each part two mates of 40 bases from its place on the reference and from 200 bases on, some of them blank."""
    at, key = (F.col("p_partkey") * 37) % 19_000 + 1, F.col("p_partkey")
    parts = _spread_parts(spark, sf_dir, key.cast("string").alias("id"), F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chrom"), at.cast("int").alias("at"), (key % 10).alias("k"))
    met = _with_stretch(parts, sequences(spark), "chrom", F.col("at"), 240, "near")
    none = F.repeat(F.lit("N"), F.lit(40))
    return met.select("id", F.when(F.col("k") == 1, none).otherwise(F.substring("near", 1, 40)).alias("seq1"), F.when(F.col("k") <= 1, none).otherwise(reverse_complement(F.substring("near", 201, 40))).alias("seq2"))


def _by_kind(values: list) -> Column:
    """The value of the row's kind k; the others are not made."""
    out = F.when(F.col("k") == 0, values[0])
    for k, value in enumerate(values[1:], 1):
        out = out.when(F.col("k") == k, value)
    return out


def with_repeat(spark: SparkSession) -> DataFrame:
    """sequences, and 5000 bases more that are there twice, as rep1 and rep2."""
    twice = sequences(spark).where("chrom = 'chr0'").select(F.explode(F.array(F.lit("rep1"), F.lit("rep2"))).alias("chrom"), F.substring(F.reverse("ref"), 1, 5000).alias("ref"))
    return sequences(spark).unionByName(twice)


def sequenced_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq: a read of 80 bases or a little more for each part, by its key modulo 8.

    As it is; with 3 bases of the reference missing; with 4 bases more; over an intron of
    300; behind 20 unknown bases; from the other strand; half from the next chromosome; and with
    its halves turned round.
    """
    key, at = F.col("p_partkey"), ((F.col("p_partkey") * 37) % 19_000 + 1).cast("int")
    parts = _spread_parts(spark, sf_dir, key.cast("string").alias("id"), F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chrom"), F.concat(F.lit("chr"), ((key + 1) % 5).cast("string")).alias("chrom2"), at.alias("at"), (key % 8).alias("k"))
    met = _with_stretch(_with_stretch(parts, sequences(spark), "chrom", F.col("at"), 600, "near"), sequences(spark), "chrom2", F.col("at"), 40, "near2")
    cut = lambda off, n, ref="near": F.substring(ref, off + 1, n)
    kinds = [cut(0, 80), F.concat(cut(0, 40), cut(43, 40)), F.concat(cut(0, 40), F.lit("ACGT"), cut(40, 40)), F.concat(cut(0, 40), cut(340, 40)), F.concat(F.lit("N" * 20), cut(0, 60)), reverse_complement(cut(0, 80)), F.concat(cut(0, 40), cut(0, 40, "near2")), F.concat(cut(500, 40), cut(0, 40))]
    return met.select("id", _by_kind(kinds).alias("seq"))


def sequenced_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq1, seq2: two mates of 60 bases for each part, related in one of twelve ways, by its key modulo 12."""
    key = F.col("p_partkey")
    at = F.when(key % 12 == 4, (key * 37) % 9_000 + 1).when(key % 12 == 11, (key * 37) % 4_000 + 1).otherwise((key * 37) % 19_000 + 1).cast("int")
    named = lambda k: F.concat(F.lit("chr"), ((key + k) % 5).cast("string"))
    parts = _spread_parts(spark, sf_dir, key.cast("string").alias("id"), F.when(key % 12 == 11, "rep1").otherwise(named(0)).alias("chrom"), named(1).alias("chrom2"), at.alias("at"), (key % 12).alias("k"))
    met = parts
    for chrom, off, name in (("chrom", 0, "near"), ("chrom", 9_500, "far"), ("chrom2", 0, "near2"), ("chrom2", 200, "far2")):
        met = _with_stretch(met, with_repeat(spark) if chrom == "chrom" else sequences(spark), chrom, F.col("at") + off, 500, name)
    cut = lambda off, n=60, ref="near": F.substring(ref, off + 1, n)
    none, turned = F.lit("N" * 60), lambda *x: reverse_complement(cut(*x))
    moved = F.concat(cut(0, 30), cut(0, 30, "near2"))
    kinds = [
        (cut(0), turned(200)), (cut(0), turned(0, 60, "far2")), (cut(0), cut(200)), (cut(200), turned(0)), (cut(0), turned(0, 60, "far")), (cut(0), none), (none, none),
        (moved, turned(200)), (moved, none), (cut(0), turned(20)), (F.concat(cut(100, 30), cut(0, 30)), turned(400)), (cut(0), turned(200)),
    ]
    return met.select("id", *[_by_kind([p[m] for p in kinds]).alias(f"seq{m + 1}") for m in (0, 1)])


def indel_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qname, mate, flag, chrom, pos, cigar, seq, qual: for each part a read over one of 61 places on five chromosomes where 3 bases are missing.

    Half of the reads show it; of the others the gap is 6 bases from an end, and they are aligned without it.
    """
    key = F.col("p_partkey")
    site, k = 300 + (F.floor(key / 5) % 61) * 320, key % 4
    parts = _spread_parts(spark, sf_dir, key.alias("qname"), F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chrom"), site.cast("int").alias("site"), F.when(k < 2, 40).when(k == 2, 74).otherwise(6).alias("a"), k.alias("k"))
    met = _with_stretch(parts, sequences(spark), "chrom", F.col("site") - 79, 240, "near")
    seq = F.concat(F.substr("near", 81 - F.col("a"), F.col("a")), F.substr("near", F.lit(84), 80 - F.col("a")))
    pos = F.col("site") - F.col("a") + 1 + F.when(F.col("k") == 3, 3).otherwise(0)
    return met.select("qname", F.lit(1).alias("mate"), F.lit(0).alias("flag"), "chrom", pos.alias("pos"), F.when(F.col("k") < 2, "40M3D40M").otherwise("80M").alias("cigar"), seq.alias("seq"), F.lit("I" * 80).alias("qual"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feature_set, name, chrom, start, end, strand."""
    start = ((F.col("p_partkey") * 37) % 20000 + 1).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("feature_set"), F.col("p_partkey").cast("string").alias("name"), F.concat(F.lit("chr"), (F.col("p_partkey") % 5).cast("string")).alias("chrom"),
        start.alias("start"), (start + F.col("p_size") * 3).cast("int").alias("end"), F.lit("*").alias("strand"),
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, tx, chrom, start, end, strand: the lines of an order are the exons of a gene's transcript."""
    a = alignments(spark, sf_dir)
    return a.select((F.col("qname") % 1000).alias("gene"), F.col("qname").alias("tx"), "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("width") + 9).alias("end"), "strand")


def coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exons shrunk by two bases at either end."""
    return exons(spark, sf_dir).withColumns({"start": F.col("start") + 2, "end": F.col("end") - 2})


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, start, end: 40 bases for each supplier."""
    start = ((F.col("s_suppkey") * 199) % 20000 + 1).cast("int")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("chr"), (F.col("s_suppkey") % 5).cast("string")).alias("chrom"), start.alias("start"), (start + 39).alias("end"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, pos, ref, alt, nref, nalt, sample."""
    line = table(spark, sf_dir, "lineitem")
    base = lambda c: F.substring(F.lit("ACGT"), 1, 4).substr((F.col(c) % 4 + 1).cast("int"), F.lit(1))
    a = line.select(
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 131) % 20000 + 1).cast("int").alias("pos"),
        base("l_partkey").alias("ref"), base("l_suppkey").alias("alt"), F.col("l_quantity").cast("int").alias("nref"), F.col("l_linenumber").alias("nalt"), F.col("l_returnflag").alias("sample"),
    )
    return a.where("ref != alt")


#: The same views as DuckDB common table expressions.
SQL = {
    "reads": f"""letters AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), '.{{1,150}}') AS p FROM documents),
pairs AS (SELECT doc_id, unnest(generate_series(0, greatest(len(p), 1) - 1)) AS n, p FROM letters),
cutting AS (SELECT (doc_id * 1000000 + n)::VARCHAR AS id, coalesce(p[n + 1], '') AS l FROM pairs),
reads AS (SELECT id, substr(translate(l, '{_FROM}', '{_BASES}'), 1, 75) AS seq1, substr(translate(l, '{_FROM}', '{_QUALS}'), 1, 75) AS qual1,
  substr(translate(l, '{_FROM}', '{_BASES}'), 76, 75) AS seq2, substr(translate(l, '{_FROM}', '{_QUALS}'), 76, 75) AS qual2 FROM cutting)""",
    "alignments": """al0 AS (SELECT *, l_quantity::INT AS width, floor(l_quantity / 2)::INT AS half FROM lineitem),
alignments AS (SELECT l_orderkey AS qname, l_linenumber AS mate,
  CASE WHEN l_linenumber = 1 THEN 64 WHEN l_linenumber = 2 THEN 128 ELSE 0 END + CASE WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN 1024 ELSE 0 END AS flag,
  'chr' || (l_suppkey % 5) AS chrom, ((l_partkey * 7 + l_linenumber * 131) % 20000 + 1)::INT AS pos, width,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, round(l_discount * 100)::INT AS nm, l_linenumber + 35 AS mapq,
  (floor(l_extendedprice)::BIGINT % 700)::INT AS isize,
  CASE WHEN width >= 2 AND l_linenumber % 3 = 0 THEN half || 'M100N' || (width - half) || 'M' WHEN l_linenumber % 3 = 1 THEN width || 'M' ELSE '2S' || width || 'M' END AS cigar,
  CASE l_returnflag WHEN 'A' THEN 'concordant_uniq' WHEN 'R' THEN 'concordant_mult' ELSE 'unpaired_uniq' END AS category, 'lane' || (l_orderkey % 3) AS run FROM al0),
good AS (SELECT *, floor(width / 2)::INT AS half, cigar LIKE '%N%' AS gap FROM alignments WHERE flag & 1536 = 0),
blocks AS (SELECT qname AS groupid, chrom, pos AS start, pos + CASE WHEN gap THEN half ELSE width END - 1 AS "end", strand, run FROM good
  UNION ALL SELECT qname, chrom, pos + half + 100, pos + width + 99, strand, run FROM good WHERE gap),
exons AS (SELECT qname % 1000 AS gene, qname AS tx, chrom, pos AS start, pos + width + 9 AS "end", strand FROM alignments),
coding AS (SELECT gene, tx, chrom, start + 2 AS start, "end" - 2 AS "end", strand FROM exons)""",
    "aligned": f"""aligned AS (SELECT *, translate(md5(qname || ':' || mate || 's1') || md5(qname || ':' || mate || 's2'), '{_HEX}', '{_TO_BASES}') AS seq,
  translate(md5(qname || ':' || mate || 'q1') || md5(qname || ':' || mate || 'q2'), '{_HEX}', '{_TO_QUALS}') AS qual FROM alignments),
reference AS (SELECT chrom, pos, translate(substr(md5(chrom || ':' || pos), 1, 1), '{_HEX}', '{_TO_BASES}') AS ref FROM (SELECT 'chr' || c AS chrom, p AS pos FROM range(5) a(c), range(1, {LENGTH + 1}) b(p)))""",
    "features": """features AS (SELECT p_brand AS feature_set, p_partkey::VARCHAR AS name, 'chr' || (p_partkey % 5) AS chrom,
  ((p_partkey * 37) % 20000 + 1)::INT AS start, ((p_partkey * 37) % 20000 + 1 + p_size * 3)::INT AS "end", '*' AS strand FROM part)""",
    "mask": """mask AS (SELECT 'chr' || (s_suppkey % 5) AS chrom, ((s_suppkey * 199) % 20000 + 1)::INT AS start, ((s_suppkey * 199) % 20000 + 40)::INT AS "end" FROM supplier)""",
    "variants": """variants AS (SELECT * FROM (SELECT 'chr' || (l_suppkey % 5) AS chrom, ((l_partkey * 7 + l_linenumber * 131) % 20000 + 1)::INT AS pos,
  substr('ACGT', (l_partkey % 4 + 1)::INT, 1) AS ref, substr('ACGT', (l_suppkey % 4 + 1)::INT, 1) AS alt, l_quantity::INT AS nref, l_linenumber AS nalt, l_returnflag AS sample FROM lineitem) WHERE ref <> alt)""",
}


def with_views(names: str, body: str) -> str:
    """A statement over the named views (space between names); body may start with more expressions and a comma."""
    return "WITH " + ",\n".join(SQL[n] for n in names.split()) + body
