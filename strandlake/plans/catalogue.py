"""Named queries over the driver's tables, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import reads as R
from strandlake.operators import align as A
from strandlake.operators import counting as C
from strandlake.operators import coverage as V
from strandlake.operators import dense as D
from strandlake.operators import features as G
from strandlake.operators import gapped as GA
from strandlake.operators import intervals as I
from strandlake.operators import preprocess as P
from strandlake.operators import quantiles as QS
from strandlake.operators import realign as RA
from strandlake.operators import runs as Q
from strandlake.operators import stats as S
from strandlake.plans import views
from strandlake.plans.views import with_views
from strandlake.sources import files, regions

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str]] = {}
CHROMOSOMES = [(f"chr{i}", views.LENGTH) for i in range(5)]
LENGTHS_SQL = f"lengths AS (SELECT 'chr' || i AS chrom, {views.LENGTH}::BIGINT AS length FROM range(5) t(i))"
ADAPTER = "GATCGGAAGAGCACACGTCT"


def _lengths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHROMOSOMES, "chrom string, length long")


def query(name: str, views_: str, sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _FOUND[name] = (f, with_views(views_, sql))
        return f

    return add


def queries() -> dict[str, Query]:
    return {k: f for k, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _FOUND.items()}


_TALLY = "tal AS (SELECT chrom, pos, ref, alt, sum(nalt)::BIGINT AS alt_depth, sum(nref)::BIGINT AS ref_depth, count(*) AS records FROM variants GROUP BY chrom, pos, ref, alt)"
_CALLS = f"{_TALLY},\ncalls AS (SELECT * FROM tal WHERE alt <> ref AND ref <> 'N' AND alt_depth >= 2 AND alt_depth * ln(0.2) + ref_depth * ln(0.8) > alt_depth * ln(0.001) + ref_depth * ln(0.999))"


# ------------------------------------------------------------------- reads


@query("trim_reads", "reads", "SELECT id, substr(seq1, 6, 50) AS seq1, substr(qual1, 6, 50) AS qual1, substr(seq2, 6, 50) AS seq2, substr(qual2, 6, 50) AS qual2 FROM reads")
def trim_reads(spark, d):
    return P.trim_reads(views.reads(spark, d), 50, 5)


_TAIL = "t AS (SELECT id, regexp_replace(qual1, '[!-#]+$', '') AS qual1, regexp_replace(qual2, '[!-#]+$', '') AS qual2, seq1, seq2 FROM reads),\ntt AS (SELECT id, substr(seq1, 1, length(qual1)) AS seq1, qual1, substr(seq2, 1, length(qual2)) AS seq2, qual2 FROM t)"


@query("trim_quality_tail", "reads", f",\n{_TAIL} SELECT * FROM tt")
def trim_quality_tail(spark, d):
    return P.trim_tails(views.reads(spark, d), "#")


@query("filter_length", "reads", "SELECT id, length(seq1) AS len1, length(seq2) AS len2 FROM reads WHERE length(seq1) >= 70 AND length(seq2) >= 70")
def filter_length(spark, d):
    return P.filter_length(views.reads(spark, d), 70).select("id", F.length("seq1").cast("long").alias("len1"), F.length("seq2").cast("long").alias("len2"))


_GOOD = "length(regexp_replace({q}, '[^8-~]', '', 'g'))::DOUBLE / nullif(length({q}), 0) > 0.7"
_HIGH = f"{_TAIL},\nhigh AS (SELECT * FROM tt WHERE length(seq1) >= 1 AND length(seq2) >= 1 AND {_GOOD.format(q='qual1')} AND {_GOOD.format(q='qual2')})"


@query("filter_quality", "reads", f",\n{_HIGH} SELECT * FROM high")
def filter_quality(spark, d):
    return P.filter_quality(views.reads(spark, d), "illumina1.8", 23, 0.7)


_ENC = ", ".join(f"({i}, '{n}', {lo}, {hi})" for i, (n, lo, hi) in enumerate(R.ENCODINGS))


@query("quality_encoding", "reads", f""",
c AS (SELECT unnest(string_split(qual1, '')) AS c FROM (SELECT * FROM reads ORDER BY id LIMIT 5000)),
m AS (SELECT min(ascii(c)) AS lo, max(ascii(c)) AS hi FROM c WHERE c <> '')
SELECT e.encoding, e.rank FROM (VALUES {_ENC}) e(rank, encoding, low, high), m WHERE m.lo >= e.low AND m.hi <= e.high""")
def quality_encoding(spark, d):
    return P.detect_encoding(views.reads(spark, d))


def _adapter_sql(mate: int, adapter: str, name: str) -> str:
    n = len(adapter)
    return f"""{name}r AS (SELECT id, CASE WHEN id::BIGINT % 7 = 0 THEN substr(seq{mate}, 1, 60) || substr('{adapter}', 1, 15) ELSE seq{mate} END AS s FROM reads),
{name}p AS (SELECT id, s, unnest(generate_series(1 - {n}, length(s) - 1)) AS d FROM {name}r),
{name}q AS (SELECT id, d, substr(s, (greatest(d, 0) + 1)::INT, (least(length(s), d + {n}) - greatest(d, 0))::INT) AS a,
  substr('{adapter}', (greatest(d, 0) - d + 1)::INT, (least(length(s), d + {n}) - greatest(d, 0))::INT) AS b FROM {name}p),
{name}s AS (SELECT id, len(list_filter(generate_series(1, length(a)), lambda i: a[i] = b[i])) AS same, length(a) AS n FROM {name}q),
{name} AS (SELECT id, max(same * {R.MATCH} + (n - same) * ({R.MISMATCH})) > {R.ADAPTER_CUTOFF} AS adapter FROM {name}s GROUP BY id)"""


def _spiked(rows, mate, adapter):
    """Reads with the start of the adapter at the end of every seventh."""
    spiked = F.when(F.col("id").cast("long") % 7 == 0, F.concat(F.substring(f"seq{mate}", 1, 60), F.lit(adapter[:15]))).otherwise(F.col(f"seq{mate}"))
    return rows.withColumn(f"seq{mate}", spiked)


@query("adapter_flag", "reads", f",\n{_adapter_sql(1, ADAPTER, 'f')} SELECT r.id, coalesce(f.adapter, false) AS adapter FROM reads r LEFT JOIN f USING (id)")
def adapter_flag(spark, d):
    return P.flag_adapters(_spiked(views.reads(spark, d), 1, ADAPTER), ADAPTER).select("id", "adapter")


@query("adapter_flag_paired", "reads", f""",\n{_adapter_sql(1, R.PAIRED_1, 'f')},\n{_adapter_sql(2, R.PAIRED_2, 'g')}
SELECT r.id, coalesce(f.adapter, false) AND coalesce(g.adapter, false) AS adapter FROM reads r LEFT JOIN f USING (id) LEFT JOIN g USING (id)""")
def adapter_flag_paired(spark, d):
    rows = _spiked(_spiked(views.reads(spark, d), 1, R.choose_adapter(True)), 2, R.choose_adapter(True, mate=2))
    return P.flag_adapters(rows, R.choose_adapter(True), R.choose_adapter(True, mate=2)).select("id", "adapter")


_BAD = "bad AS (SELECT (doc_id * 1000000)::VARCHAR AS id FROM labels WHERE toxic = 1)"


def _contaminated(spark, d):
    """The first read of every document labelled toxic."""
    return views.table(spark, d, "labels").where("toxic = 1").select((F.col("doc_id") * 1_000_000).cast("string").alias("id"))


@query("rrna_filter", "reads", f",\n{_BAD} SELECT id FROM reads WHERE id NOT IN (SELECT id FROM bad)")
def rrna_filter(spark, d):
    named = views.reads(spark, d).select(F.concat("id", F.lit("/1")).alias("id"))
    return P.remove_contaminated(named, _contaminated(spark, d)).select(R.normal_id(F.col("id")).alias("id"))


@query("subsample_exact", "reads", "SELECT id, seq1 FROM (SELECT id, seq1, row_number() OVER (ORDER BY md5(id), id) AS n FROM reads) WHERE n <= 300")
def subsample_exact(spark, d):
    return P.subsample(views.reads(spark, d), 300).select("id", "seq1")


_LANES = "'lane' || (id::BIGINT % 3)"
_MARKED = f""",
{_TAIL},
{_adapter_sql(1, ADAPTER, 'f').replace('FROM reads)', 'FROM tt)')},
{_BAD},
m AS (SELECT r.id, {_LANES} AS run, length(r.seq1) AS a1, length(r.seq2) AS a2, length(tt.seq1) AS b1, length(tt.seq2) AS b2,
  length(tt.seq1) >= 1 AND length(tt.seq2) >= 1 AND coalesce({_GOOD.format(q='tt.qual1')}, false) AND coalesce({_GOOD.format(q='tt.qual2')}, false) AS good, coalesce(f.adapter, false) AS adapter,
  r.id IN (SELECT id FROM bad) AS rrna FROM reads r JOIN tt USING (id) LEFT JOIN f USING (id)),
s AS (SELECT run, count(*) AS total_reads, min_by(a1, id) AS read_length, min(least(a1, a2)) AS input_min_read_length, max(greatest(a1, a2)) AS input_max_read_length, count(*) FILTER (good) AS highqual_reads,
  count(*) FILTER (good AND adapter) AS adapter_contam, count(*) FILTER (good AND rrna) AS "rRNA_contam_reads", min(least(b1, b2)) FILTER (good AND NOT rrna) AS processed_min_read_length,
  max(greatest(b1, b2)) FILTER (good AND NOT rrna) AS processed_max_read_length, count(*) FILTER (good AND NOT rrna) AS processed_reads FROM m GROUP BY run)"""


def _marked(spark, d):
    rows = views.reads(spark, d).withColumn("run", F.concat(F.lit("lane"), (F.col("id").cast("long") % 3).cast("string")))
    high = P.preprocess(rows, "illumina1.8", 23, 0.7, contaminated=_contaminated(spark, d))
    # adapters are looked for in reads with a planted one, so that some are found
    return P.flag_adapters(_spiked(high, 1, ADAPTER), ADAPTER).withColumns({"adapter": F.col("adapter") & F.col("highqual"), "seq1": F.substr("seq1", F.lit(1), F.length("qual1"))})


def _summaries(spark, d):
    return P.summary(_marked(spark, d), ["run"])


@query("preprocess_summary", "reads", f"{_MARKED} SELECT * FROM s")
def preprocess_summary(spark, d):
    return _summaries(spark, d)


@query("merge_preprocess", "reads", f"""{_MARKED} SELECT sum(total_reads)::BIGINT AS total_reads, min_by(read_length, run) AS read_length, min(input_min_read_length) AS input_min_read_length, max(input_max_read_length) AS input_max_read_length,
sum(highqual_reads)::BIGINT AS highqual_reads, sum(adapter_contam)::BIGINT AS adapter_contam, sum("rRNA_contam_reads")::BIGINT AS "rRNA_contam_reads",
min(processed_min_read_length) AS processed_min_read_length, max(processed_max_read_length) AS processed_max_read_length, sum(processed_reads)::BIGINT AS processed_reads FROM s""")
def merge_preprocess(spark, d):
    return P.merge_summaries(_summaries(spark, d))


@query("read_lengths", "reads", ",\nx AS (SELECT least(length(seq1), 60) AS length FROM reads) SELECT length, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percent FROM x GROUP BY length")
def read_lengths(spark, d):
    rows = views.reads(spark, d).select(P.effective_length(F.length("seq1").cast("long"), F.lit(60).cast("long")).alias("length"))
    return P.length_table(rows, "length").withColumn("percent", F.round("percent", 6))


@query("per_cycle_qa", "reads", """,
c AS (SELECT i AS cycle, seq1[i] AS base, ascii(qual1[i]) - 33 AS q FROM (SELECT seq1, qual1, unnest(generate_series(1, length(seq1)))::INT AS i FROM reads))
SELECT cycle, count(*) AS n, avg(q) AS mean_quality, count(*) FILTER (base = 'A') AS "A", count(*) FILTER (base = 'C') AS "C", count(*) FILTER (base = 'G') AS "G", count(*) FILTER (base = 'T') AS "T" FROM c GROUP BY cycle""")
def per_cycle_qa(spark, d):
    return P.per_cycle(views.reads(spark, d))


@query("per_cycle_qa_mates", "reads", """,
m AS (SELECT 1 AS mate, seq1 AS s, qual1 AS q FROM reads UNION ALL SELECT 2, seq2, qual2 FROM reads),
c AS (SELECT mate, i AS cycle, s[i] AS base, ascii(q[i]) - 33 AS q FROM (SELECT mate, s, q, unnest(generate_series(1, length(s)))::INT AS i FROM m))
SELECT mate, cycle, count(*) AS n, round(avg(q), 6) AS mean_quality, count(*) FILTER (base = 'A') AS "A", count(*) FILTER (base = 'C') AS "C", count(*) FILTER (base = 'G') AS "G", count(*) FILTER (base = 'T') AS "T" FROM c GROUP BY mate, cycle""")
def per_cycle_qa_mates(spark, d):
    one, two = (P.per_cycle(views.reads(spark, d), mate=m).withColumn("mate", F.lit(m)) for m in (1, 2))
    return one.unionByName(two).withColumn("mean_quality", F.round("mean_quality", 6))


@query("top_sequences", "reads", "SELECT seq1 AS seq, count(*) AS reads FROM reads WHERE length(seq1) > 0 GROUP BY seq1 ORDER BY reads DESC, seq LIMIT 50")
def top_sequences(spark, d):
    return P.top_sequences(views.reads(spark, d), 50)


# -------------------------------------------------------------- alignments


@query("category_unique_reads", "alignments", "SELECT category, count(DISTINCT qname) AS reads FROM alignments GROUP BY category")
def category_unique_reads(spark, d):
    return S.unique_reads(views.alignments(spark, d))


@query("analyzed_reads", "alignments", "SELECT chrom, count(*) AS records FROM alignments WHERE category = 'concordant_uniq' GROUP BY chrom")
def analyzed_reads(spark, d):
    return S.analyzed(views.alignments(spark, d)).groupBy("chrom").agg(F.count(F.lit(1)).alias("records"))


_NM = ", ".join(f"count(*) FILTER (nm = {i}) AS nm_{i}" for i in range(8))


@query("bam_stats_nm", "alignments", f"SELECT run, count(*) AS total, sum(nm)::BIGINT AS nm_sum, sum(nm * nm)::BIGINT AS nm_sum2, {_NM}, count(*) FILTER (nm >= 8) AS nm_8 FROM alignments GROUP BY run")
def bam_stats_nm(spark, d):
    return S.edit_statistics(views.alignments(spark, d), ["run"])


_MQ = ", ".join(f"count(*) FILTER (mapq = {i}) AS mapq_{i}" for i in range(37, 41))


@query("bam_stats_mapq", "alignments", f"SELECT run, sum(mapq)::BIGINT AS mapq_sum, sum(mapq * mapq)::BIGINT AS mapq_sum2, count(*) FILTER (mapq <= 36) AS mapq_36, {_MQ}, count(*) FILTER (mapq >= 41) AS mapq_41 FROM alignments GROUP BY run")
def bam_stats_mapq(spark, d):
    return S.mapq_statistics(views.alignments(spark, d), ["run"])


_OPS = ", ".join(f"sum(len(regexp_extract_all(cigar, '{v}')))::BIGINT AS ops_{k}, count(*) FILTER (regexp_matches(cigar, '{v}')) AS with_{k}" for k, v in (("s", "S"), ("n", "N"), ("id", "[ID]")))


@query("bam_stats_cigar", "alignments", f"SELECT run, sum(length(cigar))::BIGINT AS cigar_sum, sum(length(cigar) * length(cigar))::BIGINT AS cigar_sum2, {_OPS} FROM alignments GROUP BY run")
def bam_stats_cigar(spark, d):
    return S.cigar_statistics(views.alignments(spark, d), ["run"])


@query("bam_chrom_bins", "alignments", f",\n{LENGTHS_SQL} SELECT l.chrom, count(a.qname) AS records FROM lengths l LEFT JOIN alignments a USING (chrom) GROUP BY l.chrom")
def bam_chrom_bins(spark, d):
    return S.chromosome_counts(views.alignments(spark, d), _lengths(spark))


@query("insert_size_bins", "alignments", """,
b AS (SELECT (least(ceil((abs(isize) - 1) / 10.0) - 1, 59) * 10 + 1)::INT AS left_edge, count(*) AS records FROM alignments WHERE abs(isize) > 1 GROUP BY 1)
SELECT (i * 10 + 1)::INT AS left_edge, coalesce(records, 0) AS records FROM range(60) t(i) LEFT JOIN b ON b.left_edge = i * 10 + 1""")
def insert_size_bins(spark, d):
    return S.insert_size_bins(views.alignments(spark, d))


@query("flag_mate", "alignments", "SELECT CASE WHEN flag % 256 < 128 THEN 1 ELSE 2 END AS mate_number, count(*) AS records FROM alignments GROUP BY 1")
def flag_mate(spark, d):
    return views.alignments(spark, d).groupBy(R.mate_number(F.col("flag")).alias("mate_number")).agg(F.count(F.lit(1)).alias("records"))


@query("cigar_blocks", "alignments", """
SELECT qname, mate, pos AS start, pos + CASE WHEN cigar LIKE '%N%' THEN floor(width / 2)::INT ELSE width END - 1 AS "end" FROM alignments
UNION ALL SELECT qname, mate, pos + floor(width / 2)::INT + 100, pos + width + 99 FROM alignments WHERE cigar LIKE '%N%'""")
def cigar_blocks(spark, d):
    return views.alignments(spark, d).select("qname", "mate", F.inline(R.cigar_blocks(F.col("pos"), F.col("cigar"))))


@query("target_length_summary", "alignments", """,
u AS (SELECT abs(isize) AS x FROM alignments WHERE flag & 512 = 0 AND flag & 1024 = 0),
e AS (SELECT x, false AS trimmed FROM u UNION ALL SELECT x, true FROM u WHERE x < 600)
SELECT trimmed, quantile_cont(x, 0.0) AS "min", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, quantile_cont(x, 1.0) AS "max", avg(x) AS mean FROM e GROUP BY trimmed""")
def target_length_summary(spark, d):
    return S.target_lengths(views.alignments(spark, d))


@query("insert_size_quantiles", "alignments", """,
u AS (SELECT run, abs(isize)::DOUBLE AS x FROM alignments),
e AS (SELECT run, x FROM u UNION ALL SELECT 'all', x FROM u)
SELECT run, count(*) AS n, quantile_cont(x, 0.0) AS "min", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, quantile_cont(x, 1.0) AS "max" FROM e GROUP BY run""")
def insert_size_quantiles(spark, d):
    """Quantiles of each lane, and of all lanes from the lanes' own states."""
    lanes = QS.quantile_state(views.alignments(spark, d).withColumn("x", F.abs("isize")), ["run"], "x")
    whole = QS.merge_states(lanes.withColumn("run", F.lit("all")), ["run"])
    told = QS.state_quantiles(lanes.unionByName(whole), ["run"])
    return told.select("run", "n", *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("min", "q1", "median", "q3", "max"))])


@query("mark_duplicates", "alignments", """,
r AS (SELECT qname, mate, chrom, pos, strand, cigar, mapq, nm, CASE WHEN strand = '-' THEN pos + width + CASE WHEN cigar LIKE '%N%' THEN 100 ELSE 0 END - 1 ELSE pos - CASE WHEN cigar LIKE '2S%' THEN 2 ELSE 0 END END AS five FROM alignments),
m AS (SELECT qname, min((chrom, five, strand)) AS low, max((chrom, five, strand)) AS high, sum(mapq) AS mapq, sum(nm) AS nm FROM r WHERE mate IN (1, 2) GROUP BY qname HAVING count(*) FILTER (mate = 1) = 1 AND count(*) FILTER (mate = 2) = 1),
p AS (SELECT qname, row_number() OVER (PARTITION BY low, high ORDER BY mapq DESC, nm, qname) > 1 AS worse FROM m),
h AS (SELECT r.*, p.worse, p.qname IS NOT NULL AND mate IN (1, 2) AS paired FROM r LEFT JOIN p USING (qname)),
k AS (SELECT *, dense_rank() OVER (PARTITION BY chrom, five, strand ORDER BY CASE WHEN paired THEN 0 ELSE 1 END, mapq DESC, nm, qname, mate) > 1 AS later FROM h),
d AS (SELECT DISTINCT qname, mate, chrom, pos, strand, cigar FROM k WHERE CASE WHEN paired THEN worse ELSE later END)
SELECT a.qname, a.mate, d.qname IS NOT NULL AS is_dup FROM alignments a LEFT JOIN d ON a.qname = d.qname AND a.mate = d.mate AND a.chrom = d.chrom AND a.pos = d.pos AND a.strand = d.strand AND a.cigar = d.cigar""")
def mark_duplicates(spark, d):
    return S.mark_duplicates(views.alignments(spark, d)).select("qname", "mate", "is_dup")


@query("sanity_check", "alignments", """SELECT sum(CASE WHEN category LIKE '%_uniq' THEN 1 ELSE 0 END)::BIGINT AS unique_records, sum(CASE WHEN category LIKE '%_mult' THEN 1 ELSE 0 END)::BIGINT AS multiple_records,
count(*) AS processed, unique_records + multiple_records = processed AS complete, unique_records > multiple_records AS mostly_unique FROM alignments""")
def sanity_check(spark, d):
    a = views.alignments(spark, d).agg(F.count_if(F.col("category").endswith("_uniq")).alias("unique_records"), F.count_if(F.col("category").endswith("_mult")).alias("multiple_records"), F.count(F.lit(1)).alias("processed"))
    return a.withColumns({"complete": F.col("unique_records") + F.col("multiple_records") == F.col("processed"), "mostly_unique": F.col("unique_records") > F.col("multiple_records")})


@query("align_reads", "mask", """,
p AS (SELECT p_partkey::VARCHAR AS id, p_partkey % 10 AS k, 'chr' || (p_partkey % 5) AS chrom, ((p_partkey * 37) % 19000 + 1)::INT AS pos FROM part)
SELECT 1 AS mate, id, chrom, pos, '+' AS strand, 0 AS nm, 1::BIGINT AS hits FROM p WHERE k <> 1 UNION ALL SELECT 2, id, chrom, pos + 200, '-', 0, 1 FROM p WHERE k > 1""")
def align_reads(spark, d):
    pairs, references = views.placed_pairs(spark, d), views.sequences(spark)
    one, two = (A.best_hits(pairs.select("id", F.col(f"seq{m}").alias("seq")), references).withColumn("mate", F.lit(m)) for m in (1, 2))
    return one.unionByName(two).select("mate", "id", "chrom", F.col("pos").cast("int").alias("pos"), "strand", F.col("nm").cast("int").alias("nm"), "hits")


@query("align_categories", "mask", """
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 10 = 1 THEN 'nomapping' WHEN p_partkey % 10 = 0 THEN 'halfmapping_uniq' ELSE 'concordant_uniq' END AS category FROM part""")
def align_categories(spark, d):
    pairs, references = views.placed_pairs(spark, d), views.sequences(spark)
    one, two = (A.best_hits(pairs.select("id", F.col(f"seq{m}").alias("seq")), references) for m in (1, 2))
    return A.categories(one, two, pairs.select("id"), 40)


@query("contaminated_ids", "mask", "SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey % 10 <> 1 AND p_partkey % 5 = 2")
def contaminated_ids(spark, d):
    named = views.placed_pairs(spark, d).withColumn("id", F.concat("id", F.lit("/1")))
    return A.contaminated_ids(named, views.sequences(spark).where("chrom = 'chr2'"))


_AT = "p AS (SELECT p_partkey::VARCHAR AS id, p_partkey % 8 AS k, 'chr' || (p_partkey % 5) AS chrom, ((p_partkey * 37) % 19000 + 1)::BIGINT AS pos FROM part)"
#: Longest intron, and distance of mates, on chromosomes of 20,200 bases.
NEAR = 2_000


def _letters(op: str):
    """How many bases the operations of one kind have in a CIGAR string."""
    return F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+){op}"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))


@query("align_gapped", "mask", f""",
{_AT}
SELECT id, chrom, pos, pos + CASE k WHEN 1 THEN 82 WHEN 3 THEN 379 WHEN 4 THEN 59 ELSE 79 END AS "end", CASE k WHEN 5 THEN '-' ELSE '+' END AS strand, CASE k WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 0 END AS nm,
  CASE k WHEN 2 THEN 4 ELSE 0 END AS inserted, CASE k WHEN 1 THEN 3 ELSE 0 END AS deleted, CASE k WHEN 3 THEN 300 ELSE 0 END AS skipped, CASE k WHEN 4 THEN 20 ELSE 0 END AS clipped, 1 AS hits, true AS sure FROM p WHERE k < 6""")
def align_gapped(spark, d):
    """Reads with gaps, introns and clips, at their best places; not those that lie on two places."""
    placed = GA.placements(views.sequenced_reads(spark, d), views.sequences(spark), longest_intron=NEAR)
    best = GA.best_of(GA.by_read(placed, NEAR).where("split is null"))
    return best.select("id", "chrom", "pos", "end", "strand", "nm", _letters("I").alias("inserted"), _letters("D").alias("deleted"), _letters("N").alias("skipped"), _letters("S").alias("clipped"), "hits", (F.col("mapq") >= 30).alias("sure"))


@query("align_split", "mask", f""",
{_AT}
SELECT id, CASE k WHEN 6 THEN 'unpaired_transloc' WHEN 7 THEN 'unpaired_circular' ELSE 'unpaired_uniq' END AS category, chrom, pos + CASE k WHEN 7 THEN 500 ELSE 0 END AS pos, CASE k WHEN 5 THEN '-' ELSE '+' END AS strand FROM p""")
def align_split(spark, d):
    """Categories of single reads, and where their best place is, or that of the front of a split read."""
    reads = views.sequenced_reads(spark, d)
    kinds = GA.read_categories(GA.placements(reads, views.sequences(spark), longest_intron=NEAR), reads, NEAR)
    return GA.single_categories(kinds).join(kinds.select("id", "chrom", "pos", "strand"), "id")


@query("align_pair_categories", "mask", """ SELECT p_partkey::VARCHAR AS id, ['concordant_uniq', 'unpaired_uniq', 'paired_uniq_inv', 'paired_uniq_scr', 'paired_uniq_long', 'halfmapping_uniq', 'nomapping',
  'concordant_transloc', 'halfmapping_transloc', 'paired_uniq_scr', 'concordant_circular', 'concordant_mult'][p_partkey % 12 + 1] AS category FROM part""")
def align_pair_categories(spark, d):
    """Categories of pairs, translocations and circles among them."""
    pairs, references = views.sequenced_pairs(spark, d), views.with_repeat(spark)
    mates = [pairs.select("id", F.col(f"seq{m}").alias("seq")) for m in (1, 2)]
    kinds = [GA.read_categories(GA.placements(m, references, longest_intron=NEAR), m, NEAR) for m in mates]
    return GA.pair_categories(*kinds, concordant=NEAR)


_INDELS = """
p AS (SELECT p_partkey AS qname, 'chr' || (p_partkey % 5) AS chrom, (300 + (p_partkey // 5 % 61) * 320)::INT AS site, p_partkey % 4 AS k, CASE WHEN p_partkey % 4 < 2 THEN 40 WHEN p_partkey % 4 = 2 THEN 74 ELSE 6 END AS a FROM part),
whole AS (SELECT chrom, string_agg(ref, '' ORDER BY pos) AS ref FROM reference GROUP BY chrom),
q AS (SELECT p.*, substr(ref, site - a + 1, a) || substr(ref, site + 4, 80 - a) AS seq, site - a + 1 + CASE WHEN k = 3 THEN 3 ELSE 0 END AS pos, substr(ref, site - 100, 240) AS near FROM p JOIN whole USING (chrom)),
s AS (SELECT *, CASE WHEN k < 2 THEN 0 ELSE len(list_filter(range(1, 81), lambda i: seq[i] <> near[pos + i + 100 - site])) END AS wrong,
  len(list_filter(range(1, 40), lambda n: len(list_filter(range(1, n + 1), lambda j: near[102 - j] <> near[105 - j])) = 0)) AS left_by FROM q),
t AS (SELECT *, sum(CASE WHEN k < 2 THEN 1 ELSE 0 END) OVER w >= 2 AND 40 * sum(wrong) OVER w >= 50 AND wrong > 0 AS moved FROM s WINDOW w AS (PARTITION BY chrom, site))
"""


@query("realign_indels", "alignments aligned", f""",{_INDELS}
SELECT qname, chrom, (CASE WHEN moved THEN site - a + 1 ELSE pos END)::INT AS pos, CASE WHEN moved THEN (a - left_by) || 'M3D' || (80 - a + left_by) || 'M' WHEN k < 2 THEN '40M3D40M' ELSE '80M' END AS cigar, moved AS realigned FROM t""")
def realign_indels(spark, d):
    """Reads over missing bases, of which those that end soon after them are aligned anew."""
    told = RA.realign_indels(views.indel_reads(spark, d), views.sequences(spark))
    return told.select("qname", "chrom", F.col("pos").cast("int").alias("pos"), "cigar", "realigned")


@query("pileup_indels", "alignments aligned", f""",{_INDELS},
e AS (SELECT chrom, site + 1 AS pos FROM t WHERE k < 2 AND NOT moved UNION ALL SELECT chrom, site - left_by + 1 FROM t WHERE moved)
SELECT chrom, pos::BIGINT AS pos, '-3' AS alt, count(*) AS alt_depth FROM e GROUP BY chrom, pos""")
def pileup_indels(spark, d):
    """Deletions in the pileup of realigned reads, with how many reads show each."""
    realigned = RA.realign_indels(views.indel_reads(spark, d), views.sequences(spark))
    piled = S.pileup(realigned, views.reference(spark), 23)
    return piled.where(F.col("alt").rlike("^[-+]")).select("chrom", "pos", "alt", "alt_depth")


# ----------------------------------------------------------------- counts

_HITS = """hits AS (SELECT DISTINCT f.feature_set, f.name, b.groupid FROM features f JOIN blocks b ON f.chrom = b.chrom AND f.start <= b."end" AND b.start <= f."end")"""
_COUNTS = f"""{_HITS},
counts AS (SELECT f.feature_set, f.name, count(h.groupid) AS "count", any_value(f."end" - f.start + 1)::BIGINT AS width FROM features f LEFT JOIN hits h USING (feature_set, name) GROUP BY f.feature_set, f.name)"""


def _counts(spark, d):
    return C.count_features(views.features(spark, d), views.blocks(spark, d))


@query("count_features", "alignments features", f",\n{_COUNTS} SELECT * FROM counts")
def count_features(spark, d):
    return _counts(spark, d)


@query("count_features_nbreads", "alignments features", f",\n{_HITS} SELECT feature_set, count(DISTINCT groupid) AS nbreads FROM hits GROUP BY feature_set")
def count_features_nbreads(spark, d):
    return C.reads_by_set(views.features(spark, d), views.blocks(spark, d))


@query("feature_width", "features", 'SELECT feature_set, name, ("end" - start + 1)::BIGINT AS width FROM features')
def feature_width(spark, d):
    return C.feature_widths(views.features(spark, d))


@query("rpkm", "alignments features", f""",\n{_COUNTS} SELECT feature_set, name, "count", width, round(1e9 * "count" / ((SELECT count(DISTINCT groupid) FROM blocks) * width), 6) AS rpkm FROM counts""")
def rpkm(spark, d):
    blocks = views.blocks(spark, d)
    counted = C.add_rpkm(_counts(spark, d), blocks.agg(F.countDistinct("groupid").alias("n")))
    return counted.withColumn("rpkm", F.round("rpkm", 6))


@query("count_stats", "alignments features", f""",\n{_COUNTS} SELECT feature_set, count(*) FILTER ("count" >= 1) AS at_least_1, count(*) FILTER ("count" >= 10) AS at_least_10, count(*) FILTER ("count" >= 100) AS at_least_100,
round(avg("count"), 6) AS mean, quantile_cont("count", 0.0) AS "min", quantile_cont("count", 0.25) AS q25, quantile_cont("count", 0.5) AS median, quantile_cont("count", 0.75) AS q75, quantile_cont("count", 1.0) AS "max" FROM counts GROUP BY feature_set""")
def count_stats(spark, d):
    return C.count_statistics(_counts(spark, d)).withColumn("mean", F.round("mean", 6))


@query("features_detected", "alignments features", f""",\n{_COUNTS} SELECT feature_set, count(*) FILTER ("count" > 0) AS detected, count(*) AS total, count(*) FILTER ("count" > 10) AS gt_10 FROM counts GROUP BY feature_set""")
def features_detected(spark, d):
    return C.detected(_counts(spark, d))


@query("survival_curve", "alignments features", f""",\n{_COUNTS},
n AS (SELECT "count" AS value, count(*) AS n FROM counts GROUP BY 1), s AS (SELECT value, sum(n) OVER (ORDER BY value DESC)::BIGINT AS num FROM n)
SELECT value, num, round(num * 100.0 / max(num) OVER (), 6)::DOUBLE AS percent FROM s""")
def survival_curve(spark, d):
    return C.survival(_counts(spark, d)).withColumn("percent", F.round("percent", 6))


def _counts_by_run(spark, d):
    """Counts of every feature in every run, zero where a run has none."""
    return C.count_features_by(views.features(spark, d), views.blocks(spark, d))


@query("merge_counts", "alignments features", f""",\n{_COUNTS} SELECT feature_set, name, "count", width, round(1e9 * "count" / ((SELECT count(DISTINCT groupid) FROM blocks) * width), 6) AS rpkm FROM counts""")
def merge_counts(spark, d):
    analyzed = views.blocks(spark, d).agg(F.countDistinct("groupid").alias("n"))
    return C.merge_counts(_counts_by_run(spark, d), analyzed).select("feature_set", "name", "count", "width", F.round("rpkm", 6).alias("rpkm"))


@query("counts_side_by_side", "alignments features", f""",\n{_HITS.replace('f.feature_set, f.name, b.groupid', 'f.feature_set, f.name, b.groupid, b.run')},
l AS (SELECT f.name, r.run, count(h.groupid) AS n FROM features f CROSS JOIN (SELECT 'lane0' AS run UNION ALL SELECT 'lane1') r LEFT JOIN hits h ON h.feature_set = f.feature_set AND h.name = f.name AND h.run = r.run GROUP BY f.name, r.run)
SELECT a.name, p.p_name AS symbol, a.n AS count_1, b.n AS count_2 FROM l a JOIN l b ON a.name = b.name AND a.run = 'lane0' AND b.run = 'lane1' LEFT JOIN part p ON p.p_partkey::VARCHAR = a.name""")
def counts_side_by_side(spark, d):
    counts = _counts_by_run(spark, d)
    symbols = views.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("name"), F.col("p_name").alias("symbol"))
    return C.side_by_side(counts.where("run = 'lane0'"), counts.where("run = 'lane1'"), symbols)


@query("summary_counts", "alignments features", f""",\n{_COUNTS}
SELECT 'counts_' || feature_set || '_nbfeatures' AS name, count(*) FILTER ("count" > 0) AS value FROM counts GROUP BY feature_set
UNION ALL SELECT 'counts_' || feature_set || '_nbreads', count(DISTINCT groupid) FROM hits GROUP BY feature_set""")
def summary_counts(spark, d):
    one = C.detected(_counts(spark, d)).select(F.concat(F.lit("counts_"), "feature_set", F.lit("_nbfeatures")).alias("name"), F.col("detected").alias("value"))
    two = C.reads_by_set(views.features(spark, d), views.blocks(spark, d)).select(F.concat(F.lit("counts_"), "feature_set", F.lit("_nbreads")).alias("name"), F.col("nbreads").alias("value"))
    return one.union(two)


# --------------------------------------------------------------- coverage


def _runs_sql(source: str, name: str = "runs") -> str:
    return f"""{name}_e AS (SELECT chrom, edge, sum(w) AS w FROM (SELECT chrom, start AS edge, 1 AS w FROM {source} UNION ALL SELECT chrom, "end" + 1, -1 FROM {source}) GROUP BY chrom, edge HAVING sum(w) <> 0),
{name} AS (SELECT chrom, edge::BIGINT AS start, (lead(edge) OVER (PARTITION BY chrom ORDER BY edge) - 1)::BIGINT AS "end", (sum(w) OVER (PARTITION BY chrom ORDER BY edge))::BIGINT AS depth FROM {name}_e QUALIFY depth <> 0)"""


@query("coverage_runs", "alignments", f",\n{_runs_sql('blocks')} SELECT * FROM runs")
def coverage_runs(spark, d):
    return V.coverage_runs(views.blocks(spark, d))


@query("coverage_stats", "alignments", f""",\n{LENGTHS_SQL},\n{_runs_sql('blocks')},
s AS (SELECT chrom, sum(depth * ("end" - start + 1)) AS b, sum("end" - start + 1) FILTER (depth >= 1) AS g1, coalesce(sum("end" - start + 1) FILTER (depth >= 2), 0) AS g2, coalesce(sum("end" - start + 1) FILTER (depth >= 5), 0) AS g5 FROM runs GROUP BY chrom),
t AS (SELECT chrom, length, b, g1, g2, g5 FROM lengths JOIN s USING (chrom)), u AS (SELECT * FROM t UNION ALL SELECT 'genome', sum(length), sum(b), sum(g1), sum(g2), sum(g5) FROM t)
SELECT chrom, round(b / length, 6)::DOUBLE AS mean, round(g1 / length, 6)::DOUBLE AS ge1, round(g2 / length, 6)::DOUBLE AS ge2, round(g5 / length, 6)::DOUBLE AS ge5 FROM u""")
def coverage_stats(spark, d):
    out = V.coverage_statistics(V.coverage_runs(views.blocks(spark, d)), _lengths(spark))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "ge1", "ge2", "ge5")})


@query("coverage_summary", "alignments", f""",\n{LENGTHS_SQL},\n{_runs_sql('blocks')},
s AS (SELECT chrom, sum(depth * ("end" - start + 1)) AS b, sum("end" - start + 1) FILTER (depth >= 1) AS g1, coalesce(sum("end" - start + 1) FILTER (depth >= 2), 0) AS g2, coalesce(sum("end" - start + 1) FILTER (depth >= 5), 0) AS g5 FROM runs GROUP BY chrom),
t AS (SELECT chrom, length, b, g1, g2, g5 FROM lengths JOIN s USING (chrom)), u AS (SELECT * FROM t UNION ALL SELECT 'genome', sum(length), sum(b), sum(g1), sum(g2), sum(g5) FROM t),
e AS (SELECT chrom, count(*) AS n, round(avg(width)) AS length FROM alignments GROUP BY chrom)
SELECT chrom || '.' || unnest(['mean', 'ge1', 'ge2', 'ge5']) AS name, round(unnest([b, g1, g2, g5]) / length, 6)::DOUBLE AS value FROM u
UNION ALL SELECT 'estimated.fragmentLength', round(sum(length * n) / sum(n))::DOUBLE FROM e""")
def coverage_summary(spark, d):
    lengths = views.alignments(spark, d).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("width")).alias("length"))
    out = V.coverage_summary(V.coverage_statistics(V.coverage_runs(views.blocks(spark, d)), _lengths(spark)), V.weighted_fragment_length(lengths))
    return out.withColumn("value", F.round("value", 6))


@query("post_filters", "variants mask", f""",\n{_CALLS},
n AS (SELECT *, count(*) OVER (PARTITION BY chrom ORDER BY pos RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING) - 1 AS n FROM calls),
known AS (SELECT DISTINCT v.chrom, v.pos, v.alt FROM variants v JOIN mask m ON m.chrom = v.chrom AND v.pos BETWEEN m.start AND m."end")
SELECT chrom, pos, ref, alt, alt_depth FROM n WHERE n <= 20 OR EXISTS (SELECT 1 FROM known k WHERE k.chrom = n.chrom AND k.pos = n.pos AND k.alt = n.alt)""")
def post_filters(spark, d):
    v = views.variants(spark, d)
    return S.post_filter(S.call_variants(S.tally(v)), ("avgNborCount",), lambda: S.inside(v, views.mask(spark, d))).select("chrom", "pos", "ref", "alt", "alt_depth")


@query("coverage_extended_pairs", "alignments", f""",
p AS (SELECT groupid, chrom, min(start) AS start, max("end") AS "end" FROM blocks GROUP BY groupid, chrom), q AS (SELECT * FROM p WHERE "end" - start + 1 < 5000),
{_runs_sql('q')} SELECT * FROM runs""")
def coverage_extended_pairs(spark, d):
    return V.coverage_runs(V.extended_pairs(views.blocks(spark, d), 5000))


@query("coverage_resized", "alignments", f""",
p AS (SELECT chrom, greatest(CASE WHEN strand = '-' THEN "end" - 149 ELSE start END, 1) AS start, CASE WHEN strand = '-' THEN "end" ELSE start + 149 END AS "end" FROM blocks),
{_runs_sql('p')} SELECT * FROM runs""")
def coverage_resized(spark, d):
    return V.coverage_runs(V.resized_blocks(views.blocks(spark, d), 150))


@query("coverage_max_fragment", "alignments", f""",\np AS (SELECT * FROM blocks WHERE "end" - start + 1 < 30),\n{_runs_sql('p')} SELECT * FROM runs""")
def coverage_max_fragment(spark, d):
    return V.coverage_runs(views.blocks(spark, d).where(F.col("end") - F.col("start") + 1 < 30))


@query("coverage_merge_lanes", "alignments", f",\n{_runs_sql('blocks')} SELECT * FROM runs")
def coverage_merge_lanes(spark, d):
    blocks = views.blocks(spark, d)
    return V.merge_runs(I.sweep(blocks, ["run", "chrom"]).drop("run"))


@query("coverage_merge_tiles", "alignments", f",\n{_runs_sql('blocks')} SELECT * FROM runs")
def coverage_merge_tiles(spark, d):
    """The lanes' depths, each by tiles in the form that suits it, added up and given as runs again."""
    lanes = I.sweep(views.blocks(spark, d), ["run", "chrom"])
    parts = [D.tiled(lanes.where(F.col("run") == f"lane{i}").drop("run")) for i in range(3)]
    return D.tiles_to_runs(D.add_tiles(parts[0].unionByName(parts[1]).unionByName(parts[2])))


@query("coverage_tile_forms", "alignments", f""",\n{_runs_sql('blocks')},
cut AS (SELECT chrom, unnest(generate_series((start - 1) // 4096, ("end" - 1) // 4096)) AS tile FROM runs)
SELECT chrom, tile, count(*) >= 410 AS dense, CASE WHEN count(*) >= 410 THEN 4096 ELSE count(*) END AS entries FROM cut GROUP BY chrom, tile""")
def coverage_tile_forms(spark, d):
    """Which form each tile takes, and how many entries it has."""
    tiles = D.tiled(V.coverage_runs(views.blocks(spark, d)))
    return tiles.select("chrom", "tile", F.col("depths").isNotNull().alias("dense"), F.coalesce(F.size("depths"), F.size("runs")).cast("long").alias("entries"))


@query("coverage_sparsity", "alignments", f""",\n{_runs_sql('blocks')} SELECT count(*) AS n_runs, {5 * views.LENGTH}::BIGINT AS length, count(*) / {5 * views.LENGTH}.0 < 0.1 AS sparse FROM runs""")
def coverage_sparsity(spark, d):
    return V.sparsity(V.coverage_runs(views.blocks(spark, d)), _lengths(spark))


@query("checksum_coverage", "alignments", f""",\n{_runs_sql('blocks')} SELECT sum(depth * (start + "end") * ("end" - start + 1) / 2)::BIGINT AS checksum FROM runs""")
def checksum_coverage(spark, d):
    return V.checksum(V.coverage_runs(views.blocks(spark, d)))


@query("fragment_length_weighted", "alignments", """,
e AS (SELECT chrom, count(*) AS n, round(avg(width)) AS length FROM alignments GROUP BY chrom) SELECT round(sum(length * n) / sum(n))::BIGINT AS fragment_length FROM e""")
def fragment_length_weighted(spark, d):
    return V.weighted_fragment_length(views.alignments(spark, d).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("width")).alias("length")))


@query("fragment_length_estimate", "alignments", """,
five AS (SELECT chrom, strand = '-' AS minus, CASE WHEN strand = '-' THEN "end" ELSE start END AS at, count(*) AS k FROM blocks GROUP BY 1, 2, 3),
shift AS (SELECT p.chrom, m.at - p.at + 1 AS length, sum(p.k * m.k) AS pairs FROM five p JOIN five m ON p.chrom = m.chrom AND NOT p.minus AND m.minus AND m.at >= p.at AND m.at < p.at + 300 GROUP BY 1, 2),
best AS (SELECT chrom, length FROM shift QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY pairs DESC, length) = 1)
SELECT b.chrom, count(*) AS n, any_value(best.length)::BIGINT AS length FROM blocks b JOIN best USING (chrom) GROUP BY b.chrom""")
def fragment_length_estimate(spark, d):
    return D.correlate_strands(views.blocks(spark, d), 300)


# -------------------------------------------------------- interval algebra


def _reduce_sql(source: str, name: str, keys: str) -> str:
    return f"""{name}_m AS (SELECT {keys}, start, "end", max("end") OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_i AS (SELECT *, sum(CASE WHEN start > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM {name}_m),
{name} AS (SELECT {keys}, min(start)::BIGINT AS start, max("end")::BIGINT AS "end" FROM {name}_i GROUP BY {keys}, island)"""


_KEYS = ["gene", "chrom", "strand"]


@query("iv_range", "alignments", 'SELECT gene, chrom, strand, min(start) AS start, max("end") AS "end" FROM exons GROUP BY gene, chrom, strand')
def iv_range(spark, d):
    return I.span(views.exons(spark, d), _KEYS)


@query("iv_reduce", "alignments", f",\n{_reduce_sql('exons', 'r', 'gene, chrom, strand')} SELECT * FROM r")
def iv_reduce(spark, d):
    return I.merge_adjacent(views.exons(spark, d), _KEYS).withColumns({c: F.col(c).cast("long") for c in ("start", "end")})


_DISJOIN = """cuts AS (SELECT DISTINCT chrom, edge FROM (SELECT chrom, start AS edge FROM features UNION ALL SELECT chrom, "end" + 1 FROM features)),
pieces AS (SELECT chrom, edge::BIGINT AS start, (lead(edge) OVER (PARTITION BY chrom ORDER BY edge) - 1)::BIGINT AS "end" FROM cuts),
dis AS (SELECT p.chrom, p.start, p."end", count(*) AS depth FROM pieces p JOIN features f ON p.chrom = f.chrom AND p.start >= f.start AND p."end" <= f."end" GROUP BY ALL)"""


@query("iv_disjoin", "features", f",\n{_DISJOIN} SELECT * FROM dis")
def iv_disjoin(spark, d):
    return I.disjoin(views.features(spark, d), ["chrom"])


@query("iv_gaps", "features", f""",\n{LENGTHS_SQL},\n{_reduce_sql('features', 'r', 'chrom')},
g AS (SELECT chrom, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY start), 0) + 1 AS start, start - 1 AS "end" FROM r
  UNION ALL SELECT chrom, max("end") + 1, any_value(length) FROM r JOIN lengths USING (chrom) GROUP BY chrom)
SELECT chrom, start::BIGINT AS start, "end"::BIGINT AS "end" FROM g WHERE start <= "end\"""")
def iv_gaps(spark, d):
    out = I.gaps(views.features(spark, d), ["chrom"], _lengths(spark))
    return out.withColumns({c: F.col(c).cast("long") for c in ("start", "end")})


def _set_sql(a: str, b: str, keys: str, test: str) -> str:
    """Positions one by one: an oracle that shares nothing with the sweep."""
    return f"""pa AS (SELECT DISTINCT {keys}, unnest(generate_series(start::BIGINT, "end"::BIGINT)) AS p FROM {a}),
pb AS (SELECT DISTINCT {keys}, unnest(generate_series(start::BIGINT, "end"::BIGINT)) AS p FROM {b}),
k AS (SELECT * FROM pa {test} SELECT * FROM pb),
j AS (SELECT *, p - row_number() OVER (PARTITION BY {keys} ORDER BY p) AS island FROM k)
SELECT {keys}, min(p)::BIGINT AS start, max(p)::BIGINT AS "end" FROM j GROUP BY {keys}, island"""


@query("iv_setdiff", "alignments", f",\n{_set_sql('exons', 'coding', 'gene, chrom, strand', 'EXCEPT')}")
def iv_setdiff(spark, d):
    return I.set_difference(views.exons(spark, d), views.coding(spark, d), _KEYS)


@query("iv_intersect", "alignments features", ",\n" + _set_sql("exons", "features", "chrom", "INTERSECT"))
def iv_intersect(spark, d):
    return I.intersection(views.exons(spark, d), views.features(spark, d), ["chrom"])


@query("iv_tiles", "features", """,
longest AS (SELECT chrom, max("end")::BIGINT AS length FROM features GROUP BY chrom)
SELECT chrom, s AS start, least(s + 999, length) AS "end" FROM (SELECT chrom, length, unnest(generate_series(1::BIGINT, length, 1000)) AS s FROM longest)""")
def iv_tiles(spark, d):
    """Tiles of the chromosomes as far as features reach."""
    return I.tiles(views.features(spark, d).groupBy("chrom").agg(F.max("end").cast("long").alias("length")), 1000)


@query("single_gene_pieces", "alignments", """,
cuts AS (SELECT DISTINCT chrom, edge FROM (SELECT chrom, start AS edge FROM coding UNION ALL SELECT chrom, "end" + 1 FROM coding)),
pieces AS (SELECT chrom, edge::BIGINT AS start, (lead(edge) OVER (PARTITION BY chrom ORDER BY edge) - 1)::BIGINT AS "end" FROM cuts)
SELECT p.chrom, p.start, p."end", min(c.gene) AS gene FROM pieces p JOIN coding c ON p.chrom = c.chrom AND p.start >= c.start AND p."end" <= c."end" GROUP BY p.chrom, p.start, p."end" HAVING count(DISTINCT c.gene) = 1""")
def single_gene_pieces(spark, d):
    return S.single_gene_pieces(views.coding(spark, d))


@query("intron_regions", "alignments", """,
tx AS (SELECT gene, chrom, strand, min(start) AS start, max("end") AS "end" FROM exons GROUP BY gene, chrom, strand),
r0 AS (SELECT gene, chrom, strand, start, "end", max("end") OVER (PARTITION BY gene, chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM exons)
SELECT gene, chrom, strand, (reach + 1)::BIGINT AS start, (start - 1)::BIGINT AS "end" FROM r0 WHERE start > reach + 1""")
def intron_regions(spark, d):
    exons = views.exons(spark, d)
    return I.set_difference(I.span(exons, _KEYS), exons, _KEYS)


_GENES = "genes AS (SELECT gene, chrom, strand, min(start) AS start, max(\"end\") AS \"end\" FROM exons GROUP BY gene, chrom, strand)"
#: Exons of one lane of genes stretched over a long chromosome, so that something lies between the genes.
_SPARSE = f"""sparse AS (SELECT tx AS gene, chrom, strand, start + (tx % 397) * 1000000::BIGINT AS start, "end" + (tx % 397) * 1000000::BIGINT AS "end" FROM exons)"""


def _sparse(spark, d):
    shift = (F.col("tx") % 397) * 1_000_000
    return views.exons(spark, d).withColumns({"gene": F.col("tx"), "start": F.col("start") + shift, "end": F.col("end") + shift})


@query("intergenic_regions", "alignments", f""",\nlg AS (SELECT 'chr' || i AS chrom, 397000000::BIGINT AS length FROM range(5) t(i)),\n{_SPARSE},
few AS (SELECT gene, chrom, strand, min(start) AS start, max("end") AS "end" FROM sparse GROUP BY gene, chrom, strand),\n{_reduce_sql('few', 'r', 'chrom')},
g AS (SELECT chrom, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY start), 0) + 1 AS start, start - 1 AS "end" FROM r
  UNION ALL SELECT chrom, max("end") + 1, any_value(length) FROM r JOIN lg USING (chrom) GROUP BY chrom)
SELECT chrom, start::BIGINT AS start, "end"::BIGINT AS "end" FROM g WHERE start <= "end\"""")
def intergenic_regions(spark, d):
    lengths = spark.createDataFrame([(c, 397_000_000) for c, _ in CHROMOSOMES], "chrom string, length long")
    out = G.intergenic(_sparse(spark, d), lengths)
    return out.withColumns({c: F.col(c).cast("long") for c in ("start", "end")})


_INTRONS = f"""intr0 AS (SELECT gene, chrom, strand, start, max("end") OVER (PARTITION BY gene, chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM exons),
intr AS (SELECT gene, chrom, strand, (reach + 1)::BIGINT AS start, (start - 1)::BIGINT AS "end" FROM intr0 WHERE start > reach + 1)"""
_PIECES = """cuts AS (SELECT DISTINCT chrom, edge FROM (SELECT chrom, start AS edge FROM coding UNION ALL SELECT chrom, "end" + 1 FROM coding)),
cut_pieces AS (SELECT chrom, edge::BIGINT AS start, (lead(edge) OVER (PARTITION BY chrom ORDER BY edge) - 1)::BIGINT AS "end" FROM cuts),
der AS (SELECT p.chrom, p.start, p."end", min(c.gene) AS gene FROM cut_pieces p JOIN coding c ON p.chrom = c.chrom AND p.start >= c.start AND p."end" <= c."end" GROUP BY p.chrom, p.start, p."end" HAVING count(DISTINCT c.gene) = 1)"""


@query("feature_sets", "alignments", f""",\n{LENGTHS_SQL},\n{_GENES},\n{_INTRONS},\n{_PIECES},\n{_reduce_sql('genes', 'gr', 'chrom')},
gg AS (SELECT chrom, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY start), 0) + 1 AS start, start - 1 AS "end" FROM gr
  UNION ALL SELECT chrom, max("end") + 1, any_value(length) FROM gr JOIN lengths USING (chrom) GROUP BY chrom),
u AS (SELECT 'gene' AS feature_set, gene::VARCHAR AS name, chrom, start, "end", strand FROM genes UNION ALL SELECT 'gene_exonic', gene::VARCHAR, chrom, start, "end", strand FROM exons
  UNION ALL SELECT 'gene_coding', gene::VARCHAR, chrom, start, "end", strand FROM coding
  UNION ALL SELECT DISTINCT 'exon', chrom || ':' || start || '-' || "end", chrom, start, "end", strand FROM exons
  UNION ALL SELECT 'exon_disjoint', chrom || ':' || start || '-' || "end", chrom, start, "end", '*' FROM der
  UNION ALL SELECT 'intergenic', chrom || ':' || start || '..' || "end", chrom, start, "end", '*' FROM gg WHERE start <= "end"
  UNION ALL SELECT 'intron', gene || '.' || chrom || ':' || start || '-' || "end", chrom, start, "end", strand FROM intr)
SELECT feature_set, name, chrom, start::BIGINT AS start, "end"::BIGINT AS "end", strand FROM u""")
def feature_sets(spark, d):
    return G.build_features(I.span(views.exons(spark, d), _KEYS), views.exons(spark, d), views.coding(spark, d), _lengths(spark))


@query("interval_checks", "alignments features", f""",\n{_reduce_sql('features', 'r', 'chrom')}
SELECT (SELECT count(*) FROM r a JOIN r b ON a.chrom = b.chrom AND a.start < b.start AND a."end" >= b.start) = 0 AS merged_disjoint,
  (SELECT count(*) FROM features a JOIN features b ON a.chrom = b.chrom AND a.name < b.name AND a.start <= b."end" AND b.start <= a."end") = 0 AS features_disjoint,
  NOT EXISTS (SELECT 1 FROM coding c WHERE NOT EXISTS (SELECT 1 FROM exons e WHERE e.gene = c.gene AND e.chrom = c.chrom AND e.strand = c.strand AND e.start <= c.start AND e."end" >= c."end")) AS coding_within""")
def interval_checks(spark, d):
    f = views.features(spark, d)
    checks = (I.disjoint_row(I.merge_adjacent(f, ["chrom"]), ["chrom"], "merged_disjoint"), I.disjoint_row(f, ["chrom"], "features_disjoint"), I.within_row(views.coding(spark, d), views.exons(spark, d), _KEYS, "coding_within"))
    return checks[0].join(F.broadcast(checks[1])).join(F.broadcast(checks[2]))


@query("region_restriction", "features mask", "SELECT feature_set, name FROM features f WHERE EXISTS (SELECT 1 FROM mask m WHERE m.chrom = f.chrom AND m.start <= f.\"end\" AND f.start <= m.\"end\")")
def region_restriction(spark, d):
    return G.in_regions(views.features(spark, d), views.mask(spark, d)).select("feature_set", "name")


# --------------------------------------------------------------- variants


@query("variant_mask", "variants mask", "SELECT chrom, pos, ref, alt, sample FROM variants v WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = v.chrom AND v.pos BETWEEN m.start AND m.\"end\")")
def variant_mask(spark, d):
    return S.outside(views.variants(spark, d), views.mask(spark, d)).select("chrom", "pos", "ref", "alt", "sample")


@query("region_scan", "variants mask", """ SELECT chrom, pos, ref, alt, nref, nalt, sample FROM variants v WHERE EXISTS (SELECT 1 FROM mask m WHERE m.chrom = v.chrom AND v.pos BETWEEN m.start AND m."end")""")
def region_scan(spark, d):
    """Variants laid out by place, and those of the mask's regions read back."""
    path = files.shared_folder(spark)
    regions.write_by_region(views.variants(spark, d), path, "pos", "pos")
    return regions.read_regions(spark, path, views.mask(spark, d), "pos", "pos")


@query("variant_restrict", "variants mask", "SELECT chrom, pos, ref, alt, sample FROM variants v WHERE EXISTS (SELECT 1 FROM mask m WHERE m.chrom = v.chrom AND v.pos BETWEEN m.start AND m.\"end\")")
def variant_restrict(spark, d):
    return S.inside(views.variants(spark, d), views.mask(spark, d)).select("chrom", "pos", "ref", "alt", "sample")


_SNV = ", ".join(f"count(*) FILTER (ref = '{x}' AND alt = '{y}') AS \"{x}_{y}\"" for x in "ACGT" for y in "ACGT" if x != y)


@query("vcf_stats", "variants", f"SELECT count(*) AS variants, count(*) FILTER (length(ref) = 1 AND length(alt) = 1) AS snvs, {_SNV} FROM variants")
def vcf_stats(spark, d):
    return S.variant_statistics(views.variants(spark, d))


@query("snv_quantiles", "variants", """,
p AS (SELECT i * 5 AS percent, i / 20.0 AS q FROM range(21) t(i))
SELECT percent::INT AS percent, round((SELECT quantile_cont(nalt, [0,.05,.1,.15,.2,.25,.3,.35,.4,.45,.5,.55,.6,.65,.7,.75,.8,.85,.9,.95,1]) FROM variants)[(percent / 5 + 1)::INT], 6) AS nalt,
round((SELECT quantile_cont(nalt / (nalt + nref)::DOUBLE, [0,.05,.1,.15,.2,.25,.3,.35,.4,.45,.5,.55,.6,.65,.7,.75,.8,.85,.9,.95,1]) FROM variants)[(percent / 5 + 1)::INT], 6) AS fraction FROM p""")
def snv_quantiles(spark, d):
    return S.variant_quantiles(views.variants(spark, d)).withColumns({c: F.round(c, 6) for c in ("nalt", "fraction")})


@query("pileup_tally", "variants", f",\n{_TALLY} SELECT * FROM tal")
def pileup_tally(spark, d):
    return S.tally(views.variants(spark, d))


@query("calling_filters", "variants", f",\n{_CALLS} SELECT * FROM calls")
def calling_filters(spark, d):
    return S.call_variants(S.tally(views.variants(spark, d)))


@query("neighbour_filter", "variants", f""",\n{_CALLS},
n AS (SELECT *, count(*) OVER (PARTITION BY chrom ORDER BY pos RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING) - 1 AS n FROM calls) SELECT chrom, pos, ref, alt, alt_depth FROM n WHERE n <= 20""")
def neighbour_filter(spark, d):
    return S.neighbour_filter(S.call_variants(S.tally(views.variants(spark, d)))).select("chrom", "pos", "ref", "alt", "alt_depth")


@query("genotypes", "alignments variants", f""",\n{_CALLS},\n{_runs_sql('blocks')},
l AS (SELECT *, -10 * (alt_depth * log10(0.001) + ref_depth * log10(0.999)) AS a, -10 * (alt_depth * log10(0.5) + ref_depth * log10(0.5)) AS b, -10 * (alt_depth * log10(0.999) + ref_depth * log10(0.001)) AS c FROM calls),
g AS (SELECT *, round(a - least(a, b, c))::BIGINT AS x, round(b - least(a, b, c))::BIGINT AS y, round(c - least(a, b, c))::BIGINT AS z FROM l)
SELECT g.chrom, pos, ref, alt, CASE WHEN a <= b AND a <= c THEN '0/0' WHEN b <= c THEN '0/1' ELSE '1/1' END AS gt, x || ',' || y || ',' || z AS pl, list_sort([x, y, z])[2] AS gq, coalesce(runs.depth, 0) AS min_depth
FROM g LEFT JOIN runs ON runs.chrom = g.chrom AND g.pos BETWEEN runs.start AND runs."end\"""")
def genotypes(spark, d):
    called = S.genotypes(S.call_variants(S.tally(views.variants(spark, d)))).withColumns({"start": F.col("pos"), "end": F.col("pos")})
    deep = V.minimum_depth(called, V.coverage_runs(views.blocks(spark, d)))
    return deep.select("chrom", "pos", "ref", "alt", "gt", F.array_join(F.col("pl").cast("array<string>"), ",").alias("pl"), "gq", "min_depth")


_PILEUP = """clip AS (SELECT *, CASE WHEN cigar LIKE '2S%' THEN 2 ELSE 0 END AS skip, floor(width / 2)::INT AS half, cigar LIKE '%N%' AS gap FROM aligned WHERE flag & 1536 = 0),
each AS (SELECT *, unnest(range(width)) AS i FROM clip),
base AS (SELECT chrom, pos + i + CASE WHEN gap AND i >= half THEN 100 ELSE 0 END AS pos, substr(seq, (skip + i + 1)::INT, 1) AS base, ascii(substr(qual, (skip + i + 1)::INT, 1)) - 33 AS q FROM each),
cnt AS (SELECT chrom, pos, base, count(*) AS n FROM base WHERE q >= 23 GROUP BY chrom, pos, base),
met AS (SELECT c.*, r.ref FROM cnt c JOIN reference r USING (chrom, pos)),
dep AS (SELECT chrom, pos, coalesce(sum(n) FILTER (base = ref), 0)::BIGINT AS ref_depth, sum(n)::BIGINT AS records FROM met GROUP BY chrom, pos),
pile AS (SELECT chrom, pos, ref, base AS alt, n AS alt_depth, ref_depth, records FROM met JOIN dep USING (chrom, pos) WHERE base <> ref)"""


@query("pileup_bases", "alignments aligned mask", f",\n{_PILEUP} SELECT * FROM pile v WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = v.chrom AND v.pos BETWEEN m.start AND m.\"end\")")
def pileup_bases(spark, d):
    return S.pileup(views.aligned_reads(spark, d), views.reference(spark), 23, mask=views.mask(spark, d))


@query("pileup_regions", "alignments aligned mask", f",\n{_PILEUP} SELECT * FROM pile v WHERE EXISTS (SELECT 1 FROM mask m WHERE m.chrom = v.chrom AND v.pos BETWEEN m.start AND m.\"end\")")
def pileup_regions(spark, d):
    return S.pileup(views.aligned_reads(spark, d), views.reference(spark), 23, which=views.mask(spark, d))


@query("variant_concordance", "variants", """,
s AS (SELECT DISTINCT sample, chrom, pos, ref, alt FROM variants), n AS (SELECT sample, count(*) AS n FROM s GROUP BY sample),
j AS (SELECT a.sample AS a, b.sample AS b, count(*) AS shared FROM s a JOIN s b ON a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt AND a.sample < b.sample GROUP BY 1, 2)
SELECT x.sample AS a, y.sample AS b, coalesce(shared, 0) AS shared, round(coalesce(shared, 0) / least(x.n, y.n)::DOUBLE, 6) AS concordance, coalesce(shared, 0) / least(x.n, y.n)::DOUBLE >= 0.8 AS concordant FROM n x JOIN n y ON x.sample < y.sample LEFT JOIN j ON j.a = x.sample AND j.b = y.sample""")
def variant_concordance(spark, d):
    return S.concordance(views.variants(spark, d)).withColumn("concordance", F.round("concordance", 6))


# ------------------------------------------------------- lanes and quality

_CATEGORIES = ["concordant_uniq", "concordant_mult", "unpaired_uniq"]
_MATRIX = "m AS (SELECT run, " + ", ".join(f"count(*) FILTER (category = '{c}')::DOUBLE AS {c}" for c in _CATEGORIES) + " FROM alignments GROUP BY run)"
_RATIOS = f"{_MATRIX},\nr AS (SELECT run, " + ", ".join(f"round({c} * 100 / (concordant_uniq + concordant_mult + unpaired_uniq), 4) AS {c}_pct" for c in _CATEGORIES) + " FROM m)"


def _lane_summary(spark, d):
    return views.alignments(spark, d).groupBy("run", F.col("category").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))


@query("runs_matrix", "alignments", f",\n{_MATRIX} SELECT * FROM m")
def runs_matrix(spark, d):
    return Q.runs_matrix(_lane_summary(spark, d), _CATEGORIES)


def _ratios(spark, d):
    matrix = Q.runs_matrix(_lane_summary(spark, d), _CATEGORIES).withColumn("mapped", F.expr(" + ".join(_CATEGORIES)))
    return Q.run_ratios(matrix, _CATEGORIES, "mapped")


@query("qc_ratios", "alignments", f",\n{_RATIOS} SELECT * FROM r")
def qc_ratios(spark, d):
    return _ratios(spark, d)


@query("qc_calls", "alignments", f""",\n{_RATIOS}
SELECT run, concordant_uniq_pct < 30 AS concordant_uniq_pct, concordant_mult_pct > 24.5 AS concordant_mult_pct,
array_to_string(list_filter([CASE WHEN concordant_uniq_pct < 30 THEN 'concordant_uniq_pct' END, CASE WHEN concordant_mult_pct > 24.5 THEN 'concordant_mult_pct' END], lambda x: x IS NOT NULL), ',') AS failing,
concordant_uniq_pct < 30 OR concordant_mult_pct > 24.5 AS final FROM r""")
def qc_calls(spark, d):
    return Q.quality_calls(_ratios(spark, d), {"concordant_uniq_pct": ("<", 30.0), "concordant_mult_pct": (">", 24.5)})


def _alignment_matrix(spark, d):
    """Reads by category for each lane; those that passed preprocessing but have no record are not mapped."""
    a = views.alignments(spark, d)
    return a.groupBy("run").agg(*[F.count_if(F.col("category") == c).cast("double").alias(c) for c in _CATEGORIES], F.count_if(F.col("category") == "concordant_uniq").cast("double").alias("analyzed"), F.count_if(F.col("mapq") < 36).cast("double").alias("nomapping"))


def _lane_reads(spark, d):
    """A preprocessing summary that fits the alignments: every record is a read that went in."""
    a = views.alignments(spark, d)
    n, c = F.count(F.lit(1)), lambda test: F.count_if(test)
    return a.groupBy("run").agg((n + 100).alias("total_reads"), (n + 20).alias("highqual_reads"), c(F.col("nm") == 9).alias("adapter_contam"), F.lit(20).cast("long").alias("rRNA_contam_reads"), n.alias("processed_reads"), F.min("width").cast("long").alias("processed_min_read_length"), F.max("width").cast("long").alias("processed_max_read_length"))


_READS_SQL = """pre AS (SELECT run, count(*) + 100 AS total_reads, count(*) + 20 AS highqual_reads, count(*) FILTER (nm = 9) AS adapter_contam, 20 AS "rRNA_contam_reads", count(*) AS processed_reads,
  min(width) AS lo, max(width) AS hi FROM alignments GROUP BY run),
cat AS (SELECT run, count(*) FILTER (category = 'concordant_uniq') AS concordant_uniq, count(*) FILTER (category = 'concordant_mult') AS concordant_mult, count(*) FILTER (category = 'unpaired_uniq') AS unpaired_uniq,
  count(*) FILTER (category = 'concordant_uniq') AS analyzed, count(*) FILTER (mapq < 36) AS nomapping FROM alignments GROUP BY run)"""


@query("lane_funnel", "mask", """,
p AS (SELECT 'lane' || (p_partkey % 3) AS run, p_partkey % 10 <> 3 AS high, p_partkey % 12 AS k FROM part),
s AS (SELECT run, count(*) AS total, count(*) FILTER (high) AS high, count(*) FILTER (high AND k <> 6) AS mapped, count(*) FILTER (high AND k IN (0, 1, 2, 3, 4, 5, 9)) AS uniq,
  count(*) FILTER (high AND k = 11) AS mult, count(*) FILTER (high AND k IN (7, 8)) AS transloc, count(*) FILTER (high AND k = 6) AS none, count(*) FILTER (high AND k = 0) AS analyzed FROM p GROUP BY run),
u AS (SELECT run, total, unnest([1,2,3,4,5,6,7,8,9,10,11]) AS step, unnest(['Total','High-Qual','Adapter contam','rRNA reads','Post-preprocess','Mapped','Uniquely','Multiple','Translocation','Unmapped','Analyzed']) AS name,
  unnest([total, high, 0, 0, high, mapped, uniq, mult, transloc, none, analyzed]) AS n FROM s)
SELECT run, step::INT AS step, name, n::BIGINT AS n, round(n * 100.0 / total, 2)::DOUBLE AS percent FROM u""")
def lane_funnel(spark, d):
    """The funnel of three lanes from their reads on: preprocessed, and what stays placed on the reference and sorted into categories."""
    key = F.col("id").cast("long")
    quality = F.when(key % 10 == 3, F.repeat(F.lit("#"), F.lit(60))).otherwise(F.repeat(F.lit("I"), F.lit(60)))
    reads = views.sequenced_pairs(spark, d).withColumns({"run": F.concat(F.lit("lane"), key % 3), "qual1": quality, "qual2": quality})
    marked = P.preprocess(reads, "sanger", 23, 0.7)
    kept, references = marked.where("processed").select("run", "id", "seq1", "seq2"), views.with_repeat(spark)
    mates = [kept.select("id", F.col(f"seq{m}").alias("seq")) for m in (1, 2)]
    kinds = [GA.read_categories(GA.placements(m, references, longest_intron=NEAR), m, NEAR) for m in mates]
    matrix = GA.category_matrix(GA.pair_categories(*kinds, concordant=NEAR).join(kept.select("id", "run"), "id"))
    return Q.read_funnel(P.summary(marked, ["run"]), matrix)


@query("read_funnel", "alignments", f""",\n{_READS_SQL},
b AS (SELECT * FROM pre JOIN cat USING (run)),
u AS (SELECT run, total_reads AS t, unnest([1,2,3,4,5,6,7,8,9,10,11]) AS step, unnest(['Total','High-Qual','Adapter contam','rRNA reads','Post-preprocess','Mapped','Uniquely','Multiple','Translocation','Unmapped','Analyzed']) AS name,
  unnest([total_reads, highqual_reads, adapter_contam, "rRNA_contam_reads", processed_reads, processed_reads - nomapping, concordant_uniq + unpaired_uniq, concordant_mult, 0, nomapping, analyzed]) AS n FROM b)
SELECT run, step::INT AS step, name, n::BIGINT AS n, round(n * 100.0 / t, 2)::DOUBLE AS percent FROM u""")
def read_funnel(spark, d):
    return Q.read_funnel(_lane_reads(spark, d), _alignment_matrix(spark, d))


@query("run_sanity", "alignments", f""",\n{_READS_SQL}
SELECT run, concordant_uniq + concordant_mult + unpaired_uniq + nomapping = processed_reads AS complete, concordant_uniq + unpaired_uniq > concordant_mult AS more_unique FROM pre JOIN cat USING (run)""")
def run_sanity(spark, d):
    return Q.sanity_checks(_lane_reads(spark, d), _alignment_matrix(spark, d))


def _bam_matrix(spark, d):
    """Alignment statistics of each lane; chr4 stands for the mitochondrial chromosome."""
    size = F.abs("isize")
    edge = F.least(F.ceil((size - 1) / 10) - 1, F.lit(59)) * 10 + 1
    a = views.alignments(spark, d).withColumn("edge", F.when(size > 1, edge))
    return a.groupBy("run").agg(F.count(F.lit(1)).alias("mapped"), *[F.count_if(F.col("nm") == i).alias(f"nm_{i}") for i in range(8)], F.count_if(F.col("nm") >= 8).alias("nm_8"), F.count_if(F.col("cigar").contains("N")).alias("with_n"), F.count_if(F.col("cigar").contains("S")).alias("with_s"),
        F.count_if(F.col("chrom") == "chr4").alias("chromosome_bin_MT"), *[F.count_if(F.col("edge") == i).alias(f"target_length_bin_{i}") for i in range(1, 592, 10)])


_BAM_SQL = """bam AS (SELECT run, count(*) FILTER (nm >= 2) * 100.0 / count(*) AS nm2plus, count(*) FILTER (abs(isize) > 591) * 100.0 / count(*) FILTER (abs(isize) > 1) AS bin591, count(*) FILTER (cigar LIKE '%N%') * 100.0 / count(*) AS junction,
  round(count(*) FILTER (cigar LIKE '%S%') * 100.0 / count(*), 2) AS s, round(count(*) FILTER (chrom = 'chr4') * 100.0 / count(*), 2) AS mt FROM alignments GROUP BY run)"""


@query("bam_shares", "alignments", f",\n{_BAM_SQL} SELECT run, round(nm2plus, 6)::DOUBLE AS nm2plus, round(bin591, 6)::DOUBLE AS target_length_bin_591, round(junction, 6)::DOUBLE AS junction_reads, s::DOUBLE AS with_s_pct, mt::DOUBLE AS mt_pct FROM bam")
def bam_shares(spark, d):
    out = Q.bam_shares(_bam_matrix(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("nm2plus", "target_length_bin_591", "junction_reads")})


@query("selected_bam_stats", "alignments", """,
x AS (SELECT run, count(*) AS mapped, count(*) FILTER (cigar LIKE '%N%') AS n, count(*) FILTER (cigar LIKE '%S%') AS s, count(*) FILTER (nm = 0) AS z FROM alignments GROUP BY run),
y AS (SELECT run, mapped, unnest(['with_n', 'with_s', 'nm_0']) AS name, unnest([n, s, z]) AS value FROM x) SELECT run, name, value::DOUBLE AS value, round(value * 100.0 / mapped, 2)::DOUBLE AS percent FROM y""")
def selected_bam_stats(spark, d):
    return Q.selected_stats(_bam_matrix(spark, d), ["with_n", "with_s", "nm_0"])


def _gene_reads(spark, d, by):
    """Reads by feature set of the gene model for each lane, `gene` and `exon` and so on standing for brands of features."""
    kinds = {"Brand#11": "gene", "Brand#12": "exon", "Brand#13": "gene_coding", "Brand#14": "gene_exonic", "Brand#15": "intergenic"}
    names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    features = views.features(spark, d).withColumn("feature_set", F.coalesce(names[F.col("feature_set")], F.col("feature_set")))
    return C.reads_by_set(features, views.blocks(spark, d), tuple(by))


_KINDS_SQL = """kinds AS (SELECT *, CASE feature_set WHEN 'Brand#11' THEN 'gene' WHEN 'Brand#12' THEN 'exon' WHEN 'Brand#13' THEN 'gene_coding' WHEN 'Brand#14' THEN 'gene_exonic' WHEN 'Brand#15' THEN 'intergenic' ELSE feature_set END AS kind FROM features),
kr AS (SELECT b.run, k.kind, b.groupid FROM kinds k JOIN blocks b ON k.chrom = b.chrom AND k.start <= b."end" AND b.start <= k."end")"""


@query("class_shares", "alignments features", f""",\n{_KINDS_SQL},
c AS (SELECT kind, count(DISTINCT groupid) AS n FROM kr GROUP BY kind), o AS (SELECT coalesce(sum(n) FILTER (kind = 'gene'), 0) AS g, coalesce(sum(n) FILTER (kind = 'exon'), 0) AS e, coalesce(sum(n) FILTER (kind = 'gene_coding'), 0) AS c, coalesce(sum(n) FILTER (kind = 'intergenic'), 0) AS i, (SELECT count(DISTINCT groupid) FROM blocks) AS t FROM c),
u AS (SELECT t, unnest(['Genes', 'Exons', 'CDS', 'Introns', 'Intergenic']) AS feature_class, unnest([g, e, c, g - e, i]) AS reads FROM o)
SELECT feature_class, reads::BIGINT AS reads, round(reads * 100.0 / t, 2)::DOUBLE AS percent FROM u""")
def class_shares(spark, d):
    return C.class_shares(_gene_reads(spark, d, []), views.blocks(spark, d).agg(F.countDistinct("groupid").alias("n")))


def _read_matrix(spark, d):
    """Everything counted of each lane in one row, from the summary matrices."""
    counts = _gene_reads(spark, d, ["run"]).where("feature_set in ('gene', 'gene_exonic')").select("run", F.concat("feature_set", F.lit("_nbreads")).alias("name"), F.col("nbreads").cast("double").alias("value"))
    names = {"counts": ["gene_nbreads", "gene_exonic_nbreads"], "alignment": [*_CATEGORIES, "analyzed", "nomapping"], "preprocess": ["total_reads", "highqual_reads", "processed_reads"]}
    found = Q.summary_matrices({"preprocess": Q.as_summary(_lane_reads(spark, d)), "alignment": Q.as_summary(_alignment_matrix(spark, d)), "counts": counts}, names)
    return Q.with_totals(found["preprocess"].join(found["alignment"], "run").join(found["counts"], "run"))


_READ_MATRIX = f"""{_READS_SQL},\n{_KINDS_SQL},
kn AS (SELECT run, count(DISTINCT groupid) FILTER (kind = 'gene') AS g, count(DISTINCT groupid) FILTER (kind = 'gene_exonic') AS x FROM kr GROUP BY run),
rm AS (SELECT run, total_reads::DOUBLE AS total_reads, highqual_reads::DOUBLE AS highqual_reads, processed_reads::DOUBLE AS processed_reads, concordant_uniq::DOUBLE AS concordant_uniq, concordant_mult::DOUBLE AS concordant_mult, unpaired_uniq::DOUBLE AS unpaired_uniq,
  analyzed::DOUBLE AS analyzed, nomapping::DOUBLE AS nomapping, g::DOUBLE AS gene_nbreads, x::DOUBLE AS gene_exonic_nbreads, concordant_mult::DOUBLE AS mult_mapping, unpaired_uniq::DOUBLE AS unpaired_mapping, 0.0::DOUBLE AS half_mapping FROM pre JOIN cat USING (run) JOIN kn USING (run))"""
_NAMES = ["total_reads", "highqual_reads", "processed_reads", *_CATEGORIES, "analyzed", "nomapping", "gene_nbreads", "gene_exonic_nbreads", "mult_mapping", "unpaired_mapping", "half_mapping"]


@query("summary_matrix", "alignments features", f",\n{_READ_MATRIX} SELECT * FROM rm")
def summary_matrix(spark, d):
    m = _read_matrix(spark, d)
    return m.select("run", *[F.col(c).cast("double").alias(c) for c in m.columns if c != "run"])


_NORMALISED = ", ".join(f'round({c} / {w} * 100, 6) AS "{c}/{k}"' for k, w in (("total", "total_reads"), ("processed", "processed_reads"), ("analyzed", "analyzed")) for c in _NAMES)


@query("variant_matrix", "variants", """,
v AS (SELECT sample AS run, count(*) AS variants, count(*) FILTER (ref = 'A' AND alt = 'G') AS ag, count(*) FILTER (ref = 'T' AND alt = 'C') AS tc FROM variants GROUP BY sample)
SELECT run, variants::DOUBLE AS variants, ag::DOUBLE AS "A_G", tc::DOUBLE AS "T_C" FROM v""")
def variant_matrix(spark, d):
    """The matrix of variant summaries, a row a run."""
    rows = Q.as_summary(S.variant_statistics(views.variants(spark, d), ["sample"]), by="sample")
    return Q.summary_matrices({"variants": rows}, {"variants": ["variants", "A_G", "T_C"]})["variants"]


@query("target_length_matrix", "alignments", """,
u AS (SELECT run, abs(isize)::DOUBLE AS x FROM alignments WHERE flag & 512 = 0 AND flag & 1024 = 0 AND abs(isize) < 600)
SELECT run, quantile_cont(x, 0.0) AS target_length_min, quantile_cont(x, 0.25) AS target_length_q1, quantile_cont(x, 0.5) AS target_length_median, quantile_cont(x, 0.75) AS target_length_q3,
  quantile_cont(x, 1.0) AS target_length_max, round(avg(x), 6) AS target_length_mean FROM u GROUP BY run""")
def target_length_matrix(spark, d):
    """The matrix of target lengths, a row a run."""
    rows = Q.as_summary(S.target_length_rows(views.alignments(spark, d)))
    names = [f"target_length_{n}" for n in ("min", "q1", "median", "q3", "max", "mean")]
    return Q.summary_matrices({"target_lengths": rows}, {"target_lengths": names})["target_lengths"].withColumn("target_length_mean", F.round("target_length_mean", 6))


@query("normalised_matrix", "alignments features", f",\n{_READ_MATRIX} SELECT run, {_NORMALISED} FROM rm")
def normalised_matrix(spark, d):
    out = Q.normalised(_read_matrix(spark, d))
    return out.select("run", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in out.columns if c != "run"])


_LIMITS = {"goodReads": 500.0, "analyzed": 100.0, "concordantUniq": 5000.0, "analyzedPerc": 24.8, "concordantUniqPerc": 25.1, "geneReadsPerc": 120.0, "geneExonicReadsPerc": 10.0, "junctionReads": 28.0, "targetBin591": 15.5, "cigarWithS": 30.0, "mtReads": 20.0, "nonMappingPct": 0.5, "highQualPct": 99.0}


def _calls(spark, d, technology):
    reads = _read_matrix(spark, d)
    qc = reads.join(Q.normalised(reads), "run").join(Q.bam_shares(_bam_matrix(spark, d)), "run").join(Q.lengths_equal(_lane_reads(spark, d)), "run")
    return Q.final_calls(Q.threshold_calls(qc, _LIMITS, technology), technology)


def _calls_sql(technology: str) -> str:
    """Every test as SQL; those that fail a run are listed in their own order, the others by name."""
    tests = {
        "goodReads": "total_reads < {}", "analyzed": "analyzed < {}", "analyzedPerc": "analyzed * 100 / total_reads < {}", "geneReadsPerc": "gene_nbreads * 100 / analyzed < {}", "geneExonicReadsPerc": "gene_exonic_nbreads * 100 / analyzed < {}",
        "highQualPct": "highqual_reads * 100 / total_reads < {}", "cigarWithS": "s > {}", "mtReads": "mt > {}", "nonMappingPct": "nomapping * 100 / processed_reads > {}", "concordantUniq": "concordant_uniq < {}",
        "concordantUniqPerc": "concordant_uniq * 100 / processed_reads < {}", "inOutLenEqual": "NOT (lo = hi AND lo = (SELECT median(lo) FROM pre))", "junctionReads": "junction < {}" if technology == "RNASeq" else "junction > {}",
    }
    if technology != "RNASeq":
        tests["targetBin591"] = "bin591 > {}"
    columns = ", ".join(f'{t.format(_LIMITS.get(n))} AS "{n}"' for n, t in tests.items())
    matter = [t for t in (Q.FAIL_RNA if technology == "RNASeq" else Q.FAIL_OTHER) if t in tests]
    listed = lambda names: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN \"{n}\" THEN '{n}' END" for n in names) + "], lambda x: x IS NOT NULL), ',')"
    final = " OR ".join(f'"{n}"' for n in matter)
    return f"{_READ_MATRIX},\n{_BAM_SQL},\nct AS (SELECT rm.run, {columns} FROM rm JOIN bam USING (run) JOIN pre USING (run)) SELECT *, {final} AS final, {listed(matter)} AS failed, {listed(sorted(set(tests) - set(matter)))} AS warnings FROM ct".replace("total_reads <", "rm.total_reads <").replace("* 100 / total_reads", "* 100 / rm.total_reads").replace("highqual_reads * 100", "rm.highqual_reads * 100").replace("/ processed_reads", "/ rm.processed_reads")


@query("qc_final_rna", "alignments features", f",\n{_calls_sql('RNASeq')}")
def qc_final_rna(spark, d):
    return _calls(spark, d, "RNASeq")


@query("qc_final_exome", "alignments features", f",\n{_calls_sql('Exome')}")
def qc_final_exome(spark, d):
    return _calls(spark, d, "Exome")


@query("merge_lanes", "alignments", "SELECT category AS name, count(*)::DOUBLE AS value FROM alignments GROUP BY category")
def merge_lanes(spark, d):
    return _lane_summary(spark, d).groupBy("name").agg(F.sum("value").alias("value"))


@query("config_merge", "mask", """,
kept AS (SELECT DISTINCT 'nation.' || n_name AS key, n_regionkey::VARCHAR AS value FROM nation, orders WHERE o_custkey % 25 = n_nationkey),
seen AS (SELECT 'orders.' || left(o_orderpriority, 1) AS key, count(*)::VARCHAR AS value FROM orders GROUP BY o_orderkey % 3, left(o_orderpriority, 1))
SELECT key, value FROM kept UNION ALL
SELECT key, CASE WHEN count(DISTINCT value) = 1 THEN min(value) ELSE '<merged>' || string_agg(DISTINCT value, ' ' ORDER BY value) || '</merged>' END FROM seen GROUP BY key""")
def config_merge(spark, d):
    """Three lanes' settings: nations that their orders touch, the same in all lanes, and how many orders of each priority they have."""
    orders = views.table(spark, d, "orders").withColumn("lane", F.concat(F.lit("lane"), F.col("o_orderkey") % 3))
    nations = views.table(spark, d, "nation").select(F.concat(F.lit("nation."), "n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value"), "n_nationkey")
    touched = orders.join(nations, F.col("o_custkey") % 25 == F.col("n_nationkey"), "left_semi").select("lane").distinct()
    met = nations.join(orders.select((F.col("o_custkey") % 25).alias("n_nationkey")).distinct(), "n_nationkey").select("key", "value")
    same = met.join(F.broadcast(touched)).select("lane", "key", "value")
    seen = orders.groupBy("lane", F.concat(F.lit("orders."), F.substring("o_orderpriority", 1, 1)).alias("key")).agg(F.count("*").cast("string").alias("value"))
    settings = S.assert_same_keys(same.unionByName(seen.select("lane", "key", "value")))
    return S.merge_settings(settings, tuple(f"orders.{i}" for i in range(1, 6)))
