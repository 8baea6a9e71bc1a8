import gzip
import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators.align import best_hits, categories, contaminated_ids
from strandlake.sources import config, fastq, files
from strandlake.streaming.lanes import merged, summarise_arriving


def test_fastq_round_trip(spark, tmp_path):
    text = "".join(f"@r{i}/1\n{'ACGT' * 3}\n+\n{'I' * 12}\n" for i in range(26))
    (tmp_path / "a.fastq").write_text(text)
    rows = files.read_fastq(spark, str(tmp_path / "a.fastq"))
    assert [r.id for r in rows.orderBy("record").collect()] == [f"r{i}/1" for i in range(26)]
    pairs = files.read_fastq_pair(spark, *[str(tmp_path / "a.fastq")] * 2)
    files.write_fastq(pairs, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 26 * 4
    (tmp_path / "bad.fastq").write_text(text[:-5])
    with pytest.raises(Exception, match="bad FASTQ"):
        files.read_fastq(spark, str(tmp_path / "bad.fastq")).collect()


def test_mates_of_different_length_fail(spark, tmp_path):
    (tmp_path / "a").write_text("@a\nA\n+\nI\n@b\nA\n+\nI\n")
    (tmp_path / "b").write_text("@a\nA\n+\nI\n")
    with pytest.raises(Exception, match="differ in length"):
        files.read_fastq_pair(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()


def test_other_files(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">one\nACGT\nAC\n>two\nGG\n")
    assert {(r.name, r.seq) for r in files.read_fasta(spark, str(tmp_path / "x.fa")).collect()} == {("one", "ACGTAC"), ("two", "GG")}
    (tmp_path / "x.bed").write_text("17\t0\t10\tn\t1\t+\n")
    assert files.read_bed(spark, str(tmp_path / "x.bed")).first()[:3] == ("17", 1, 10)
    variants = spark.createDataFrame([("y", 5, "A", "G", 3, 4), ("x", 9, "C", "T", 1, 2)], "chrom string, pos int, ref string, alt string, nref int, nalt int")
    assert files.write_vcf(variants, str(tmp_path / "v"))
    assert {(r.chrom, r.pos, r.nref, r.nalt) for r in files.read_vcf(spark, str(tmp_path / "v")).collect()} == {("x", 9, 1, 2), ("y", 5, 3, 4)}
    assert not files.write_vcf(variants.limit(0), str(tmp_path / "none"))


def test_broken_gzip_fails_and_records_are_counted(spark, tmp_path):
    text = "".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(3000))
    packed = gzip.compress(text.encode())
    (tmp_path / "a.fastq.gz").write_bytes(packed)
    (tmp_path / "b.fastq.gz").write_bytes(packed[: len(packed) // 2])
    assert files.read_fastq(spark, str(tmp_path / "a.fastq.gz")).count() == files.count_fastq(spark, str(tmp_path / "a.fastq.gz")) == 3000
    with pytest.raises(Exception, match="(?i)unexpected end|bad FASTQ"):
        files.read_fastq(spark, str(tmp_path / "b.fastq.gz")).collect()
    both = files.read_fastq_pair(spark, *[str(tmp_path / "a.fastq.gz")] * 2)
    assert both.where("seq1 = seq2 and qual1 = qual2").count() == 3000
    with pytest.raises(ValueError):
        (tmp_path / "d.fastq").write_text("@a\nA\n+\n")
        files.count_fastq(spark, str(tmp_path / "d.fastq"))
    files.concatenate_fastq(spark, [str(tmp_path / "a.fastq.gz")] * 2, str(tmp_path / "both"))
    assert spark.read.text(str(tmp_path / "both")).count() == 24000
    empty = files.read_fastq_pair(spark, str(tmp_path / "a.fastq.gz")).limit(0)
    files.write_fastq(empty, str(tmp_path / "empty"))
    assert spark.read.text(str(tmp_path / "empty")).count() == 0


def test_tables_runs_and_alignments(spark, tmp_path):
    rows = spark.createDataFrame([("total", 26.0), ("kept", 25.0)], "name string, value double")
    files.write_table(rows, str(tmp_path / "x.summary.tab"), "tab")
    assert {(r.name, r.value) for r in files.read_name_value(spark, str(tmp_path / "x.summary.tab")).collect()} == {("total", 26.0), ("kept", 25.0)}
    assert files.read_named(spark, str(tmp_path), r"\.summary", "name string, value double").count() == 2
    with pytest.raises(FileNotFoundError):
        files.only_path(spark, str(tmp_path), "nothing")
    files.write_table(rows, str(tmp_path / "x.csv"), "csv")
    assert spark.read.csv(str(tmp_path / "x.csv"), header=True).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_table(rows, str(tmp_path / "x.csv"), "csv")
    files.write_table(rows, str(tmp_path / "x.csv"), "csv", mode="overwrite")
    with pytest.raises(ValueError):
        files.write_table(rows, str(tmp_path / "y"), "xlsx")
    runs = spark.createDataFrame([("x", 1, 10, 3), ("x", 11, 12, 1)], "chrom string, start long, end long, depth long")
    files.write_runs(runs, str(tmp_path / "runs"))
    assert sorted(files.read_runs(spark, str(tmp_path / "runs")).collect()) == sorted(runs.collect())
    a = spark.createDataFrame([("x", 5, "uniq"), ("x", 1, "uniq"), ("y", 2, "mult")], "chrom string, pos int, category string")
    files.write_alignments(files.merge_alignments([a, a.limit(0)], sort=False), str(tmp_path / "al"))
    assert sorted(p.name for p in (tmp_path / "al").glob("category=*")) == ["category=mult", "category=uniq"]
    assert [r.pos for r in spark.read.parquet(str(tmp_path / "al" / "category=uniq")).collect()] == [1, 5]
    assert [r.pos for r in files.merge_alignments([a, a]).collect()] == [1, 1, 5, 5, 2, 2]
    (tmp_path / "x.dict").write_text("@HD\tVN:1.0\n@SQ\tSN:one\tLN:12\n")
    assert files.read_lengths(spark, str(tmp_path / "x.dict")).first()[:] == ("one", 12)
    files.write_fasta(spark.createDataFrame([("s", "ACGT" * 40)], "name string, seq string"), str(tmp_path / "fa"))
    assert files.read_fasta(spark, str(tmp_path / "fa")).first()[:] == ("s", "ACGT" * 40)
    folder = tmp_path / "kept"
    folder.mkdir()
    with pytest.raises(FileExistsError):
        files.prepare_folder(spark, str(folder))
    assert files.prepare_folder(spark, str(folder), "overwrite") == "overwrite" and folder.exists()
    assert files.prepare_folder(spark, str(folder), "erase") == "errorifexists" and not folder.exists()
    with pytest.raises(ValueError):
        files.prepare_folder(spark, str(folder), "perhaps")


def test_settings(tmp_path):
    (tmp_path / "base.txt").write_text("a: 1\nb: 2 # note\n\n# all\n")
    (tmp_path / "own.txt").write_text("template_config: base.txt\nb: 3\nflag: true\nlist: x, y,z\n")
    got = config.load(str(tmp_path / "own.txt"))
    assert (got["a"], got["b"], config.boolean(got, "flag"), config.listed(got, "list")) == ("1", "3", True, ["x", "y", "z"])
    with pytest.raises(ValueError):
        config.parse("no colon")
    with pytest.raises(ValueError):
        config.number(got, "b", 0, 2)
    assert config.unknown(got, {"a": "", "b": ""}) == ["flag", "list", "template_config"]


def test_faults_of_settings():
    good = {"num_cores": "4", "paired_ends": "TRUE", "input_file": "a", "input_file2": "b", "trimReads.do": "FALSE", "trimReads.trim5": "0", "filterQuality.minFrac": "0.7", "analyzeVariants.callingFilters": "nonRef, readCount"}
    known = ("nonRef", "readCount")
    assert config.faults(good, known) == []
    bad = [
        {"num_cores": "0"}, {"filterQuality.minFrac": "1.5"}, {"filterQuality.minQuality": "x"}, {"overwrite_save_dir": "maybe"}, {"paired_ends": "yes"}, {"input_file2": ""}, {"input_file2": "a"}, {"save_dir": "a b"},
        {"trimReads.do": "TRUE"}, {"trimReads.length": "50"}, {"coverage.fragmentLength": "100"}, {"analyzeVariants.callingFilters": "other"}, {"paired_ends": "FALSE"},
    ]
    assert all(config.faults(good | b, known) for b in bad)


def test_lanes_that_arrive_add_up(spark, tmp_path):
    for i in range(2):
        spark.range(10 * (i + 1)).withColumn("run", F.lit(i)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    partial = lambda df: df.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    summarise_arriving(spark, str(tmp_path / "in"), "id long, run int", partial, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert merged(spark, str(tmp_path / "out"), lambda df: df.agg(F.sum("n").alias("n"))).first().n == 30


def test_reads_find_their_place(spark):
    import random

    rnd = random.Random(7)
    ref = "".join(rnd.choice("ACGT") for _ in range(600))
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    one = [("p", ref[100:140]), ("q", ref[50:90]), ("r", "A" * 40)]
    two = [("p", back(ref[300:340])), ("q", "C" * 40), ("r", "G" * 40)]
    refs = spark.createDataFrame([("x", ref)], "chrom string, ref string")
    h1, h2 = (best_hits(spark.createDataFrame(x, "id string, seq string"), refs) for x in (one, two))
    assert h1.where("id = 'p'").select("pos", "strand", "nm").first() == (101, "+", 0)
    pairs = spark.createDataFrame([(f"{a}/1", x, y) for (a, x), (_, y) in zip(one, two)], "id string, seq1 string, seq2 string")
    assert {r.id for r in contaminated_ids(pairs, refs).collect()} == {"p", "q"}
    long = "".join(rnd.choice("ACGT") for _ in range(9000))
    far = [(str(p), long[p : p + 50]) for p in (0, 4070, 4090, 8180, 8950)]  # over the edges of tiles
    placed = best_hits(spark.createDataFrame(far, "id string, seq string"), spark.createDataFrame([("y", long)], "chrom string, ref string"))
    assert {(r.id, r.pos, r.nm) for r in placed.collect()} == {(str(p), p + 1, 0) for p in (0, 4070, 4090, 8180, 8950)}
    ids = spark.createDataFrame([(x,) for x in "pqr"], "id string")
    assert {r.id: r.category for r in categories(h1, h2, ids, 40).collect()} == {"p": "concordant_uniq", "q": "halfmapping_uniq", "r": "nomapping"}


@pytest.fixture(scope="module")
def tricky(tmp_path_factory):
    """Two mate files whose qualities begin with `@` or `+`, with records of all lengths and an empty one."""
    draw, folder = random.Random(7), tmp_path_factory.mktemp("fastq")
    rows = []
    for i in range(400):
        n = draw.choice((0, 1, 5, 60))
        quality = lambda: "".join(draw.choice("@+!I#") for _ in range(n))
        rows.append((f"r{i} @x +y", "ACGT" * 15, quality(), "TTGA" * 15, quality(), n))
    for mate in (1, 2):
        text = "".join(f"@{r[0]}\n{r[2 * mate - 1][: r[5]]}\n+{r[0] if i % 3 else ''}\n{r[2 * mate]}\n" for i, r in enumerate(rows))
        (folder / f"{mate}.fastq").write_text(text if mate == 1 else text[:-1])
    return folder, [(i, r[0], r[1][: r[5]], r[2], r[3][: r[5]], r[4]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("split", [97, 1_000, 1 << 20])
def test_any_split_gives_the_same_records(spark, tricky, split):
    folder, want = tricky
    one = fastq.read_fastq(spark, str(folder / "1.fastq"), split)
    assert sorted(map(tuple, one.collect())) == [w[:4] for w in want]
    both = fastq.read_mates(spark, str(folder / "1.fastq"), str(folder / "2.fastq"), split)
    assert sorted(map(tuple, both.collect())) == want
    assert sorted(r.id for r in fastq.read_fastq(spark, str(folder / "1.fastq"), split, numbered=False).collect()) == sorted(w[1] for w in want)
    for frame in (one, both):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_folders_packed_files_and_uris(spark, tricky, tmp_path):
    folder, want = tricky
    data = (folder / "1.fastq").read_bytes()
    cut = data.index(b"@r200 ")
    (tmp_path / "a.fastq").write_bytes(data[:cut])
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(data[cut:]))
    (tmp_path / "_SUCCESS").write_text("")
    assert sorted(map(tuple, fastq.read_fastq(spark, f"file://{tmp_path}", 5_000).collect())) == [w[:4] for w in want]
    both = fastq.read_mates(spark, str(tmp_path), str(folder / "2.fastq"), 5_000)
    assert sorted(map(tuple, both.collect())) == want
    (tmp_path / "none").mkdir()
    assert fastq.read_fastq(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="nothing.fastq"):
        fastq.read_fastq(spark, str(tmp_path / "nothing.fastq"))


@pytest.mark.parametrize("broken", [b"@a\nAC\n+\nII\n\n@b\nAC\n+\nII\n", b"@a\nAC\n+\nI\n", b"@a\nAC\nII\n+\n", b"AC\n@a\nAC\n+\nII\n", b"@a\nAC\n+\nII\n@b\nAC\n"])
@pytest.mark.parametrize("split", [3, 14, 1 << 20])
def test_broken_files_fail(spark, tmp_path, broken, split):
    (tmp_path / "x.fastq").write_bytes(broken)
    with pytest.raises(Exception, match="bad FASTQ record"):
        fastq.read_fastq(spark, str(tmp_path / "x.fastq"), split).collect()


def test_fasta_headers_hold_marks(spark, tmp_path):
    (tmp_path / "x.fa").write_text("ignored\n>one a>b desc\nACGT\n AC \n>two\n>three\nGG\n\nTT")
    rows = {r.name: r.seq for r in files.read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert rows == {"one a>b desc": "ACGTAC", "two": "", "three": "GGTT"}
