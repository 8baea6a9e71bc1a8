import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import reads as R
from strandlake.operators import preprocess as P
from strandlake.sources import files


def reads(spark, rows):
    return spark.createDataFrame(rows, "id string, seq1 string, qual1 string, seq2 string, qual2 string")


def value(spark, column, **cells):
    names = list(cells)
    return spark.createDataFrame([tuple(cells.values())], names).select(column).first()[0]


def test_truncate_lengths(spark):
    for width, length, trim5, left in ((100, 60, 30, 60), (20, 60, 30, 0), (0, 60, 30, 0), (1, 1, 0, 1), (100, 75, 30, 70), (20, 75, 19, 1)):
        assert len(value(spark, R.truncate(F.col("s"), length, trim5), s="A" * width)) == left


def test_tail_trim_takes_only_the_right_end(spark):
    assert value(spark, R.without_tail(F.col("q"), "#"), q="##FF#FF##") == "##FF#FF"
    assert value(spark, R.without_tail(F.col("q"), "I"), q="IIFF") == ""


def test_quality_share_is_strict(spark):
    share = R.good_share(F.col("q"), 33, 30)
    assert value(spark, share, q="????????!!") == 0.8
    rows = reads(spark, [("a", "A" * 10, "???????!!!", None, None), ("b", "A" * 10, "????????!!", None, None)])
    assert [r.id for r in P.filter_quality(rows, "sanger", 30, 0.7).collect()] == ["b"]


def test_length_filter_needs_both_mates(spark):
    rows = reads(spark, [("a", "A" * 10, "I" * 10, "A" * 16, "I" * 16), ("b", "A" * 16, "I" * 16, "A" * 10, "I" * 10), ("c", "A" * 12, "I" * 12, "A" * 12, "I" * 12)])
    assert [r.id for r in P.filter_length(rows, 12).collect()] == ["c"]


def test_adapter_overlaps(spark):
    adapter = "GATCGGAAGAGCACACGTCT"
    random.seed(1)
    tail = "".join(random.choice("ACGT") for _ in range(20))
    found = lambda s: value(spark, R.adapter_score(F.col("s"), adapter) > R.ADAPTER_CUTOFF, s=s)
    assert found(adapter)
    assert found(adapter[-11:] + "T" * 30)
    assert found("T" * 30 + adapter[:7])
    assert not found("T" * 30 + adapter[:6])
    assert not found("N" * 40)
    assert found("") is False
    del tail


def test_encodings_of_a_range(spark):
    rows = reads(spark, [("a", "AA", "!J", None, None)])
    assert [r.encoding for r in P.detect_encoding(rows).orderBy("rank").collect()] == ["illumina1.8", "GATK-rescaled"]


def test_flags(spark):
    assert [value(spark, R.is_first(F.col("f")), f=f) for f in (1, 64, 128, 320, 384)] == [True, True, False, True, False]


def test_cigar_with_a_gap(spark):
    start = 46085749
    found = value(spark, R.cigar_blocks(F.col("p"), F.col("c")), p=start, c="35M3092N40M")
    assert [(b.start, b.end) for b in found] == [(start, start + 34), (start + 35 + 3092, start + 35 + 3092 + 39)]
    assert [(b.start, b.end) for b in value(spark, R.cigar_blocks(F.col("p"), F.col("c")), p=10, c="2S5M1I2D3M4H")] == [(10, 19)]


def test_subsample_is_exact_and_repeatable(spark):
    rows = spark.range(26).select(F.col("id").cast("string").alias("id"))
    one, two = ({r.id for r in P.subsample(rows.repartition(n), 17).collect()} for n in (1, 5))
    assert len(one) == 17 and one == two
    assert P.subsample(rows, 100).count() == 26


def test_normal_ids(spark):
    assert value(spark, R.normal_id(F.col("i")), i="read/1") == "read"
    assert value(spark, R.normal_id(F.col("i")), i="read/1 lane") == "read/1"


def test_merging_lanes_gives_the_whole(spark):
    rows = reads(spark, [(str(i), "A" * (10 + i % 5), "I" * (10 + i % 5), None, None) for i in range(26)])
    marked = P.preprocess(rows, "sanger", 23, 0.7, 12).withColumn("run", F.col("id").cast("int") < 10)
    lanes, whole = P.summary(marked, ["run"]), P.summary(marked.withColumn("run", F.lit(1)), ["run"])
    one, all_ = P.merge_summaries(lanes).first().asDict(), whole.first().asDict()
    assert one | {"read_length": 0} == {k: all_[k] for k in P.SUMMARY} | {"read_length": 0}
    assert all_["total_reads"] == 26 and all_["processed_reads"] == all_["highqual_reads"] == 15


@pytest.fixture(scope="module")
def lane(tmp_path_factory):
    """26 pairs of 75 bases with qualities from code 64 on: one of low quality, one with adapters on both mates."""
    draw, folder = random.Random(26), tmp_path_factory.mktemp("lane")
    bases = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    for mate, adapter in ((1, R.PAIRED_1), (2, R.PAIRED_2)):
        text = ""
        for i in range(26):
            seq = bases(30) + adapter + bases(45 - len(adapter)) if i == 7 else bases(75)
            qual = "C" * 75 if i == 11 else "".join(draw.choice("defgh") for _ in range(75))
            text += f"@pair{i}/{mate}\n{seq}\n+\n{qual}\n"
        (folder / f"{mate}.fastq").write_text(text)
    return folder


@pytest.mark.parametrize("paired", [True, False])
def test_a_lane_gives_the_expected_counts(spark, lane, paired):
    rows = files.read_fastq_pair(spark, str(lane / "1.fastq"), str(lane / "2.fastq") if paired else None)
    adapters = (R.choose_adapter(True), R.choose_adapter(True, mate=2)) if paired else (R.choose_adapter(False, force_paired=True), None)
    got = P.summary(P.preprocess(rows, "illumina1.5", 23, 0.7, adapters=adapters).withColumn("run", F.lit(1)), ["run"]).first()
    assert (got.total_reads, got.highqual_reads, got.adapter_contam, got.read_length, got.rRNA_contam_reads, got.processed_reads) == (26, 25, 1, 75, 0, 25)


def test_adapters_are_chosen_by_layout():
    assert R.choose_adapter(True, True) == R.choose_adapter(True, False) == R.choose_adapter(False, True) == R.PAIRED_1
    assert R.choose_adapter(True, mate=2) == R.PAIRED_2 and R.choose_adapter(False) == R.SINGLE
    assert [len(x) for x in (R.PAIRED_1, R.PAIRED_2, R.SINGLE)] == [37, 33, 34]
    rnd = random.Random(2)
    tail = "".join(rnd.choice("ACGT") for _ in range(100))
    scores = R.adapter_scores([R.SINGLE, R.SINGLE + tail, R.SINGLE[:10] + tail, R.SINGLE[-11:] + tail, None, ""], R.SINGLE) > 17
    assert scores.tolist() == [True, True, False, True, False, False]


def test_a_pair_is_flagged_only_by_both_mates(spark):
    rows = reads(spark, [("a", R.PAIRED_1, "I" * 37, R.PAIRED_2, "I" * 33), ("b", R.PAIRED_1, "I" * 37, "A" * 33, "I" * 33)])
    assert {r.id: r.adapter for r in P.flag_adapters(rows, R.PAIRED_1, R.PAIRED_2).collect()} == {"a": True, "b": False}


def test_contaminated_reads_are_flagged_and_must_exist(spark):
    rows = reads(spark, [("a/1", "A" * 10, "I" * 10, None, None), ("b/1", "A" * 10, "I" * 10, None, None)])
    ids = spark.createDataFrame([("a",)], "id string")
    marked = P.preprocess(rows, "sanger", contaminated=ids)
    assert {r.id: (r.rrna, r.processed) for r in marked.collect()} == {"a/1": (True, False), "b/1": (False, True)}
    assert P.assert_all_matched(rows, ids).count() == 1
    with pytest.raises(Exception, match="no read has the id"):
        P.assert_all_matched(rows, spark.createDataFrame([("z",)], "id string")).collect()


def test_duplicated_ids_fail_and_firsts_stay(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "id string, n int")
    with pytest.raises(Exception, match="duplicated read id"):
        P.assert_unique_ids(rows).collect()
    assert P.assert_unique_ids(rows.where("n != 2")).count() == 2
    assert {(r.id, r.n) for r in P.first_of_each(rows, ["id"], ["n"]).collect()} == {("a", 1), ("b", 5)}


def test_chunks_and_protocols(spark):
    assert P.first_chunks(spark.range(50).withColumnRenamed("id", "record"), 10, 3).count() == 30
    assert value(spark, R.protocol(F.col("e")), e="illumina1.5") == "illumina" and value(spark, R.protocol(F.col("e")), e="other") is None
    steps = value(spark, R.cigar_steps(F.col("c")), c="2S5M1I2D3M4N1M")
    assert [(s.kind, s["size"], s["read"], s["ref"]) for s in steps] == [("S", 2, 0, 0), ("M", 5, 2, 0), ("I", 1, 7, 5), ("D", 2, 8, 5), ("M", 3, 8, 7), ("N", 4, 11, 10), ("M", 1, 11, 14)]
