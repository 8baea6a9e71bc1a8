import pytest
from pyspark.sql import functions as F

from strandlake.operators import counting as C
from strandlake.operators import coverage as V
from strandlake.operators import runs as Q
from strandlake.operators import stats as S


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_names_of_columns():
    assert Q.placed(["1", "GL01", "X", "KI2"]) == ["1", "X"] and Q.placed(["1", "GL01"]) == ["1", "GL01"]


def test_columns_by_pattern_and_first_available(spark):
    m = table(spark, [(1, 2, 3)], "halfmapping_mult int, unpaired_uniq int, unpaired_mult int")
    assert Q.columns_like(m, "_mult") == ["halfmapping_mult", "unpaired_mult"] and Q.columns_like(m, "_mult", "half") == ["unpaired_mult"]
    assert m.select(Q.first_available(m, "concordant_uniq", "unpaired_uniq").alias("x")).first().x == 2
    with pytest.raises(ValueError):
        Q.first_available(m, "no")
    total = Q.with_totals(m).first()
    assert (total.mult_mapping, total.unpaired_mapping, total.half_mapping) == (4, 5, 1)


def test_summaries_must_have_the_same_runs(spark):
    one = table(spark, [("a", "x", 1.0), ("b", "x", 2.0)], "run string, name string, value double")
    same = Q.summary_matrices({"preprocess": one, "counts": one}, {"preprocess": ["x"], "counts": ["x"]})
    assert {r.run: r.x for r in same["counts"].collect()} == {"a": 1.0, "b": 2.0}
    with pytest.raises(Exception, match="different numbers of runs"):
        Q.summary_matrices({"preprocess": one, "counts": one.where("run = 'a'")}, {"preprocess": ["x"], "counts": ["x"]})["counts"].collect()
    with pytest.raises(ValueError):
        Q.summary_matrices({"other": one}, {})


def test_lanes_are_checked_before_they_merge(spark):
    good = table(spark, [("a", 75), ("b", 75)], "run string, processed_max_read_length long")
    assert Q.assert_mergeable(good).count() == 2
    with pytest.raises(Exception, match="read lengths of lanes differ"):
        Q.assert_mergeable(good.withColumn("processed_max_read_length", F.when(F.col("run") == "a", 75).otherwise(50))).collect()
    sites = [("s", "x", p, "A", "G") for p in range(10)] + [("t", "x", p, "A", "G") for p in range(9)] + [("u", "x", 50, "A", "G")]
    found = S.concordance(table(spark, sites, "sample string, chrom string, pos int, ref string, alt string"))
    assert {(r.a, r.b): (r.shared, r.concordant) for r in found.collect()} == {("s", "t"): (9, True), ("s", "u"): (0, False), ("t", "u"): (0, False)}
    with pytest.raises(Exception, match="not concordant"):
        Q.assert_mergeable(good, found).collect()


def test_settings_of_lanes(spark):
    rows = [("a", "version", "1"), ("b", "version", "1"), ("a", "k", "x"), ("b", "k", "y")]
    settings = table(spark, rows, "lane string, key string, value string")
    assert {r.key: r.value for r in S.merge_settings(S.assert_same_keys(settings), ("k",)).collect()} == {"version": "1", "k": "<merged>x y</merged>"}
    with pytest.raises(Exception, match="lanes differ in k"):
        S.merge_settings(settings).collect()
    with pytest.raises(Exception, match="some lane lacks k"):
        S.assert_same_keys(settings.where("not (lane = 'b' and key = 'k')")).collect()
    with pytest.raises(Exception, match="different versions"):
        S.assert_same_keys(settings.withColumn("value", F.concat("value", "lane"))).collect()


def test_counts_of_lanes_must_agree(spark):
    schema = "run string, feature_set string, name string, count long, width long"
    rows = [("a", "g", "x", 1, 10), ("b", "g", "x", 2, 10), ("a", "g", "y", 0, 5), ("b", "g", "y", 0, 5)]
    merged = C.merge_counts(table(spark, rows, schema), table(spark, [(3,)], "n long"))
    assert {r.name: (r["count"], r.rpkm) for r in merged.collect()} == {"x": (3, 1e9 * 3 / 30), "y": (0, 0.0)}
    with pytest.raises(Exception, match="names differ"):
        C.merge_counts(table(spark, rows[:3], schema)).collect()
    with pytest.raises(Exception, match="widths differ"):
        C.merge_counts(table(spark, [*rows[:3], ("b", "g", "y", 0, 6)], schema)).collect()
    one = table(spark, [("x", 1), ("y", 2)], "name string, count long")
    both = C.side_by_side(one, one, table(spark, [("x", "TP53")], "name string, symbol string"))
    assert sorted((r.name, r.symbol, r.count_1, r.count_2) for r in both.where("symbol is not null").collect()) == [("x", "TP53", 1, 1)] and both.count() == 2
    assert C.restricted(table(spark, [(1, "p"), (2, "q")], "gene int, tx string"), table(spark, [(2,)], "gene int")).first().tx == "q"


def test_survival(spark):
    curve = lambda values: sorted((r.value, r.num) for r in C.survival(table(spark, [(v,) for v in values], "count long")).collect())
    assert curve([1, 1, 2, 2, 4]) == [(1, 5), (2, 3), (4, 1)] and curve([]) == [(1, 1)]
    assert curve(range(5000)) == [(v, 5000 - v) for v in range(5000)]


def test_usable_blocks_of_gapped_records(spark):
    schema = "qname string, flag int, chrom string, pos int, cigar string, strand string, run string"
    rows = [("a", 0, "x", 10, "5M10N5M", "+", "l"), ("b", 1024, "x", 10, "5M", "+", "l"), ("c", 512, "x", 10, "5M", "+", "l"), ("d", 0, None, 10, "5M", "+", "l")]
    assert sorted((r.groupid, r.start, r.end) for r in V.aligned_blocks(table(spark, rows, schema)).collect()) == [("a", 10, 14), ("a", 25, 29)]


def test_minimum_depth_and_fragment_length(spark):
    runs = table(spark, [("x", 1, 10, 3), ("x", 11, 20, 1)], "chrom string, start long, end long, depth long")
    places = table(spark, [("x", 5, 5), ("x", 8, 12), ("x", 18, 25), ("y", 1, 1)], "chrom string, start long, end long")
    assert sorted((r.chrom, r.start, r.min_depth) for r in V.minimum_depth(places, runs).collect()) == [("x", 5, 3), ("x", 8, 1), ("x", 18, 0), ("y", 1, 0)]
    blocks = [("x", p, p + 9, "+") for p in (100, 300, 700)] + [("x", p + 140, p + 149, "-") for p in (100, 300, 700)]
    got = V.estimate_fragment_length(table(spark, blocks, "chrom string, start int, end int, strand string")).first()
    assert (got.length, got.n) == (150, 6)


def test_pileup_with_indels_and_quality(spark):
    schema = "flag int, chrom string, pos int, cigar string, seq string, qual string"
    rows = [(0, "x", 1, "3M1I2M2D2M", "ACGTACGT", "IIIIIIII"), (0, "x", 1, "8M", "ACTACGTA", "II#IIIII"), (1024, "x", 1, "8M", "TTTTTTTT", "IIIIIIII")]
    reference = table(spark, [("x", i + 1, b) for i, b in enumerate("ACGACGTG")], "chrom string, pos long, ref string")
    got = {(r.pos, r.alt): (r.alt_depth, r.ref_depth, r.records) for r in S.pileup(table(spark, rows, schema), reference).collect()}
    assert got[(3, "+T")] == (1, 1, 1) and got[(6, "-2")] == (1, 1, 1) and (3, "T") not in got  # of low quality
    assert got[(8, "A")] == (1, 0, 2) and got[(8, "G")][0] == 1 if (8, "G") in got else got[(8, "A")][0] == 1
    assert all(not a.startswith(("+", "-")) for _, a in ((r.pos, r.alt) for r in S.pileup(table(spark, rows, schema), reference, indels=False).collect()))


def test_pileup_counts_what_the_bases_are_and_reads_once(spark, monkeypatch):
    import random
    from collections import Counter

    from strandlake.functions import pileup as K

    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        cigar = "".join(f"{rnd.randint(1, 9)}{rnd.choice('MMMIDNS=XH')}" for _ in range(rnd.randint(1, 6)))
        size = 60 if rnd.random() < 0.8 else rnd.randint(0, 20)  # some are shorter than their CIGAR says
        letters = lambda of: "".join(rnd.choice(of) for _ in range(size))  # noqa: E731, B023
        rows.append((rnd.choice([0, 0, 512]), rnd.choice(["x", "y", None]), rnd.choice([None, *range(1, 90)]), rnd.choice([cigar, cigar, None]), letters("ACGTN"), rnd.choice([letters("#5I"), None])))
    rows.append((0, "x", 1, "3M2D3M", None, "IIIIII"))
    schema = "flag int, chrom string, pos int, cigar string, seq string, qual string"
    a = table(spark, rows, schema)
    want = Counter((r.chrom, r.pos, r.base) for r in S.bases(a).where("quality >= 20 and chrom is not null and pos is not null and base is not null").collect())
    assert {(r.chrom, r.pos, r.base): r.n for r in S.base_counts(a, 20).collect()} == want and len(want) > 150
    # small steps and a full tally change nothing
    monkeypatch.setattr(K, "STEP", 16)
    monkeypatch.setattr(K, "HELD", 64)
    told = Counter()
    for batch in K.count_bases(20, 33, True)(a.where("flag = 0").select("chrom", F.col("pos").cast("long"), "cigar", "seq", "qual").dropna(subset=["chrom", "pos", "cigar", "qual"]).toArrow().to_batches(50)):
        for r in batch.to_pylist():
            told[r["chrom"], r["pos"], r["base"]] += r["n"]
    assert told == want
    reference, mask = (table(spark, [("x", 1, 5)], f"chrom string, {c}").drop("n") for c in ("pos long, n int", "start int, end int"))
    plan = S.pileup(a, reference.withColumn("ref", F.lit("A")), mask=mask)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("qual#") and plan.count("MapInArrow") == 1 and "Generate explode(sequence(0" not in plan


def test_neighbours_across_tiles_and_known_sites(spark):
    edge = S.TILE
    calls = table(spark, [("x", p, "A", "G") for p in [*range(edge - 15, edge + 15), 5]], "chrom string, pos int, ref string, alt string")
    assert [r.pos for r in S.neighbour_filter(calls, 50, 20).collect()] == [5]
    known = table(spark, [("x", edge, "G")], "chrom string, pos int, alt string")
    assert sorted(r.pos for r in S.neighbour_filter(calls, 50, 20, known).collect()) == [5, edge]


def test_reads_are_counted_once_for_each_feature(spark):
    import random

    rnd = random.Random(6)
    blocks = [(rnd.randint(0, 40), f"c{rnd.randint(0, 1)}", s := rnd.randint(1, 400), s + rnd.randint(0, 30)) for _ in range(200)]
    ranges = [("one", str(i), f"c{i % 2}", s := rnd.randint(1, 400), s + rnd.choice([0, 5, 80, 20_000])) for i in range(60)]
    ranges += [("many", str(i % 7), f"c{rnd.randint(0, 1)}", s := rnd.randint(1, 400), s + 20) for i in range(30)]
    want = {}
    for kind, name, chrom, start, end in ranges:
        hit = {g for g, c, s, e in blocks if c == chrom and s <= end and e >= start}
        want[kind, name] = want.get((kind, name), set()) | hit
    got = C.count_features(table(spark, ranges, "feature_set string, name string, chrom string, start int, end int"), table(spark, blocks, "groupid long, chrom string, start int, end int"))
    assert {(r.feature_set, r.name): r["count"] for r in got.collect()} == {k: len(v) for k, v in want.items()}


def test_numbers_of_cigars_are_cast_without_exceptions(spark):
    """An empty text under try_cast is an exception a row; the digits go behind a 0, so there is none."""
    from strandlake.functions import reads as R

    a = table(spark, [(5, "3S4M2S", "-"), (5, "4M", "+"), (5, "2M9N2M", "+"), (5, "99999999999S4M", "+"), (5, None, "+")], "pos int, cigar string, strand string")
    told = a.select(R.five_prime(F.col("pos"), F.col("cigar"), F.col("strand")).alias("five"), R.cigar_blocks(F.col("pos"), F.col("cigar")).alias("blocks"))
    assert [(r.five, r.blocks and [tuple(b) for b in r.blocks]) for r in told.collect()] == [(10, [(5, 8)]), (5, [(5, 8)]), (5, [(5, 6), (16, 17)]), (5, [(5, 8)]), (5, None)]
    plan = told._jdf.queryExecution().analyzed().toString()
    assert "try_cast(concat(0, regexp_extract(" in plan and "try_cast(regexp_extract(" not in plan


def test_duplicates_are_fragments(spark):
    """Clipped and unclipped copies of a fragment, pairs told apart by their other end, single records at an end of a pair."""
    rows = [
        ("p1", 1, "c", 10, "+", "20M", 40, 0), ("p1", 2, "c", 100, "-", "20M", 40, 0),
        ("p2", 1, "c", 12, "+", "2S18M", 30, 0), ("p2", 2, "c", 100, "-", "17M3S", 40, 0),  # the same ends, once clipped
        ("p3", 1, "c", 10, "+", "20M", 50, 0), ("p3", 2, "c", 130, "-", "20M", 50, 0),  # another second end
        ("p4", 2, "c", 10, "+", "20M", 20, 0), ("p4", 1, "c", 90, "-", "10M10N10M", 20, 0),  # mates the other way round, over a gap
        ("s1", 1, "c", 10, "+", "20M", 60, 0), ("s2", 1, "c", 10, "-", "20M", 60, 0), ("s3", 3, "c", 15, "-", "15M", 60, 1), ("s4", 3, "c", 15, "-", "1H2S12M2S1H", 60, 0),
        ("u", 1, None, None, None, None, None, None), (None, 1, "c", 10, "+", "20M", 60, 0),
    ]
    a = spark.createDataFrame([(*r, "kept") for r in rows], "qname string, mate int, chrom string, pos int, strand string, cigar string, mapq int, nm int, five string")
    told = S.mark_duplicates(a)
    assert told.columns == [*a.columns, "is_dup"] and told.count() == len(rows)
    assert sorted((r.qname, r.mate) for r in told.where("is_dup").collect()) == [("p2", 1), ("p2", 2), ("p4", 1), ("p4", 2), ("s1", 1), ("s3", 3), ("s4", 3)]
