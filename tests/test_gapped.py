"""Gapped and spliced placement: the table against a plain one, whole reads with planted gaps, introns, clips and splits."""

import random
import re

import pytest

from strandlake.functions import gapped as K
from strandlake.operators import gapped as G
from strandlake.plans import views

draw = random.Random(2)
REF = bytes(draw.choice(b"ACGT") for _ in range(20_000))
LOW = -(10**9)


def plain_score(read, window):
    """The best local score by the textbook recurrence."""
    n, m = len(read), len(window)
    h, f = [LOW] * (m + 1), [LOW] * (m + 1)
    best = 0
    for i in range(1, n + 1):
        new, e = [LOW] * (m + 1), LOW
        for j in range(1, m + 1):
            match = (K.MATCH if read[i - 1] == window[j - 1] else -K.MISMATCH) + max(h[j - 1], K.END if i == 1 else 0)
            f[j] = max(h[j] - K.OPEN - K.EXTEND, f[j] - K.EXTEND)
            e = max(new[j - 1] - K.OPEN - K.EXTEND, e - K.EXTEND)
            new[j] = max(match, f[j], e)
            best = max(best, match + (K.END if i == n else 0))
        h = new
    return best


def score_of(a, read, start, window):
    i, j, total, nm = a.low, a.pos - start, (K.END if a.low == 0 else 0) + (K.END if a.high == len(read) else 0), 0
    for n, op in re.findall(r"(\d+)([MIDNS])", a.cigar):
        n = int(n)
        if op == "M":
            same = sum(read[i + x] == window[j + x] for x in range(n))
            total, nm, i, j = total + same * K.MATCH - (n - same) * K.MISMATCH, nm + n - same, i + n, j + n
        elif op in "ID":
            total, nm = total - K.OPEN - K.EXTEND * n, nm + n
            i, j = i + n * (op == "I"), j + n * (op == "D")
    assert (nm, i, j + start) == (a.nm, a.high, a.end)
    return total


def test_table_equals_textbook():
    reads, windows = [], []
    for _ in range(300):
        at = draw.randrange(100, 19_000)
        window = REF[at : at + draw.randrange(20, 70)]
        read = bytearray(window[draw.randrange(8) : draw.randrange(14, len(window))])
        for _ in range(draw.randrange(4)):
            p, kind = draw.randrange(len(read)), draw.random()
            if kind < 0.4:
                read[p] = draw.choice(b"ACGTN")
            elif kind < 0.7 and len(read) > 6:
                del read[p : p + draw.randrange(1, 4)]
            else:
                read[p:p] = bytes(draw.choice(b"ACGT") for _ in range(draw.randrange(1, 4)))
        reads.append(bytes(read))
        windows.append([(at, window)])
    for read, w, a in zip(reads, windows, K.align(reads, windows)):
        want = plain_score(read, w[0][1])
        assert a.score == want if a else want < K.MATCH + K.END
        if a:
            assert score_of(a, read, *w[0]) == want


@pytest.mark.parametrize(
    ("read", "parts", "cigar"),
    [
        (REF[1000:1080], [(990, 1100)], r"80M"),
        (REF[1000:1040] + REF[1043:1083], [(990, 1100)], r"\d+M3D\d+M"),
        (REF[1000:1040] + b"ACGT" + REF[1040:1076], [(990, 1100)], r"\d+M4I\d+M"),
        (b"N" * 20 + REF[1000:1060], [(970, 1100)], r"20S60M"),
        (REF[1000:1040] + REF[1340:1380], [(990, 1060), (1320, 1400)], r"\d+M300N\d+M"),
        (REF[1000:1030] + REF[1340:1360] + REF[1900:1930], [(990, 1060), (1320, 1400), (1880, 1950)], r"\d+M310N\d+M540N\d+M"),
        (b"NNNN", [(0, 50)], None),
        (b"", [(0, 50)], None),
    ],
)
def test_operations(read, parts, cigar):
    (a,) = K.align([read], [[(x, REF[x:y]) for x, y in parts]])
    assert (a is None) if cigar is None else re.fullmatch(cigar, a.cigar)
    if a and "N" not in a.cigar:
        assert a.pos == 1000


def test_usual_sites_draw_the_intron():
    ref = b"ACCATTGCAACCTTACGAAC" + b"GTAAAT" + b"C" * 40 + b"TTTTAG" + b"GTCCATTTGACATTGCCAAT"
    read = ref[:20] + ref[-20:]
    (a,) = K.align([read], [[(0, ref[:40]), (40, ref[40:])]])
    assert a.cigar == "20M52N20M"


def test_gaps_lie_furthest_left():
    ref = b"ACGTTGCA" + b"AAAAAA" + b"CCGTATTGCGATC"
    (a,) = K.align([ref.replace(b"AAAAAA", b"AAAA")], [[(0, ref)]])
    assert a.cigar == "7M2D18M"  # the A before the run is one of seven


def test_minimizers_are_the_same_on_both_strands():
    seq = REF[300:500]
    one, two = K.minimizers(seq, 12, 5), K.minimizers(K.reverse_complement(seq), 12, 5)
    assert set(zip(one[0].tolist(), one[1].tolist(), one[2].tolist())) == {(h, 200 - 12 - at, not f) for h, at, f in zip(*(x.tolist() for x in two))}
    assert not len(K.minimizers(b"N" * 50, 12, 5)[0]) and not len(K.minimizers(b"ACGT", 12, 5)[0])


@pytest.fixture(scope="module")
def world(spark):
    """Two chromosomes with 300 bases in common, longer than a tile, and reads of each kind with what they must give."""
    draw = random.Random(4)
    refs = {c: "".join(draw.choice("ACGT") for _ in range(9_000)) for c in ("c0", "c1")}
    refs["c1"] = refs["c1"][:7_000] + refs["c0"][5_000:5_300] + refs["c1"][7_300:]
    cut = lambda c, a, n: refs[c][a : a + n]
    other = {"c0": "c1", "c1": "c0"}
    rows, want = [], {}
    for i in range(120):
        c, a = draw.choice(("c0", "c1")), draw.choice((draw.randrange(100, 4_200), draw.randrange(7_400, 8_000), 4_060 + i % 40))
        kind, back = i % 8, i % 3 == 0
        seq, told = [
            (cut(c, a, 80), ("uniq", a + 1, a + 80)),
            (cut(c, a, 40) + cut(c, a + 43, 40), ("uniq", a + 1, a + 83)),
            (cut(c, a, 40) + "ACGT" + cut(c, a + 40, 40), ("uniq", a + 1, a + 80)),
            (cut(c, a, 40) + cut(c, a + 340, 40), ("uniq", a + 1, a + 380)),
            ("N" * 20 + cut(c, a, 60), ("uniq", a + 1, a + 60)),
            (cut(c, a, 40) + cut(other[c], a // 2 + 100, 40), ("transloc", None, None)),
            (cut(c, a + 500, 40) + cut(c, a, 40), ("circular", None, None)),
            (cut("c0", 5_000 + i, 80), ("mult", 5_001 + i, 5_080 + i)),
        ][kind]
        rows.append((str(i), K.reverse_complement(seq.encode()).decode() if back else seq))
        want[str(i)] = (*told, None if told[1] is None else "-" if back else "+")
    rows += [("null", None), ("empty", ""), ("short", "ACGTAC"), ("noise", "".join(draw.choice("ACGT") for _ in range(80)))]
    reads = spark.createDataFrame(rows, "id string, seq string")
    references = spark.createDataFrame([*refs.items(), ("none", None), ("blank", "")], "chrom string, ref string")
    return reads, references, want


def test_reads_come_back(spark, world):
    reads, references, want = world
    placed = G.placements(reads, references, longest_intron=2_000)
    kinds = {r["id"]: r for r in G.read_categories(placed, reads, 2_000).collect()}
    assert len(kinds) == reads.count()
    assert {k: kinds[k]["kind"] for k in ("null", "empty", "short", "noise")} == dict.fromkeys(("null", "empty", "short", "noise"), "none")
    for name, (kind, pos, end, strand) in want.items():
        got = kinds[name]
        assert got["kind"] == kind, (name, got)
        if pos is not None:
            assert (got["pos"], got["end"], got["strand"]) == (pos, end, strand), (name, got)


def test_quality_tells_sure_places_from_repeats(spark, world):
    reads, references, want = world
    best = G.best_placements(G.placements(reads, references, longest_intron=2_000)).collect()
    assert all(r["mapq"] == 0 and r["hits"] == 2 for r in best if want.get(r["id"], ("",))[0] == "mult")
    assert all(r["mapq"] >= 30 for r in best if want.get(r["id"], ("",))[0] == "uniq")


def test_reads_of_common_seeds_keep_their_places(spark, world):
    """Where every seed is common a read's rarest are used, and plain reads have the same places."""
    reads, references, want = world
    plain = lambda p: sorted((r["id"], r["chrom"], r["pos"], r["cigar"]) for r in G.best_placements(p).collect() if r["id"].isdigit() and int(r["id"]) % 8 in (0, 4, 7))
    got = plain(G.placements(reads, references, 2_000, common=0))
    assert got == plain(G.placements(reads, references, 2_000)) and len(got) == 60


def test_nothing_to_place(spark, world):
    reads, references, _ = world
    assert G.placements(reads.limit(0), references).count() == 0
    assert G.placements(reads, references.limit(0)).count() == 0


def test_pair_categories(spark):
    fields = "id string, kind string, hits int, chrom string, pos long, end long, strand string"
    cases = [
        ("uniq c 1 60 +", "uniq c 200 260 -", "concordant_uniq"), ("uniq c 200 260 -", "uniq c 1 60 +", "concordant_uniq"), ("uniq c 1 60 +", "uniq d 200 260 -", "unpaired_uniq"), ("mult c 1 60 +", "uniq d 200 260 -", "unpaired_mult"),
        ("uniq c 1 60 +", "uniq c 200 260 +", "paired_uniq_inv"), ("uniq c 200 260 +", "uniq c 1 60 -", "paired_uniq_scr"), ("uniq c 1 60 +", "uniq c 40 99 -", "paired_uniq_scr"), ("uniq c 1 60 +", "uniq c 900 960 -", "paired_uniq_long"),
        ("mult c 1 60 +", "uniq c 900 960 -", "paired_mult"), ("uniq c 1 60 +", "none c 0 0 +", "halfmapping_uniq"), ("none c 0 0 +", "mult c 0 0 +", "halfmapping_mult"), ("none c 0 0 +", "none c 0 0 +", "nomapping"),
        ("transloc c 1 60 +", "uniq c 200 260 -", "concordant_transloc"), ("circular c 1 60 +", "none c 0 0 +", "halfmapping_circular"), ("circular c 1 60 +", "uniq c 40 99 -", "paired_uniq_circular"),
    ]
    rows = lambda at: [(str(i), k, 1, c, int(a), int(b), s) for i, case in enumerate(cases) for k, c, a, b, s in [case[at].split()]]
    got = G.pair_categories(spark.createDataFrame(rows(0), fields), spark.createDataFrame(rows(1), fields), concordant=500)
    assert {r["id"]: r["category"] for r in got.collect()} == {str(i): c[2] for i, c in enumerate(cases)}


def test_halves_that_go_on_by_chance_are_still_split(spark):
    """Halves of reads of the catalogue's reference whose best placement goes on past the break, over an intron or gaps found by chance."""
    from strandlake.plans import views

    reads = [
        ("a", "TCGATTAAGGCGCATCGCTTTAATCCTGTCTATTGAGGTTGGATCGCCCCAAAACTTCAA", "circular", "chr1", 503), ("b", "ATACTTAAGGCGGCGCTAGCGCGCGAGTATCCCCACTGGGAACATCGTTTCGCATTTGGC", "transloc", "chr3", 15192),
        ("c", "TAAGGCGGCGCTAGCGCGCGAGTATGCCCACTGGGAACATCGTTTCGCATTTGGCACGGA", "transloc", "chr3", 15197), ("d", "CGGTGCGTTACTACTTGCACGAACCTCATCTTTCCATTAAATGCGGACGTGAGACCAGAG", "transloc", "chr3", 1877),
    ]
    df = spark.createDataFrame([r[:2] for r in reads], "id string, seq string")
    kinds = G.read_categories(G.placements(df, views.sequences(spark), longest_intron=2_000), df, 2_000).collect()
    assert sorted((k["id"], k["kind"], k["chrom"], k["pos"]) for k in kinds) == [(i, kind, c, p) for i, _, kind, c, p in reads]


def test_pieces_reach_as_far_as_a_diagonal_goes():
    read = REF[1000:1030] + REF[1340:1380]
    windows = [(990, REF[990:1060]), (1320, REF[1320:1400])]
    (whole,) = K.align([read], [windows])
    found = K.pieces(read, windows, whole)
    assert [(p.pos, p.end, p.low, p.high) for p in found if p.nm == 0][0][0] == 1000 and {p.pos + 70 - p.low for p in found} == {1070, 1380}
    assert all(p.score <= whole.score + K.INTRON for p in found)
    (plain,) = K.align([REF[1000:1080]], [[(990, REF[990:1100])]])
    assert K.pieces(REF[1000:1080], [(990, REF[990:1100])], plain) == []


def test_batches_give_what_single_reads_do(monkeypatch):
    rnd = random.Random(8)
    reads = [b"", b"ACGT", b"A" * 40, b"N" * 30, b"ACGTTGCAAC" * 6]
    for _ in range(150):
        at = rnd.randrange(19_000)
        part = bytes(rnd.choice(b"ACGTNa") if rnd.random() < 0.03 else b for b in REF[at : at + rnd.randrange(100)])
        reads.append(part[:40] + part[43:] if rnd.random() < 0.3 else part)
    row, *told = K.minimizers_of(reads, 12, 5)
    for i, read in enumerate(reads):
        assert [x[row == i].tolist() for x in told] == [x.tolist() for x in K.minimizers(read, 12, 5)]
    windows = [[(7, REF[max(0, i := REF.find(r[:12]) - 10) : i + 130])] if len(r) > 12 and r[:12] in REF else [(0, b"")] for r in reads]
    assert K.align(reads, windows) == [K.table_align([r], [w])[0] for r, w in zip(reads, windows)]
    assert K.exact(REF[50:90], [(0, REF[:30]), (40, REF[40:100])]).cigar == "40M" and K.exact(b"ANA", [(0, b"ANA")]) is None
    marks = [("x", "+", rnd.randrange(60), 500 + rnd.randrange(400)) for _ in range(50)] + [("x", "+", a, 100 + a) for a in range(0, 40, 5)]
    few = K.chains(marks, 80, 12, 16, 2_000)
    monkeypatch.setattr(K, "MANY", 0)
    assert few == K.chains(marks, 80, 12, 16, 2_000)


def test_reads_are_aligned_once_and_on_all_cores(spark):
    reads, references = spark.createDataFrame([("a", REF[:80].decode())], "id string, seq string"), spark.createDataFrame([("x", REF.decode())], "chrom string, ref string")
    plan = G.read_categories(G.placements(reads, references), reads)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow _aligned(") == 1
    for view in (views.placed_pairs, views.sequenced_reads, views.sequenced_pairs, views.indel_reads):
        assert view(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
