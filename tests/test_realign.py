"""Realignment around indels: the pieces against plain versions, and reads with planted indels."""

import random
import re

import numpy as np

from strandlake.operators import realign as R

FIELDS = "qname string, mate int, flag int, chrom string, pos int, cigar string, seq string, qual string, note string"


def world(seed=1, size=12_000):
    draw = random.Random(seed)
    return draw, "".join(draw.choice("ACGT") for _ in range(size))


def undone(pos, cigar, seq, ref):
    """The bases that a record says the read has, from the reference; added and clipped ones from the read."""
    at, read, out = pos - 1, 0, ""
    for n, op in re.findall(r"(\d+)([MIDS])", cigar):
        n = int(n)
        out += ref[at : at + n] if op == "M" else seq[read : read + n] if op in "IS" else ""
        at, read = at + n * (op in "MD"), read + n * (op in "MIS")
    return out


def test_equal_ways_to_write_an_indel_meet():
    draw, _ = world()
    for _ in range(300):
        ref = "".join(draw.choice("AC") for _ in range(40))
        at, n = draw.randrange(5, 30), draw.randrange(1, 5)
        deleted = ref[:at] + ref[at + n :]
        added = "".join(draw.choice("AC") for _ in range(n))
        inserted = ref[:at] + added + ref[at:]
        ways = [x for x in range(0, 40 - n) if ref[:x] + ref[x + n :] == deleted]
        assert R.shifted_left(at, n, "", ref, 0) == (min(ways), "")
        ways = [x for x in range(0, 41) if inserted[:x] + inserted[x + n :] == ref]
        assert R.shifted_left(at, 0, added, ref, 0) == (min(ways), inserted[min(ways) : min(ways) + n])


def test_laying_equals_trying_every_place():
    draw, ref = world(2, 300)
    for _ in range(200):
        at, gone, added = draw.randrange(60, 120), draw.choice((0, 1, 4)), ""
        if not gone:
            added = "".join(draw.choice("ACGT") for _ in range(draw.randrange(1, 6)))
        changed = ref[:at] + added + ref[at + gone :]
        start = draw.randrange(30, 110)
        seq = "".join(b if draw.random() < 0.95 else draw.choice("ACGT") for b in changed[start : start + 50])
        qual = np.array([draw.randrange(2, 40) for _ in seq])
        least = min(sum(int(q) for q, a, b in zip(qual, seq, changed[o:]) if a != b) for o in range(len(changed) - len(seq) + 1))
        total, pos, cigar = R.laid_along(seq, qual, ref, 0, at, gone, added, start)
        assert total == least
        assert sum(int(n) for n, op in re.findall(r"(\d+)([MIS])", cigar)) == 50
        wrong = sum(int(q) for q, a, b in zip(qual, seq, undone(pos, cigar, seq, ref)) if a != b)
        assert wrong <= least and ("S" in cigar or "I" in cigar or wrong == least)
        if "I" not in cigar and "S" not in cigar:
            assert R.mismatch_sum(pos, cigar, seq, qual, ref, 0) == least


def records(draw, ref, site, gone, added, seed_kinds):
    """Reads of 60 bases over an indel before base `site`, with what an aligner would say of each and what is right."""
    changed = ref[:site] + added + ref[site + gone :]
    rows, right = [], {}
    for i, ahead in enumerate(seed_kinds):
        start = site - ahead
        seq, name, n = changed[start : start + 60], f"{site}:{i}", len(added)
        behind = 60 - ahead - n
        place, left = R.shifted_left(site, gone, added, ref, 0)
        a = ahead - (site - place)
        true = f"{a}M{gone}D{60 - a}M" if gone else f"{a}M{n}I{60 - a - n}M"
        if ahead >= 15 and behind >= 15:
            rows.append((name, 1, 0, "c", start + 1, f"{ahead}M{gone}D{behind}M" if gone else f"{ahead}M{n}I{behind}M", seq, "I" * 60, "x"))
            right[name] = (start + 1, rows[-1][5], False)
        elif ahead > behind:
            rows.append((name, 1, 0, "c", start + 1, "60M", seq, "I" * 60, "x"))
            right[name] = (start + 1, true, True)
        else:
            rows.append((name, 1, 0, "c", start + 1 + gone - n, "60M", seq, "I" * 60, "x"))
            right[name] = (start + 1, true, True)
        if right[name][2] and seq == ref[rows[-1][4] - 1 : rows[-1][4] + 59]:
            right[name] = (rows[-1][4], "60M", False)
    return rows, right


def test_reads_near_their_ends_get_the_gap(spark):
    draw, ref = world(3)
    rows, right = [], {}
    for site, gone, added in ((1_000, 4, ""), (4_090, 2, ""), (6_000, 0, "TTGCA"), (9_000, 1, "")):
        some, told = records(draw, ref, site, gone, added, (30, 25, 20, 52, 7, 50, 9))
        rows, right = rows + some, right | told
    rows += [("far", 1, 0, "c", 11_001, "60M", ref[11_000:11_060], "I" * 60, None), ("bad", 1, 512, "c", 1_001, "60M", "A" * 60, "I" * 60, None)]
    rows += [("spliced", 1, 0, "c", 970, "30M100N30M", "A" * 60, "I" * 60, None), ("bare", 1, 0, "c", 990, "60M", None, None, None), (None, 1, 0, "c", 990, "60M", "A" * 60, "I" * 60, None)]
    records_ = spark.createDataFrame(rows, FIELDS)
    told = R.realign_indels(records_, spark.createDataFrame([("c", ref)], "chrom string, ref string"))
    assert told.columns == [*records_.columns, "realigned"] and told.schema["pos"].dataType == records_.schema["pos"].dataType
    got = told.collect()
    assert len(got) == len(rows)
    by_name = {r["qname"]: (r["pos"], r["cigar"], r["realigned"]) for r in got}
    for name, want in right.items():
        assert by_name[name] == want, name
    for r in rows[-5:]:
        assert by_name[r[0]] == (r[4], r[5], False)


def test_an_indel_of_one_read_is_not_believed(spark):
    draw, ref = world(4)
    rows, _ = records(draw, ref, 2_000, 4, "", (30, 52, 7))
    references = spark.createDataFrame([("c", ref)], "chrom string, ref string")
    told = R.realign_indels(spark.createDataFrame(rows, FIELDS), references).collect()
    assert not any(r["realigned"] for r in told)
    rows, _ = records(draw, ref, 2_000, 4, "", (30, 25, 20))
    assert not any(r["realigned"] for r in R.realign_indels(spark.createDataFrame(rows, FIELDS), references).collect())


def test_clips_stay(spark):
    draw, ref = world(5)
    rows, _ = records(draw, ref, 2_000, 4, "", (30, 25, 52))
    name, mate, flag, chrom, pos, _, seq, qual, note = rows[-1]
    rows[-1] = (name, mate, flag, chrom, pos, "3S60M2S", "NNN" + seq + "NN", "I" * 65, note)
    told = R.realign_indels(spark.createDataFrame(rows, FIELDS), spark.createDataFrame([("c", ref)], "chrom string, ref string")).where("realigned").collect()
    assert [r["cigar"][:2] + r["cigar"][-2:] for r in told] == ["3S2S"] and told[0]["pos"] == pos


def test_nothing_to_realign(spark):
    _, ref = world()
    none = spark.createDataFrame([], FIELDS)
    assert R.realign_indels(none, spark.createDataFrame([("c", ref)], "chrom string, ref string")).count() == 0


def test_indels_shown_alike_are_counted_before_their_windows(spark):
    from strandlake.operators.gapped import cut_tiles
    from strandlake.operators.realign import indel_events

    ref = "ACGGTCATTTTTGCAGTCCATGACGTAACCGT" * 4
    rows = [("x", 3, 30, "9M2D17M", "A" * 26)] * 5 + [("x", 5, 30, "7M2D17M", "C" * 24)] * 2 + [("x", 3, 30, "5M1I23M", "GGTCAT" + "A" * 23)] * 3
    found = indel_events(spark.createDataFrame(rows, "chrom string, pos long, end long, cigar string, seq string"), cut_tiles(spark.createDataFrame([("x", ref)], "chrom string, ref string")))
    assert sorted(r.reads for r in found.collect()) == [3, 7]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow find(") < plan.index("count(1)")  # counted below the windows' join
