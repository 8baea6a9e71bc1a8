"""States that merge over lanes, and bounded counting of sequences."""

import random

import numpy as np
import pytest

from strandlake.operators import counting as C
from strandlake.operators import intervals as I
from strandlake.operators import preprocess as P
from strandlake.operators import quantiles as Q


def test_merged_lanes_have_the_quantiles_of_the_whole(spark):
    draw = random.Random(3)
    rows = [(f"l{i % 3}", draw.choice((float(draw.randrange(5)), draw.uniform(-5_000, 5_000), 1e6))) for i in range(500)] + [("l3", 7.0), (None, 1.0), ("l0", None), ("l0", float("nan"))]
    lanes = Q.quantile_state(spark.createDataFrame(rows, "lane string, x double"), ["lane"], "x")
    fit = [(lane, x) for lane, x in rows if lane and x is not None and x == x]
    shares = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    for lane in ("l0", "l1", "l2", "l3"):
        got = Q.state_quantiles(lanes.where(f"lane = '{lane}'"), ["lane"], shares).first()
        values = [x for y, x in fit if y == lane]
        assert got.n == len(values) and got["quantiles"] == pytest.approx(np.quantile(values, shares).tolist())
    whole = Q.state_quantiles(Q.merge_states(lanes, []), [], shares).first()
    assert whole.n == len(fit) and whole["quantiles"] == pytest.approx(np.quantile([x for _, x in fit], shares).tolist())
    assert Q.state_quantiles(lanes.limit(0), ["lane"]).count() == 0


def test_few_counters_give_the_commonest_sequences(spark):
    draw = random.Random(4)
    common = {"".join(draw.choice("ACGT") for _ in range(12)): 300 - 20 * i for i in range(8)}
    seqs = [s for s, n in common.items() for _ in range(n)] + ["".join(draw.choice("ACGT") for _ in range(20)) for _ in range(3_000)] + [None, ""] * 50
    draw.shuffle(seqs)
    reads = spark.createDataFrame([(s,) for s in seqs], "seq1 string").repartition(3)
    want = sorted(common.items(), key=lambda x: (-x[1], x[0]))[:5]
    for size in (100_000, 200, 3):  # nothing dropped; dropped but sure; not sure, so all are counted
        assert [tuple(r) for r in P.top_sequences(reads, 5, size=size).collect()] == want
    assert P.top_sequences(reads.limit(0), 5).count() == 0


def test_commonest_sequences_read_their_input_twice(spark, tmp_path):
    draw = random.Random(5)
    seqs = ["ACGT"] * 300 + ["CCGT"] * 200 + ["".join(draw.choice("ACGT") for _ in range(20)) for _ in range(1_000)]
    reads = spark.createDataFrame([(s,) for s in seqs], "seq1 string").coalesce(1)

    def told(batches):
        with open(tmp_path / "reads", "a") as out:
            out.write("x")
        yield from batches

    got = P.top_sequences(reads.mapInArrow(told, "seq1 string"), 2, size=100)
    assert [tuple(r) for r in got.collect()] == [("ACGT", 300), ("CCGT", 200)]
    assert len((tmp_path / "reads").read_text()) == 2


def test_counters_know_what_they_may_have_lost():
    import pyarrow as pa

    draw = random.Random(5)
    words = [str(min(draw.randrange(1, 400), draw.randrange(1, 400))) for _ in range(4_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(words[i : i + 100])], names=["seq"]) for i in range(0, 4_000, 100)]
    (out,) = list(P._frequent(iter(batches), 20))
    kept, lost = set(out.column(0).to_pylist()[:-1]), out.column(1).to_pylist()[-1]
    assert len(kept) <= 40 and all(words.count(w) <= lost for w in set(words) - kept)


def test_counts_by_run_are_counts_of_each_run(spark):
    draw = random.Random(6)
    features = spark.createDataFrame([(f"s{i % 2}", f"f{i % 15}", f"c{i % 2}", x, x + draw.randrange(40)) for i in range(20) for x in [draw.randrange(1, 500)]], "feature_set string, name string, chrom string, start int, end int")
    rows = [(i % 40, f"c{i % 2}", x, x + draw.randrange(30), i % 3) for i in range(200) for x in [draw.randrange(1, 500)]]
    blocks = spark.createDataFrame([*rows, (1, "c0", 5, 9, None)], "groupid int, chrom string, start int, end int, run int")
    got = {(r.run, r.feature_set, r["name"]): (r["count"], r.width) for r in C.count_features_by(features, blocks).collect()}
    for run in range(3):
        want = {(run, r.feature_set, r["name"]): (r["count"], r.width) for r in C.count_features(features, blocks.where(f"run = {run}")).collect()}
        assert {k: v for k, v in got.items() if k[0] == run} == want
    assert {k[0] for k in got} == {0, 1, 2}


def test_checks_as_rows(spark):
    a = spark.createDataFrame([("c", 1, 5), ("c", 6, 9)], "chrom string, start int, end int")
    b = spark.createDataFrame([("c", 5, 7)], "chrom string, start int, end int")
    rows = [I.disjoint_row(a, ["chrom"], "x"), I.disjoint_row(a.union(b), ["chrom"], "x"), I.disjoint_row(a.limit(0), ["chrom"], "x"), I.within_row(b, a, ["chrom"], "x"), I.within_row(a, b, ["chrom"], "x")]
    assert [r.first().x for r in rows] == [True, False, True, True, False]


def test_one_exchange_serves_both_uses_of_events(spark, tmp_path):
    spark.createDataFrame([("c", 1, 5), ("d", 6, 9)], "chrom string, start int, end int").write.parquet(str(tmp_path / "r"))
    swept = I.sweep(spark.read.parquet(str(tmp_path / "r")), ["chrom"])
    swept.collect()
    plan = swept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan parquet") == 1
