import random
import threading

import pytest

from strandlake.operators import counting as C

BLOCKS = "groupid long, chrom string, start int, end int, run string"
FEATURES = "feature_set string, name string, chrom string, start int, end int"


def brute(features, blocks, by=lambda b: ()):
    hits = {}
    for b in blocks:
        for f in features:
            if f[2] == b[1] and f[3] <= b[3] and b[2] <= f[4]:
                hits.setdefault((*by(b), f[0], f[1]), set()).add(b[0])
    return hits


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_counting_pair_by_pair(spark, seed):
    draw = random.Random(seed)
    blocks = [(draw.randrange(60), draw.choice("xy"), s := draw.randrange(1, 400), s + draw.randrange(40), draw.choice("ab")) for _ in range(300)]
    features = [(f"set{draw.randrange(70)}", f"f{i}", draw.choice("xyz"), s := draw.randrange(1, 400), s + draw.choice((0, 1, 6, 63, 64, 200))) for i in range(150)]
    features += [(features[i][0], features[i][1], "x", 500 - i, 520) for i in range(5)]
    b, f = spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(features, FEATURES)
    hits = brute(features, blocks)
    got = {(r["feature_set"], r["name"]): r["count"] for r in C.count_features(f, b).collect()}
    assert got == {k: len(hits.get(k, ())) for k in {(x[0], x[1]) for x in features}}
    for by, of in (((), lambda b: ()), (("run",), lambda b: (b[4],))):
        sets = {}
        for key, reads in brute(features, blocks, of).items():
            sets.setdefault(key[:-1], set()).update(reads)
        rows = C.reads_by_set(f, b, by).collect()
        assert {(*[r[c] for c in by], r["feature_set"]): r["nbreads"] for r in rows} == {k: len(v) for k, v in sets.items()}
        assert len(rows) == len(sets)


def test_a_place_with_many_reads_and_features_is_no_product(spark):
    """60,000 features around 60,000 reads of two blocks; a join of both would make 3.6e9 pairs."""
    n = 60_000
    features = spark.range(n).selectExpr("concat('set', id % 5) feature_set", "cast(id as string) name", "'x' chrom", "cast(1000 - id % 500 as int) start", "cast(2000 + id % 300 as int) end")
    blocks = spark.range(n).selectExpr("id groupid", "'x' chrom", "explode(array(1100, 1500)) start").selectExpr("groupid", "chrom", "start", "start + 20 end", "'a' run")
    stop = threading.Timer(120, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        assert C.count_features(features, blocks).where(f"count = {n}").count() == n
        assert {r["nbreads"] for r in C.reads_by_set(features, blocks).collect()} == {n}
    finally:
        stop.cancel()
