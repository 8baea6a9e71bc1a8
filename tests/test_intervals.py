import random
from collections import Counter

from pyspark.sql import functions as F

from strandlake.operators import counting as C
from strandlake.operators import coverage as V
from strandlake.operators import intervals as I
from strandlake.operators import stats as S

SCHEMA = "chrom string, start int, end int"


def some(spark, seed, n=60, most=400, wide=40):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        start = rnd.randint(1, most)
        rows.append((rnd.choice("xy"), start, start + rnd.randint(0, wide)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def places(rows):
    return {(c, p) for c, a, b in rows for p in range(a, b + 1)}


def ranges(df):
    return sorted((r.chrom, r.start, r.end) for r in df.collect())


def test_depth_equals_counting(spark):
    rows, df = some(spark, 1)
    depth = Counter((c, p) for c, a, b in rows for p in range(a, b + 1))
    for tile in (64, 1 << 20):
        runs = I.sweep(df, ["chrom"], tile=tile).collect()
        assert {(r.chrom, p): r.depth for r in runs for p in range(r.start, r.end + 1)} == dict(depth)


def test_set_operations_equal_positions(spark):
    a_rows, a = some(spark, 2)
    b_rows, b = some(spark, 3)
    assert places(ranges(I.set_difference(a, b, ["chrom"]))) == places(a_rows) - places(b_rows)
    assert places(ranges(I.intersection(a, b, ["chrom"]))) == places(a_rows) & places(b_rows)
    merged = ranges(I.merge_adjacent(a, ["chrom"]))
    assert places(merged) == places(a_rows)
    assert ranges(I.merge_adjacent(spark.createDataFrame(merged, SCHEMA), ["chrom"])) == merged
    lengths = spark.createDataFrame([("x", 500), ("y", 500)], "chrom string, length long")
    assert places(ranges(I.gaps(a, ["chrom"], lengths))) == {(c, p) for c in "xy" for p in range(1, 501)} - places(a_rows)


def test_disjoint_pieces_cover_and_do_not_touch_twice(spark):
    rows, df = some(spark, 4)
    found = I.disjoin(df, ["chrom"]).collect()
    seen = Counter((r.chrom, p) for r in found for p in range(r.start, r.end + 1))
    assert set(seen.values()) == {1} and set(seen) == places(rows)
    assert all(r.depth == sum(c == r.chrom and a <= r.start and r.end <= b for c, a, b in rows) for r in found)


def test_overlap_join_equals_nested_loop(spark):
    a_rows, a = some(spark, 5, wide=3)
    b_rows, b = some(spark, 6, wide=400)
    pairs = I.overlap_join(I.left_side(a.distinct()), I.right_side(b.distinct()), bin_width=2)
    got = sorted((r.chrom, r.l_start, r.l_end, r.r_start, r.r_end) for r in pairs.collect())
    assert got == sorted((c, s, e, t, f) for c, s, e in set(a_rows) for d, t, f in set(b_rows) if c == d and s <= f and t <= e)


def test_tiles(spark):
    lengths = spark.createDataFrame([("x", 25)], "chrom string, length long")
    assert ranges(I.tiles(lengths, 10)) == [("x", 1, 10), ("x", 11, 20), ("x", 21, 25)]


def test_coverage_of_three_lanes_is_three_times(spark):
    runs = spark.createDataFrame([("x", i, i, i) for i in range(1, 11)] * 3, "chrom string, start int, end int, depth long")
    assert {(r.start, r.depth) for r in V.merge_runs(runs).collect()} == {(i, 3 * i) for i in range(1, 11)}


def test_survival(spark):
    curve = C.survival(spark.createDataFrame([(x,) for x in (1, 1, 2, 2, 4)], "count long"))
    assert sorted((r.value, r.num) for r in curve.collect()) == [(1, 5), (2, 3), (4, 1)]
    assert [(r.value, r.num) for r in C.survival(spark.createDataFrame([], "count long")).collect()] == [(1, 1)]


def test_regions_drop_variants(spark):
    variants = spark.createDataFrame([("x", p) for p in (1, 2, 3)], "chrom string, pos int")
    regions = spark.createDataFrame([("x", 1, 1), ("x", 2, 2)], SCHEMA)
    assert [r.pos for r in S.outside(variants, regions).collect()] == [3]
    assert sorted(r.pos for r in S.inside(variants, regions).collect()) == [1, 2]


def test_resize_is_held_at_the_front(spark):
    rows = spark.createDataFrame([("x", 100, 120, "+"), ("x", 100, 120, "-")], SCHEMA + ", strand string")
    assert ranges(V.resized_blocks(rows, 10).drop("strand")) == [("x", 100, 109), ("x", 111, 120)]


def test_features_without_reads_are_zero(spark):
    features = spark.createDataFrame([("s", "a", "x", 1, 10, "*"), ("s", "b", "x", 50, 60, "*"), ("s", "a", "x", 8, 12, "*")], "feature_set string, name string, chrom string, start int, end int, strand string")
    blocks = spark.createDataFrame([(1, "x", 5, 9), (1, "x", 10, 11), (2, "x", 1, 2)], "groupid long, chrom string, start int, end int")
    counts = {r.name: (r["count"], r.width) for r in C.count_features(features, blocks).collect()}
    assert counts == {"a": (2, 12), "b": (0, 11)}
    done = C.add_rpkm(C.count_features(features, blocks), blocks.agg(F.countDistinct("groupid").alias("n"))).where("name = 'a'").first()
    assert done.rpkm == 1e9 * 2 / (2 * 12)
