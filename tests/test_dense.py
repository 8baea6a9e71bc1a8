"""Depth by tiles, and shifts between strands, against plain counting."""

import random

import numpy as np
import pytest

from strandlake.operators import dense as D
from strandlake.operators.coverage import coverage_runs, merge_runs

BLOCK = "chrom string, start int, end int, strand string"


@pytest.fixture(scope="module")
def lanes(spark):
    """A deep lane, a thin one, and one that lies on tile borders."""
    draw = random.Random(8)
    at = lambda n, width: [("c", x, x + draw.randrange(1, width), draw.choice("+-")) for x in (draw.randrange(1, 9_000) for _ in range(n))]
    edges = [("c", D.TILE, D.TILE + 1, "+"), ("c", D.TILE - 5, D.TILE, "-"), ("c", D.TILE + 1, D.TILE + 1, "-"), ("d", 1, 3 * D.TILE, "+"), ("d", 2 * D.TILE, 2 * D.TILE, "-")]
    return [spark.createDataFrame(rows, BLOCK) for rows in (at(4_000, 90), at(30, 60), edges)]


def sorted_rows(df):
    return sorted(map(tuple, df.select("chrom", "start", "end", "depth").collect()))


def test_tiles_and_runs_are_the_same_depth(lanes):
    deep = D.tiled(coverage_runs(lanes[0]))
    forms = {r.tile: r.depths is not None for r in deep.collect()}
    assert forms[0] and not any(r.depths for r in D.tiled(coverage_runs(lanes[1])).collect())
    for lane in lanes:
        runs = coverage_runs(lane)
        assert sorted_rows(D.tiles_to_runs(D.tiled(runs))) == sorted_rows(runs)


def test_adding_tiles_equals_adding_runs(spark, lanes):
    runs = [coverage_runs(lane) for lane in lanes]
    tiles = [D.tiled(r) for r in runs]
    both = tiles[0].unionByName(tiles[1]).unionByName(tiles[2])
    want = merge_runs(runs[0].unionByName(runs[1]).unionByName(runs[2]))
    assert sorted_rows(D.tiles_to_runs(D.add_tiles(both))) == sorted_rows(want)
    taken = D.add_tiles(tiles[0].unionByName(D.tiled(runs[0].withColumn("depth", -runs[0]["depth"]))))
    assert sorted_rows(D.tiles_to_runs(taken)) == []


def test_dense_tiles_are_smaller(lanes):
    runs = coverage_runs(lanes[0])
    tiles = D.tiled(runs)
    arrays = sum(len(r.depths) * 8 for r in tiles.where("depths is not null and tile < 2").collect())
    covered = runs.where(f"start <= {2 * D.TILE}").count()
    assert arrays < covered * 24


def test_odd_runs(spark):
    odd = spark.createDataFrame([(None, 1, 5, 2), ("c", 9, 4, 2), ("c", 3, 3, 1), ("c", 3, 4, 2)], "chrom string, start int, end int, depth int")
    assert sorted_rows(D.tiles_to_runs(D.tiled(odd))) == [("c", 3, 3, 3), ("c", 4, 4, 2)]
    assert D.add_tiles(D.tiled(odd.limit(0))).count() == 0


@pytest.mark.parametrize("most", [50, 5_000])
def test_shift_equals_pairing_all_ends(spark, most):
    draw = random.Random(most)
    rows = []
    for _ in range(1_500):
        at, size = draw.randrange(1, 20_000), draw.choice((33, 33, 33, draw.randrange(10, 49)))
        rows += [("c", at, at + 9, "+"), ("c", at + size - 10, at + size - 1, "-")]
    rows += [("e", 5, 9, "+"), (None, 5, 9, "-")]
    got = {r.chrom: (r.n, r.length) for r in D.correlate_strands(spark.createDataFrame(rows, BLOCK), most).collect()}
    plus, minus = np.array([r[1] for r in rows if r[0] == "c" and r[3] == "+"]), np.array([r[2] for r in rows if r[0] == "c" and r[3] == "-"])
    apart = (minus[None, :] - plus[:, None]).ravel()
    pairs = np.bincount(apart[(apart >= 0) & (apart < most)])
    assert got == {"c": (3_000, int(pairs.argmax()) + 1)}
