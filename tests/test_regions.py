"""Tables by place: the rows of any regions, and only the files that can hold them."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.sources import regions as R

ROW = "chrom string, start int, end int, name string"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    draw, path = random.Random(2), str(tmp_path_factory.mktemp("regions") / "t")
    rows = []
    for i in range(600):
        at, width = draw.choice((draw.randrange(1, 60_000_000), 1 << 20, (1 << 23) - 2)), draw.choice((1, 50, 100, 3_000_000))
        rows.append((draw.choice(("1", "c2", "x y")), at, at + width - 1, f"r{i}"))
    rows += [("1", 1, 1_200_000_000, "wide"), (None, 5, 6, "lost"), ("1", None, None, "placeless")]
    R.write_by_region(spark.createDataFrame(rows, ROW), path)
    return path, rows


def overlapping(rows, which):
    return sorted(n for c, a, b, n in rows if a is not None and any(c == d and a <= y and x <= b for d, x, y in which))


@pytest.mark.parametrize("which", [[("1", 1, 100)], [("c2", 1 << 20, 1 << 20), ("x y", 30_000_000, 30_900_000)], [("1", 8_388_600, 8_388_700), ("1", 8_388_650, 9_000_000), ("1", 9_000_001, 9_000_002)], [("c2", 1, 60_000_000)], [("none", 1, 5)], []])
def test_regions_give_their_rows(spark, table, which):
    path, rows = table
    got = R.read_regions(spark, path, spark.createDataFrame(which, "chrom string, start int, end int"))
    assert got.columns == ["chrom", "start", "end", "name"]
    assert sorted(r.name for r in got.collect()) == overlapping(rows, which)


def test_only_the_bins_of_a_region_are_opened(spark, table):
    path, rows = table
    which = spark.createDataFrame([("c2", 20_000_000, 20_000_500)], "chrom string, start int, end int")
    got = R.read_regions(spark, path, which)
    files = got.select(F.input_file_name()).distinct()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws" in plan
    assert files.count() <= 5 < spark.read.parquet(path).select(F.input_file_name()).distinct().count()


def test_all_rows_are_kept(spark, table):
    path, rows = table
    assert spark.read.parquet(path).count() == len(rows)
