"""Lanes that arrive while the stream stops and starts again."""

import pytest
from pyspark.sql import functions as F

from strandlake.streaming import lanes as L

SCHEMA = "lane string, id string, length int"


def sums():
    return {"reads": F.count("*"), "bases": F.sum("length"), "shortest": F.min("length"), "longest": F.max("length")}


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def totals(spark, folder):
    L.total_arriving(spark, str(folder / "in"), SCHEMA, ["lane"], sums(), str(folder / "out"), str(folder / "state")).awaitTermination(120)
    return {r.lane: tuple(r)[1:] for r in L.current(spark, str(folder / "out"), ["lane"]).collect()}


def test_each_file_counts_once_over_restarts(spark, tmp_path):
    arrive(spark, tmp_path, [("a", "1", 75), ("a", "2", 60), ("b", "3", 75)])
    assert totals(spark, tmp_path) == {"a": (2, 135, 60, 75), "b": (1, 75, 75, 75)}
    assert totals(spark, tmp_path) == {"a": (2, 135, 60, 75), "b": (1, 75, 75, 75)}  # nothing new
    arrive(spark, tmp_path, [("a", "4", 100), ("c", "5", None), (None, "6", 10)])
    arrive(spark, tmp_path, [("a", "7", 50)])
    want = {"a": (4, 285, 50, 100), "b": (1, 75, 75, 75), "c": (1, None, None, None), None: (1, 10, 10, 10)}
    assert totals(spark, tmp_path) == want
    whole = spark.read.parquet(str(tmp_path / "in")).groupBy("lane").agg(*[c.alias(n) for n, c in sums().items()])
    assert {r.lane: tuple(r)[1:] for r in whole.collect()} == want


def test_an_id_of_an_earlier_batch_is_rejected(spark, tmp_path):
    run = lambda: L.reject_repeated(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "ids")).awaitTermination(120)
    arrive(spark, tmp_path, [("a", "1", 75), ("a", "2", 60), ("b", None, 1), ("b", None, 1)])
    run()
    arrive(spark, tmp_path, [("b", "3", 75)])
    run()
    arrive(spark, tmp_path, [("b", "1", 75)])
    for _ in range(2):
        with pytest.raises(Exception, match="duplicated read id 1"):
            run()
