"""Lanes that arrive as files: partial summaries for each batch, merged as they come, or totals kept as state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def summarise_arriving(spark: SparkSession, folder: str, schema: str, partial: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Write partial(batch) of every new Parquet file in the folder to `out`, one folder a batch, once.

    A batch that is tried again overwrites its own folder, so each file counts once.
    """

    def each(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, out: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """merge() of all partial summaries so far."""
    return merge(spark.read.parquet(out).drop("batch"))


def total_arriving(spark: SparkSession, folder: str, schema: str, by: list[str], totals: dict[str, Column], out: str, checkpoint: str) -> StreamingQuery:
    """Add every new Parquet file in the folder to its lane's running totals: one row of state a key, whatever has come before.

    totals are aggregates by name, of the kinds that go on from a state (sums, counts, least and
    largest). They are combined before the shuffle, so a lane with most of the reads is no hot task. Only
    keys that a batch touched are written, with all they have by then, into a folder of the batch's own, which a
    batch tried again overwrites; `current` reads what holds now. A new start goes on from the checkpoint.
    """
    state = spark.readStream.schema(schema).parquet(folder).groupBy(*by).agg(*[c.alias(n) for n, c in totals.items()])

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return state.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    """The totals that hold now: of each key the row of the last batch that touched it."""
    rows = spark.read.parquet(out)
    names = [c for c in rows.columns if c not in (*by, "batch")]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*names), "batch").alias("_last")).select(*by, "_last.*")


def reject_repeated(spark: SparkSession, folder: str, schema: str, checkpoint: str, id_col: str = "id") -> StreamingQuery:
    """Fail once a read id comes a second time, in one file or in files of different batches; null ids don't count.

    How often each id has come is state by id. A batch that fails is not committed, so a new
    start fails again until the file is gone. For many ids let the session keep state in
    RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    seen = spark.readStream.schema(schema).parquet(folder).where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n"))

    def each(batch: DataFrame, number: int) -> None:
        name = F.concat(F.lit("duplicated read id "), F.col(id_col).cast("string"))
        batch.select(F.when(F.col("n") > 1, F.raise_error(name)).alias("x")).write.format("noop").mode("overwrite").save()

    return seen.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
