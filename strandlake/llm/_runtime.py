"""What the operators share on the Spark side: tables that cut lineage, checked broadcasts.

An intermediate result that is read more than once is written as Parquet into
the folder that ``spark.checkpoint.dir`` names, which every executor can read,
so a lost executor costs the tasks it was running and no more.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of narrow rows (under about 100 bytes) may be broadcast.
BROADCAST_ROWS = 200_000
#: Rows of an Arrow batch that holds texts.
BATCH_ROWS = 250


_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; where none is set, a temporary folder if all runs in one process, else an error."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="strandlake-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: lineage and partitioning end here. With `tasks`, at most so many write."""
    path = f"{shared_dir(df.sparkSession)}/strandlake-{uuid.uuid4().hex}"
    df = df.coalesce(tasks) if tasks else df
    df.write.parquet(path)
    if (tables := _tables.get()) is not None:
        tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within are deleted on leaving; what is to stay must be written elsewhere before, or by an outer scope."""
    token = _tables.set([])
    try:
        yield
    finally:
        paths = _tables.get() or []
        _tables.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def kept(df: DataFrame, path: str) -> DataFrame:
    """Write df to a path of its own, which no scope deletes, and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_tasks(df: DataFrame, rows: int) -> int | None:
    """Two tasks a core if df has at most `rows` rows, else None: how many shall write the tables made from df.

    A task that writes costs some 50 ms however few rows it has, so small tables made in many
    steps take as long as there are shuffle partitions.
    """
    return 2 * df.sparkSession.sparkContext.defaultParallelism if df.limit(rows + 1).count() <= rows else None


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, tasks: int | None = None) -> DataFrame:
    """Write df; mark it for broadcast if it has at most `rows` rows, else leave a shuffled join.

    Both ways give the same rows. df must have narrow rows of a fixed number of columns.
    """
    table = written(df, tasks)
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows in this session, as rows here are whole texts; fewer, if already set, stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_of(column: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(column, F.lit(""))
