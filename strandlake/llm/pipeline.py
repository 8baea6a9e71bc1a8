"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and gives the documents that go on, with
the columns of `documents`; the last gives token ids as digests. run() writes each
stage's documents to the shared folder, reads them back for the next and deletes what
the stage wrote on its way. A stage that drops rows gives each row a key of its own, as
ids may be null or repeated. In every stage null and empty texts, repeated rows and an
empty table are as in the operator it calls.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm._runtime import fresh, kept, scratch, shared_dir, small_side, written
from strandlake.llm.bpe import bpe_encode, token_digests
from strandlake.llm.exact_dedup import exact_dedup
from strandlake.llm.minhash_dedup import near_duplicates
from strandlake.llm.queries import halves, languages_of, vocabulary_path
from strandlake.llm.source_mix import mixed_documents


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key for each row that stays the same however often they are read; and the key's name.

    A row of a file is told by the file's number and its place in it, so nothing is rewritten;
    rows that are not read from files are written with a key.
    """
    key, path, place = (fresh(docs, c) for c in ("row_key", "file_path_", "row_index_"))
    try:
        rows = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        return written(docs.withColumn(key, F.monotonically_increasing_id())), key
    # one row a file, numbered in one task
    files = written(written(rows.select(path).distinct()).coalesce(1).withColumn(key, F.monotonically_increasing_id()))
    number = F.col(key) * F.lit(1 << 40) + F.col(place)
    return rows.join(small_side(files), path).withColumn(key, number).select(*docs.columns, key), key


def _without(keyed: DataFrame, key: str, out: DataFrame) -> DataFrame:
    """The rows whose keys are not in out, without the key; only keys are moved while they are few."""
    return keyed.join(small_side(out.select(key)), key, "left_anti").drop(key)


def _one_of_each(keyed: DataFrame, key: str, decided: DataFrame, group: str) -> DataFrame:
    """Of each group, named by one of its keys, the row of the smallest (doc_id, key); a null id is the largest."""
    others = decided.where(F.col("row_id") != F.col(group)).select(F.col("row_id").alias(key), F.col(group).alias("_group"))
    several = written(others.union(others.select(F.col("_group").alias(key), "_group").distinct()))
    known = keyed.select(key, "doc_id").join(small_side(several), key)
    first = known.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key)).alias("first"))
    return _without(keyed, key, several.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_anti"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a posterior of 0.5 or more."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, languages_of(spark, keyed, sf_dir, key).where("not kept").withColumnRenamed("row_id", key))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the smallest id; the older half of the ids is the snapshot."""
    keyed, key = _keyed(docs)
    return _one_of_each(keyed, key, exact_dedup(*halves(keyed), id_col=key), "keep_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked by sets of five-word shingles at 0.8."""
    keyed, key = _keyed(docs)
    return _one_of_each(keyed, key, near_duplicates(keyed, id_col=key, shingle_words=5, percent=80), "component_id")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of its source takes it."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the digests of ids and decoded text of each mixed document."""
    encoded = bpe_encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path(), decoded_col="decoded")
    return token_digests(encoded.drop("text"), "ids", "decoded")


STAGES = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("minhash_dedup", drop_near_copies),
    ("source_mix", mix),
    ("bpe", encode),
]

#: MinHash candidates and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`. Of the tables written, the last stage's own and its input stay."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = kept(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
