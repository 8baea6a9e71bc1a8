"""The subpackage's queries over the driver's tables, and their SQL oracles."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import oracles
from strandlake.llm.bpe import bpe_encode, token_digests
from strandlake.llm.chat_format import format_chats, read_back
from strandlake.llm.embedding_dedup import link_embeddings
from strandlake.llm.exact_dedup import exact_dedup
from strandlake.llm.language_id import identify_languages, page_evidence, train_languages
from strandlake.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest
from strandlake.llm.minhash_dedup import near_duplicates
from strandlake.llm.quality import score_quality
from strandlake.llm.quality_rules import apply_quality_rules
from strandlake.llm.run_detection import detect_runs, with_planted_runs
from strandlake.llm.sharding import shard_documents
from strandlake.llm.source_mix import mix_sources
from strandlake.llm.substring_dedup import repeated_passages

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources share the words of the corpus by weights 1, 2, 3, repeating."""
    return mix_sources(_table(spark, sf_dir, "documents")).drop("source").withColumnRenamed("row_id", "doc_id")


def languages_of(spark: SparkSession, docs: DataFrame, sf_dir: str, id_col: str = "doc_id") -> DataFrame:
    """The languages of docs, by a model of `documents`, with the markup and address of their pages.

    id_col may name another column, unique, by which the rows are told apart; pages go by doc_id.
    """
    languages, model = train_languages(_table(spark, sf_dir, "documents"))
    addresses = page_evidence(_table(spark, sf_dir, "pages"))
    if id_col != "doc_id":
        addresses = docs.select("doc_id", F.col(id_col).alias("_row")).join(addresses, "doc_id").drop("doc_id").withColumnRenamed("_row", "doc_id")
    return identify_languages(docs, languages, model, id_col=id_col, host_col="source", addresses=addresses)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document from its text, its page's markup and its host."""
    told = languages_of(spark, _table(spark, sf_dir, "documents"), sf_dir).withColumnRenamed("row_id", "doc_id")
    return told.withColumn("posterior", F.round("posterior", 6))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes, as ranges of text hash and id."""
    return shard_documents(_table(spark, sf_dir, "documents"), shards=16).withColumnRenamed("row_id", "doc_id")


def vocabulary_path() -> str:
    """The vocabulary file of the queries; STRANDLAKE_TOKENIZERS names another folder that has it."""
    if folder := os.environ.get("STRANDLAKE_TOKENIZERS"):
        return os.path.join(folder, VOCABULARY)
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text they decode to, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_encode(docs, vocabulary_path(), decoded_col="decoded").drop("text")
    return token_digests(encoded, "ids", "decoded")


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with ids up to the middle of their range, and the rest (null ids too). Rows of one id stay together; of an empty table both are empty."""
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    return docs.where(old), docs.where(~old)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the ids is the snapshot, the rest the batch that comes in."""
    return exact_dedup(*halves(_table(spark, sf_dir, "documents"))).drop("is_new").withColumnRenamed("row_id", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labels that are not held out."""
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).withColumnRenamed("row_id", "doc_id")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93."""
    return link_embeddings(_table(spark, sf_dir, "embeddings")).withColumnRenamed("row_id", "vec_id")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2, percent=80).withColumnRenamed("row_id", "doc_id")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document shares with another."""
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts hold control strings, read back from the output."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    back = read_back(format_chats(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and verdicts of all documents, by cutoffs certified for each language on the labelled ones."""
    judged = apply_quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(F.col("row_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of words of every document, with runs planted into a tenth of them."""
    docs = with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return detect_runs(docs, with_text=False).withColumnRenamed("row_id", "doc_id")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by source, checked against documents of which a fifth may be tampered with."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, leaf_digest([lower if c == "text" else F.col(c) for c in columns]))
    told = merkle_manifest(_table(spark, sf_dir, "documents"), columns, others={"tampered": tampered})
    root = folded(F.coalesce("tampered", "leaf"), F.col("before"), F.col("after"))
    return (
        told.select(F.col("row_id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("before"), F.col("after")).alias("proof_sha256"), root.alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    from strandlake.llm.pipeline import run

    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mix": op1_source_mix,
        "op2_language_id": op2_language_id,
        "op3_sharding": op3_sharding,
        "op4_bpe": op4_bpe,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_quality": op6_quality,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_minhash_dedup": op8_minhash_dedup,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_chat_format": op10_chat_format,
        "op11_quality_rules": op11_quality_rules,
        "op12_run_detection": op12_run_detection,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
