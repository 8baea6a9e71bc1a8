"""Language identification by fusing the evidence of text, markup and address.

Text gives a likelihood for each language, from byte trigrams hashed into bins and
counted over the labelled documents. The declared language of the markup gives
another: how often documents that look like language l declare d. The address
gives a prior: how documents of its host divide over languages, smoothed towards
its suffix, which is smoothed towards the whole corpus. These counts are grouped
aggregations over all documents; the posterior is the product of the three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm._runtime import BROADCAST_ROWS, small_batches, small_side, written
from strandlake.llm._text import LOWER, blocks, column_bytes

BINS = 1 << 13
#: Languages that a model may have; it is collected and broadcast, BINS numbers for each.
MAX_LANGUAGES = 200
#: Trigrams are not independent: a text counts as at most so many.
EFFECTIVE = 60.0
#: Pseudo-counts that a level of the host prior takes from the level above it.
SMOOTH = 20.0


def _bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and document of every byte trigram within a document that has a letter or a byte over 127."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = LOWER[data].astype(np.uint32)
    letter = (x >= 97) & (x <= 122) | (x >= 128)
    gram = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(19)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = (doc[:-2] == doc[2:]) & letter[1:-1]
    return gram[ok].astype(np.int64), doc[:-2][ok]


def train_languages(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """The languages in code point order and log probabilities, BINS rows of one column each.

    Counts cover every document with a language, rows that repeat an id each; rows without a
    language are left out, null and empty texts add nothing. More than MAX_LANGUAGES is an error;
    an empty table gives no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            langs = batch.column(0).to_pylist()
            for first, last in blocks(offsets, 1 << 19):
                gram, doc = _bins(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                names = sorted(set(langs[first:last]))
                place = {n: i for i, n in enumerate(names)}
                of = np.array([place[x] for x in langs[first:last]])
                table = np.bincount(of[doc] * BINS + gram, minlength=len(names) * BINS).reshape(-1, BINS)
                for name, row in zip(names, table):
                    sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            full = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(row[full], pa.int64())], ["lang", "bin", "n"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    summed = written(rows.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    names = sorted(r[0] for r in summed.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((BINS, max(1, len(names))))
    for r in summed.collect():  # at most MAX_LANGUAGES * BINS rows
        table[r.bin, names.index(r.lang)] = r.n
    table += 0.5
    return names, np.log(table / table.sum(axis=0))


def text_evidence(docs: DataFrame, languages: list[str], model: np.ndarray, id_col: str, text_col: str, others: list[str]) -> DataFrame:
    """row_id, the columns `others`, grams (trigrams in the text), likelihoods (log, tempered, the largest 0)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            data, offsets = column_bytes(batch.column(batch.num_columns - 1))
            for first, last in blocks(offsets, 1 << 19):
                n = last - first
                gram, doc = _bins(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                grams = np.bincount(doc, minlength=n)
                sums = np.stack([np.bincount(doc, weights=table[gram, k], minlength=n) for k in range(table.shape[1])], axis=1).astype(float)
                sums *= (np.minimum(grams, EFFECTIVE) / np.maximum(grams, 1))[:, None]
                sums -= sums.max(axis=1, keepdims=True)
                likely = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * sums.shape[1]), pa.array(sums.ravel()))
                kept = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(grams, pa.int64()), likely], [*batch.schema.names[:-1], "grams", "likelihoods"])

    rows = docs.select(F.col(id_col).alias("row_id"), *others, F.col(text_col).alias("_text"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(score, ", ".join([*kinds, "grams long", "likelihoods array<double>"]))


def _shares(counts: Column, above: Column) -> Column:
    """(counts + SMOOTH * above) / (sum of counts + SMOOTH), element by element."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(counts, above, lambda c, p: (c + SMOOTH * p) / (total + SMOOTH))


def identify_languages(docs: DataFrame, languages: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = None, host_col: str | None = None, suffix_col: str | None = None, addresses: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """row_id, lang, posterior, text_lang, declared, host, kept: one row for each document.

    declared_col, host_col and suffix_col name columns with the language the markup declares and
    the address's host and suffix; None or a null value is no evidence of that kind (a null host
    takes its suffix's prior, a null suffix the corpus's). addresses: (doc_id, declared, host,
    suffix), at most one row an id, goes before these columns where it is not null; it is joined
    to the scored rows, so no text is shuffled for it. A document is kept if its text has a
    trigram around a letter and its posterior is at least `least`; a text that is null, empty or
    without letters has its language from the other evidence and is not kept. Ties go to the first language.
    Repeated rows count and are answered each. An empty table, or a model without a language,
    gives rows with a null language that are not kept.
    """
    null = F.lit(None).cast("string")
    evidence = {"declared": F.lower(F.substring_index(F.trim(F.col(declared_col)), "-", 1)) if declared_col else null, "host": F.lower(F.col(host_col)) if host_col else null, "suffix": F.lower(F.col(suffix_col)) if suffix_col else null}
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"), *[c.alias(k) for k, c in evidence.items()])
    if not languages:
        return plain.select(F.col("_id").alias("row_id"), null.alias("lang"), F.lit(0.0).alias("posterior"), null.alias("text_lang"), "declared", "host", F.lit(False).alias("kept"))
    rows = written(text_evidence(plain, languages, model, "_id", "_body", list(evidence)))
    if addresses is not None:
        known = addresses.select(F.col("doc_id").alias("_doc"), *[F.lower(c).alias(f"_{c}") for c in evidence])
        found = rows.join(known, F.col("row_id") == F.col("_doc"), "left")
        rows = written(found.select("row_id", *[F.coalesce(f"_{c}", c).alias(c) for c in evidence], "grams", "likelihoods"))
    k = len(languages)
    best = F.array_position("likelihoods", F.array_max("likelihoods")) - 1
    looks = rows.where("grams > 0").select(*evidence, best.cast("int").alias("l"))
    # one row for each host, suffix, declared language and language: sums before any shuffle
    cube = written(looks.groupBy("host", "suffix", "declared", "l").agg(F.count(F.lit(1)).cast("double").alias("n")))
    each = [F.sum(F.when(F.col("l") == i, F.col("n")).otherwise(0.0)) for i in range(k)]
    whole = cube.agg(*[F.coalesce(e, F.lit(0.0)).alias(f"n{i}") for i, e in enumerate(each)]).first()
    total = sum(whole) + SMOOTH
    corpus = F.array(*[F.lit((n + SMOOTH / k) / total) for n in whole])
    by_suffix = written(cube.where("suffix is not null").groupBy("suffix").agg(F.array(*each).alias("n")).select("suffix", _shares(F.col("n"), corpus).alias("suffix_prior")))
    by_host = cube.where("host is not null").groupBy("host", "suffix").agg(F.array(*each).alias("n")).join(by_suffix, "suffix", "left")
    by_host = by_host.select("host", F.coalesce("suffix", F.lit("")).alias("_suffix"), _shares(F.col("n"), F.coalesce("suffix_prior", corpus)).alias("host_prior"))
    by_declared = cube.where("declared is not null").groupBy("declared").agg(F.array(*each).alias("n"))
    # how likely each language is to declare this, with one pseudo-count in all
    sums = F.array(*[F.lit(float(n) + 1.0) for n in whole])
    by_declared = by_declared.select("declared", F.zip_with("n", sums, lambda c, t: F.log((c + 1.0 / k) / t)).alias("declares"))
    joined = rows.withColumn("_suffix", F.coalesce("suffix", F.lit("")))
    few = BROADCAST_ROWS * 100 // (60 + 8 * k)  # rows hold k numbers
    joined = joined.join(small_side(by_declared, few), "declared", "left").join(small_side(by_suffix, few), "suffix", "left").join(small_side(by_host, few), ["host", "_suffix"], "left")
    prior = F.transform(F.coalesce("host_prior", "suffix_prior", corpus), lambda p: F.log(p))
    nothing = F.array(*[F.lit(0.0)] * k)
    log = F.zip_with(F.zip_with("likelihoods", prior, lambda a, b: a + b), F.coalesce("declares", nothing), lambda a, b: a + b)
    joined = joined.withColumn("log", log)
    top = F.array_max("log")
    mass = F.aggregate("log", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    names = F.array(*[F.lit(x) for x in languages])
    posterior = 1.0 / mass
    return joined.select(
        "row_id",
        F.element_at(names, F.array_position("log", top).cast("int")).alias("lang"),
        posterior.alias("posterior"),
        F.when(F.col("grams") > 0, F.element_at(names, best.cast("int") + 1)).alias("text_lang"),
        "declared",
        "host",
        ((F.col("grams") > 0) & (posterior >= least)).alias("kept"),
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """doc_id, declared, host, suffix: the markup and address of the first page with that document number in its path.

    First is the page of the least page_id. A page with a null or unreadable url belongs to no
    document and is left out; parts that a page lacks are null. Repeated rows count once; an empty table has no rows.
    """
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#:]+)", 1)
    found = pages.select(
        F.try_to_number(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]+/(?:[^?#]*/)?(\d{1,18})(?:\.[a-z]+)?/?(?:[?#]|$)", 1), F.lit("9" * 18)).cast("long").alias("doc_id"),
        "page_id",
        F.nullif(F.regexp_extract("html", r"<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1), F.lit("")).alias("suffix"),
    )
    found = found.where("doc_id is not null").groupBy("doc_id").agg(F.min_by(F.struct("declared", "host", "suffix"), "page_id").alias("p"))
    return found.select("doc_id", "p.*")
