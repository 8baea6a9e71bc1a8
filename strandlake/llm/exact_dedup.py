"""Exact deduplication of incoming batches against immutable snapshots.

A snapshot is the table of distinct normalised texts (as SHA-256 digests) with
the row that stands for each. Its digests are dealt into buckets by their first
bits, and each bucket gets one static binary-fuse filter, 9 to 12 bits a digest.
An incoming batch is first grouped by digest on its own; its distinct digests
then meet the filter of their bucket. What the filter turns away is new. What
passes joins the exact digests of the snapshot, and for every match the two
normalised texts are compared byte by byte.

Everything is keyed by digests, which spread evenly, and copies are summed
before they are shuffled: a text that a third of all rows share is one row in
every step but the last, a join whose large side Spark may split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm._runtime import small_side, text_of, written

WHITE = r"[\x20\x09-\x0D]+"
#: Digests in a bucket, on average; a bucket's filter and its digests are held by one task.
BUCKET_KEYS = 4_000


# ---------------------------------------------------------------- the filter


def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> np.ndarray:
    """Three slots for each key, in three segments that follow each other."""
    x = keys ^ np.uint64(seed)
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    x ^= x >> np.uint64(33)
    start = ((x >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = start.astype(np.int64) * segment
    low = segment - 1
    parts = [(x & np.uint64(low)), ((x >> np.uint64(11)) & np.uint64(low)), ((x >> np.uint64(21)) & np.uint64(low))]
    return np.stack([base + i * segment + p.astype(np.int64) for i, p in enumerate(parts)], axis=1)


def _prints(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


class FuseFilter:
    """A static set of 64-bit keys with 8-bit fingerprints: no false negative, about 1/256 false positives."""

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray) -> None:
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel the keys: those alone in a slot go first, a whole round at a time; fill in reverse.

        Within a round no key touches the slot of another, so a round is one array operation.
        A seed under which some keys can't be peeled is given up for the next.
        """
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 200):
            slots = _slots(keys, seed * 0x9E3779B97F4A7C1 % (1 << 64), segment, segments)
            size = (segments + 2) * segment
            degree = np.bincount(slots.ravel(), minlength=size)
            owner = np.zeros(size, np.int64)  # the exclusive or of the keys' numbers in a slot
            for j in range(3):
                np.bitwise_xor.at(owner, slots[:, j], np.arange(n))
            rounds, left, alone = [], n, np.flatnonzero(degree == 1)
            while len(alone):
                key, at = np.unique(owner[alone], return_index=True)
                rounds.append((key, alone[at]))
                left -= len(key)
                touched = slots[key].ravel()
                np.subtract.at(degree, touched, 1)
                np.bitwise_xor.at(owner, touched, np.repeat(key, 3))
                alone = np.unique(touched)
                alone = alone[degree[alone] == 1]
            if not left:
                break
            if seed % 20 == 0:
                segments += 1 + segments // 10
        else:
            raise RuntimeError("no seed peels these keys")
        table, prints = np.zeros(size, np.uint8), _prints(keys)
        for key, slot in reversed(rounds):
            three = slots[key]
            table[slot] = prints[key] ^ table[three[:, 0]] ^ table[three[:, 1]] ^ table[three[:, 2]]
        return cls(seed * 0x9E3779B97F4A7C1 % (1 << 64), segment, segments, table)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slots = _slots(keys, self.seed, self.segment, self.segments)
        return _prints(keys) == self.table[slots[:, 0]] ^ self.table[slots[:, 1]] ^ self.table[slots[:, 2]]


# ------------------------------------------------------------- the operator


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id, digest (SHA-256 of the normalised text, hex), bytes (its length), raw (a hash of the text): one row a document."""
    text = _normal(text_col)
    return docs.select(F.col(id_col).alias("row_id"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"), F.xxhash64(text_of(F.col(text_col))).alias("raw"))


def _groups(keyed: DataFrame) -> DataFrame:
    """One row for each distinct digest; Spark sums on the map side, so copies never meet in one task."""
    return keyed.groupBy("digest", "bytes").agg(F.min("row_id").alias("keep_id"), F.min("raw").alias("raw"), F.count(F.lit(1)).alias("n"))


def _bucket(digest: str, buckets: int):
    return F.expr(f"pmod(cast(conv(substr({digest}, 1, 12), 16, 10) as bigint), {buckets})").cast("int")


def _key64(digests_: np.ndarray) -> np.ndarray:
    """Hex digits 13 to 28 of each digest: bits that the bucket does not use."""
    return np.array([int(d[12:28], 16) for d in digests_], np.uint64)


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """bucket, seed, segment, segments, table: a binary-fuse filter for each bucket of a snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(_key64(pdf["digest"].to_numpy()))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [str(made.seed)], "segment": [made.segment], "segments": [made.segments], "table": [made.table.tobytes()]})

    keyed = snapshot.select(_bucket("digest", buckets).alias("bucket"), "digest")
    return keyed.groupBy("bucket").applyInPandas(build, "bucket int, seed string, segment long, segments long, table binary")


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """digest: those of the incoming groups that the filter of their bucket may hold. Only digests go through Python."""

    def probe(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        if not len(old) or not len(new):
            return new[["digest"]].iloc[:0]
        row = old.iloc[0]
        made = FuseFilter(int(row["seed"]), int(row["segment"]), int(row["segments"]), np.frombuffer(row["table"], np.uint8))
        return new.loc[made.holds(_key64(new["digest"].to_numpy())), ["digest"]]

    keyed = incoming.select("digest", _bucket("digest", buckets).alias("bucket"))
    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest string")


def _normal(text_col: str) -> Column:
    return F.regexp_replace(text_of(F.col(text_col)), WHITE, " ")


def _same_bytes(pairs: DataFrame, old: DataFrame, new: DataFrame, text_col: str) -> DataFrame:
    """digest: those of the pairs (digest, old_raw, new_raw) whose normalised texts are equal byte by byte.

    Only texts with the hashes of pairs are normalised again and shuffled, one for each digest and task.
    """

    def side(docs: DataFrame, name: str) -> DataFrame:
        wanted = small_side(pairs.select(F.col(f"{name}_raw").alias("raw"), F.col("digest").alias("_digest")))
        found = docs.select(F.xxhash64(text_of(F.col(text_col))).alias("raw"), F.col(text_col).alias("text")).join(wanted, "raw")
        found = found.select("_digest", _normal("text").alias(f"{name}_text")).where(F.sha2(f"{name}_text", 256) == F.col("_digest"))
        return found.groupBy(F.col("_digest").alias("digest")).agg(F.first(F.col(f"{name}_text")).alias(f"{name}_text"))

    return side(old, "old").join(side(new, "new"), "digest").where(F.col("old_text") == F.col("new_text")).select("digest")


def exact_dedup(snapshot: DataFrame, incoming: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row for each document of both: row_id, keep_id, group_size, kept, text_sha256, is_new.

    Texts are equal when they are identical after each run of white space has
    become one space; a null text counts as empty. The document of the smallest
    id among equal ones stays. Rows that repeat an id are copies like others and
    carry the same answer; a null id is larger than any other and stays only if
    all ids of its group are null. Ids may be of any type Spark can order, and go through
    Spark alone. Either table may be empty; other columns are ignored.
    """
    columns = (id_col, text_col)
    old_keyed, new_keyed = (written(digests(x.select(*columns), id_col, text_col)) for x in (snapshot, incoming))
    old, new = written(_groups(old_keyed)), written(_groups(new_keyed))
    # a bucket's incoming digests are in one task too, however few the snapshot has
    buckets = max(1, -(-max(old.count(), new.count()) // bucket_keys))
    screened = written(screen(new, written(build_filters(old, buckets)), buckets))
    stored = old.select("digest", F.col("keep_id").alias("old_id"), F.col("raw").alias("old_raw"), F.col("n").alias("old_n"))
    arrived = new.join(screened, "digest").select("digest", F.col("keep_id").alias("new_id"), F.col("raw").alias("new_raw"), F.col("n").alias("new_n"))
    positive = written(arrived.join(stored, "digest"))
    both = positive.join(_same_bytes(positive, snapshot, incoming, text_col), "digest", "left_semi")
    both = both.select("digest", F.least("old_id", "new_id").alias("keep_id"), (F.col("old_n") + F.col("new_n")).alias("n"))
    one_side = old.select("digest", "bytes", "keep_id", "n").unionByName(new.select("digest", "bytes", "keep_id", "n"))
    copies = one_side.where("n > 1").join(both, "digest", "left_anti").select("digest", "keep_id", "n").union(both)
    copies = written(copies)  # texts with one document need no row here
    rows = old_keyed.withColumn("is_new", F.lit(False)).union(new_keyed.withColumn("is_new", F.lit(True)))
    joined = rows.join(copies, "digest", "left")
    return joined.select(
        "row_id",
        F.when(F.col("n").isNull(), F.col("row_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.when(F.col("n").isNull(), F.col("row_id")).otherwise(F.col("keep_id")).eqNullSafe(F.col("row_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "is_new",
    )
