"""Sharding by sampled splitters.

The key of a document is (hash of its text, hash of its id): equal texts lie
next to each other in key order. A sample of keys, each drawn with a chance in
proportion to its size, gives splitters that cut the keys into many fine
ranges of about equal bytes. The ranges are then measured exactly; one that
holds more than its share (a text with very many copies, say) gets splitters of
its own from a sample of its keys, until none is overfull. Shards are runs of
ranges, cut where the bytes reach the next multiple of the shard's share.
"""

from __future__ import annotations

import json
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm._runtime import BROADCAST_ROWS, text_of, written

#: Fine ranges at first; also bounds what the driver and every task hold of them.
RANGES = 1024
#: Samples drawn for a range.
OVERSAMPLE = 12
#: A range with more than this many shares is subdivided.
OVERFULL = 2.0


def _splitters(sample: DataFrame, pieces: Column) -> DataFrame:
    """For each range of the sample (range, k1, k2, mass), its (pieces - 1) quantile keys."""
    order = Window.partitionBy("range").orderBy("k1", "k2")
    run = sample.withColumn("upto", F.sum("mass").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("all", F.sum("mass").over(Window.partitionBy("range")))
    step = lambda upto: F.floor(upto * pieces / F.col("all"))
    # a key ends a piece where the running mass passes a multiple of a piece's mass
    return run.where((step(F.col("upto")) > step(F.col("upto") - F.col("mass"))) & (F.col("upto") < F.col("all"))).select("k1", "k2")


def _range_of(keys: list[tuple[int, int]]) -> Column:
    """The number of splitters that lie below (k1, k2), by binary search in a literal array."""
    if not keys:
        return F.lit(0)
    # one literal, folded once: a call for each of a thousand keys would cost seconds
    bounds = F.from_json(F.lit(json.dumps([{"k1": a, "k2": b} for a, b in keys])), "array<struct<k1:bigint,k2:bigint>>")
    key = F.struct(F.col("k1"), F.col("k2"))
    span = 1 << (len(keys)).bit_length()

    def halve(low: Column, width: Column) -> Column:
        at = low + width
        return F.when((at <= len(keys)) & (F.try_element_at(bounds, at) < key), at).otherwise(low)

    widths = F.array(*[F.lit(span >> i) for i in range(span.bit_length())])
    return F.aggregate(widths, F.lit(0), halve)


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES) -> DataFrame:
    """row_id, size, text_crc32, law, shard, slot, grown_shard: one row for each document.

    The law is `bytes`: shards 0 to shards - 1 hold nearly equal sizes, a size being the
    UTF-8 bytes of the text (none for null) plus 1. Each shard is a range of keys; a shard
    may differ from an equal share by what one range on either end holds: about
    1 / ranges of the whole, or one document where that is larger. `slot` numbers a
    shard's documents from 0 in key order. grown_shard is null under this law. Copies of a
    text lie in one shard or in neighbouring ones, at any number of copies. Ties: rows that repeat
    an id and text have equal keys and lie in one range, which nothing can part; their slots differ.
    Other columns are ignored. An empty table
    gives an empty result.
    """
    text = text_of(F.col(text_col))
    bytes_of = F.encode(text, "utf-8")
    keyed = written(
        docs.select(
            F.col(id_col).alias("row_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(bytes_of).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit("id"), F.col(id_col)).alias("k2"),
        )
    )
    spark = docs.sparkSession
    total = keyed.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / ranges)
    draw = (F.pmod(F.xxhash64(F.lit("draw"), F.col("k2"), F.col("k1")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    mass_of = lambda rate: F.greatest(F.lit(1.0), F.col("size") * rate)
    sample = keyed.where(draw < F.col("size") * (OVERSAMPLE / share)).select(F.lit(0).alias("range"), "k1", "k2", mass_of(OVERSAMPLE / share).alias("mass"))
    keys = sorted({(r.k1, r.k2) for r in _splitters(sample, F.lit(float(ranges))).collect()})
    for round_ in count():
        ranged = keyed.withColumn("range", _range_of(keys))
        measured = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2")).alias("least"), F.max(F.struct("k1", "k2")).alias("most"))
        measured = measured.collect()  # one row a range: at most a few times `ranges`
        overfull = {r["range"]: r.bytes for r in measured if r.bytes > OVERFULL * share and r.least != r.most}
        if not overfull:
            break
        pieces = F.create_map(*[x for k, b in overfull.items() for x in (F.lit(k), F.lit(float(-(-b // share) + 1)))])
        rate = OVERSAMPLE / share * 2.0 ** min(round_, 60)
        inside = ranged.where(F.col("range").isin(list(overfull)))
        drawn = inside.where(draw < F.col("size") * rate).select("range", "k1", "k2", mass_of(rate).alias("mass"))
        more = {(r.k1, r.k2) for r in _splitters(drawn.withColumn("pieces", pieces[F.col("range")]), F.col("pieces")).collect()}
        # the least key of a full range parts it from the rest, should the sample hold none: each round gets on
        more |= {(r.least.k1, r.least.k2) for r in measured if r["range"] in overfull}
        if more <= set(keys):
            break
        keys = sorted(set(keys) | more)
    rows, before, counts = [], 0, {}
    for r in sorted(measured, key=lambda r: r["range"]):
        shard = min(shards - 1, int((before + r.bytes / 2) * shards / total))
        rows.append((r["range"], shard, counts.get(shard, 0)))
        counts[shard] = counts.get(shard, 0) + r.n
        before += r.bytes
    places = spark.createDataFrame(rows, "range int, shard int, slot_from long")
    places = F.broadcast(places) if len(rows) <= BROADCAST_ROWS else places
    in_range = Window.partitionBy("range").orderBy("k1", "k2", "row_id")
    numbered = ranged.withColumn("at", F.row_number().over(in_range) - 1)
    placed = numbered.join(places, "range")
    return placed.select("row_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot_from") + F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
