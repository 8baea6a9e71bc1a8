"""Near-duplicate documents: MinHash bands for candidates, sequential Bayesian pruning, exact checks.

A document is the set of its distinct word shingles. Documents with equal sets
are one node, named by a digest of the set, so copies cost nothing further.
Each node has bands of minimum hashes; nodes that share a band's key are
candidates. At first they are not paired with each other but, in a few rounds,
with one centre each; that connects most groups. Only groups that are then
still in several components are compared further, and only across components:
small ones by a join, large ones block by block. A pair's signatures are compared in batches; after each batch the pair
is dropped if, by the posterior of its similarity, the chance that it reaches
the threshold is below the miss probability. Survivors are decided on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm._components import connected_components
from strandlake.llm._runtime import few_tasks, small_batches, small_side, text_of, written
from strandlake.llm._text import LOWER, U64, blocks, column_bytes, mix, shingles, word_hashes

#: 28 bands of 6 rows: a pair of similarity 0.8 shares none with probability 2e-4, one of 0.9 with 5e-10.
BANDS, ROWS = 28, 6
#: Hashes compared between two looks at the posterior.
BATCH = 24
#: Chance that the posterior leaves a dropped pair to reach the threshold.
MISS = 1e-4
#: Rounds in which each node of an unconnected group meets one centre.
STAR_ROUNDS = 3
#: Members up to which an unconnected group is paired by a join; larger ones are compared in blocks of BLOCK_NODES.
JOINED_GROUP = 48
#: Rows up to which a table of keys or nodes is broadcast here: some megabytes.
FEW = 20_000
#: Rows of bands with candidates up to which the tables made from them are written by few tasks.
FEW_BANDED = 300_000
#: Bitmaps of 64 hashes each that keep texts without candidates from being moved.
WORDS = 200_000
BLOCK_NODES = 256

_seeds = np.random.default_rng(77).integers(1, 1 << 63, (2, 1024), dtype=U64)


def _signatures(values: np.ndarray, owner: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """size minimum hashes (32 bits) for each document; a document without shingles has the largest."""
    out = np.full((n_docs, size), 0xFFFFFFFF, np.uint32)
    docs, first = np.unique(owner, return_index=True)
    if len(docs):
        for k in range(size):
            hashed = ((values * (_seeds[0, k] | U64(1)) + _seeds[1, k]) >> U64(32)).astype(np.uint32)
            out[docs, k] = np.minimum.reduceat(hashed, first)
    return out


def _block_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, doc = word_hashes(LOWER[data], offsets)
    return shingles(hashes, doc, len(offsets) - 1, words)


def _nodes(value: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """The digest of each document's set, null without shingles; value holds the sets end to end."""
    return [hashlib.blake2b(value[e - s : e].tobytes(), digest_size=16).digest() if s else None for s, e in zip(sizes, np.cumsum(sizes))]


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """row_id, raw (a hash of the text), n_shingles, node (16 bytes, null without shingles), keys (a 64-bit key a band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for first, last in blocks(offsets):
                local = offsets[first : last + 1] - offsets[first]
                value, owner = _block_shingles(data[offsets[first] : offsets[last]], local, words)
                n = last - first
                sizes = np.bincount(owner, minlength=n)
                nodes = _nodes(value, sizes)
                signature = _signatures(value, owner, n, bands * rows)
                keys = np.zeros((n, bands), U64)
                for b in range(bands):
                    key = np.full(n, b + 1, U64)
                    for r in range(rows):
                        key = mix(key * U64(0x9E3779B97F4A7C15) + signature[:, b * rows + r].astype(U64))
                    keys[:, b] = key
                keys_list = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), keys_list], ["row_id", "raw", "n_shingles", "node", "keys"])

    return _texts(docs, id_col, text_col).mapInArrow(run, f"row_id {dict(docs.dtypes)[id_col]}, raw long, n_shingles long, node binary, keys array<long>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text_of(F.col(text_col))).alias("raw"), F.col(text_col).alias("text"))


def _full_sets(texts: DataFrame, words: int, size: int) -> DataFrame:
    """node, signature (size minimum hashes), members (the sorted shingles as bytes) of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for first, last in blocks(offsets):
                local = offsets[first : last + 1] - offsets[first]
                value, owner = _block_shingles(data[offsets[first] : offsets[last]], local, words)
                sizes = np.bincount(owner, minlength=last - first)
                signature = _signatures(value, owner, last - first, size)
                ends = np.cumsum(sizes)
                sets = [value[s:e].tobytes() for s, e in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([pa.array(_nodes(value, sizes), pa.binary()), pa.array([x.tobytes() for x in signature], pa.binary()), pa.array(sets, pa.binary())], ["node", "signature", "members"])

    return texts.select("text").mapInArrow(run, "node binary, signature binary, members binary")


def _maybe_among(rows: DataFrame, held: DataFrame) -> DataFrame:
    """The rows whose (row_id, raw) are in held (held_id, held_raw), and a few others: WORDS bitmaps of 64 hashes are broadcast, so no text is moved."""
    place = lambda i, raw: F.pmod(F.xxhash64(i, raw), F.lit(WORDS * 64))
    bit = lambda at: F.expr(f"shiftleft(1L, cast(pmod({at}, 64) as int))")
    words = held.select(place("held_id", "held_raw").alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(bit("at")).alias("bits"))
    at = rows.withColumn("at", place("row_id", "raw")).withColumn("word", F.expr("at div 64"))
    return at.join(F.broadcast(written(words)), "word").where(F.col("bits").bitwiseAND(bit("at")) != 0).select(*rows.columns)


def least_matches(total: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes seen, fewest matches with which a pair goes on), after each batch.

    With m matches among n the similarity has the posterior Beta(m + 1, n - m + 1) under a
    uniform prior; a pair goes on while its mass at or over the threshold is at least miss.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in [*range(batch, total, batch), total]:
        m = np.arange(n + 1)[:, None]
        log = m * np.log(grid) + (n - m) * np.log1p(-grid)
        mass = np.exp(log - log.max(axis=1, keepdims=True))
        tail = mass[:, grid >= threshold].sum(axis=1) / mass.sum(axis=1)
        out.append((n, int(np.argmax(tail >= miss)) if (tail >= miss).any() else n + 1))
    return out


def _prune(pairs: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """The pairs (a, b) of (a, b, sig_a, sig_b) that no batch of signatures drops."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(len(batch), -1) for i in (2, 3))
            alive, matches, seen = np.arange(len(batch)), np.zeros(len(batch), np.int64), 0
            for n, least in steps:
                matches[alive] += (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1)
                alive, seen = alive[matches[alive] >= least], n
            yield batch.select([0, 1]).take(pa.array(alive))

    return pairs.mapInArrow(run, "a binary, b binary")


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union; sizes alone may rule it out."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _exact(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of (a, b, set_a, set_b) with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                if _linked(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), percent):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.mapInArrow(run, "a binary, b binary")


def _with_both(pairs: DataFrame, table: DataFrame, value: str, tasks: int | None = None) -> DataFrame:
    """pairs with the value of a and of b; either join may be split where one node has many pairs.

    pairs is read more than once. Where it names few nodes, only their values are shuffled.
    """
    names = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), tasks)
    if names.limit(FEW + 1).count() <= FEW:
        table = table.join(F.broadcast(names), "node", "left_semi")
    one = table.select(F.col("node").alias("a"), F.col(value).alias("left_value"))
    two = table.select(F.col("node").alias("b"), F.col(value).alias("right_value"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left_value", "right_value")


def _across_small(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components within each group; groups are small, so is the fan-out."""
    one = rows.select("key", F.col("node").alias("a"), F.col("component").alias("ca"))
    two = rows.select("key", F.col("node").alias("b"), F.col("component").alias("cb"))
    return one.join(two, "key").where("a < b and ca != cb").select("a", "b").distinct()


def _likely(signature: np.ndarray, number: np.ndarray, i: int, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The later rows of other components that no batch of signatures drops for row i, and their matches."""
    alive, seen = np.flatnonzero(number[i + 1 :] != number[i]) + i + 1, 0
    matches = np.zeros(len(alive), np.int64)
    for n, least in steps:
        matches = matches + (signature[alive, seen:n] == signature[i, seen:n]).sum(axis=1)
        alive, matches, seen = alive[matches >= least], matches[matches >= least], n
    return alive, matches


def _across_large(rows: DataFrame, sizes: DataFrame, signatures: DataFrame, sets: DataFrame, steps: list[tuple[int, int]], percent: int, tasks: int | None = None) -> DataFrame:
    """Links (a, b) that connect whatever different components of a large group have a link.

    The members of a group's largest component meet only the others, not each other. Both
    kinds are dealt into blocks, and each pair of blocks is one group of rows of bounded size.
    Signatures alone tell which members of a pair of blocks have a likely partner there; only
    for these the full sets are fetched. Likely pairs are then checked on full sets, the likeliest
    first, unless their components have been connected meanwhile: at most one link is given
    for each component, however many there are.
    """
    count = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    major = count.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.max("n").alias("n_major"))
    shape = written(sizes.join(major, "key"), tasks)
    blocks_of = lambda n: F.greatest(F.ceil(n / BLOCK_NODES), F.lit(1)).cast("int")
    dealt = rows.join(shape, "key").withColumns({"minors": blocks_of(F.col("n") - F.col("n_major")), "majors": blocks_of(F.col("n_major")), "is_major": F.col("component") == F.col("major")})
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors"))).cast("int"))
    count_to = lambda n: F.sequence(F.lit(0), n - 1)
    task = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("own")
    of_major = F.transform(count_to(F.col("minors")), lambda i: task(1, i, own))
    of_minor = F.concat(F.transform(count_to(F.col("minors")), lambda j: task(0, F.least(j, own), F.greatest(j, own))), F.transform(count_to(F.col("majors")), lambda j: task(1, own, j)))
    # the block of signatures goes along: joined before the rows are copied to their blocks
    dealt = dealt.join(signatures, "node").select("key", "node", "component", "signature", F.explode(F.when(F.col("is_major"), of_major).otherwise(of_minor)).alias("task"))
    key = ["key", "kind", "i", "j"]
    dealt = dealt.select("key", "task.*", "node", "component", "signature")

    def partners(pdf: pd.DataFrame) -> pd.DataFrame:
        signature = np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(len(pdf), -1)
        number, hit = np.unique(pdf["component"].to_numpy(), return_inverse=True)[1], np.zeros(len(pdf), bool)
        for i in range(len(pdf) - 1):
            alive, _ = _likely(signature, number, i, steps)
            hit[alive] = True
            hit[i] |= len(alive) > 0
        return pdf[hit]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        signature = np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(len(pdf), -1)
        node, sets = pdf["node"].to_numpy(), [np.frombuffer(x, U64) for x in pdf["members"]]
        number = np.unique(pdf["component"].to_numpy(), return_inverse=True)[1]
        out = []
        for i in range(len(pdf) - 1):
            alive, matches = _likely(signature, number, i, steps)
            for j in alive[np.argsort(-matches, kind="stable")]:
                if number[i] != number[j] and _linked(sets[i], sets[j], percent):
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
                    number[number == number[j]] = number[i]
        return pd.DataFrame(out, columns=["a", "b"])

    likely = written(dealt.groupBy(*key).applyInPandas(partners, dealt.schema))
    return likely.join(sets, "node").groupBy(*key).applyInPandas(compare, "a binary, b binary")


def _stars(components: DataFrame) -> DataFrame:
    """Links (a, b) of each node with the one that names its component."""
    return components.select(F.col("component").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """row_id, n_shingles, component_id, kept: one row for each document.

    Words are runs of characters other than space and 0x09-0x0D, with A-Z in lower case; a
    document of fewer than shingle_words words has its whole sequence as one shingle, and one
    without words (or with a null text) has none and is linked with nothing. Documents are
    linked if 100 * |intersection| >= percent * |union|; a component is what links connect,
    named by its smallest id. Rows that repeat an id are copies and get equal answers. A row
    with a null id is linked like others but never names a component unless all its ids are
    null. An id may stand for several texts; each is judged by its own set. Shingles are compared as 64-bit hashes. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    all_rows = written(sketch(docs, id_col, text_col, shingle_words, bands, rows))
    banded = all_rows.where("node is not null").select("node", F.explode("keys").alias("key"))
    # hashes of nodes tell whether a key has several, and are summed without a sort
    ends = banded.select("key", F.xxhash64("node").alias("h")).groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo != hi")
    shared = small_side(ends.select("key"), FEW)
    active = written(banded.join(shared, "key").select("key", "node").distinct())
    tasks = few_tasks(active, FEW_BANDED)

    # what is compared later: signatures and sets of the nodes that have candidates, from one document each
    involved = small_side(active.select("node").distinct(), FEW, tasks)
    first = F.min(F.struct(F.col("row_id").isNull().alias("no_id"), "row_id", "raw"))
    held = all_rows.select("node", "row_id", "raw").join(involved, "node").groupBy("node").agg(first.alias("first"))
    held = small_side(held.select(F.col("first.row_id").alias("held_id"), F.col("first.raw").alias("held_raw")), FEW, tasks)
    # the few other texts that pass do no harm; an exact join here would be planned first and move all texts
    sets = written(_full_sets(_maybe_among(_texts(docs, id_col, text_col), held), shingle_words, bands * rows), tasks)
    if sets.count() > sets.select("node").distinct().count():  # rows that repeat id and text
        sets = written(sets.dropDuplicates(["node"]), tasks)
    signatures, sets = sets.select("node", "signature"), sets.select("node", "members")

    steps = least_matches(bands * rows, BATCH, percent / 100, miss)

    def judged(pairs: DataFrame) -> DataFrame:
        likely = written(_prune(_with_both(written(pairs, tasks), signatures, "signature", tasks), steps), tasks)
        return _exact(_with_both(likely, sets, "members", tasks), percent)

    components = None
    current = active.withColumn("component", F.col("node"))
    for round_ in range(STAR_ROUNDS):
        # each node with the first, in this round's order, of the centres of its groups
        rank = F.xxhash64("node", F.lit(round_)) if round_ else F.lit(0)
        centres = written(current.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), F.col("node").alias("centre"), F.col("component").alias("other"))).alias("c")).select("key", "c.*"), tasks)
        met = current.join(centres, "key").where("component != other")
        nearest = met.groupBy("node").agg(F.min(F.struct("rank", "centre"))["centre"].alias("centre"))
        found = written(judged(nearest.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))), tasks)
        # what is connected already goes on as stars
        links = found if components is None else found.union(_stars(components))
        components = written(connected_components(links, tasks=tasks), tasks)
        # groups that are connected by now are done
        named = written(current.drop("component").join(components, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), tasks)
        open_ = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo != hi").select("key", "n")
        open_ = written(open_, tasks)
        current = written(named.join(small_side(open_.select("key"), FEW, tasks), "key"), tasks)
        if not open_.take(1):
            break
    # then, in groups that are still in several components, everything across them
    small, large = (written(current.join(small_side(open_.where(x).select("key"), FEW, tasks), "key"), tasks) for x in (f"n <= {JOINED_GROUP}", f"n > {JOINED_GROUP}"))
    more = written(judged(_across_small(small)), tasks)
    if large.take(1):
        more = more.union(written(_across_large(large, open_, signatures, sets, steps, percent, tasks)))
    if more.take(1):
        components = written(connected_components(more.union(_stars(components)), tasks=tasks), tasks)

    rows_out = all_rows.select("row_id", "n_shingles", "node")
    rows_out = written(rows_out.join(components, "node", "left").withColumn("node", F.coalesce("component", "node")).drop("component"))
    names = rows_out.where("node is not null").groupBy("node").agg(F.min("row_id").alias("name"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows_out = rows_out.join(written(names.select("node", "name")), "node", "left")
    name = F.coalesce("name", "row_id").cast(kind)
    return rows_out.select("row_id", "n_shingles", name.alias("component_id"), name.eqNullSafe(F.col("row_id")).alias("kept"))
