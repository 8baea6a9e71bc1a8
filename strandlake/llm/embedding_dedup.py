"""Embedding near-duplicates by a pivot-permutation index.

The mean of a sample is taken off first, for vectors that all point much the same way
would find every pivot equally near. Reference points (pivots) are drawn from what
remains and thinned, so that a dense group doesn't hold many of them: among pivots that
lie about equally near, noise would choose which are named. How many pivots a vector names is
fitted on the sample: the fewest at which enough pairs made to lie just at the threshold
share two. If no number is enough, vectors of that length are compared all with all, in
blocks, which is exact. Each vector is described by its nearest pivots in
order; near vectors have nearly the same description. Inverted lists hold, for each
label and two pivots, the vectors that name both: who shares a list shares two pivots.
There are more pivots the more vectors there are, so a list stays short.

A list holds ids and sketches (the signs of fixed random projections), no vectors.
Pairs that meet in lists, share enough pivots and differ in few signs are verified:
their vectors are fetched and the cosine is computed in double precision. A list that
is long all the same, as of a dense group, is dealt into blocks instead, and pairs of
blocks with their vectors give sums for each vector, never a row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm._components import connected_components
from strandlake.llm._runtime import small_side, written

#: Pivots for each vector length: PIVOT_SHARE times the root of the number of vectors, within these bounds.
PIVOTS, PIVOT_SHARE = (256, 4096), 4.0
#: No two pivots are closer than the first of these cosines that leaves half of those wanted; so many vectors are drawn for each.
APART, DRAWN = (0.7, 0.8, 0.9), 16
#: Numbers that the drawn vectors of one length hold at most: the sample that the driver fits the index on.
SAMPLE_NUMBERS = 4_000_000
#: Vector lengths that get pivots, the commonest first; vectors of other lengths are all in one list, which is exact.
LENGTHS = 16
#: How many of its nearest pivots may describe a vector; a candidate pair shares two of them.
NAMED = (6, 8, 12, 16)
#: Share of the pairs at the threshold that must share two pivots, and how many pairs are made to measure it.
RECALL, TRIALS = 0.97, 2_000
#: Signs of a sketch, in two words. Signs differ with the chance angle / pi; a pair may differ in its mean and so many standard deviations more.
SIGNS, SLACK = 128, 5.0
#: Rows up to which a list is joined with itself; longer ones are dealt into blocks of about BLOCK_ROWS.
JOINED, BLOCK_ROWS = 128, 256


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """row_id, label, vector: rows that can be linked."""
    fit = F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    rows = vectors.where(fit).select(F.col(id_col).alias("row_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    odd = F.exists("vector", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    kind = dict(rows.dtypes)["vector"]
    # -0.0 and 0.0 are one number
    return rows.where(~odd & F.exists("vector", lambda x: x != 0)).withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, 0.0).otherwise(x)).cast(kind))


def _unit(vectors: list) -> np.ndarray:
    """The vectors, all of one length, scaled to length 1 in double precision."""
    v = np.array(vectors, float)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v**2).sum(axis=1, keepdims=True))


@dataclass
class Index:
    """What describes the vectors of one length: the mean taken off them, pivots of length 1, how many a vector names (0: none will do), measured recall."""

    mean: np.ndarray
    pivots: np.ndarray
    named: int
    recall: float

    def nearest(self, unit: np.ndarray, named: int) -> np.ndarray:
        return _nearest(_centred(unit, self.mean), self.pivots, named)


def _nearest(points: np.ndarray, pivots: np.ndarray, named: int) -> np.ndarray:
    return np.argsort(-(points @ pivots.T), axis=1, kind="stable")[:, :named]


def _centred(unit: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Vectors without the mean, scaled to length 1 again; what is nothing then stays so."""
    rest = (unit - mean).astype(np.float32)
    return rest / np.maximum(np.sqrt((rest**2).sum(axis=1, keepdims=True)), 1e-12)


def _at_threshold(unit: np.ndarray, mean: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """TRIALS pairs of centred vectors, as vectors with a cosine of `least` leave them.

    One is a sampled vector, the other that vector turned towards the difference of two
    others and as far from the mean as it was: by how much follows from the distance that the two have in any case.
    """
    draw = np.random.default_rng(len(unit))
    u, a, b = (draw.integers(0, len(unit), TRIALS) for _ in range(3))
    x, turn = _centred(unit[u], mean).astype(float), unit[a] - unit[b]
    turn = turn - np.einsum("ij,ij->i", turn, x)[:, None] * x
    size = np.sqrt((turn**2).sum(axis=1, keepdims=True))
    cosine = np.maximum(-1.0, 1 - (1 - least) / np.maximum(((unit[u] - mean) ** 2).sum(axis=1, keepdims=True), 1e-12))
    some = size[:, 0] > 1e-9
    return x[some].astype(np.float32), (cosine * x + np.sqrt(1 - cosine**2) * turn / np.maximum(size, 1e-12))[some].astype(np.float32)


def _fitted(unit: np.ndarray, wanted: int, least: float) -> Index:
    """The index of a sample of unit vectors."""
    mean = unit.mean(axis=0)
    points = _centred(unit, mean)
    for apart in APART:
        pivots = _thinned(points, wanted, apart)
        if 2 * len(pivots) >= wanted:
            break
    (one, two), recall = _at_threshold(unit, mean, least), 0.0
    for named in NAMED:
        if named >= len(pivots) or not len(one):
            break
        x, y = _nearest(one, pivots, named), _nearest(two, pivots, named)
        recall = float(((x[:, :, None] == y[:, None, :]).sum(axis=(1, 2)) >= 2).mean())
        if recall >= RECALL:
            return Index(mean, pivots, named, recall)
    return Index(mean, pivots, 0, recall)


def _thinned(points: np.ndarray, most: int, apart: float) -> np.ndarray:
    """The first `most` unit vectors, in order, of which no two are closer than a cosine of `apart`."""
    out, free = [], np.ones(len(points), bool)
    while free.any() and len(out) < most:
        at = int(np.argmax(free))
        out.append(at)
        free &= points @ points[at] <= apart
        free[at] = False
    return points[out]


def _draw_pivots(distinct: DataFrame, least: float) -> dict[int, Index]:
    """Indexes for the LENGTHS commonest vector lengths, from a bounded sample: the vectors with the least hashes."""
    points = {}
    for dim, n in distinct.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").limit(LENGTHS).collect():
        wanted = int(np.clip(PIVOT_SHARE * n**0.5, *PIVOTS))
        most = max(wanted, min(wanted * DRAWN, SAMPLE_NUMBERS // dim))
        drawn = distinct.where(F.size("vector") == dim).select("vector", F.xxhash64("same").alias("h")).orderBy("h", "node").limit(most).collect()
        points[dim] = _fitted(_unit([r.vector for r in drawn]), wanted, least)
    return points


def _sketches(unit: np.ndarray) -> np.ndarray:
    """SIGNS signs of each vector as two 64-bit words."""
    planes = np.random.default_rng(unit.shape[1]).normal(size=(unit.shape[1], SIGNS)).astype(np.float32)
    return np.packbits(unit.astype(np.float32) @ planes > 0, axis=1).view(np.int64)


def _described(distinct: DataFrame, points: dict[int, Index], columns: list[str]) -> DataFrame:
    """columns (vector last) with dim, pivots (the nearest, in order; none where all are compared with all) and the sketch's words."""
    sent = distinct.sparkSession.sparkContext.broadcast(points)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                rows = batch.column(batch.num_columns - 1).to_pylist()
                size = np.array([len(r) for r in rows], np.int32)
                near, words = [[]] * len(rows), np.zeros((len(rows), SIGNS // 64), np.int64)
                for dim in np.unique(size):
                    of = np.flatnonzero(size == dim)
                    unit = _unit([rows[i] for i in of])
                    words[of] = _sketches(unit)
                    if (index := sent.value.get(dim)) and index.named:
                        for i, row in zip(of, index.nearest(unit, index.named).tolist()):
                            near[i] = row
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size), pa.array(near, pa.list_(pa.int32())), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())], [*batch.schema.names, "dim", "pivots", "s1", "s2"])

    rows = distinct.select(*columns)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(describe, f"{kinds}, dim int, pivots array<int>, s1 long, s2 long")


def _lists() -> Column:
    """The lists of a vector: two named pivots each, the smaller first; one list for all vectors of a length without an index."""
    pair = lambda a, b: F.struct(F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))
    every = F.flatten(F.transform("pivots", lambda a, i: F.transform(F.slice("pivots", i + 2, F.size("pivots")), lambda b: pair(a, b))))
    one = F.array(F.struct(F.lit(-1).alias("p"), F.lit(-1).alias("q")))
    return F.when(F.size("pivots") == 0, one).otherwise(every)


def _verify(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b, na, nb) of (a, b, na, nb, va, vb) whose cosine is at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            one, two = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            size = np.array([len(v) for v in one], int)
            for dim in np.unique(size):
                of = np.flatnonzero(size == dim)
                keep[of] = np.einsum("ij,ij->i", _unit([one[i] for i in of]), _unit([two[i] for i in of])) >= least
            yield batch.select([0, 1, 2, 3]).take(pa.array(np.flatnonzero(keep)))

    return pairs.mapInArrow(run, "a long, b long, na long, nb long")


def _compare(pdf: pd.DataFrame, least: float) -> pd.DataFrame:
    """For the rows of two blocks of one list: node, links (rows of the other vectors linked), root (the least node linked within).

    A pair is judged in the list of the two smallest pivots it shares, and nowhere else.
    """
    ids, copies, unit = pdf["node"].to_numpy(), pdf["n"].to_numpy(), _unit(pdf["vector"].tolist())
    kind, i, j, q = pdf["block"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0], pdf["q"].iloc[0]
    one, two = np.flatnonzero(kind == i), np.flatnonzero(kind == j)
    if q >= 0:  # of the pivots below q both name p alone
        near = np.array(pdf["pivots"].tolist())
        known = np.unique(near[near < q])
        named = (near[:, :, None] == known).any(axis=1).astype(np.float32)
        ok = named[one] @ named[two].T == 1
    else:
        ok = np.ones((len(one), len(two)), bool)
    if i == j:
        ok &= one[:, None] < two
    if ok.mean() > 0.2:
        ok &= unit[one] @ unit[two].T >= least - 1e-9
    a, b = np.nonzero(ok)
    a, b = one[a], two[b]
    exact = np.concatenate([np.einsum("ij,ij->i", unit[a[s : s + 8192]], unit[b[s : s + 8192]]) >= least for s in range(0, len(a), 8192)] or [np.zeros(0, bool)])
    a, b = a[exact], b[exact]
    links = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
    root = ids.copy()
    while True:
        was = root.copy()
        np.minimum.at(root, a, was[b])
        np.minimum.at(root, b, was[a])
        if (root == was).all():
            break
    hit = links > 0
    return pd.DataFrame({"node": ids[hit], "links": links[hit].astype(np.int64), "root": root[hit]})


def link_embeddings(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """row_id, n_links, component_id, kept: one row for each vector.

    Vectors are linked if their labels are equal and not null, they have the same length and
    their cosine is at least `least`. Vectors that are null, zero, or hold a null or non-finite
    component link with nothing, nor do rows with a null id. n_links counts the other rows linked
    directly, exact copies among them; component_id is the least id reachable. Rows that repeat an
    id are vectors of their own. Links found are exact; the index misses a pair only if its vectors
    share fewer than two of the nearest pivots that they name (at most a share of 1 - RECALL of the
    pairs at the threshold, as measured on the sample, fewer above it; or, with a chance of some 1e-6,
    differ in too many signs). Where no number of pivots is enough for that, as where most vectors are
    nearly at the threshold with one another, all vectors of a label and length are compared, which is
    quadratic in their number. Columns beside the three named are ignored, whatever their names. An empty
    table gives an empty result.
    """
    kind = dict(vectors.dtypes)[id_col]
    rows = _usable(vectors, id_col, vector_col, label_col)
    keyed = written(rows.withColumn("same", F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)))
    grouped = keyed.groupBy("label", "same").agg(F.min("row_id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    distinct = written(grouped.withColumn("node", F.monotonically_increasing_id()))
    points = _draw_pivots(distinct, least)
    described = written(_described(distinct, points, ["node", "label", "n", "vector"]).withColumn("lists", _lists()))
    held = described.select("node", "n", "vector", "pivots", "label", "dim")
    posted = described.select("node", "label", "dim", "s1", "s2", F.explode("lists").alias("l")).select("node", "label", "dim", "l.p", "l.q", "s1", "s2")
    key = ["label", "dim", "p", "q"]
    sizes = posted.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    long = small_side(sizes.where(F.col("size") > JOINED))

    # short lists: pairs that share a list and nearly all signs, then their vectors
    short = posted.join(long, key, "left_anti")
    angle = np.arccos(least) / np.pi
    most = int(SIGNS * angle + SLACK * (SIGNS * angle * (1 - angle)) ** 0.5) + 1
    one = short.select(*key, F.col("node").alias("a"), F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    two = short.select(*key, F.col("node").alias("b"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    differ = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    likely = written(one.join(two, key).where((F.col("a") < F.col("b")) & (differ <= most)).select("a", "b").distinct())
    left = held.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("vector").alias("va"), F.col("pivots").alias("pa"), "label", "dim")
    right = held.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("vector").alias("vb"), F.col("pivots").alias("pb"))
    shared = F.array_sort(F.array_intersect("pa", "pb"))
    of = {c: F.when(F.size("pa") == 0, F.lit(-1)).otherwise(F.get(shared, F.lit(i))) for i, c in enumerate(("p", "q"))}
    # a pair belongs to the list of the two smallest pivots it shares, which may be a long one
    met = likely.join(left, "a").join(right, "b").withColumns(of).join(long, key, "left_anti")
    linked = written(_verify(met.select("a", "b", "na", "nb", "va", "vb"), least))
    judged = linked.select(F.col("a").alias("node"), F.col("nb").alias("links"), F.col("a").alias("root"))
    judged = judged.union(linked.select(F.col("b").alias("node"), F.col("na").alias("links"), F.col("a").alias("root")))

    # long lists: pairs of blocks, with their vectors
    if long.take(1):
        dealt = described.select("node", "n", "label", "dim", "pivots", "vector", F.explode("lists").alias("l")).select("node", "n", "label", "dim", "pivots", "vector", "l.p", "l.q")
        dealt = dealt.join(long.withColumn("parts", F.ceil(F.col("size") / BLOCK_ROWS).cast("int")), key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        compared = dealt.groupBy(*key, "i", "j").applyInPandas(lambda pdf: _compare(pdf, least), "node long, links long, root long")
        judged = judged.union(written(compared))

    links = written(judged.groupBy("node").agg(F.sum("links").alias("links")))
    components = written(connected_components(judged.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))))
    classes = distinct.select("node", "label", "same", "least_id", "n").join(links, "node", "left").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = written(classes.select("label", "same", "component", "least_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    names = written(classes.groupBy("component").agg(F.min("least_id").alias("component_id")))
    classes = written(classes.join(names, "component").select("label", "same", "n_links", "component_id"))
    # the rows of a very common vector meet its one class row; the join may be split
    fit = written(keyed.select("row_id", "label", "same").join(classes, ["label", "same"]).select("row_id", "n_links", "component_id"))
    unfit = vectors.select(F.col(id_col).alias("row_id")).exceptAll(fit.select("row_id"))
    every = fit.unionByName(unfit.select("row_id", F.lit(0).cast("long").alias("n_links"), F.col("row_id").alias("component_id")))
    return every.select("row_id", F.col("n_links").cast("long"), F.col("component_id").cast(kind), F.col("component_id").eqNullSafe(F.col("row_id")).alias("kept"))
