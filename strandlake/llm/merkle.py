"""A Merkle manifest of a dataset, reduced superblock by superblock.

Every row is a leaf; the leaves of a source, in the order of their ids, are numbered from 0, and
every FANOUT consecutive nodes become one, level by level, until one remains: the
source's subroot. The subroots, in the order of their sources, are reduced likewise to the root.

Nodes are bucketed by their number over FANOUT**LEVELS. One applyInPandas call collapses LEVELS
levels of one bucket, and the bucket roots, far fewer, go round again, so no task holds
more than FANOUT**LEVELS nodes whatever the size of a source. On the way back each bucket
is collapsed once more, beside the proof of its own root, and hands every node its own proof: the
lower levels' siblings and then the upper ones'. So nothing but digests and one upper proof a
bucket is shuffled.

A proof is two arrays with an entry a level, from the leaf up: the digests before and after the
node in its run, each joined to one string.

Numbers come from a range partitioning by (source, id, leaf): rows are counted by partition and
source, and those counts, summed over the partitions before, are added to the number within the partition.
"""

from __future__ import annotations

import hashlib
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm._runtime import small_side, written

#: Nodes of a run, and levels that one call collapses: buckets of 4096 nodes.
FANOUT, LEVELS = 16, 3



def field(value: Column) -> Column:
    """A value as it enters a leaf: `-` for null, else its number of UTF-8 bytes, a colon, and itself."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """The leaf of a row with these values, as lowercase hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def levels_of(nodes: int) -> int:
    """How many levels reduce so many nodes to one; a lone node stays as it is."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def collapse(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and what they become, level by level."""
    tree = [nodes]
    for _ in range(levels):
        below = tree[-1]
        tree.append([hashlib.sha256("".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return tree


def siblings(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """For each level of the tree below its top, what stands before and after node i's ancestor in its run."""
    out = []
    for nodes in tree[:-1]:
        first = i - i % FANOUT
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + FANOUT])))
        i //= FANOUT
    return out


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with i, their number within the group from 0 on, in the order given; nulls come first, and rows equal in it are numbered either way."""
    ordered = [F.col(c).asc_nulls_first() for c in order]
    placed = written(rows.repartitionByRange(F.col(group).asc_nulls_first(), *ordered).withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = placed.groupBy(group, "part").agg(F.count("*").alias("n"))
    offsets = small_side(counts.select(F.col(group).alias("_group"), F.col("part").alias("_part"), before.alias("before")))
    within = F.row_number().over(Window.partitionBy("part", group).orderBy(*ordered)) - 1
    found = placed.withColumn("within", within).join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
    return found.withColumn("i", (F.col("within") + F.col("before")).cast("long")).drop("_group", "_part", "before", "within", "part")


def _levels(n: str) -> Column:
    """levels_of a column, for counts up to FANOUT**15."""
    return sum((F.when(F.col(n) > FANOUT**k, 1).otherwise(0) for k in range(1, 15)), F.when(F.col(n) > 1, 1).otherwise(0)).cast("long")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The rounds of a reduction: nodes (grp, i, n, node), then bucket roots (grp, i, node, left), then theirs, down to one a group.

    i runs from 0 to n - 1 without gaps; n is the group's size. `left` is how many levels are still to do.
    """

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        left = int(rows["left"].iloc[0])
        top = collapse(list(rows["node"]), min(LEVELS, left))[-1][0]
        return pd.DataFrame({"grp": rows["grp"].iloc[:1], "i": rows["bucket"].iloc[:1], "node": [top], "left": [max(0, left - LEVELS)]})

    rounds = [nodes.withColumn("left", _levels("n"))]
    steps = -(-levels_of(nodes.agg(F.max("n")).first()[0] or 0) // LEVELS)
    for _ in range(steps):
        bucketed = rounds[-1].select("grp", "i", "node", "left", F.floor(F.col("i") / FANOUT**LEVELS).alias("bucket"))
        rounds.append(written(bucketed.groupBy("grp", "bucket").applyInPandas(reduce, "grp long, i long, node string, left long")))
    return rounds


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the first round, with their proofs, before and after, and the columns of tops.

    tops has a row for each group: grp, i (0), before and after, the proof of the group's
    last node, and whatever columns of strings each node of the group is to be given.
    """
    given = [c for c in tops.columns if c not in ("grp", "i", "before", "after")]
    proofs = tops
    for at in range(len(rounds) - 2, -1, -1):
        below = rounds[at] if at == 0 else rounds[at].select("grp", "i", "node", "left")
        dealt = below.withColumn("bucket", F.floor(F.col("i") / FANOUT**LEVELS)).groupBy("grp", "bucket")
        kept = [f for f in below.schema.fields if at == 0 or f.name in ("grp", "i")]
        upper = proofs.select("grp", F.col("i").alias("bucket"), "before", "after", *given).groupBy("grp", "bucket")
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} string" for c in given] + ["before array<string>", "after array<string>"]
        proofs = dealt.cogroup(upper).applyInArrow(_prover([f.name for f in kept], given), ", ".join(fields))
        proofs = proofs if at == 0 else written(proofs)
    return proofs if len(rounds) > 1 else rounds[0].join(tops.drop("i"), "grp")


def _prover(kept: list[str], given: list[str]):
    def prove(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("i")
        tree = collapse(rows["node"].to_pylist(), min(LEVELS, rows["left"][0].as_py()))
        higher = above.slice(0, 1).to_pylist()[0]
        proofs = [siblings(tree, i) for i in range(len(rows))]
        ways = [pa.array([[p[side] for p in proof] + higher[name] for proof in proofs], pa.list_(pa.string())) for side, name in enumerate(("before", "after"))]
        same = [pa.array([higher[c]] * len(rows), pa.string()) for c in given]
        return pa.Table.from_arrays([*[rows[c] for c in kept], *same, *ways], names=[*kept, *given, "before", "after"])

    return prove


def merkle_manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", others: dict[str, Column] | None = None) -> DataFrame:
    """row_id, grp_name, leaf, subroot, root, before, after and the others (expressions over docs) for every row of docs.

    A leaf is the digest of the columns, in their order. Leaves of a group go by id, null
    first; rows of one id by leaf, so repeated rows may change places and the manifest stays
    the same. A null group is a group and comes first; groups go by UTF-8 bytes. A null value has
    a field of its own, unlike an empty text. One lone leaf is its subroot, and one lone
    subroot the root, with an empty proof. An empty table has no rows. Only the named columns are read.
    """
    others = others or {}
    leaves = docs.select(
        F.col(id_col).alias("row_id"), F.col(group_col).alias("grp_name"), leaf_digest([F.col(c) for c in columns]).alias("node"), F.struct(*[e.alias(c) for c, e in others.items()], F.lit(0).alias("_")).alias("others")
    )
    leaves = written(leaves)
    groups = written(leaves.groupBy("grp_name").agg(F.count("*").alias("n")))
    named = small_side(numbered(groups.withColumn("all", F.lit(0)), "all", ["grp_name"]).select(F.col("grp_name").alias("_name"), F.col("i").alias("grp"), "n"))
    placed = leaves.join(named, F.col("grp_name").eqNullSafe(F.col("_name"))).drop("_name")
    rounds = climb(written(numbered(placed, "grp", ["row_id", "node"])))
    subroots = rounds[-1].select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("i"), F.lit(groups.count()).cast("long").alias("n"), "node")
    above = climb(subroots)
    nothing = F.array().cast("array<string>")
    top = above[-1].select("grp", "i", nothing.alias("before"), nothing.alias("after"), F.col("node").alias("root"))
    tops = descend(above, top).select(F.col("i").alias("grp"), F.lit(0).cast("long").alias("i"), F.col("node").alias("subroot"), "root", "before", "after")
    told = descend(rounds, written(tops))
    return told.select("row_id", "grp_name", F.col("node").alias("leaf"), "subroot", "root", "before", "after", *[F.col("others")[c].alias(c) for c in others])


def folded(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and a proof give; null for a null leaf or proof. A manifest is verified where it equals the root."""
    return F.aggregate(F.arrays_zip(before.alias("before"), after.alias("after")), leaf, lambda a, p: F.sha2(F.concat(p["before"], a, p["after"]), 256))


def proof_digest(before: Column, after: Column) -> Column:
    """The digest of all siblings of a proof, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(F.arrays_zip(before.alias("before"), after.alias("after")), lambda p: F.concat(p["before"], p["after"])), ""), 256)


def verify_rows(docs: DataFrame, manifest: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """manifest's rows with verified: whether the row of that id in docs, as it is now, folds to the root.

    Rows that docs no longer has, and ids that are null, aren't verified; where an id has several rows in
    docs, any of them may match. Rows that only docs has are not looked at.
    """
    now = docs.select(F.col(id_col).alias("_id"), leaf_digest([F.col(c) for c in columns]).alias("_leaf")).groupBy("_id").agg(F.collect_set("_leaf").alias("_leaves"))
    held = manifest.join(now, manifest["row_id"] == F.col("_id"), "left")
    matches = F.exists("_leaves", lambda x: folded(x, F.col("before"), F.col("after")) == F.col("root"))
    return held.withColumn("verified", F.coalesce(matches, F.lit(False))).drop("_id", "_leaves")
