"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm._runtime import written

MAX_STEPS = 60


def _least(edges: DataFrame) -> DataFrame:
    """For every u its smallest neighbour or itself; summed on the map side."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _star(edges: DataFrame, tasks: int | None) -> DataFrame:
    """(v, m) for every edge (u, v), m being the least of u and its neighbours.

    The least neighbours are written before the join, so the edges of a node with
    very many of them can be split over several tasks.
    """
    return edges.join(written(_least(edges), tasks), "u")


def connected_components(links: DataFrame, a: str = "a", b: str = "b", tasks: int | None = None) -> DataFrame:
    """node, component: the least node reachable from each node that has a link to another.

    links: undirected, one row a link; repeated links, links to itself and nulls do no harm.
    Nodes may be of any type Spark can order. Each step keeps the components and brings the
    links nearer to stars around the least nodes; it ends when they are such stars, after
    a number of steps that grows with the logarithm of the longest path. `tasks`: for few
    links, how many tasks write a step's table at most.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tasks)
    for _ in range(MAX_STEPS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, tasks)
        small = _star(large, tasks)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = written(small.where("u != v").distinct(), tasks)
        # done when the links are stars: each node has one link up, and no centre has any
        roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        roles = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not roles.agg(F.coalesce(F.max((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)), F.lit(False))).first()[0]:
            break
    else:
        raise RuntimeError("the components did not settle")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
