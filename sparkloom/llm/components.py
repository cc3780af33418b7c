"""Connected components of an edge table, by alternating large and small stars.

Every step is a join or an aggregate on node ids, so a node with very many neighbours is only ever met as rows
of a shuffle and never as a list.  Each round is checkpointed to the shared folder, and goes on in no more tasks than
its edges ask for (``EDGES`` to a task), so that few edges don't leave many files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import checkpointed

#: Edges that a task takes in hand.
EDGES = 50_000


def connected_components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) -> (node, component): the smallest node reachable.  Nodes without an edge are not listed.

    Rows with a null end, loops and repeated edges change nothing; an empty table gives an empty result."""
    e = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    e = checkpointed(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, tasks = None, 1 + e.count() // EDGES
    for _ in range(most_rounds):
        e = e.coalesce(tasks)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(tasks).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").coalesce(tasks).distinct()
        e = checkpointed(small.coalesce(tasks))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        tasks = 1 + now[0] // EDGES
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    labels = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = labels.select(F.col("component").alias("node"), "component").distinct()
    return labels.union(roots)
