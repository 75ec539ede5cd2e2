"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stash

#: Most edges that one task unites by itself; beyond them the rounds of joins do.
TASK_EDGES = 20_000


def _united(batches: Iterator) -> Iterator:
    import pyarrow as pa

    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array([root(x) for x in nodes], pa.string())], ["node", "component"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component) for every node of an edge (strings); component is the smallest node that can be reached.

    A table of at most task_edges distinct edges is united in one task. Beyond that, each round keeps at most the rows it
    was given: nodes move their larger neighbours, then themselves, to the smallest neighbour, until nothing moves.
    Rounds grow with the logarithm of the longest path. Minima come from aggregation and joins, never from one group in
    memory; rows of a node with very many neighbours are spread over tasks where they join its minimum.
    Loops and nulls are ignored; an empty table gives an empty table.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    pairs, before = stash(pairs, "edges"), None
    if pairs.count() <= task_edges:
        return pairs.coalesce(1).mapInArrow(_united, "node string, component string")
    while True:
        total = 2 * pairs.count()
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = salted_join(both, least, "u", "n", total, "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = salted_join(large, root, "u", "n", total, "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stash(small.union(root.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select(F.col("v"), F.col("v")).distinct())
