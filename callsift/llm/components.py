"""Connected components by hooking and pointer jumping, every round a few joins over staged tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import discard, local_roots, stage

EDGE_BATCHES = 8


def _forest(batches):
    """Star edges that connect what the edges of a few batches connect: no more rows than nodes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def stars():
        nodes, roots = local_roots(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        own = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(roots[own]), pa.array(nodes[own])], names=["a", "b"])

    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        if len(held) == EDGE_BATCHES:
            yield stars()
            held = []
    if held:
        yield stars()


def components(links: DataFrame) -> DataFrame:
    """``links(a long, b long)`` -> ``(node, component)``: each linked node with the smallest node it can reach.

    Tasks first replace their edges by stars. Then in each round every node hooks onto its smallest
    neighbour, pointer jumping flattens the resulting trees, and the edges are rewritten between roots;
    each component that still has an edge merges, so rounds are logarithmic. Joins read staged tables on
    both sides, so adaptive execution splits hubs. Self links and links with a null end count for nothing.
    """
    edges = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a != b")
    edges = stage(edges.mapInArrow(_forest, "a long, b long").distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tree = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "hooks")
        while True:
            up = tree.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = stage(tree.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "jumps")
            discard(tree)
            still = not jumped.where("moved").isEmpty()
            tree = jumped.select("node", "root")
            tree.staged_at = jumped.staged_at
            if not still:
                break
        if found is None:
            found = tree
        else:
            later = tree.select(F.col("node").alias("root"), F.col("root").alias("top"))
            merged = stage(found.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
            discard(found)
            found = merged
        ends = tree.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        left = edges.join(ends, "a").select("ra", "b")
        right = tree.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = left.join(right, "b").where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        rest = stage(rest, "edges")
        discard(edges)
        edges = rest
        if edges.isEmpty():
            discard(edges)
            return found.select("node", F.col("root").alias("component"))
