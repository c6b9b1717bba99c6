"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on its least neighbour.

    The least neighbour comes from a partial aggregate and a join, so a node
    with very many neighbours is never gathered; Spark splits its join.
    """
    if large:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    out = joined.where(F.col("v") > F.col("u")) if large else joined
    out = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


#: Edges that one task turns into stars at a time, and how many are left to one task alone.
FOREST_EDGES = 1 << 21
FEW_EDGES = 1 << 18


def _stars(ends: np.ndarray) -> pa.RecordBatch:
    """Edges as stars: a row per node that isn't the least of its piece."""
    nodes, code = np.unique(ends, return_inverse=True)
    code = code.reshape(ends.shape)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[code[0]], root[code[1]])
        step = root.copy()
        np.minimum.at(step, root[code[0]], low)
        np.minimum.at(step, root[code[1]], low)
        step = step[step]
        if (step == root).all():
            break
        root = step
    hung = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(nodes[root[hung]])], ["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(np.stack((batch.column(0).to_numpy(), batch.column(1).to_numpy())))
        size += len(batch)
        if size >= FOREST_EDGES:
            yield _stars(np.concatenate(held, axis=1))
            held, size = [], 0
    if held:
        yield _stars(np.concatenate(held, axis=1))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component.

    Null ends and self-loops are left out.  Each round is written to the shared
    folder, so its lineage is one table deep.  FEW_EDGES or fewer edges, counted
    first, need no rounds.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    state, now = None, materialize(edges.distinct().mapInArrow(_forest, "a long, b long").distinct(), "edges")
    few = now.count() <= FEW_EDGES
    if few:
        now = materialize(now.coalesce(1).mapInArrow(_forest, "a long, b long"), "edges")
    while not few:
        # Stars on sorted roots: nothing changes once every node hangs on its root.
        now = materialize(_star(materialize(_star(now, True), "edges"), False), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b"))).distinct()
