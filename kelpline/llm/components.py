"""Connected components of an edge table by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond") keep the edge count from growing and finish in about
log^2 rounds whatever the diameter. Minima are taken by mergeable aggregates
and joined back, so a hub's edges are never gathered in one task.

A round is half a dozen shuffles, which for few edges are many tasks that write
next to nothing. So up to SMALL edges, counted first, are solved on the driver, where
they take 16 bytes each; more take the rounds. Both give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, written

#: Edges that the driver may hold (8 MB).
SMALL = BROADCAST_ROWS


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different nodes of the edges (a, b), and the smallest node that each reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        # Each root takes the smallest that an edge leads to; two steps at least halve the roots that have edges.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _joined_minimum(pairs: DataFrame) -> DataFrame:
    """(node, other, least) for each pair; least is the smallest of node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node").select("node", "other", F.least("node", "least").alias("least"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is its component's smallest node.

    Nulls and loops in the edges are ignored; an edge table without rows gives no rows.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    if now.count() <= SMALL:
        found = now.toArrow()
        nodes, roots = smallest(*(found.column(k).to_numpy() for k in ("a", "b")))
        table = pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())})
        return written(now.sparkSession.createDataFrame(table, "node long, root long"), "roots")
    state = None
    for _ in range(rounds):
        both = now.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            now.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        large = (
            _joined_minimum(both)
            .where("other > node")
            .select(F.col("other").alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        down = large.select(F.col("a").alias("node"), F.col("b").alias("other"))
        small = _joined_minimum(down)
        now = written(
            small.select(F.col("other").alias("a"), F.col("least").alias("b"))
            .unionAll(small.select(F.col("node").alias("a"), F.col("least").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        if seen == state and seen[0] == seen[2]:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
