"""Connected components as DataFrame joins: large-star and small-star, in turn, until nothing changes.

Each round is two grouped minima (combined before the shuffle) and two joins.  The minima of the
first, where hot nodes are, are written before they are joined: both sides of that join are then
plain shuffles, which adaptive execution can split.  Rounds grow with the logarithm of the longest
path; what is written to the shared folder cuts the lineage.  Nothing but a count and a checksum
reaches the driver.  A graph of at most LOCAL_EDGES edges, a fixed bound, is solved by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Edges that one task solves by itself (a few dozen MB); larger graphs go in rounds.
LOCAL_EDGES = 500_000


def _solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of a small graph by union-find."""
    ends = [np.stack([b.column("u").to_numpy(), b.column("v").to_numpy()], axis=1) for b in it if b.num_rows]
    if not ends:
        return
    nodes, edges = np.unique(np.concatenate(ends), return_inverse=True)
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges.reshape(-1, 2).tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)  # nodes ascend, so the root is the smallest
    home = np.array([find(x) for x in range(len(nodes))])
    own = home != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[home[own]])], ["node", "component"])


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Tie each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them; large stars leave it few."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (u long, v long) to (``node``, ``component``): the smallest node reachable.

    Nodes that are the smallest of their component, and nodes without edges, have no row.
    """
    now = stored(edges.select("u", "v").where("u <> v").distinct(), name)
    if now.count() <= LOCAL_EDGES:
        return stored(now.coalesce(1).mapInArrow(_solve, "node long, component long"), name)
    seen = None
    while True:
        now = stored(_small_star(_large_star(now, name).distinct()).distinct(), name)
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())
        if sign == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = sign
