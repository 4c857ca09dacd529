"""Connected components of an edge list, without gathering them anywhere unbounded.

Rounds of contraction: every node hooks onto its smallest neighbour if that is smaller than
itself, chains of hooks are cut short by pointer doubling, edges are renamed to their ends'
roots, and those inside one component go. At least half of the components that still have an
edge vanish in a round. Once no more than ``finish_rows`` edges are left, a size that is counted
first, one task ends the work with a union-find; a larger rest goes through further rounds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common


class Forest:
    """Union-find over numbers 0 to n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = a = up[up[a]]
        return a

    def join(self, a: int, b: int) -> bool:
        """True if the two were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(a) for a in range(len(self.up))], np.int64)


def _finish(batches):
    """Union-find in one task over a bounded number of edges."""
    import pyarrow as pa

    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
    if not a:
        return
    nodes, place = np.unique(np.concatenate(a + b), return_inverse=True)
    half = len(place) // 2
    forest = Forest(len(nodes))
    for x, y in zip(place[:half].tolist(), place[half:].tolist(), strict=True):
        forest.join(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[forest.roots()])], ["node", "root"])


def _jumped(hooks: DataFrame) -> DataFrame:
    """Follow hooks to their ends: node, root, as a written table. Hooks lead to smaller nodes, so there is no cycle."""
    hooks = common.stored(hooks, "hooks")
    while True:
        onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
        longer = common.stored(hooks.join(onward, "root", "left").select("node", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("_moved")), "hooks")
        common.forget(hooks)
        hooks = longer
        if hooks.where("_moved").isEmpty():
            return hooks
        path, hooks = hooks._tidemark_path, hooks.drop("_moved")
        hooks._tidemark_path = path


def connected(edges: DataFrame, *, finish_rows: int = 1 << 18) -> DataFrame:
    """Smallest node that each node reaches: node, root, for every node that has an edge; a written table.

    ``edges``: columns a and b, 64-bit integers. Repeated edges and loops do no harm; a node
    with a loop alone is its own root.
    """
    with common.Scratch() as tmp:
        left = tmp.stored(edges.select("a", "b").distinct(), "edges")
        nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
        labels = None  # node, root: what earlier rounds have merged
        while left.count() > finish_rows:
            both = left.where("a <> b").select("a", "b").union(left.where("a <> b").select("b", "a"))
            hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).where("root < node")
            roots = _jumped(hooks)
            tmp.frames.append(roots)
            roots = roots.select("node", "root")
            labels = tmp.stored(_renamed(nodes.withColumn("root", F.col("node")) if labels is None else labels, roots), "labels")
            at = lambda side: F.coalesce(F.col(f"r{side}.root"), F.col(side))  # noqa: B023, E731
            joined = left.join(roots.alias("ra"), F.col("a") == F.col("ra.node"), "left").join(roots.alias("rb"), F.col("b") == F.col("rb.node"), "left")
            renamed = joined.select(at("a").alias("a"), at("b").alias("b")).where("a <> b")
            left = tmp.stored(renamed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        roots = left.repartition(1).mapInArrow(_finish, "node long, root long")
        return common.stored(roots if labels is None else _renamed(labels, roots), "components")


def _renamed(labels: DataFrame, roots: DataFrame) -> DataFrame:
    onto = roots.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return labels.join(onto, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
