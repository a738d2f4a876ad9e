"""Connected components of an edge table by repeated contraction.

Every round hangs each node under its smallest neighbour, shortens the chains
by pointer jumping, replaces edges by edges between roots and drops those that
became loops. Edges shrink with every round and a star, however large, is gone
after one. Nothing is gathered by node: minima are combined on the map side,
and joins on a hot node can be split. All tables stay in shared files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoset.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Labels (node, root) of all nodes of `edges` (a, b); the root is the smallest node reachable.

    Loops and repeated edges do no harm; NULL ends are left out.
    """
    edges = staged(edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while True:
        # parents are smaller than their children, so there are no cycles
        parent = staged(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "parent")
        if parent.isEmpty():
            break
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            parent = staged(parent.join(up, "root", "left").select("node", F.coalesce("upper", "root").alias("root"), F.col("upper").isNotNull().alias("moved")), "parent")
            if parent.where("moved").isEmpty():
                break
            parent = parent.drop("moved")
        parent = parent.select("node", "root")
        if labels is None:
            labels = parent
        else:
            # earlier labels whose root went under another, and the nodes that lost their root's place just now
            to = parent.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            labels = staged(labels.join(to, "root", "left").select("node", F.coalesce("upper", "root").alias("root")).unionByName(parent), "labels")
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        edges = staged(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = labels.select("root").distinct().join(labels.select(F.col("node").alias("root")), "root", "left_anti")
    return labels.unionByName(roots.select(F.col("root").alias("node"), "root"))
