"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b) can reach, as (node, root).

    Every round hooks the parent of each node, and the node itself, to the smallest parent among its neighbours, then lets
    every node point to the parent of its parent; rounds grow with the logarithm of the longest path. Each round is stored,
    so that lineage stays short, and joins only stored tables, so that adaptive execution can split a node with very many
    neighbours. The driver gets one sum per round. Self loops and repeated edges change nothing; edges with a null end are
    dropped; no edges give no rows.
    """
    forth = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = stored(forth.union(forth.select("b", "a")).distinct(), "components-edges")
    labels = stored(both.select(F.col("a").alias("node"), F.col("a").alias("parent")).distinct(), "components-labels")
    last = None
    while True:
        least = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("parent").alias("near"))
        hooks = labels.join(least, labels["node"] == least["b"]).select(
            F.explode(
                F.array(
                    F.struct(F.col("parent").alias("node"), F.least("parent", "near").alias("parent")),
                    F.struct("node", F.least("parent", "near").alias("parent")),
                )
            ).alias("h")
        )
        hooked = stored(hooks.groupBy("h.node").agg(F.min("h.parent").alias("parent")), "components-hooked")
        above = hooked.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        labels = stored(hooked.join(above, "parent").select("node", F.col("grand").alias("parent")), "components-labels")
        total = labels.agg(F.sum(F.col("parent").cast("decimal(38,0)"))).first()[0]
        if total == last:  # parents only ever get smaller
            return labels.withColumnRenamed("parent", "root")
        last = total
