"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.workspace import dropped, written


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root): the smallest node of each node's component, for nodes with an edge.

    ``edges`` has the long columns a and b. Every node hooks onto its smallest
    neighbour, edges are redrawn between the roots, and so on until no edge is
    left; each turn shrinks the graph, and both tables are written. None when
    there is no edge at all.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    mapping = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("r"))
        step = hook.select(F.col("a").alias("r"), F.col("r").alias("r2"))
        hook = written(hook.join(step, "r", "left").select("a", F.coalesce("r2", "r").alias("r")))
        old_mapping, old_edges = mapping, edges
        if mapping is None:
            mapping = hook.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            mapping = mapping.join(hook, mapping.root == hook.a, "left").select(
                "node", F.coalesce("r", "root").alias("root")
            )
        mapping = written(mapping)
        left = hook.select("a", F.col("r").alias("ra"))
        right = hook.select(F.col("a").alias("b"), F.col("r").alias("rb"))
        edges = written(
            edges.join(left, "a").join(right, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        dropped(old_mapping, old_edges, hook)
    dropped(edges)
    return mapping
