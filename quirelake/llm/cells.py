"""Pairs and what both their ends hold, brought together without a copy per pair.

Nodes are dealt to blocks, pairs to the cells of two blocks. A cell gets what a node holds
once, however many of its pairs ask for it, so what is shuffled grows with nodes times
blocks and never beyond two copies a pair. Blocks are so many that cells hold a bounded
share of pairs and load.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of a cell on average.
CELL_PAIRS = 20_000
#: Blocks at least, so that small jobs are spread too.
LEAST_BLOCKS = 6


def blocks_for(pairs: int, load: int, most: int) -> int:
    """In how many blocks nodes are dealt: ``load`` is what all of them hold together, ``most``
    what a block may hold on average."""
    return max(LEAST_BLOCKS, math.isqrt(pairs // CELL_PAIRS) + 1, -(-load // most))


def in_cells(pairs: DataFrame, held: DataFrame, blocks: int, work, schema: str, fragments: int = 1):
    """``work`` (pandas frames of pairs a, b and of held rows) applied to each cell and fragment.

    ``held`` has the long ``node``, the int ``fragment`` and what a node holds.
    """
    x, y = (F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias(to) for c, to in (("a", "x"), ("b", "y")))
    placed = pairs.select("a", "b", x, y)
    needed = placed.select("x", "y", F.explode(F.array("a", "b")).alias("node")).distinct()
    names = [c for c in held.columns if c != "fragment"]
    held = needed.join(held, "node").select(
        F.col("x").alias("of_x"), F.col("y").alias("of_y"), F.col("fragment").alias("of"), *names
    )
    asked = placed.withColumn("fragment", F.explode(F.lit(list(range(fragments)))))
    return (
        asked.groupBy("x", "y", "fragment").cogroup(held.groupBy("of_x", "of_y", "of"))
        .applyInPandas(work, schema)
    )
