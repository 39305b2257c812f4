"""Approximate nearest neighbours by cosine with a forest of hash prefixes.

Every vector gets one long hash string per tree: a letter for the nearest axis of a random
rotation, then sign bits. A shard of the vectors keeps one sorted array of strings per
tree; what shares a prefix with a query is one stretch of such an array. A query descends
to its longest matches in all trees and shards and ascends in all of them at once, prefix
by prefix, until they hold enough candidates together. Candidates are compared exactly.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.workspace import written

TREES = 64
SEED = 90_001
#: Axes of the rotation at most; a letter takes LETTER_BITS bits, the string CODE_BITS.
AXES, LETTER_BITS, CODE_BITS = 64, 7, 63
#: Prefix lengths at which a query stops, in bits; 0 is the root, which holds everything.
LEVELS = (0, *range(LETTER_BITS, 21), 24, 28, 32, 40, 48, CODE_BITS)
#: A query ascends until its trees hold so many entries, ...
MIN_CANDIDATES = 4_096
#: ... and this share of all vectors: without structure in the vectors, a fixed number
#: would find fewer and fewer of the nearest.
CANDIDATE_SHARE = 0.2
#: Vectors of a shard and queries of a block, which meet in one task.
SHARD, BLOCK = 4_096, 4_096


def hash_strings(vectors: np.ndarray) -> np.ndarray:
    """One row per vector, one column per tree; CODE_BITS bits in each."""
    n, d = vectors.shape
    out = np.empty((n, TREES), np.int64)
    axes = min(d, AXES)
    for tree in range(TREES):
        random = np.random.default_rng((SEED, tree))
        turned = vectors @ np.linalg.qr(random.standard_normal((d, axes)))[0]
        axis = np.abs(turned).argmax(1)
        code = 2 * axis + (turned[np.arange(n), axis] < 0)
        signs = vectors @ random.standard_normal((d, CODE_BITS - LETTER_BITS)) > 0
        code = code.astype(np.int64)
        for bit in range(signs.shape[1]):
            code = (code << 1) | signs[:, bit]
        out[:, tree] = code
    return out


def _index(batches):
    for batch in batches:
        if len(batch):
            # vectors of unlike length are hashed apart and never compared
            for _, same in batch.groupby(batch.vector.map(len)):
                rows = np.vstack(same.vector.to_numpy()).astype(np.float64)
                unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
                yield same.assign(codes=list(hash_strings(unit)))


def _ends(ordered: np.ndarray, codes: np.ndarray, level: int):
    """The stretch of a sorted array that shares ``level`` bits with each code."""
    shift = CODE_BITS - level
    low = (codes >> shift) << shift
    high = low + (np.int64(1) << shift) - 1 if level else np.full_like(codes, (1 << 63) - 1)
    return ordered.searchsorted(low, "left"), ordered.searchsorted(high, "right")


def _sizes(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if points.empty or queries.empty:
        return pd.DataFrame({"query": [], "level": [], "size": []})
    codes, asked = np.vstack(points.codes), np.vstack(queries.codes)
    sizes = np.zeros((len(asked), len(LEVELS)), np.int64)
    for tree in range(TREES):
        ordered = np.sort(codes[:, tree])
        for i, level in enumerate(LEVELS):
            low, high = _ends(ordered, asked[:, tree], level)
            sizes[:, i] += high - low
    return pd.DataFrame({
        "query": np.repeat(queries.point.to_numpy(), len(LEVELS)),
        "level": np.tile(LEVELS, len(asked)),
        "size": sizes.ravel(),
    })


def _nearest(k: int):
    def search(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "point": [], "score": []}
        if not points.empty and not queries.empty:
            codes, asked = np.vstack(points.codes), np.vstack(queries.codes)
            vectors = np.vstack(points.vector).astype(np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            names = points.point.to_numpy()
            order = codes.argsort(axis=0, kind="stable")
            ordered = np.take_along_axis(codes, order, 0)
            low = np.zeros((len(asked), TREES), np.int64)
            high = low.copy()
            for level, rows in queries.reset_index(drop=True).groupby("level").groups.items():
                for tree in range(TREES):
                    ends = _ends(ordered[:, tree], asked[rows, tree], level)
                    low[rows, tree], high[rows, tree] = ends
            for i, (name, vector) in enumerate(zip(queries.point, queries.vector)):
                held = np.zeros(len(points), bool)
                for tree in np.flatnonzero(low[i] < high[i]):
                    held[order[low[i, tree] : high[i, tree], tree]] = True
                held = np.flatnonzero(held)
                vector = np.asarray(vector, np.float64)
                score = np.einsum("ij,j->i", vectors[held], vector)
                score /= norms[held] * np.sqrt(vector @ vector)
                best = np.lexsort((names[held], -score))[:k]
                out["query"] += [name] * len(best)
                out["point"] += names[held[best]].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out)

    return search


def nearest(vectors: DataFrame, queries: str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of ``vectors``
    (vec_id, embedding) that meets the condition ``queries``, by cosine, ties to smaller
    vec_id, the row itself left out; all others if there are fewer.

    Vectors that are NULL, empty, zero, or hold NULL or a number that is not finite take
    no part, nor do rows without vec_id. Equal vectors are searched as one, so a vector that fills a third
    of the table is one entry. Rows with the same vec_id and vector count once; rows with the
    same vec_id and other vectors are taken as others. Vectors of unlike length are never
    compared. Other columns are ignored. An empty table gives no row.
    """
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    ).where(
        "vec_id IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND"
        " NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)"
    )
    rows = usable.withColumn("same", F.xxhash64("vector"))
    # of equal vectors the smallest k + 1 ids can be among the k nearest of any query
    by_id = Window.partitionBy("same", "vector").orderBy("vec_id")
    first = (
        rows.withColumn("nth", F.dense_rank().over(by_id)).where(F.col("nth") <= k + 1)
        .groupBy("same", "vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("point"), "vector", "ids")
    )
    indexed = written(
        first.mapInPandas(
            _index, "point long, vector array<double>, ids array<long>, codes array<long>"
        )
    )
    count = indexed.count()
    names = rows.where(queries).select("vec_id", "same", "vector").distinct()
    heads = rows.groupBy("same", "vector").agg(F.min("vec_id").alias("point"))
    asked = written(names.join(heads, ["same", "vector"]).select(F.col("vec_id").alias("query_id"), "point"))
    entries = written(indexed.join(asked.select("point").distinct(), "point", "left_semi"))

    shards = max(1, -(-count // SHARD))
    blocks = max(1, -(-entries.count() // BLOCK))

    def spread(df, own, own_count, other, other_count):
        every = F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)))
        mine = F.pmod(F.xxhash64("point"), F.lit(own_count)).cast("int")
        return df.withColumn(own, mine).withColumn(other, every).groupBy("shard", "block")

    points = spread(indexed.select("point", "vector", "codes"), "shard", shards, "block", blocks)
    bare = spread(indexed.select("point", "codes"), "shard", shards, "block", blocks)
    sizes = spread(entries.select("point", "codes"), "block", blocks, "shard", shards)
    enough = min(max(MIN_CANDIDATES, int(CANDIDATE_SHARE * count)), TREES * count)
    levels = (
        bare.cogroup(sizes).applyInPandas(_sizes, "query long, level int, size long")
        .groupBy("query", "level").agg(F.sum("size").alias("size"))
        .where(F.col("size") >= enough)
        .groupBy(F.col("query").alias("point")).agg(F.max("level").alias("level"))
    )
    levels = written(levels)
    entries = entries.select("point", "vector", "codes").join(levels, "point")
    found = points.cogroup(spread(entries, "block", blocks, "shard", shards)).applyInPandas(
        _nearest(k + 1), "query long, point long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    found = written(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1))
    named = (
        asked.join(found.withColumnRenamed("point", "near"), asked.point == found["query"])
        .join(indexed.select(F.col("point").alias("near"), "ids"), "near")
        .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        named.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
