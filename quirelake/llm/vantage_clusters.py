"""Centroid clustering with exact integer arithmetic: a vantage-point tree over the centroids.

The tree is built anew on the driver each round, from K centroids at most, and broadcast.
Every vector searches it best-first by branch-and-bound: of its open subtrees it visits the
one with the smallest lower bound, until that bound lies beyond its best distance. A subtree
at exactly the best distance is still visited (the pruning radius is inclusive), so that of
equally near centroids the smallest number is found. Distances are integers; the bounds of
the triangle inequality are floating numbers, rounded to the safe side.

The vectors of an Arrow batch search together: in one step each of them visits its own next
node, and those that visit the same node are measured at once.
"""

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.workspace import written

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = "2:"
#: Centroids in a leaf.
LEAF = 4
#: Integer components beyond this are not taken: squared distances would not fit a long.
MOST = 2**27
#: Vectors that search together.
RUN = 4096
#: Relative slack of the floating bounds, far above their rounding errors.
SLACK = 1e-9


@dataclass
class Node:
    """A leaf lists centroid numbers; an inner node has its vantage centroid, and per child
    the smallest and the largest distance of the child's centroids to it."""

    numbers: np.ndarray
    centroids: np.ndarray
    children: tuple = ()


def build_tree(centroids: np.ndarray) -> list[Node]:
    """Nodes of a vantage-point tree, the root first. Equal centroids are all kept."""
    nodes: list[Node] = []

    def add(numbers: np.ndarray) -> int:
        place = len(nodes)
        if len(numbers) <= LEAF:
            nodes.append(Node(numbers, centroids[numbers]))
            return place
        vantage, rest = _vantage(numbers)
        node = Node(vantage, centroids[vantage])
        nodes.append(node)
        far = np.sqrt(squared(centroids[rest], centroids[vantage])[:, 0].astype(np.float64))
        order = np.argsort(far, kind="stable")
        half = len(order) // 2
        node.children = tuple(
            (add(rest[side]), far[side].min() * (1 - SLACK), far[side].max() * (1 + SLACK))
            for side in (order[:half], order[half:])
        )
        return place

    def _vantage(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the centroid whose distances to the others spread most
        spread = np.sqrt(squared(centroids[numbers], centroids[numbers]).astype(np.float64)).std(1)
        chosen = int(spread.argmax())
        return numbers[chosen : chosen + 1], np.delete(numbers, chosen)

    add(np.arange(len(centroids)))
    return nodes


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances as longs, one column per centroid."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for i, centroid in enumerate(centroids):
        apart = vectors - centroid
        out[:, i] = np.einsum("ij,ij->i", apart, apart)
    return out


def assign(nodes: list[Node], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smallest number) and its squared distance."""
    n = len(vectors)
    cluster = np.full(n, np.iinfo(np.int64).max)
    best = np.full(n, np.iinfo(np.int64).max)
    # lower bounds of the nodes that are open to a vector; infinity for all others
    bounds = np.full((n, len(nodes)), np.inf)
    bounds[:, 0] = 0.0
    searching = np.arange(n)
    while len(searching):
        visited = bounds[searching].argmin(1)
        bound = bounds[searching, visited]
        radius = np.sqrt(best[searching].astype(np.float64)) * (1 + SLACK)
        left = bound <= radius
        searching, visited = searching[left], visited[left]
        bounds[searching, visited] = np.inf
        for place in np.unique(visited):
            node, rows = nodes[place], searching[visited == place]
            distances = squared(vectors[rows], node.centroids)
            for column, number in enumerate(node.numbers):
                far = distances[:, column]
                nearer = (far < best[rows]) | ((far == best[rows]) & (number < cluster[rows]))
                best[rows[nearer]] = far[nearer]
                cluster[rows[nearer]] = number
            if node.children:
                apart = np.sqrt(distances[:, 0].astype(np.float64))
                for child, low, high in node.children:
                    gap = np.maximum(apart * (1 - SLACK) - high, low - apart * (1 + SLACK))
                    bounds[rows, child] = np.maximum(gap, 0.0)
    return cluster, best


def _integers(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are taken, and their integer components."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == DIMENSIONS)
    values = column.take(pa.array(rows)).flatten()
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL becomes NaN
    numbers = np.floor(SCALE * numbers.reshape(-1, DIMENSIONS))
    taken = (np.abs(numbers) <= MOST).all(1)
    return rows[taken], numbers[taken].astype(np.int64)


def _kept(batches):
    for batch in batches:
        rows, numbers = _integers(batch.column("embedding"))
        flat = pa.array(numbers.astype(np.int32).ravel())
        offsets = pa.array(np.arange(0, len(rows) * DIMENSIONS + 1, DIMENSIONS, dtype=np.int32))
        lists = pa.ListArray.from_arrays(offsets, flat)
        ids = batch.column("vec_id").take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([ids, lists], ["vec_id", "v"])


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and the integer components v = floor(256 * x) of the vectors that take part:
    those of exactly 64 components, none NULL or non-finite (or beyond 2**27 once scaled)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_kept, "vec_id long, v array<int>")


def _matrices(batch: pa.RecordBatch):
    """The batch's vectors as matrices of RUN rows, each with its first row."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(-1, DIMENSIONS).astype(np.int64)
    for at in range(0, len(vectors), RUN):
        yield at, vectors[at : at + RUN]


def _sums(tree, clusters: int):
    def sums(batches):
        counts = np.zeros(clusters, np.int64)
        totals = np.zeros((clusters, DIMENSIONS), np.int64)
        for batch in batches:
            for _, vectors in _matrices(batch):
                cluster, _ = assign(tree.value, vectors)
                counts += np.bincount(cluster, minlength=clusters)
                np.add.at(totals, cluster, vectors)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held]),
             pa.array(list(totals[held]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    return sums


def _assigned(tree):
    def assigned(batches):
        for batch in batches:
            for at, vectors in _matrices(batch):
                cluster, distance = assign(tree.value, vectors)
                ids = batch.column("vec_id").slice(at, len(vectors))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster, pa.int32()), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return assigned


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. The driver gets a count and a sum per centroid."""
    tree = vectors.sparkSession.sparkContext.broadcast(build_tree(centroids))
    parts = vectors.select("v").mapInArrow(
        _sums(tree, len(centroids)), "cluster int, n long, total array<long>"
    )
    totals = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(DIMENSIONS)]
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect()
    tree.destroy()
    moved = centroids.copy()
    for row in sums:
        moved[row.cluster] = [row[f"t{i}"] // row.n for i in range(DIMENSIONS)]
    return moved


def clustered(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """Per vector of ``embeddings`` (vec_id, embedding) that takes part: vec_id, cluster,
    distance, cluster_inertia, inertia and centroid_sha256.

    The first centroids are the kept vectors with the smallest sha256 of ``2:<vec_id>``;
    vectors without an id come last there, equal hashes are ordered by the components. With
    fewer vectors than ``clusters`` each of them begins one. Repeated rows are vectors of
    their own; equal centroids keep their numbers, and the smaller one gets the vectors. A
    centroid without vectors stays. An inertia beyond a long is NULL. No vector gives no
    row; other columns are ignored, whatever their names.
    """
    spark = embeddings.sparkSession
    vectors = written(kept_vectors(embeddings))
    text = F.concat(F.lit(SEED), F.col("vec_id").cast("string"))
    first = vectors.orderBy(F.asc_nulls_last(F.sha2(text, 256)), "v").limit(clusters).collect()
    kinds = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long,"
             " centroid_sha256 string")  # fmt: skip
    if not first:
        return spark.createDataFrame([], kinds)
    centroids = np.array([r.v for r in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    tree = spark.sparkContext.broadcast(build_tree(centroids))
    found = written(vectors.mapInArrow(_assigned(tree), "vec_id long, cluster int, distance long"))
    tree.destroy()
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38)")).alias("s"))
    sums = {r.cluster: int(r.s) for r in sums.collect()}

    def long_or_null(total: int):
        return total if total < 2**63 else None

    facts = [(i, long_or_null(s), long_or_null(sum(sums.values())),
              sha256(",".join(map(str, centroids[i])).encode()).hexdigest())
             for i, s in sums.items()]
    facts = spark.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # one row per cluster at most
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql() -> str:
    apart = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"""k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (
  SELECT number, v FROM (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}' || vec_id) NULLS LAST, v) - 1 AS number, v
    FROM k) WHERE number < {CLUSTERS})"""
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, number, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY distance, number) AS place FROM (
      SELECT v.rid, v.vec_id, v.v, c.number, CAST({apart} AS BIGINT) AS distance FROM k v, c{i} c))
  WHERE place = 1)""")
        if i < ROUNDS:
            parts.append(f"""s{i} AS (
  SELECT number, dim, sum(x) AS s, count(*) AS n FROM (
    SELECT number, unnest(v) AS x, unnest(range({DIMENSIONS})) AS dim FROM a{i})
  GROUP BY number, dim),
m{i} AS (
  SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v
  FROM s{i} GROUP BY number),
c{i + 1} AS MATERIALIZED (
  SELECT c.number, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.number = c.number)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.number AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.number) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.number = a.number"""


CLUSTERS_SQL = _sql()
