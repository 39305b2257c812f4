"""The tree search and the whole clustering against plain loops."""

import math
import random
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm import vantage_clusters as vc
from tests.conftest import rows


@given(st.integers(0, 10**6), st.integers(1, 45), st.sampled_from([1, 2, 300, 2**27]))
@settings(max_examples=60, deadline=None)
def test_search_is_exact_and_ties_go_to_the_smaller_number(seed, count, reach):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-reach, reach + 1, (count, 4))
    centroids[rng.integers(0, count, count // 2)] = centroids[0]  # equal centroids
    vectors = np.concatenate([rng.integers(-reach, reach + 1, (80, 4)), centroids])
    cluster, distance = vc.assign(vc.build_tree(centroids), vectors)
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (distance == every.min(1)).all()
    assert (cluster == every.argmin(1)).all()  # argmin names the first of equals


def brute(rows_):
    kept = []
    for vec_id, x in rows_:
        if x is not None and len(x) == 64 and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [math.floor(256 * c) for c in x]))

    def order(k):
        return k[0] is None, sha256(f"2:{k[0]}".encode()).hexdigest() if k[0] is not None else "", k[1]

    centroids = [v for _, v in sorted(kept, key=order)[:40]]

    def assigned():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(5):
        of = assigned()
        for i in range(len(centroids)):
            mine = [v for (_, v), (c, _) in zip(kept, of) if c == i]
            if mine:
                centroids[i] = [sum(x) // len(mine) for x in zip(*mine)]
    of = assigned()
    total = sum(d for _, d in of)
    shas = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(vec_id, c, d, sum(e for k, e in of if k == c), total, shas[c])
            for (vec_id, _), (c, d) in zip(kept, of)]


def vectors(count, spread=1.0):
    rng = random.Random(11)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(7)]
    return [(i, [round(rng.choice(middles)[k] + rng.uniform(-spread, spread), 2) for k in range(64)])
            for i in range(count)]


KINDS = "vec_id long, embedding array<double>"


def odd_rows():
    found = vectors(160)
    found += [found[3], found[3], (900, found[4][1]), (901, found[4][1])]
    found += [(None, found[5][1]), (None, found[6][1]), (902, None), (903, []), (904, [1.0] * 63),
              (905, [1.0] * 65), (906, [None] + [1.0] * 63), (907, [math.nan] + [1.0] * 63),
              (908, [math.inf] + [0.0] * 63), (909, [0.0] * 64), (910, [-0.001] * 64),
              (911, [400.0] + [-400.0] * 63)]
    return found


def test_clusters_against_loops(spark):
    found = odd_rows()
    frame = spark.createDataFrame(found, KINDS).repartition(6)
    assert rows(vc.clustered(frame)) == sorted(brute(found), key=lambda t: tuple(
        (v is not None, str(v)) for v in t))


def test_few_vectors_and_odd_tables(spark):
    few = [(i, [float(i % 3)] * 64) for i in range(9)]
    frame = spark.createDataFrame(few, KINDS)
    got = vc.clustered(frame)
    assert sorted(map(tuple, got.collect())) == sorted(brute(few))
    clash = frame.selectExpr("*", "1 AS cluster", "2 AS v", "3 AS distance", "4 AS n", "5 AS total")
    assert rows(vc.clustered(clash)) == rows(got)
    nothing = vc.clustered(frame.limit(0))
    assert nothing.columns == got.columns and nothing.count() == 0
    assert vc.clustered(frame.selectExpr("vec_id", "CAST(NULL AS array<float>) embedding")).count() == 0


def test_what_no_long_could_hold_is_left_out(spark):
    frame = spark.createDataFrame([(1, [2.0**40] + [0.0] * 63), (2, [0.0] * 64)], KINDS)
    assert [r.vec_id for r in vc.clustered(frame).collect()] == [2]
