import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from corpusml.llm import clustering

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k, rounds, seed=2, dimensions=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) for c in v)]
    kept = [(i, [max(-clustering.LIMIT, min(clustering.LIMIT, c)) for c in v]) for i, v in kept]
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]) if r[0] is not None else (True, ""), r[1]))[:k]]

    def closest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(closest(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centroids)]
    found = [(i, *closest(v)) for i, v in kept]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, n, fits(d), fits(sum(e for _, e, m in found if m == n)), fits(sum(e for _, e, _ in found)),
                    hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found), key=str)


def got(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("extra") for c in ("cluster", "v", "x", "distance", "n", "label")})
    result = clustering.cluster(df, dimensions=4, **settings)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


def vectors(n, seed=1, step=1.0):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0, 1) / step) * step for _ in range(4)]) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(300) + [(i, [float(i % 3), 0.0, 0.5, -0.001]) for i in range(300, 420)]
    assert got(spark, rows, k=7, rounds=3) == brute(rows, 7, 3)


def test_ties_repeats_and_equal_centroids(spark):
    # Coarse vectors: many ties, equal first centroids, clusters that run empty.
    rows = vectors(80, 2, 1.0) + [(500 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)] + [(3, [0.0, 0.0, 0.0, 0.0])] * 3
    assert got(spark, rows, k=25, rounds=2) == brute(rows, 25, 2)


def test_awkward_rows(spark):
    rows = vectors(20) + [(50, None), (51, []), (52, [1.0, 2.0, 3.0]), (53, [1.0, None, 2.0, 3.0]), (54, [1.0, float("nan"), 0.0, 0.0]),
                          (55, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.1, 0.2, 0.3, 0.4]), (56, [1.0] * 5)]
    result = got(spark, rows, k=40, rounds=1)
    assert result == brute(rows, 40, 1) and len(result) == 21
    assert got(spark, [], k=40, rounds=1) == [] and got(spark, [(1, None)], k=40, rounds=1) == []


def test_huge_components(spark):
    rows = vectors(10) + [(60, [1e30, -1e30, 0.0, 0.0]), (61, [1e30, -1e30, 5.0, 0.0]), (62, [1e7, 0.0, 0.0, 0.0])]
    for k in (1, 3):
        result = got(spark, rows, k=k, rounds=2)
        assert result == brute(rows, k, 2) and (k > 1 or result[0][2] is result[0][4] is None)


def test_search_stops_strictly_beyond_twice_the_distance():
    # The vector lies half way: the centroid at exactly twice the distance ties and has the smaller number.
    centroids = np.array([[4, 0], [0, 0], [100, 0]])
    order, apart = clustering.neighbour_lists(centroids)
    number, distance = clustering.nearest(np.array([[2, 0], [3, 0], [99, 0]]), centroids, order, apart)
    assert number.tolist() == [0, 0, 2] and distance.tolist() == [4, 1, 1]
    rng = np.random.default_rng(0)
    for _ in range(50):
        c, v = rng.integers(-3, 4, (12, 3)), rng.integers(-4, 5, (200, 3))
        order, apart = clustering.neighbour_lists(c)
        number, distance = clustering.nearest(v, c, order, apart)
        full = ((v[:, None] - c[None]) ** 2).sum(2)
        assert np.array_equal(number, full.argmin(1)) and np.array_equal(distance, full.min(1))
