import hashlib
import math

import numpy as np
import pytest

from cohortlens.llm import centroids
from llm_rows import rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, k=16, rounds=3, dims=64, scale=64):
    """The definition with Python integers and all distances."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in data
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        groups = [[] for _ in c]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        c = [[sum(col) // len(g) for col in zip(*g)] if g else m for g, m in zip(groups, c)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    per = {j: sum(d for _, x, d in got if x == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in got), key=repr)


def edge_vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(9, 64))
    data = [(i, (base[i % 9] + rng.normal(scale=0.2, size=64)).tolist()) for i in range(150)]
    return data + [
        (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [1.0] * 63 + [None]),
        (205, [float("nan")] * 64), (206, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (None, [0.25] * 64),
        (207, [0.0] * 64), (207, [0.0] * 64), (208, [-1e-9] * 64), (209, [1.0] * 64), (209, [-1.0] * 64)]


def test_clusters_brute_force(spark):
    data = edge_vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in data], SCHEMA)
    for d in (df, df.repartition(7), df.selectExpr("*", "'x' AS cluster", "'x' AS vector", "'x' AS distance", "'x' AS h")):
        assert rows(centroids.cluster(d)) == brute(data)


def test_ties_go_to_the_smaller_number():
    b = centroids.Bisectors([[4, 0], [0, 0], [2, 0], [0, 0]])
    x = np.array([[2, 0], [1, 0], [3, 0], [0, 9], [-5, 1]])
    assert b.winners(x).tolist() == [2, 1, 0, 1, 1]
    assert b.distances(x, b.winners(x)).tolist() == [0, 1, 1, 81, 26]


def test_tournament_equals_all_distances():
    rng = np.random.default_rng(1)
    c, x = rng.integers(-3, 4, (40, 5)), rng.integers(-3, 4, (3000, 5))  # many ties
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (centroids.Bisectors(c.tolist()).winners(x) == d.argmin(axis=1)).all()


def test_few_vectors_and_none(spark):
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert rows(centroids.cluster(spark.createDataFrame([(i, v, 0) for i, v in few], SCHEMA))) == brute(few)
    none = centroids.cluster(spark.createDataFrame([(1, [1.0], 0)], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(ValueError):
        centroids.fit(none, k=centroids.MOST_CLUSTERS + 1)


def test_large_components_stay_exact(spark):
    big = [(i, [float(2**33 + 2 * (i % 3))] * 64) for i in range(30)]
    df = spark.createDataFrame([(i, v) for i, v in big], "vec_id long, embedding array<double>")
    kept = [(i, [64 * int(x) for x in v]) for i, v in big]
    got = {r.vec_id: (r.cluster, r.distance) for r in centroids.cluster(df, k=3).collect()}
    order = sorted(kept, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())[:3]
    c = [v for _, v in order]
    for _ in range(3):
        groups = [[] for _ in c]
        for _, v in kept:
            groups[min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))[1]].append(v)
        c = [[sum(col) // len(g) for col in zip(*g)] if g else m for g, m in zip(groups, c)]
    for i, v in kept:
        d, j = min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
        assert got[i] == (j, d)
