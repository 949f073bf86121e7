"""Centroid clustering by a bisector tournament.

Vectors become integers, so sums, tests and distances are exact and no result
depends on the order of the rows. For centroids i < j the bisector is the
hyperplane 2(c_j - c_i) . x = |c_j|^2 - |c_i|^2; normals and thresholds of all
pairs are made once per round. A vector meets the centroids in ascending order:
k - 1 sign tests, each eliminating one, zero in favour of the smaller number.
Only for the winner is a distance computed.

A round is one scan. Each task adds up the components of its vectors by
cluster, Spark adds up the tasks' sums, and k x dims totals reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = "1"
#: The pair table has k x k x dims integers; more clusters than this are refused.
MOST_CLUSTERS = 256


def _fits(largest: int, dims: int) -> bool:
    """Whether sign tests and distances of components up to ``largest`` stay below 2**63."""
    return 8 * dims * (largest + 1) ** 2 < 2**63


def grid(vectors: pa.Array, dims: int = DIMS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors with exactly ``dims`` finite components, and
    floor(scale * x) of each component, as int64 (Python integers if they are
    too large for exact tests in 64 bits)."""
    length = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dims)
    x = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    good = np.isfinite(x).all(axis=1)
    x = np.floor(x[good] * scale)
    if x.size and not _fits(int(np.abs(x).max()), dims):
        return rows[good], np.array([[int(v) for v in row] for row in x], dtype=object)
    return rows[good], x.astype(np.int64)


class Bisectors:
    """The pair table of a list of integer centroids."""

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, dtype=object)
        dims = c.shape[1]
        if _fits(max(abs(v) for row in centroids for v in row), dims):
            c = c.astype(np.int64)
        self.centroids = c
        self.normals = 2 * (c[None, :, :] - c[:, None, :])
        square = (c * c).sum(axis=1)
        self.thresholds = square[None, :] - square[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row, the smaller one of equals."""
        best = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            side = (x * self.normals[best, j]).sum(axis=1) - self.thresholds[best, j]
            best[side > 0] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[best]
        return (gap * gap).sum(axis=1)


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))


def seeds(vectors: DataFrame, k: int, dims: int, scale: int, seed: str) -> list[list[int]]:
    """The k kept vectors with the smallest sha256 of ``seed:vec_id`` (a null
    id as the empty string), in that order; equal hashes by components. Each
    task keeps its k best, and k rows reach the driver."""
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[tuple[str, list[int]]] = []
        for b in batches:
            rows, x = grid(b.column("vector"), dims, scale)
            ids = b.column("vec_id").take(pa.array(rows)).to_pylist()
            name = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i in ids]
            limit = sorted(name)[:k][-1:]  # rows that tie with the k-th hash stay, so that components decide
            top = sorted(top + [(h, [int(v) for v in x[i]]) for i, h in enumerate(name) if [h] <= limit])[:k]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in top], pa.string()),
                                          pa.array([[str(v) for v in x] for _, x in top], pa.list_(pa.string()))], names=["h", "x"])
    parts = vectors.mapInArrow(best, "h string, x array<string>")
    parts = parts.withColumn("ints", F.transform("x", lambda v: v.cast("decimal(38,0)")))
    return [[int(v) for v in r.x] for r in parts.orderBy("h", "ints").limit(k).collect()]


def move(vectors: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """One round: the floor of the mean of each centroid's vectors; a centroid without any stays."""
    k = len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=object)
        for b in batches:
            _, x = grid(b.column("vector"), dims, scale)
            best = bisectors.winners(x)
            for j in np.unique(best):
                mine = x[best == j]
                count[j] += len(mine)
                total[j] += mine.sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
             pa.array(np.repeat(count[used], dims), pa.int64()), pa.array([str(int(v)) for v in total[used].ravel()], pa.string())],
            names=["cluster", "dim", "n", "total"])

    parts = vectors.mapInArrow(sums, "cluster int, dim int, n long, total string")
    totals = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = [list(c) for c in centroids]
    for r in totals.collect():  # at most k x dims rows
        out[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return out


def fit(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
        dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> list[list[int]]:
    """Centroids after ``rounds`` rounds from the k seeds (all kept vectors if
    there are fewer than k; none for a table without any)."""
    if not 1 <= k <= MOST_CLUSTERS:
        raise ValueError(f"the number of clusters must be 1 to {MOST_CLUSTERS}")
    vectors = _vectors(table, id_col, vector_col)
    centroids = seeds(vectors, k, dims, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = move(vectors, centroids, dims, scale)
    return centroids


def assign(table: DataFrame, centroids: list[list[int]], id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance of every kept vector."""
    vectors = _vectors(table, id_col, vector_col)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if not centroids:
        return vectors.where("false").selectExpr("vec_id", "0 AS cluster", "0L AS distance")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for b in batches:
            rows, x = grid(b.column("vector"), len(centroids[0]), scale)
            best = bisectors.winners(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array(best, pa.int32()),
                                              pa.array(bisectors.distances(x, best), pa.int64())],
                                             names=["vec_id", "cluster", "distance"])
    return vectors.mapInArrow(run, schema)


def cluster(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256.

    Vectors that are null, of another length, or hold a null, NaN or infinite
    component are left out; ids may be null or repeat (each row is a vector);
    other columns are ignored; equal vectors get the same cluster, and of
    equally near centroids the smaller number wins. A table without kept
    vectors gives an empty result. A distance or inertia over 2**63 - 1 has no
    64-bit result and raises."""
    centroids = fit(table, id_col, vector_col, k, rounds, dims, scale, seed)
    rows = cut(assign(table, centroids, id_col, vector_col, scale))
    found = rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # at most k rows
    total = sum(r["d"] for r in found)
    table_of = [(r["cluster"], r["d"], total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
                for r in found]
    names = rows.sparkSession.createDataFrame(table_of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> str:
    def nearest(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, sum((v.x - m.x) * (v.x - m.x))::HUGEINT AS d FROM v JOIN c{i} m USING (dim) GROUP BY r, c) GROUP BY r)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT m.c, m.dim, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, m.x) AS x FROM c{i} m LEFT JOIN (
    SELECT c, dim, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM v JOIN a{i} USING (r) GROUP BY c, dim) USING (c, dim))"""

    steps = ",\n".join(s for i in range(rounds) for s in (nearest(i), moved(i)))
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor({scale} * y::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {dims}),
v AS MATERIALIZED (SELECT r, unnest(range({dims})) AS dim, unnest(q) AS x FROM e),
s AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS c FROM e QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, dim, x FROM v JOIN s USING (r)),
{steps},
{nearest(rounds)},
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS sha FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN e USING (r) JOIN h USING (c)
"""


SQL = _sql()
