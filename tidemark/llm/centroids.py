"""Centroid clustering of vectors over a table of pivot distances (operator 12).

The distances of every vector to a few fixed pivots are worked out once and stored with
it. In each round the centroids' distances to the same pivots give, by the triangle
inequality, a lower bound on the distance of every vector from every centroid. The
centroid of least bound is measured first; of the others, only those whose bound isn't
beyond that distance are. Measured distances are whole numbers, and so are centroids,
so the result is exact whatever the pivots are.

A task sums its vectors up by cluster before anything is shuffled; a round sends one
row a task and cluster, and the driver sees one row a cluster.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

SCALE = 256
#: Pivots, at most.
PIVOTS = 8
#: Components below this keep all sums of squares of at most 2**13 of them within 64 bits.
SAFE = 2**24
LONGEST = 2**63 - 1
WIDE = "decimal(38,0)"


def scaled(vectors: DataFrame, dim: int) -> DataFrame:
    """(vec_id, v) of the vectors of ``dim`` components, all finite: whole numbers, 64 bits at most."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter((F.size("embedding") == dim) & F.coalesce(ok, F.lit(False)))
    return kept.select(F.col("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))


def first_centroids(points: DataFrame, k: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in the order of the hashes; ties by the vector. k rows are collected."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def _largest(x: np.ndarray) -> int:
    """The largest absolute value."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers, pair by pair; Python's integers where 64 bits could be too few."""
    if max(_largest(x), _largest(y)) < SAFE:
        d = x - y
        return np.einsum("ij,ij->i", d, d)
    d = x.astype(object) - y.astype(object)
    return (d * d).sum(axis=1)


def spread_pivots(centroids: np.ndarray, n: int) -> np.ndarray:
    """n of the first centroids, each as far as can be from those chosen before; the first is centroid 0."""
    chosen = [0]
    near = square_distances(centroids, centroids[[0] * len(centroids)])
    while len(chosen) < min(n, len(centroids)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, square_distances(centroids, centroids[[chosen[-1]] * len(centroids)]))
    return centroids[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every row of ``x`` to every pivot, as doubles."""
    return np.stack([np.sqrt(square_distances(x, pivots[[p] * len(x)]).astype(np.float64)) for p in range(len(pivots))], axis=1).reshape(len(x), len(pivots))


class Assigner:
    """Finds the nearest centroids of vectors whose pivot distances are known."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids = centroids
        self.to_pivots = pivot_distances(centroids, pivots)

    def bounds(self, known: np.ndarray) -> np.ndarray:
        """The least distance that each vector can have from each centroid, rounding errors allowed for."""
        low = np.zeros((len(known), len(self.centroids)))
        for p in range(known.shape[1]):
            np.maximum(low, np.abs(known[:, p, None] - self.to_pivots[None, :, p]), out=low)
        slack = 1e-9 * (1.0 + known.max(axis=1, initial=0)[:, None] + self.to_pivots.max(axis=1, initial=0)[None, :])
        return low - slack

    def nearest(self, x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each vector (ties: the smaller number), the squared distance, and how many were measured."""
        if not len(x):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0
        low = self.bounds(known)
        best = low.argmin(axis=1)
        least = square_distances(x, self.centroids[best])
        reach, measured, begun = np.sqrt(least.astype(np.float64)), len(x), best.copy()
        for c in range(len(self.centroids)):
            rows = np.flatnonzero((low[:, c] <= reach) & (begun != c))
            if not len(rows):
                continue
            measured += len(rows)
            d = square_distances(x[rows], self.centroids[[c] * len(rows)])
            better = (d < least[rows]) | (d == least[rows]) & (c < best[rows])
            if d.dtype != least.dtype:
                least = least.astype(object)
            least[rows[better]] = d[better]
            best[rows[better]] = c
            reach[rows[better]] = np.sqrt(d[better].astype(np.float64))
        return best, least, measured


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _with_pivots(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    dim, id_type = pivots.shape[1], points.schema["vec_id"].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = pivot_distances(_matrix(batch.column(1), dim, np.int64), pivots)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(known.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "v", "known"])

    return points.mapInArrow(add, f"vec_id {id_type}, v array<long>, known array<double>")


def _moved(points: DataFrame, assigner: Assigner) -> np.ndarray:
    """The centroids after one round: exact floors of the means; those without vectors stay."""
    k, dim = assigner.centroids.shape
    pivots = assigner.to_pivots.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim, np.int64)
            best, _, _ = assigner.nearest(x, _matrix(batch.column(1), pivots, np.float64))
            wide = x if _largest(x) < SAFE else x.astype(object)
            for c in np.unique(best):
                own = wide[best == c]
                n[c] += len(own)
                total[c] += own.sum(axis=0).astype(object)
        some = np.flatnonzero(n)
        lists = [[decimal.Decimal(int(s)) for s in total[c]] for c in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(lists, pa.list_(pa.decimal128(38, 0)))], ["cluster", "n", "sums"])

    partial = points.select("v", "known").mapInArrow(sums, f"cluster int, n long, sums array<{WIDE}>")
    added = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", i)).cast(WIDE).alias(f"s{i}") for i in range(dim)))
    centroids = assigner.centroids.copy()
    for row in added.collect():  # a row a cluster
        centroids[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dim)]
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Vectors that are null, of other lengths or hold null or non-finite components are left
    out. Repeated rows and ids count each. Rows without an id are clustered; they start a
    centroid only where fewer than k others are there. Fewer than k vectors give as many
    centroids; no rows give no rows. Components stop at the limits of 64 bits, as do
    distances and inertias in the result; comparisons and sums before are exact. Other
    columns of ``vectors`` don't matter.
    """
    points = scaled(vectors, dim)
    centroids = first_centroids(points, k)
    id_type = points.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return points.sparkSession.createDataFrame([], columns)
    pivots = spread_pivots(centroids, PIVOTS)
    stored = materialize(_with_pivots(points, pivots), "pivoted")
    for _ in range(rounds):
        centroids = _moved(stored, Assigner(centroids, pivots))
    assigner = Assigner(centroids, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, known = _matrix(batch.column(1), dim, np.int64), _matrix(batch.column(2), len(pivots), np.float64)
            best, least, _ = assigner.nearest(x, known)
            exact = pa.array([decimal.Decimal(int(d)) for d in least], pa.decimal128(38, 0)) if least.dtype == object else pa.array(least).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), exact], ["vec_id", "cluster", "exact"])

    assigned = materialize(stored.mapInArrow(assign, f"vec_id {id_type}, cluster int, exact {WIDE}"), "assigned")
    sums = {r["cluster"]: int(r["sum"]) for r in assigned.groupBy("cluster").agg(F.sum("exact").cast(WIDE).alias("sum")).collect()}  # a row a cluster
    short = lambda n: min(int(n), LONGEST)
    own = F.array(*(F.lit(short(sums.get(c, 0))).cast("long") for c in range(len(centroids))))
    digests = F.array(*(F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()))
    at = F.col("cluster") + 1
    return assigned.select(
        "vec_id",
        "cluster",
        F.least("exact", F.lit(decimal.Decimal(LONGEST))).cast("long").alias("distance"),
        F.element_at(own, at).alias("cluster_inertia"),
        F.lit(short(sum(sums.values()))).cast("long").alias("inertia"),
        F.element_at(digests, at).alias("centroid_sha256"),
    )


def oracle(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """DuckDB SQL that measures every centroid in every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT p.row, p.vec_id, p.v, c.c, CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM p CROSS JOIN c{r} c),
a{r} AS MATERIALIZED (SELECT row, vec_id, v, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i),
n{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN n{r} USING (c))""")
    return f"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS c, v FROM p
      QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) <= {k}),{",".join(steps)}
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(e.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} e USING (c)"""
