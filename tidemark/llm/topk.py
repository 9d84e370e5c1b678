"""Exact top-k inner products over a pivot-distance index (operator 4).

Vectors become points on a sphere by one more coordinate, so the largest inner product
is the smallest distance. Each is keyed by its nearest pivot and its distance to it;
distances cut every pivot's points into annuli, stored as blocks of packed vectors. A
query first scans the annuli that its own distances to the pivots point at, which
bounds its k-th score from below; then it scans the others, save those that the
triangle inequality keeps out of reach. The result is exact whatever the pivots are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize, parts_for

#: Pivots are the first vectors by a hash of the id, so many at most; annuli of a pivot. Both grow with the rows up to these.
MAX_PIVOTS, MAX_RINGS = 128, 32
#: Vectors in an annulus, in a block and in a block of queries, about.
CELL_ROWS, BLOCK_ROWS, QUERY_ROWS = 1024, 2048, 512
#: Annuli in a query's first scan.
FIRST_CELLS = 2
#: Scores that a task holds before it cuts them to k a query, and tasks whose scores are cut together.
HELD_ROWS, CUT_TASKS = 500_000, 32
SCALE = 256


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as whole numbers; vectors null or with null or non-finite parts left out."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(ok, F.lit(False)))
    # floor() of a double gives a long; larger components stay doubles, which are whole by then.
    big = lambda x: F.abs(x.cast("double") * SCALE) >= 2.0**53
    v = F.transform("embedding", lambda x: F.when(big(x), x.cast("double") * SCALE).otherwise(F.floor(F.when(big(x), 0.0).otherwise(x.cast("double") * SCALE)).cast("double")))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(cells: list[bytes], dim: int) -> np.ndarray:
    """Rows of doubles, short ones filled up with zeros."""
    if all(len(c) == 8 * dim for c in cells):
        return np.frombuffer(b"".join(cells), dtype=np.float64).reshape(-1, dim)
    out = np.zeros((len(cells), dim))
    for i, c in enumerate(cells):
        out[i, : len(c) // 8] = np.frombuffer(c, dtype=np.float64)
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 64 bits they stop at the largest or smallest long."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < 2**53:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(c) for c in row] for row in q.tolist()], dtype=object) @ np.array([[int(c) for c in row] for row in x.tolist()], dtype=object).T
    return np.clip(exact, 1 - 2**63, 2**63 - 1).astype(np.int64)


class Index:
    """Pivots, annuli and the sphere's radius; bounded by the configuration, not the data."""

    def __init__(self, dim: int, radius2: float, pivots: np.ndarray):
        self.dim, self.radius2, self.pivots = dim, radius2, pivots
        self.height = np.sqrt(np.maximum(0.0, radius2 - (pivots**2).sum(axis=1)))
        self.cells: list[tuple[int, float, float, int]] = []  # pivot, nearest, farthest, rows

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Distances to the pivots; a query lies in the plane of the original coordinates."""
        norm2 = (x**2).sum(axis=1)
        dot = x @ self.pivots.T
        if query:
            return np.sqrt(np.maximum(0.0, (norm2 + self.radius2)[:, None] - 2 * dot))
        up = np.sqrt(np.maximum(0.0, self.radius2 - norm2))
        return np.sqrt(np.maximum(0.0, 2 * self.radius2 - 2 * (dot + up[:, None] * self.height)))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The least distance of any point of each cell from each query."""
        pivot, near, far, _ = (np.array(c) for c in zip(*self.cells, strict=True))
        d = self.distances(q, query=True)[:, pivot.astype(int)]
        return np.maximum(0.0, np.maximum(d - far, near - d))


def _keyed(points: DataFrame, index: Index) -> DataFrame:
    """(row, vec_id, v, pivot, far) with the nearest pivot and the distance to it."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = index.distances(_matrix(batch.column(2).to_pylist(), index.dim), query=False)
            best = d.argmin(axis=1) if len(d) else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32)), pa.array(d[np.arange(len(d)), best])], ["row", "vec_id", "v", "pivot", "far"])

    return points.mapInArrow(key, "row long, vec_id long, v binary, pivot int, far double")


def _packed(scaled_rows: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(v, dtype=np.float64) for v in batch.column(1).to_pylist()]
            size = pa.array([float((v**2).sum()) for v in rows], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in rows], pa.binary()), size], ["vec_id", "v", "norm2"])

    return scaled_rows.mapInArrow(pack, "vec_id long, v binary, norm2 double")


def _celled(keyed: DataFrame, edges: list[np.ndarray], rings: int, number: np.ndarray | None = None) -> DataFrame:
    """``keyed`` with ``cell``: pivot and annulus as one number, or what ``number`` makes of it."""

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, far = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            ring = np.zeros(len(pivot), dtype=np.int64)
            for p in np.unique(pivot):
                ring[pivot == p] = np.searchsorted(edges[p], far[pivot == p], side="left")
            raw = pivot * rings + ring
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((raw if number is None else number[raw]).astype(np.int32))], [*batch.schema.names, "cell"])

    return keyed.mapInArrow(cell, "row long, vec_id long, v binary, pivot int, far double, cell int")


def _blocks(rows: DataFrame, sizes: list[int], size: int, *more: str) -> DataFrame:
    """(cell, part, ids, vs, rows, more): rows of a cell in parts of about ``size``, dealt by a hash of the row."""
    counts = F.broadcast(rows.sparkSession.createDataFrame([(i, parts_for(n, size)) for i, n in enumerate(sizes)], "cell int, __parts int"))  # a row a cell
    dealt = rows.join(counts, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("__parts")).cast("int"))
    lists = [F.collect_list(c).alias(n) for c, n in (("vec_id", "ids"), ("v", "vs"), ("row", "rows"), *((m, m) for m in more))]
    return dealt.groupBy("cell", "part").agg(*lists)


def _scan(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, index: Index, k: int) -> DataFrame:
    """(query, vec_id, score): each query's k best of all blocks that a task has met.

    ``pairs`` has (query block, query part, cell, part, wanted): which of the block's queries
    scan the part of the cell. Parts are met one by one, so a frequent vector's cell is
    spread over tasks.
    """
    met = pairs.join(queries.select("qblock", "qpart", "qrows", "qvs"), ["qblock", "qpart"]).join(blocks, ["cell", "part"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [np.empty((0, 3), dtype=np.int64)], 0

        def cut() -> np.ndarray:
            """The k best rows of each query held, ties to the smaller id."""
            x = np.concatenate(held)
            x = x[np.lexsort((x[:, 1], -x[:, 2], x[:, 0]))]
            begins = np.flatnonzero(np.r_[True, x[1:, 0] != x[:-1, 0]]) if len(x) else np.empty(0, dtype=np.int64)
            nth = np.arange(len(x)) - np.repeat(begins, np.diff(np.r_[begins, len(x)]))
            return x[nth < k]

        def out(x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[:, c]) for c in range(3)], ["query", "vec_id", "score"])

        for batch in batches:
            for n in range(batch.num_rows):
                wanted, qrows, qvs, ids, vs, rows = (batch.column(i)[n].as_py() for i in range(6))
                q, x = _matrix([qvs[i] for i in wanted], index.dim), _matrix(vs, index.dim)
                asked, ids = np.array(qrows, dtype=np.int64)[wanted], np.array(ids, dtype=np.int64)
                scores, own = _products(q, x), asked[:, None] == np.array(rows, dtype=np.int64)[None, :]
                scores[own] = -(2**63)
                # All that reach the k-th score of their query, ties too.
                least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(asked), -(2**63))
                i, j = np.nonzero((scores >= least[:, None]) & ~own)
                held.append(np.column_stack([asked[i], ids[j], scores[i, j]]))
                n_held += len(i)
                if n_held >= HELD_ROWS:
                    held[:] = [cut()]
                    n_held = len(held[0])
                    if n_held >= HELD_ROWS // 2:
                        yield out(held[0])
                        held, n_held = [np.empty((0, 3), dtype=np.int64)], 0
        yield out(cut())

    return met.select("wanted", "qrows", "qvs", "ids", "vs", "rows").mapInArrow(scan, "query long, vec_id long, score long")


def _best(scores: DataFrame, k: int) -> DataFrame:
    """(query, best): the k best scores of each query, first the highest, ties to the smaller id.

    A task gives a query k rows, but for those it had to let go in between. They are cut
    to k for every ``CUT_TASKS`` tasks first, so no list holds more than those tasks' rows
    or one for each such group.
    """
    entry = F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("vec_id"))
    first = lambda lists: F.slice(F.sort_array(lists), 1, k)
    some = scores.groupBy("query", F.floor(F.spark_partition_id() / CUT_TASKS).alias("tasks")).agg(first(F.collect_list(entry)).alias("best"))
    return some.groupBy("query").agg(first(F.flatten(F.collect_list("best"))).alias("best"))


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): exact top k of each row whose id is divisible by ``every``.

    Vectors that are null or hold null or non-finite components take no part; shorter
    ones, empty ones too, count as filled up with zeros. Every row is a query of its own
    where its id says so, and all other rows are its candidates, those of its own id too;
    so rows that are there twice are in each other's lists, and their lists come twice.
    Fewer than k candidates are all returned; no rows give no rows. Scores beyond 64 bits
    stop at the limit.
    """
    points = materialize(_packed(scaled(vectors)).select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", "norm2"), "points")
    n, dim, radius2 = points.agg(F.count("*"), F.max(F.length("v") / 8), F.max("norm2")).first()
    empty = points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    dim, cells_wanted = max(1, int(dim)), min(MAX_PIVOTS * MAX_RINGS, parts_for(n, CELL_ROWS))
    count = max(1, min(MAX_PIVOTS, round((cells_wanted * MAX_PIVOTS / MAX_RINGS) ** 0.5)))
    seeds = points.orderBy(F.xxhash64("vec_id"), "v").limit(count).select("v").collect()  # MAX_PIVOTS rows at most
    index = Index(dim, float(radius2), _matrix([bytes(r["v"]) for r in seeds], dim))
    rings = max(1, -(-cells_wanted // count))
    keyed = materialize(_keyed(points.select("row", "vec_id", "v"), index), "keyed")
    discard(points)
    edges = [np.empty(0)] * count
    if rings > 1:
        marks = [i / rings for i in range(1, rings)]
        for r in keyed.groupBy("pivot").agg(F.percentile_approx("far", marks, 1000).alias("edges")).collect():  # pivots x rings
            edges[r["pivot"]] = np.unique(np.array(r["edges"], dtype=np.float64))
    found = _celled(keyed, edges, rings).groupBy("cell").agg(F.min("far").alias("near"), F.max("far").alias("far"), F.count("*").alias("n")).orderBy("cell").collect()  # pivots x rings
    index.cells = [(r["cell"] // rings, r["near"], r["far"], r["n"]) for r in found]
    number = np.zeros(count * rings, dtype=np.int64)
    number[[r["cell"] for r in found]] = np.arange(len(found))
    celled, sizes = _celled(keyed, edges, rings, number).select("row", "vec_id", "v", "cell"), [r["n"] for r in found]
    blocks = materialize(_blocks(celled, sizes, BLOCK_ROWS), "blocks")
    # Equal rows ask the same: one of them asks for all. A query block holds queries of one cell, so that they want the same annuli.
    asking = celled.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.min("row").alias("row"), F.min("cell").alias("cell"), F.count("*").alias("times"))
    queries = _blocks(asking, sizes, QUERY_ROWS, "times")
    queries = materialize(queries.select(F.col("cell").alias("qblock"), F.col("part").alias("qpart"), F.col("rows").alias("qrows"), F.col("ids").alias("qids"), F.col("vs").alias("qvs"), "times"), "queries")
    discard(keyed)
    slack = 1e-6 * (1.0 + radius2**0.5)
    parts = [parts_for(size, BLOCK_ROWS) for size in sizes]

    def choose(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.schema.names
                for n in range(batch.num_rows):
                    row = {c: batch.column(i)[n].as_py() for i, c in enumerate(names)}
                    q = _matrix(row["qvs"], index.dim)
                    low = index.bounds(q)
                    order = np.argsort(low, axis=1, kind="stable")[:, :FIRST_CELLS]
                    early = np.zeros(low.shape, dtype=bool)
                    np.put_along_axis(early, order, True, axis=1)
                    if first:
                        wanted = early
                    else:
                        # A cell is out of reach if its best possible score is below the k-th so far.
                        kth = np.array([-np.inf if s is None else float(s) for s in row["kth"]])
                        reach = ((q**2).sum(axis=1) + index.radius2)[:, None] - np.maximum(0.0, low - slack) ** 2
                        wanted = ~early & (reach / 2 + slack >= kth[:, None])
                    rows = [(c, p, np.flatnonzero(wanted[:, c]).tolist()) for c in np.flatnonzero(wanted.any(axis=0)).tolist() for p in range(parts[c])]
                    size = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["qblock"]] * size, pa.int32()), pa.array([row["qpart"]] * size, pa.int32()), pa.array([c for c, _, _ in rows], pa.int32()), pa.array([p for _, p, _ in rows], pa.int32()), pa.array([w for _, _, w in rows], pa.list_(pa.int32()))],
                        ["qblock", "qpart", "cell", "part", "wanted"],
                    )

        return run

    schema = "qblock int, qpart int, cell int, part int, wanted array<int>"
    asked = queries.select("qblock", "qpart", "qvs")
    one = materialize(_best(_scan(asked.mapInArrow(choose(True), schema), queries, blocks, index, k), k), "first")
    # The k-th score of each query, in the order of its block.
    spread = queries.select("qblock", "qpart", F.posexplode("qrows").alias("i", "query"))
    kth = F.when(F.size("best") >= k, -F.get("best", k - 1)["minus"])
    known = spread.join(one.select("query", kth.alias("kth")), "query", "left")
    lists = known.groupBy("qblock", "qpart").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "kth"))), lambda s: s["kth"]).alias("kth"))
    two = _scan(asked.join(lists, ["qblock", "qpart"]).mapInArrow(choose(False), schema), queries, blocks, index, k)
    earlier = one.select("query", F.inline("best")).select("query", "vec_id", (-F.col("minus")).alias("score"))
    best = _best(earlier.unionByName(two), k).select("query", F.posexplode("best").alias("rank", "b"))
    asks = queries.select(F.inline(F.arrays_zip(F.col("qrows").alias("query"), F.col("qids").alias("query_id"), "times")))
    ranked = best.join(asks, "query").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
