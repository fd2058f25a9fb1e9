"""Approximate nearest neighbours with a hierarchical k-means tree searched best bin first.

The tree is fitted on the driver from at most `sample` vectors (those with the smallest hashed ids); its size is bounded by
that sample. Every vector of the table descends to the leaf of the nearest centres. A query walks the tree with a priority
queue of centres by distance, opening the nearest next, and visits leaves in that order; how many is calibrated: for
`probes` queries the exact neighbours are found by comparing them with every row, and the number of leaves is raised until
`recall` of those neighbours lie in visited leaves. A query goes on beyond that number while its leaves may hold too few
different ids.

Vectors and visiting queries meet in bins of about `bin_rows` vectors: small neighbouring leaves share a bin, and a leaf with
more is cut into bins by a hash of the id, so a vector that a third of all rows repeat fills many. Each bin compares a query with
the leaves it visits and returns the best `k`; the final order is taken over visited bins x k rows per query. Distances are Euclidean in double precision on the given components.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part, nor do those whose length
is not the most frequent one, nor rows without an id; rows with one id are one candidate at its nearest vector, and as a
query that id is asked with its smallest vector; equal distances go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lloyd(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Nearest of at most k centres for each point; centres start at different points."""
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = nearest(points, centres)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return nearest(points, centres)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


@dataclass
class Tree:
    """`children[i]` are the inner or leaf nodes below node i, `centres` one row per node; leaves are numbered by `leaf`."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray
    leaves: int = field(default=0)

    @classmethod
    def fit(cls, points: np.ndarray, branch: int = 8, leaf_size: int = 256, seed: int = 5) -> Tree:
        rng = np.random.default_rng(seed)
        centres, children, leaf, stack = [points.mean(0)], [np.zeros(0, int)], [-1], [(0, points)]
        while stack:
            node, rows = stack.pop()
            group = lloyd(rows, branch, rng) if len(rows) > leaf_size else np.zeros(len(rows), int)
            parts = [rows[group == g] for g in np.unique(group)]
            if len(parts) < 2:
                continue
            below = []
            for part in parts:
                below.append(len(centres))
                stack.append((len(centres), part))
                centres.append(part.mean(0))
                children.append(np.zeros(0, int))
                leaf.append(-1)
            children[node] = np.array(below)
        ends = [i for i, c in enumerate(children) if not len(c)]
        for number, i in enumerate(ends):
            leaf[i] = number
        return cls(np.array(centres), children, np.array(leaf), len(ends))

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point, by the nearest centre on every level."""
        out, stack = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            below = self.children[node]
            if not len(below):
                out[rows] = self.leaf[node]
                continue
            near = nearest(points[rows], self.centres[below])
            stack += [(int(b), rows[near == j]) for j, b in enumerate(below)]
        return out

    def visits(self, query: np.ndarray):
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not len(below):
                yield int(self.leaf[node])
                continue
            far = ((self.centres[below] - query) ** 2).sum(1)
            for d, b in zip(far.tolist(), below.tolist()):
                heapq.heappush(queue, (d, b))


def best(query: np.ndarray, own: int, ids: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest other ids, ties to the smaller id."""
    gap = points - query
    far = np.sqrt((gap * gap).sum(1))
    rows = np.flatnonzero(ids != own)
    while True:
        few = rows
        if len(rows) > 4 * k:
            few = rows[far[rows] <= np.partition(far[rows], 4 * k - 1)[4 * k - 1]]
        order = few[np.lexsort((ids[few], far[few]))]
        _, first = np.unique(ids[order], return_index=True)
        if len(first) >= k or len(few) == len(rows):
            order = order[np.sort(first)][:k]
            return ids[order], far[order]
        k_rows = ids[order]  # one id fills the near rows: look at it once and at all others again
        seen = np.isin(ids[rows], k_rows)
        rows = np.concatenate([order[np.sort(first)], rows[~seen]])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("v") == (size["size"] if size else 0))


def exact(rows: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """(query_id, vec_id, score) of a bounded list of queries against every row: the best k of each task, then of all."""

    def scan(batches):
        held = {q: (np.zeros(0, np.int64), np.zeros((0, 0))) for q, _ in queries}
        for batch in batches:
            ids, points = batch.column("id").to_numpy(), matrix(batch.column("v"))
            for q, vector in queries:
                old = held[q]
                near, _ = best(vector, q, ids, points, k)
                at = np.flatnonzero(np.isin(ids, near))
                both = np.concatenate([old[0], ids[at]]), np.vstack([old[1], points[at]]) if len(old[0]) else points[at]
                keep, _ = best(vector, q, both[0], both[1], k)
                at = np.flatnonzero(np.isin(both[0], keep))
                held[q] = both[0][at], both[1][at]
        for q, vector in queries:
            ids, points = held[q]
            if len(ids):
                near, far = best(vector, q, ids, points, k)
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(near), pa.int64()), pa.array(near), pa.array(far)], names=["query_id", "vec_id", "score"])

    return ranked(rows.mapInArrow(scan, "query_id bigint, vec_id bigint, score double"), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def calibrated_visits(tree: Tree, rows: DataFrame, probes: list[tuple[int, np.ndarray]], k: int, recall: float) -> int:
    """Number of leaves after which `recall` of the probes' exact neighbours have been visited."""
    asked = dict(probes)
    truth = exact(rows, probes, k).select("query_id", "vec_id").collect()  # probes x k rows
    wanted = F.broadcast(rows.sparkSession.createDataFrame([(r["vec_id"],) for r in truth] or [(None,)], "id bigint").distinct())
    where: dict[int, list[np.ndarray]] = {}
    for r in rows.join(wanted, "id").collect():  # the vectors of those neighbours
        where.setdefault(r["id"], []).append(np.array(r["v"]))
    turns = []
    for q in asked:
        order = {leaf: i + 1 for i, leaf in enumerate(tree.visits(asked[q]))}
        for vec in [r["vec_id"] for r in truth if r["query_id"] == q]:
            near = min(where[vec], key=lambda v: ((v - asked[q]) ** 2).sum())
            turns.append(order[int(tree.assign(near[None])[0])])
    return int(np.sort(turns)[max(0, int(np.ceil(recall * len(turns))) - 1)]) if turns else 1


def search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 100,
    k: int = 10,
    recall: float = 0.96,
    sample: int = 20_000,
    probes: int = 200,
    bin_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row whose id is divisible by `every`."""
    rows = usable(vectors, id_col, vector_col)
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    picked = rows.orderBy(F.xxhash64("id"), "v").limit(sample).collect()
    if not picked:
        return rows.selectExpr("id as query_id", "1 as rank", "id as vec_id", "0D as score").limit(0)
    tree = Tree.fit(np.array([r["v"] for r in picked]))
    asked = [(r["id"], np.array(r["v"])) for r in queries.orderBy(F.xxhash64("id")).limit(probes).collect()]
    visits = calibrated_visits(tree, rows, asked, k, recall)

    def place(batches):
        for batch in batches:
            leaf = tree.assign(matrix(batch.column("v"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), batch.column("id"), batch.column("v")], names=["leaf", "id", "v"])

    placed = rows.mapInArrow(place, "leaf bigint, id bigint, v array<double>")
    filled = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per leaf
    # ids counted in the smallest of their leaves: visited leaves hold at least as many different ids as these sums say
    owned = placed.groupBy("id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    different = {r["leaf"]: r["n"] for r in owned.collect()}  # one row per leaf
    shard, bins, held_rows, number = np.zeros(tree.leaves, np.int64), [1], 0, 0
    for leaf in range(tree.leaves):
        n = filled.get(leaf, 0)
        if held_rows and held_rows + n > bin_rows:
            held_rows, number = 0, number + 1
            bins.append(1)
        shard[leaf], held_rows = number, held_rows + n
        bins[number] = max(1, -(-held_rows // bin_rows))
    of_leaf = lambda table: F.element_at(F.lit([int(x) for x in table]), (F.col("leaf") + 1).cast("int")).cast("bigint")
    placed = placed.withColumn("bin", F.pmod(F.xxhash64("id"), of_leaf([bins[s] for s in shard]))).withColumn("shard", of_leaf(shard))

    def route(batches):
        for batch in batches:
            points, out = matrix(batch.column("v")), ([], [], [], [])
            for i in range(batch.num_rows):
                held, seen = 0, {}
                for turn, leaf in enumerate(tree.visits(points[i])):
                    if turn >= visits and held > 2 * k:
                        break
                    held += different.get(leaf, 0)
                    seen.setdefault(int(shard[leaf]), []).append(leaf)
                for s, leaves in seen.items():
                    for b in range(bins[s]):
                        for part, x in zip(out, (i, s, b, leaves)):
                            part.append(x)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int64()))]
                + [batch.column("id").take(at), batch.column("v").take(at)],
                names=["shard", "bin", "leaves", "id", "v"],
            )

    routed = queries.select("id", "v").mapInArrow(route, "shard bigint, bin bigint, leaves array<bigint>, id bigint, v array<double>")

    def compare(key, points, asked):
        out = ([], [], [])
        if points.num_rows and asked.num_rows:
            ids, table, leaf = points["id"].to_numpy(), matrix(points["v"].combine_chunks()), points["leaf"].to_numpy()
            for q, leaves, vector in zip(asked["id"].to_pylist(), asked["leaves"].to_pylist(), matrix(asked["v"].combine_chunks())):
                rows_in = np.flatnonzero(np.isin(leaf, leaves))
                near, far = best(vector, q, ids[rows_in], table[rows_in], k)
                for part, x in zip(out, (np.full(len(near), q), near, far)):
                    part.append(x)
        flat = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"query_id": pa.array(flat[0].astype(np.int64)), "vec_id": pa.array(flat[1].astype(np.int64)), "score": pa.array(flat[2].astype(np.float64))})

    grouped = placed.groupBy("shard", "bin").cogroup(routed.groupBy("shard", "bin"))
    return ranked(grouped.applyInArrow(compare, "query_id bigint, vec_id bigint, score double"), k)
