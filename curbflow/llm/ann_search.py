"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component so that the largest inner product is the
smallest distance, and are put into lists by nearest centroid. Within each
probed list the rotated vectors are compared block of columns by block of
columns; after each block a hypothesis test on the distance so far abandons
candidates that would hardly come below the query's bound. What is left is
scored exactly in double precision.

Lists are cut into shards and their queries into blocks, so that no task holds
more than a bounded part of a list whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbflow.llm.common import map_arrow
from curbflow.session import cut_lineage

# Vectors that centroids, probes and bounds are fitted on, at most. Every vector is in the index.
SAMPLE = 20_000
# Lists grow with the root of the table up to so many, with so many sampled vectors a list at least.
MOST_LISTS, SAMPLED_A_LIST = 1024, 16
# Sampled vectors that a query's bound is taken from.
SEEDS = 8192
# Share of the sample's true neighbours that the probed lists must hold.
TARGET = 0.97
SHARD, BLOCK = 4096, 1024
COLUMNS = 16
# Standard errors that the distance so far must be off by before a candidate is abandoned.
DOUBT = 2.1


@dataclass
class Index:
    """What tasks need to know of all vectors; of bounded size."""

    longest: float
    rotation: np.ndarray
    centroids: np.ndarray
    seed_ids: np.ndarray
    seeds: np.ndarray
    seed_lists: np.ndarray
    probes: int
    k: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes all equally long."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x.astype(float) ** 2).sum(axis=1), 0))
        return np.c_[x, rest].astype(np.float32)

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return nearest(self.lifted(x), self.centroids)

    def order(self, q: np.ndarray) -> np.ndarray:
        """Lists from the nearest on."""
        far = (self.centroids**2).sum(axis=1)[None] - 2 * q @ self.centroids[:, :-1].T
        return np.argsort(far, axis=1, kind="stable")

    def asked(self, ids: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each query a score that its k-th neighbour has at least, and the lists to probe.

        As many lists more than usual are probed as it takes to meet k sampled vectors; the score is that of the k-th
        best sampled vector of these lists, so that k are found."""
        order = self.order(q)
        place = np.argsort(order, axis=1)[:, self.seed_lists]
        other = ids[:, None] != self.seed_ids[None]
        enough = min(self.k, len(self.seeds))
        reach = np.partition(np.where(other, place, len(self.centroids) - 1), enough - 1, axis=1)[:, enough - 1] + 1
        probes = np.maximum(reach, self.probes)
        score = np.where(other & (place < probes[:, None]), q.astype(float) @ self.seeds.T.astype(float), -np.inf)
        floors = np.partition(score, -self.k, axis=1)[:, -self.k] if len(self.seeds) > self.k else np.full(len(q), -np.inf)
        return floors, [lists[:n] for lists, n in zip(order, probes)]


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = (centroids**2).sum(axis=1) / 2
    return np.concatenate([(half[None] - x[at : at + 4096] @ centroids.T).argmin(axis=1) for at in range(0, len(x), 4096)] or [np.zeros(0, int)])


def centroids_of(x: np.ndarray, lists: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    random = np.random.default_rng(seed)
    centers = x[random.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        home = nearest(x, centers)
        order = np.argsort(home, kind="stable")
        filled, starts = np.unique(home[order], return_index=True)
        centers[filled] = np.add.reduceat(x[order].astype(float), starts) / np.diff(np.r_[starts, len(x)])[:, None]
    return centers.astype(np.float32)


def fit(ids: np.ndarray, x: np.ndarray, total: int, longest: float, k: int, target: float = TARGET) -> Index:
    """Centroids, rotation and probes from sampled vectors; ``total`` is the number of all vectors."""
    lists = int(np.clip(np.sqrt(total) / 2, 1, min(MOST_LISTS, max(1, len(x) // SAMPLED_A_LIST))))
    turned = np.linalg.qr(np.random.default_rng(2).normal(size=(x.shape[1] + 1,) * 2))[0].astype(np.float32)
    index = Index(longest, turned, np.zeros((1, x.shape[1] + 1), np.float32), ids[:SEEDS], x[:SEEDS], np.zeros(0, int), lists, k)
    lifted = index.lifted(x)
    index.centroids = centroids_of(lifted, lists)
    # The fewest lists that hold enough of the sample's own neighbours.
    asked = np.random.default_rng(3).choice(len(x), min(len(x), 400), replace=False)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-score, axis=1)[:, : max(1, min(k, len(x) - 1))]
    home = nearest(lifted, index.centroids)
    index.seed_lists = home[:SEEDS]
    found = np.take_along_axis(np.argsort(index.order(x[asked]), axis=1), home[best], axis=1)
    index.probes = int(np.quantile(found, target, method="higher")) + 1
    return index


def vectors_of(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def scanned(index: Index, q: np.ndarray, floors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that the scan doesn't abandon."""
    turned_q = np.c_[q, np.zeros(len(q), np.float32)] @ index.rotation
    turned_x = index.lifted(x) @ index.rotation
    width = turned_x.shape[1]
    bound = np.maximum((q.astype(float) ** 2).sum(axis=1) + index.longest**2 - 2 * floors, 0)
    far, rows, cols = np.zeros((len(q), len(x)), np.float32), None, None
    for start in range(0, width, COLUMNS):
        stop = min(width, start + COLUMNS)
        a, b = turned_q[:, start:stop], turned_x[:, start:stop]
        if rows is None:
            far += (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T
        else:
            far += ((a[rows] - b[cols]) ** 2).sum(axis=1)
        # The part seen of the distance, scaled up, against the bound and its doubt; all columns seen, rounding alone.
        slack = (1 + DOUBT / np.sqrt(stop)) ** 2 * stop / width if stop < width else 1 + 1e-4
        limit = (bound * slack + 1e-4 * index.longest**2).astype(np.float32)
        near = far <= (limit[:, None] if rows is None else limit[rows])
        if rows is not None:
            rows, cols, far = rows[near], cols[near], far[near]
        elif near.mean() < 0.1 or stop == width:  # few are left: go on with them alone
            rows, cols = np.nonzero(near)
            far = far[rows, cols]
        else:
            far[~near] = np.inf
    return rows, cols


def best_of_cell(index: Index, vectors: pa.Table, queries: pa.Table) -> pa.Table:
    """The best of the vectors of a cell for each of its queries."""
    dim = index.rotation.shape[0] - 1
    q, x = vectors_of(queries["embedding"], dim), vectors_of(vectors["embedding"], dim)
    q_ids, x_ids, floors = queries["vec_id"].to_numpy(), vectors["vec_id"].to_numpy(), queries["floor"].to_numpy()
    rows, cols = scanned(index, q, floors, x) if len(q) and len(x) else (np.zeros(0, int), np.zeros(0, int))
    other = q_ids[rows] != x_ids[cols]
    rows, cols = rows[other], cols[other]
    score = np.concatenate(
        [np.einsum("ij,ij->i", q[rows[at : at + 100_000]].astype(float), x[cols[at : at + 100_000]].astype(float)) for at in range(0, len(rows), 100_000)]
        or [np.zeros(0)]
    )
    good = score >= floors[rows] - 1e-6
    rows, cols, score = rows[good], cols[good], score[good]
    order = np.lexsort((x_ids[cols], -score, rows))
    rows, cols, score = rows[order], cols[order], score[order]
    first = np.searchsorted(rows, rows, "left")
    top = np.arange(len(rows)) - first < index.k
    return pa.table({"query_id": q_ids[rows[top]], "vec_id": x_ids[cols[top]], "score": score[top]})


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Rows (vec_id, embedding) that take part, one per vec_id, and their dimension."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("embedding"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0
    return rows.where(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), dim


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each vector whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Score is the inner product of the vectors as they are, in double precision; ties go to the smaller vec_id.
    Vectors that are null, zero, of another than the most usual dimension, or hold null or non-finite components
    take no part, as rows without vec_id; of repeated rows of one vec_id one counts. Fewer candidates than k give
    fewer rows; an empty table gives none. Other columns are ignored, whatever their names.
    """
    rows, dim = usable(vectors, key, vector)
    rows = cut_lineage(rows)
    length = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    total, longest = rows.agg(F.count("*"), F.max(length)).first()
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], out)
    share = min(1.0, SAMPLE / total)
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else rows
    drawn = drawn.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not drawn.num_rows:
        drawn = rows.orderBy("vec_id").limit(SAMPLE).toArrow()
    index = fit(drawn["vec_id"].to_numpy(), vectors_of(drawn["embedding"], dim), total, float(np.sqrt(longest)), k)

    def into_lists():
        return lambda batch: {"list": index.list_of(vectors_of(batch.column("embedding"), dim))}

    def into_probes():
        def work(batch: pa.RecordBatch) -> dict:
            q = vectors_of(batch.column("embedding"), dim)
            parts = [index.asked(batch.column("vec_id").to_numpy()[at : at + 256], q[at : at + 256]) for at in range(0, len(q), 256)]
            return {"floor": np.concatenate([floors for floors, _ in parts]), "lists": [lists for _, part in parts for lists in part]}

        return work

    blank = F.lit("").alias("none")
    listed = cut_lineage(map_arrow(rows.select("*", blank), into_lists, "list int", "none", keep=True).drop("none"))
    asked = map_arrow(rows.where(F.col("vec_id") % every == 0).select("*", blank), into_probes, "floor double, lists array<int>", "none", keep=True)
    asked = cut_lineage(asked.select("vec_id", "embedding", "floor", "lists"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    found = cut_lineage(best(scored(index, listed, asked)))
    # A candidate that was abandoned in error may leave a query short; such queries are held against every vector.
    full = found.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= min(k, total - 1)).select("vec_id")
    short = cut_lineage(asked.join(full, "vec_id", "left_anti"))
    if total == 1 or short.isEmpty():
        return found
    every_list = F.sequence(F.lit(0), F.lit(len(index.centroids) - 1))
    again = best(scored(index, listed, short.withColumns({"floor": F.lit(float("-inf")), "lists": every_list})))
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*again.columns).unionByName(again)


def scored(index: Index, listed: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows (query_id, vec_id, score): the best of each cell of vectors for each query that probes its list."""
    # At most MOST_LISTS rows: how many shards a list is cut into, and its queries into how many blocks.
    sizes = listed.groupBy("list").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    calls = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cells = F.broadcast(cut_lineage(sizes.join(calls, "list")))
    part = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = (
        listed.join(cells, "list").withColumn("shard", part("shards", 1)).withColumn("block", every_one("blocks"))
        .select("list", "shard", "block", "vec_id", "embedding")
    )
    called = (
        asked.withColumn("list", F.explode("lists")).join(cells, "list").withColumn("block", part("blocks", 2)).withColumn("shard", every_one("shards"))
        .select("list", "shard", "block", "vec_id", "embedding", "floor")
    )
    cell = ["list", "shard", "block"]
    return stored.groupBy(*cell).cogroup(called.groupBy(*cell)).applyInArrow(
        lambda own, queries: best_of_cell(index, own, queries), "query_id long, vec_id long, score double"
    )
