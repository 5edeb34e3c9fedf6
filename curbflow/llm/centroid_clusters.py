"""Exact centroid clustering over dictionaries of subvectors.

Vectors of whole numbers are kept in chunks. A chunk's dimensions are cut into
blocks, and each block is a dictionary of its distinct subvectors and a code a
vector, which loses nothing. Once a round every subvector's exact squared
distances to the centroids' blocks are worked out; a vector's distance is the
sum of those of its codes. Sums for the next centroids come from the counts of
the codes by cluster.

Blocks start with one dimension and are joined in twos as long as that lowers
the number of distances to work out and to add up, so that chunks of spread
vectors get narrow blocks and chunks of repeated ones get wide blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbflow.llm.whole_numbers import floors, vectors
from curbflow.session import cut_lineage

# Vectors of a chunk, at most.
CHUNK = 32_768
CHUNKS = "ids array<bigint>, widths array<int>, sizes array<int>, subvectors binary, codes binary"


def dictionary(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a block of columns, and each row's place among them."""
    if block.shape[1] == 1:
        values, codes = np.unique(block[:, 0], return_inverse=True)
        return values[:, None], codes.reshape(-1)
    rows, codes = np.unique(block, axis=0, return_inverse=True)
    return rows, codes.reshape(-1)


def joined(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The dictionary of two blocks side by side, from theirs."""
    both, codes = np.unique(left[1] * len(right[0]) + right[1], return_inverse=True)
    return np.hstack([left[0][both // len(right[0])], right[0][both % len(right[0])]]), codes.reshape(-1)


def cost(block: tuple[np.ndarray, np.ndarray]) -> int:
    """Products to work out for each centroid, and distances to add up."""
    return block[0].size + len(block[1])


def blocks_of(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Dictionaries of blocks of dimensions, side by side."""
    blocks = [dictionary(x[:, j : j + 1]) for j in range(x.shape[1])]
    while len(blocks) > 1:
        pairs = [(blocks[j], blocks[j + 1]) for j in range(0, len(blocks) - 1, 2)]
        wider = [joined(*pair) for pair in pairs]
        if not any(cost(one) < cost(a) + cost(b) for one, (a, b) in zip(wider, pairs)):
            break
        after = []
        for one, (a, b) in zip(wider, pairs):
            after += [one] if cost(one) < cost(a) + cost(b) else [a, b]
        blocks = after + blocks[2 * len(pairs) :]
    return blocks


def as_chunk(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    blocks = blocks_of(x)
    row = {
        "ids": [ids], "widths": [[b.shape[1] for b, _ in blocks]], "sizes": [[len(b) for b, _ in blocks]],
        "subvectors": [b"".join(b.astype("<i8").tobytes() for b, _ in blocks)], "codes": [b"".join(c.astype("<u4").tobytes() for _, c in blocks)],
    }
    types = {"ids": pa.list_(pa.int64()), "widths": pa.list_(pa.int32()), "sizes": pa.list_(pa.int32()), "subvectors": pa.binary(), "codes": pa.binary()}
    return pa.RecordBatch.from_pydict({name: pa.array([v.to_pylist() if name == "ids" else v for v in row[name]], t) for name, t in types.items()})


def of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]]:
    """Ids and blocks of the chunks, one at a time."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(name)[r] for name in batch.schema.names}
            ids, widths, sizes = row["ids"].values, row["widths"].as_py(), row["sizes"].as_py()
            numbers = np.frombuffer(row["subvectors"].as_buffer(), "<i8")
            codes = np.frombuffer(row["codes"].as_buffer(), "<u4").reshape(len(widths), len(ids))
            blocks, at = [], 0
            for width, size, own in zip(widths, sizes, codes):
                blocks.append((numbers[at : at + width * size].reshape(size, width), own))
                at += width * size
            yield ids, blocks


def nearest(blocks: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (the first of equally near ones) and the squared distance."""
    far, at = np.zeros((len(blocks[0][1]), len(centroids)), np.int64), 0
    for subvectors, codes in blocks:
        width = subvectors.shape[1]
        part = np.zeros((len(subvectors), len(centroids)), np.int64)
        for j in range(width):
            part += (subvectors[:, j, None] - centroids[None, :, at + j]) ** 2
        far += part[codes]
        at += width
    home = far.argmin(axis=1)
    return home, far[np.arange(len(far)), home]


def in_chunks(rows: DataFrame, dim: int, scale: int, most: int) -> DataFrame:
    """Chunks of the vectors of ``rows`` (vec_id, vector), each from one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if sum(b.num_rows for b in held) + part.num_rows > most:
                    yield whole(held)
                    held = []
                held.append(part)
        if sum(b.num_rows for b in held):
            yield whole(held)

    def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        return as_chunk(table["vec_id"].combine_chunks(), floors(table["vector"], dim, scale))

    return rows.select("vec_id", "vector").mapInArrow(run, CHUNKS)


def sums(chunks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By nearest centroid: how many vectors, the sum of their components, the sum of their distances."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, inertia, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, blocks in of_chunks(batches):
            home, far = nearest(blocks, centroids)
            count += np.bincount(home, minlength=k)
            np.add.at(inertia, home, far)
            at = 0
            for subvectors, codes in blocks:
                size, width = subvectors.shape
                often = np.bincount(home * size + codes, minlength=k * size).reshape(k, size)
                total[:, at : at + width] += often @ subvectors
                at += width
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(there, pa.int32()), "n": count[there], "inertia": inertia[there],
            "total": pa.array(total[there].tolist(), pa.list_(pa.int64())),
        })

    # One row a task and centroid; k rows of dim numbers come to the driver.
    parts = chunks.mapInArrow(run, "cluster int, n bigint, inertia bigint, total array<bigint>")
    added = F.array(*(F.sum(F.col("total")[j]) for j in range(dim))).alias("total")
    count, inertia, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), added).collect():
        count[row["cluster"]], inertia[row["cluster"]], total[row["cluster"]] = row["n"], row["inertia"], row["total"]
    return count, total, inertia


def first_centroids(rows: DataFrame, k: int, dim: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``seed`` and id, ascending; repeated ids by their components."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("place")
    drawn = rows.where("vec_id is not null").select(place, "vector").orderBy("place", "vector").limit(k).collect()
    return np.array([np.floor(np.array(row["vector"]) * scale) for row in drawn]).astype(np.int64).reshape(len(drawn), dim)


def clusters(
    df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
    key: str = "vec_id", vector: str = "embedding", chunk: int = CHUNK,
) -> DataFrame:
    """One row per vector kept: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``dim`` components, none null or non-finite; components are floor(scale * x). ``rounds`` times
    every vector goes to its nearest centroid (squared distance; ties to the smaller number) and every centroid with
    vectors becomes floor(sum / count) of them; then vectors are assigned once more. Null vectors take no part.
    Repeated rows are vectors of their own. Rows without vec_id are kept, and never a first centroid; without any first
    centroid, as in an empty table, there are no rows. Fewer vectors than ``k`` are fewer centroids. Other columns are
    ignored, whatever their names. A component beyond 2^25 once scaled is an error.
    """
    rows = vectors(df, key, vector).where(F.size("vector") == dim)
    centroids = first_centroids(rows, k, dim, seed, scale)
    out = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], out)
    chunks = cut_lineage(in_chunks(rows, dim, scale, chunk))
    for _ in range(rounds):
        count, total, _ = sums(chunks, centroids)
        filled = count > 0
        centroids = centroids.copy()
        centroids[filled] = total[filled] // count[filled, None]
    inertia = sums(chunks, centroids)[2]
    digests = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in of_chunks(batches):
            home, far = nearest(blocks, centroids)
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids, "cluster": pa.array(home, pa.int32()), "distance": far, "cluster_inertia": inertia[home],
                "inertia": np.full(len(home), inertia.sum()), "centroid_sha256": digests[home],
            })

    return chunks.mapInArrow(run, out)


def oracle(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same in SQL, round by round."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT r, c, list_sum(list_transform(list_zip(kept.v, c{n}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{n}) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""u{n} AS MATERIALIZED (
  SELECT c, list(m ORDER BY j) AS v FROM (
    SELECT best.c AS c, j, CAST(floor(CAST(sum(v[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM kept JOIN a{n} USING (r), range(1, {dim + 1}) t(j) GROUP BY best.c, j) GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c, coalesce(u{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN u{n} USING (c))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.c = best.c"""


ORACLE = oracle()
