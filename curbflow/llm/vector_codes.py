"""Vector code compression: each part of a vector becomes the index of the nearest entry of that part's codebook.

Parts are whole numbers, and distances to the entries are exact. Their dot
products are float64 matrix products of limbs: numbers are cut into limbs so
narrow that a sum of products stays below 2^53, where float64 is exact, and the
products are put together in int64. The first of equally near entries counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbflow.llm.common import sent_if_small
from curbflow.llm.whole_numbers import floors, vectors
from curbflow.session import cut_lineage

# Parts compared with a codebook at a time.
BLOCK = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb for which ``width`` products of two of them add up to less than 2^53."""
    return (52 - max(0, width - 1).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of whole numbers, the lowest first; the highest has the sign. Small numbers have one limb."""
    out, most = [], 1 << bits
    while True:
        if not x.size or (x.min() >= -most and x.max() < most):
            return [*out, x.astype(np.float64)]
        out.append((x & (most - 1)).astype(np.float64))
        x = x >> bits


def dot_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of whole numbers, exact as long as the results fit 64 bits."""
    bits = limb_bits(x.shape[1])
    out = np.zeros((len(x), len(y)), np.int64)
    right = [b.T for b in limbs(y, bits)]
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += (a @ b).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row, and the squared distance."""
    own = (entries**2).sum(axis=1)
    home, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), BLOCK):
        part = x[at : at + BLOCK]
        distance = own[None] - 2 * dot_products(part, entries)
        home[at : at + BLOCK] = distance.argmin(axis=1)
        far[at : at + BLOCK] = distance.min(axis=1) + (part**2).sum(axis=1)
    return home, far


def batches_of(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, floors(batch.column("vector"), dim, scale)


def renewed(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """Codebooks (part, entry, component) after one round."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, x in batches_of(batches, parts * width, scale):
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                home = nearest(own, books[p])[0]
                count[p] += np.bincount(home, minlength=entries)
                np.add.at(total[p], home, own)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": count[part, entry],
            "total": pa.array(total[part, entry].tolist(), pa.list_(pa.int64())),
        })

    # One row a task and entry; parts x entries rows come to the driver.
    sums = rows.select("vector").mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    added = F.array(*(F.sum(F.col("total")[j]) for j in range(width))).alias("total")
    after = books.copy()
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), added).collect():
        after[row["part"], row["entry"]] = np.array(row["total"], np.int64).reshape(width) // row["n"]
    return after


def first_books(rows: DataFrame, parts: int, entries: int, width: int, scale: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids; repeated ids by their components."""
    drawn = rows.where("vec_id is not null").select("vec_id", "vector").orderBy("vec_id", "vector").limit(entries).collect()
    x = np.array([np.floor(np.array(row["vector"]) * scale) for row in drawn]).astype(np.int64).reshape(len(drawn), parts, width)
    return x.transpose(1, 0, 2).copy()


def codes(
    df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per vector kept: vec_id, code, error, label_error, codebooks_sha256.

    Kept are vectors without null or non-finite components, of the table's most usual length among those that ``parts``
    divides (ties: the shorter; all vectors of a table should have one length). Components are floor(scale * x). Each
    part's codebook starts as that part of the ``entries`` (256 at most) smallest vec_ids; ``rounds`` times each entry with parts becomes
    floor(sum / count) of them; then parts are assigned again. code has two hexadecimal digits a part; label_error adds
    the errors of equal labels, of null labels too. Null vectors take no part. Repeated rows are vectors of their own.
    Rows without vec_id are kept, and never a first entry; without a first entry, as in an empty table, there are no
    rows. Fewer vectors than ``entries`` are fewer entries. Other columns are ignored, whatever their names. A component
    beyond 2^25 once scaled is an error.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits a part, so entries are 256 at most")
    rows = vectors(df, key, vector, label).withColumnRenamed(label, "label")
    size = F.size("vector")
    usual = rows.where(size % parts == 0).groupBy(size.alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    out = "vec_id bigint, code string, error bigint"
    dim = usual[0]["dim"] if usual else 0
    rows = rows.where(size == dim)
    books = first_books(rows, parts, entries, dim // parts, scale)
    for _ in range(rounds if books.shape[1] else 0):
        books = renewed(rows, books, scale)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    hexadecimal = np.array([f"{i:02x}" for i in range(256)])
    width = dim // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in batches_of(batches, dim, scale):
            if not books.shape[1]:
                continue
            found = [nearest(x[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            code = ["".join(digits) for digits in zip(*(hexadecimal[home] for home, _ in found))]
            made = {"code": pa.array(code, pa.string()), "error": pa.array(sum(far for _, far in found), pa.int64())}
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *made.values()], ["vec_id", "label", *made])

    kind = dict(rows.dtypes)["label"]
    coded = cut_lineage(rows.select("vec_id", "label", "vector").mapInArrow(run, out.replace(", code", f", label {kind}, code")))
    by_label = cut_lineage(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"))
    whole = coded.join(sent_if_small(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return whole.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, dim: int = 64) -> str:
    """The same in SQL for vectors of ``dim`` components, round by round."""
    width = dim // parts
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (SELECT r, p, v[p * {width} + 1 : (p + 1) * {width}] AS v FROM kept, range(0, {parts}) t(p)),
e0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, kept.v) - 1 AS e, cut.v FROM cut JOIN kept USING (r)
  WHERE r IN (SELECT r FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id, v LIMIT {entries}))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT r, p, e, list_sum(list_transform(list_zip(cut.v, e{n}.v), lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT AS d
    FROM cut JOIN e{n} USING (p)) GROUP BY r, p)""")
        if n < rounds:
            steps.append(f"""u{n} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY j) AS v FROM (
    SELECT p, best.e AS e, j, CAST(floor(CAST(sum(v[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM cut JOIN a{n} USING (r, p), range(1, {width + 1}) t(j) GROUP BY p, best.e, j) GROUP BY p, e),
e{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(u{n}.v, e{n}.v) AS v FROM e{n} LEFT JOIN u{n} USING (p, e))""")
    return f"""WITH {", ".join(steps)},
coded AS MATERIALIZED (
  SELECT r, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM e{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


ORACLE = oracle()
