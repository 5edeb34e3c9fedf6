"""What the operators of this folder share: reading tables, cutting batches, folds."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

import curbflow
from curbflow.session import ensure_checkpoint_dir

# Code of this package travels with the job: executors need no copy of it.
cloudpickle.register_pickle_by_value(curbflow)

# Text bytes that a task holds unpacked at once; a longer single text comes alone.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table holds."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All text bytes of a batch end to end, and where each text starts (one more entry than texts)."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def give_back() -> None:
    """Give freed memory back to the system. Workers wait for their next task, of any operator, and would keep what the last one freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(
    df: DataFrame, build: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, column: str = "text", keep: bool = False
) -> DataFrame:
    """Run a function over slices of the rows. ``build`` runs once a task and returns the function,
    which gives the columns of ``schema`` for one slice. With ``keep`` all columns of ``df`` stay beside them."""
    made = T._parse_datatype_string(schema)
    struct = T.StructType([*df.schema.fields, *made.fields]) if keep else made
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        part = out = values = None
        for part in slices(batches, column):
            out = work(part)
            values = [*part.columns, *(out[f.name] for f in made)] if keep else [out[f.name] for f in made]
            yield pa.RecordBatch.from_arrays(
                [v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type) for f, v in zip(arrow, values)],
                schema=arrow,
            )
        del work, part, out, values
        give_back()

    return df.mapInArrow(run, struct)


def beside_rows(docs: DataFrame, build: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, text: str = "text") -> DataFrame:
    """Column row, a struct of all columns of ``docs``, and the columns of ``schema``, which no name in ``docs`` can clash with.

    The work gets a batch with the column text, which is taken out of the struct in the task, so that it travels once."""
    made = T._parse_datatype_string(schema)
    held = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    struct = T.StructType([*held.schema.fields, *made.fields])
    arrow, place = to_arrow_schema(struct), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        batch = texts = part = out = values = None
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), [place]).cast(pa.string())
            for part in slices(iter([pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"])])):
                out = work(part)
                values = [part.column("row"), *(out[f.name] for f in made)]
                yield pa.RecordBatch.from_arrays(
                    [v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type) for f, v in zip(arrow, values)],
                    schema=arrow,
                )
        del work, batch, texts, part, out, values
        give_back()

    return held.mapInArrow(run, struct)


def blank_parts(batch: pa.RecordBatch, column: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """The texts of a batch cut at blanks: the distinct parts, the place among them of each part in order, and where each
    text's parts start (one more entry than texts). Whatever never reaches over a blank can be worked out once a distinct part."""
    parts = pc.split_pattern(pc.fill_null(batch.column(column), ""), " ")
    coded = pc.dictionary_encode(parts.flatten())
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]


# Bytes up to which a settled side of a join is sent to all tasks; larger sides are shuffled.
SENT_BYTES = 16 << 20


def table_bytes(df: DataFrame) -> int:
    """About the bytes of a settled frame's rows, texts and arrays by their length."""

    def size(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(column)
        if isinstance(field.dataType, T.ArrayType):
            return F.greatest(F.size(column), F.lit(0)) * 16
        return F.lit(16)

    return df.agg(F.sum(sum((F.coalesce(size(field), F.lit(0)).cast("long") for field in df.schema.fields), F.lit(16)))).first()[0] or 0


def written(df: DataFrame) -> DataFrame:
    """Rows written as a table in the folder for checkpoints, which all executors share, and read again.

    Cuts lineage like a checkpoint, and takes less room: columns are compressed, and only those asked for are read."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(df: DataFrame) -> DataFrame:
    """Broadcast a settled frame if it has few bytes."""
    return F.broadcast(df) if table_bytes(df) <= SENT_BYTES else df


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: tuple[int, int], learn) -> DataFrame:
    """Rows (doc_id, text, label 0 or 1) of at most ``per_label`` labelled documents of label 0 and of label 1.

    ``learn`` is a condition on a key column. Keys are drawn by a hash; a key labelled both ways is left out.
    The drawn keys are few whatever the size of the tables, so they go to each task.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("doc_id", "label", F.xxhash64("doc_id", F.lit(11)).alias("place"))
    )
    drawn = [known.where(F.col("label") == kind).orderBy("place", "doc_id").limit(per_label[kind]) for kind in (0, 1)]
    return keyed_texts(docs).join(F.broadcast(drawn[0].unionByName(drawn[1]).drop("place")), "doc_id")
