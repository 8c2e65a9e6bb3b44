"""Helpers the operators share: row-local Arrow passes, staged tables, code-point offsets."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.session import staged  # noqa: F401 - the operators take it from here

# Rows that one Python call handles at a time; bounds the memory of a worker.
SLICE_ROWS = 256
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and text columns alone, so that no other column can clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def bundled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row``, a struct of all columns but the text, and ``text``; so no column's name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.struct(*rest, F.lit(0).alias("#")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))


def unbundled(df: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The columns that ``bundled`` packed, in their order, with the text as it is now."""
    return df.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns])


def held_out() -> Column:
    """Rows whose id the contracts keep out of training."""
    return F.expr("coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps that nothing refers to any more.

    It acts when the driver collects garbage, which a driver with little to do may
    put off for half an hour while the files fill the executors' disks.
    """
    for _ in range(2):  # what the first pass frees may hold what the second one finds
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def slices(batch: pa.RecordBatch, column: str | None = None) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of bounded rows and, measured on ``column``, bounded bytes."""
    step = SLICE_ROWS
    if column is not None and batch.num_rows:
        mean = batch.column(batch.schema.get_field_index(column)).nbytes / batch.num_rows
        step = max(1, min(step, int(SLICE_BYTES / max(mean, 1))))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def append_columns(df: DataFrame, fields: list[T.StructField], factory: Callable, text_col: str = "text") -> DataFrame:
    """Pass every row through and append computed columns, without a shuffle.

    ``factory()`` runs once per task and returns a function from a record batch
    to a list of Arrow arrays, one per field.  A field replaces a column of the
    same name; ``bundled`` keeps a caller's own columns out of the way.
    """
    names = [f.name for f in fields]
    base = df.drop(*names)
    schema = T.StructType(base.schema.fields + fields)

    def run(batches):
        step = factory()
        for batch in batches:
            for piece in slices(batch, text_col):
                arrays = list(piece.columns) + step(piece)
                yield pa.RecordBatch.from_arrays(arrays, names=piece.schema.names + names)

    return base.mapInArrow(run, schema)


def list_column(counts: list[int], values: pa.Array) -> pa.Array:
    """A list array from per-row lengths and the concatenated values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def span_column(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    """``array<struct<kind, start, end>>`` of each row's spans."""
    flat = [s for row in rows for s in row]
    values = pa.StructArray.from_arrays(
        [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.int32()),
         pa.array([s[2] for s in flat], pa.int32())], ["kind", "start", "end"])
    return list_column([len(r) for r in rows], values)


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType())]))
