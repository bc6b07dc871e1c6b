"""Shared helpers: typed Arrow batches, whole-table columns, small set hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
         "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
         "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
         "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}
#: Rows that a task holds as Python objects at a time; texts may be long.
SLICE_ROWS = 256


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow schema of a ``"name type, name type"`` description."""
    return pa.schema([(f.split()[0], ARROW[f.split()[1]]) for f in schema.split(",")])


def map_rows(df: DataFrame, work: Callable, schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Apply ``work`` to slices of at most ``rows`` rows of every Arrow batch.

    ``work`` gets one Python list per column of ``df``, in order, and returns one
    sequence per column of ``schema``. Nothing is kept between slices.
    """
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                got = work(*[part.column(i).to_pylist() for i in range(part.num_columns)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(got, out, strict=True)], schema=out)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Session setting of the jobs on texts: an Arrow batch holds 4 MB instead of 64 MB.

    A task keeps one batch on each side of the Python boundary, so this bounds the
    memory that long texts take beside the heap.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; others are not read."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (uint64 in and out), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A per-task cache of bounded size: when full, it starts anew."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room(self) -> None:
        if len(self) > self.limit:
            self.clear()
