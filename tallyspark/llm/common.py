"""Shared helpers of the training-data operators.

Conventions of every operator here: a null ``text`` counts as the empty text,
extra input columns are ignored (only ``doc_id`` and ``text`` are read, so names
can't clash), an empty table gives an empty result, and rows that repeat a
``doc_id`` are treated as rows of their own unless an operator says otherwise.
"""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import shared_path
from tallyspark.sources.tables import table

#: The white space that separates words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage without a copy on one executor only: every later read
    works although executors were lost.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spark_python(spark: SparkSession) -> None:
    """Let Python workers import this package where they see the driver's copy of it.

    A cluster gets the package as ``--py-files`` or installed; then this path is just unused.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def give_back() -> None:
    """Return freed memory to the system; Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc has it
        if trim is not None:
            trim(0)


#: What a worker keeps between tasks of one kind: how to free it, by kind.
_kept: dict[str, Callable[[], None]] = {}


def keep_between_tasks(kind: str, free: Callable[[], None]) -> None:
    """Let ``free`` be called when a worker that lives on starts work of another kind."""
    _kept[kind] = free


def free_others(keeps: str) -> None:
    for kind, free in _kept.items():
        if kind != keeps:
            free()


def arrow_map(df: DataFrame, fn: Callable, schema: str, keeps: str = "") -> DataFrame:
    """``mapInArrow`` whose tasks can import this package and give their memory back at the end; keeps: the kind of what is kept."""
    spark_python(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_others(keeps)
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_docs(docs: DataFrame, schema: str, fn: Callable[[list, list], dict], raw: bool = False, keeps: str = "") -> DataFrame:
    """Apply ``fn(doc_ids, texts) -> {column: values}`` to whole texts, batch by batch; raw: texts as UTF-8 bytes."""
    out_schema = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in sliced(b):
                texts = part.column(1).cast(pa.binary()) if raw else part.column(1)
                got = fn(part.column(0).to_pylist(), texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], f.type) for f in out_schema], schema=out_schema)

    return arrow_map(id_text(docs), run, schema, keeps)


def sliced(batch: pa.RecordBatch, text_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices with at most ``text_bytes`` of text in column 1 (at least one row each)."""
    n = batch.num_rows
    if not n:
        return
    offsets = text_offsets(batch.column(1))
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + text_bytes, "right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def text_offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and where each text starts (one more at the end)."""
    offsets = text_offsets(col)
    if col.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets * 0
    raw = np.frombuffer(col.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0])
    return raw, offsets - offsets[0]


_ARROW = {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
          "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def pa_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat ``name type, ...`` list."""
    def kind(t: str) -> pa.DataType:
        if t.startswith("array<"):
            return pa.list_(kind(t[6:-1]))
        return _ARROW[t]
    return pa.schema([pa.field(n, kind(t)) for n, t in (x.split() for x in ddl.split(","))])
