"""Shared helpers: reading tables, cutting lineage, batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
# Text that a Python task works on at a time, in bytes.
PIECE_BYTES = 1 << 20
# Python workers live on between tasks; with these, memory that a task has freed goes back
# to the system instead of staying with the worker.
_GIVE_BACK = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
              "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them from there: cuts lineage and
    outlives executors. Spark's own reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """As ``settle``, but as compressed Parquet: for rows that carry texts."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, body: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes, so long texts do not pile up.

    Workers started from here on find this package where the driver found it; on a
    cluster it is installed there or sent along with ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    for name, value in _GIVE_BACK.items():
        environment.setdefault(name, value)
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (environment.get("PYTHONPATH"), _ROOT)))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from body(batches)
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return what a task has freed to the system, as idle workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # not in every C library
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``limit`` bytes of text, one row at least."""
    start, held = 0, 0
    sizes = pa.compute.binary_length(batch.column(text)).to_pylist()
    for at, size in enumerate(sizes):
        size = size or 0
        if at > start and held + size > limit:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def n_words(text: Column) -> Column:
    """Words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_side(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """The side of a join, kept in the shared folder and measured there: broadcast up to
    ``max_bytes``, joined by a shuffle beyond."""
    kept = settle(df)
    width = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)).cast("long")
    total = kept.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(kept) if total <= max_bytes else kept
