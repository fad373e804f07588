"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from duelframe.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor re-reads the files instead of running
    the plan again, and values that depend on the partitioning (row numbers,
    run numbers) stay fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(filesystem, path) of a shared folder, for files Spark has no writer for."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20, rows: int = 10_000):
    """Slices of a batch whose texts hold about ``limit`` bytes each (one row at least, ``rows`` at most)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > limit or i - start == rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows at most for this session: 10,000 long texts would fill a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def merged_chunks(batches, column: str, limit: int):
    """Arrow batches put together or cut until their texts hold about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        for part in text_chunks(batch, column, limit):
            n = part.column(column).nbytes
            if held and size + n > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def tidy() -> None:
    """Gives a finished task's free memory back, as Spark keeps the worker: Arrow's
    pool, and (on glibc) what Python, numpy and the tokenizer have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
