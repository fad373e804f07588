"""Token-id binary output (9): Arrow files of fixed-size-list batches.

The ids of all documents, in ascending id order, are one stream.  Spark
range-partitions the texts by id; each task writes its share of the stream
as one Arrow IPC file whose rows are ``length`` ids and a mask (false only
in the padding of the last row).  All batches of a file have ``batch_rows``
rows but the last, so row r lies at row r % batch_rows of batch
r // batch_rows: a memory-mapped reader slices the values buffer of a batch
without copying.  A file appears under its final name only when complete, so
a task that is run again replaces it by the same bytes.

The index (one row per document: file, first id, number of ids) is a Parquet
table beside the files.  Where a document starts in the whole stream is its
place in the file plus the ids of all files before it.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import merged_chunks, open_fs, small_batches, tidy
from duelframe.llm.tokens import encoder

INDEX = "dfx_id long, dfx_file string, dfx_part int, first long, n_tokens long"


def sequence_schema(length: int, width: str = "uint16") -> pa.Schema:
    ids = pa.uint16() if width == "uint16" else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(ids, length)), pa.field("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a stream of ids into rows of equal length and writes full batches."""

    def __init__(self, sink, length: int, batch_rows: int, width: str):
        self.length, self.rows, self.dtype = length, batch_rows, np.dtype(width)
        self.writer = pa.ipc.new_file(sink, sequence_schema(length, width))
        self.held: list[np.ndarray] = []
        self.n = self.written = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n += len(ids)
        step = self.length * self.rows
        if self.n >= step:
            flat = np.concatenate(self.held)
            whole = len(flat) // step * step
            for at in range(0, whole, step):
                self._batch(flat[at:at + step], step)
            self.held, self.n = [flat[whole:].copy()], len(flat) - whole

    def _batch(self, flat: np.ndarray, real: int) -> None:
        rows = len(flat) // self.length
        mask = np.zeros(len(flat), bool)
        mask[:real] = True
        ids = pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length)
        keep = pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)
        self.writer.write_batch(pa.RecordBatch.from_arrays([ids, keep], schema=self.writer_schema()))
        self.written += rows

    def writer_schema(self) -> pa.Schema:
        return sequence_schema(self.length, self.dtype.name)

    def close(self) -> None:
        if self.n:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-self.n // self.length) * self.length, self.dtype)
            padded[:self.n] = flat
            self._batch(padded, self.n)
        self.writer.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = 2048,
                      batch_rows: int = 64, width: str = "uint16", id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Writes the files under ``folder`` and returns the index, read back from there.

    Null texts are empty: their ids are the end id alone.  Rows with a null
    id come first; rows that repeat an id follow one another in the order
    of their texts.  ``width`` must hold the vocabulary's largest id.  An
    empty table writes an empty index and no file.
    """
    small_batches(docs.sparkSession)
    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("dfx_text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = (cols.repartitionByRange(parts, "dfx_id").sortWithinPartitions("dfx_id", F.xxhash64("dfx_text"))
            .withColumn("dfx_part", F.spark_partition_id()))

    def run(batches):
        code, writer = encoder(tokenizer), None
        fs, top = open_fs(folder)
        for part in merged_chunks(batches, "dfx_text", 8 << 20):
            if writer is None:
                pid, first = part.column(2)[0].as_py(), 0
                name = f"ids-{pid:06d}.arrow"
                draft = f"{top}/.{name}.{uuid.uuid4().hex}"
                fs.create_dir(top, recursive=True)
                sink = fs.open_output_stream(draft)
                writer = SequenceWriter(sink, length, batch_rows, width)
            ids, bounds = code.encode(part.column(1), end_id)
            writer.add(ids)
            n = np.diff(bounds)
            k = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([name] * k), pa.array([pid] * k, pa.int32()),
                 pa.array(first + bounds[:-1]), pa.array(n)], names=[f.split()[0] for f in INDEX.split(", ")])
            first += int(bounds[-1])
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(draft, f"{top}/{name}")
        tidy()

    index = f"{folder.rstrip('/')}/index"
    cols.mapInArrow(run, INDEX).write.option("compression", "zstd").parquet(index)
    return docs.sparkSession.read.schema(INDEX).parquet(index)


class TokenFile:
    """Random access to one file; a local path is memory-mapped and not copied."""

    def __init__(self, folder: str, name: str):
        fs, top = open_fs(folder)
        path = f"{top}/{name}"
        local = type(fs).__name__ == "LocalFileSystem" and os.path.exists(path)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batch_rows = len(self.reader.get_batch(0)) if self.reader.num_record_batches else 1
        self.at, self.batch = -1, None

    def _flat(self, b: int) -> np.ndarray:
        if self.at != b:
            self.at, self.batch = b, self.reader.get_batch(b)
        column = self.batch.column(0)
        return column.values.to_numpy(zero_copy_only=True)[column.offset * self.length:]

    def row(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence r."""
        b, i = divmod(r, self.batch_rows)
        ids = self._flat(b)[i * self.length:(i + 1) * self.length]
        return ids, self.batch.column(1)[i].values.to_numpy(zero_copy_only=False)

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids of the file's stream from ``first`` on."""
        step, parts = self.length * self.batch_rows, []
        while n > 0:
            b, i = divmod(first, step)
            part = self._flat(b)[i:i + n]
            parts.append(part)
            first, n = first + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def close(self) -> None:
        self.source.close()


def read_documents(spark: SparkSession, folder: str, index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document read from the files: id, start, n_tokens, ids (little-endian uint32)."""
    def run(batches):
        name, file = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                out = []
                for f, first, n in zip(*(part.column(c).to_pylist() for c in ("dfx_file", "first", "n_tokens"))):
                    if f != name:
                        if file:
                            file.close()
                        name, file = f, TokenFile(folder, f)
                    out.append(file.ids(first, n).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("dfx_id"), part.column("start"), part.column("n_tokens"), pa.array(out, pa.binary())],
                    names=["dfx_id", "start", "n_tokens", "ids"])

    sizes = index.groupBy("dfx_part").agg(F.sum("n_tokens").alias("size"))      # one row per file
    base = sizes.select("dfx_part", (F.sum("size").over(Window.orderBy("dfx_part")) - F.col("size")).alias("base"))
    placed = index.join(F.broadcast(base), "dfx_part").withColumn("start", F.col("base") + F.col("first"))
    out = placed.select("dfx_id", "dfx_file", "first", "n_tokens", "start").mapInArrow(
        run, "dfx_id long, start long, n_tokens long, ids binary")
    return out.withColumnRenamed("dfx_id", id_col)
