"""Scratch tables in the cluster's shared folder and packed blocks of rows.

Several operators work on *blocks*: runs of documents of a few MB, compressed
into one binary value and written once. Tasks compute on a block with array
arithmetic and exchange packed arrays of keys with the other blocks through
Spark's shuffle. A block is read from the written table each time, so a lost
executor costs a re-read and never changes a block's content.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_SCHEMA = "block long, raw long, rows long, blob binary"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where
    it is unset and the master is local (as in tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: later uses
    neither recompute it nor depend on shuffle files of lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Fewer rows per Arrow batch than Spark's default of 10,000, so that a batch
    of long texts stays within a Python worker's memory. A session that sets its
    own value keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, byte planes apart."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)).astype(np.uint64))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def write_blocks(df: DataFrame, block_bytes: int, name: str) -> DataFrame:
    """The rows of ``df`` as a written table of blocks of about ``block_bytes``
    of Arrow data each (a longer row makes a longer block)."""
    small_batches(df.sparkSession)

    def blob(batches: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batches[0].schema) as writer:
            for batch in batches:
                writer.write_batch(batch)
        data = sink.getvalue()
        packed = zstandard.ZstdCompressor(level=6).compress(data)
        rows = sum(b.num_rows for b in batches)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([data.size], pa.int64()), pa.array([rows], pa.int64()),
             pa.array([packed], pa.binary())], ["block", "raw", "rows", "blob"])

    def cut(batches):
        first = TaskContext.get().partitionId() << 32
        held, size, made = [], 0, 0
        for batch in batches:
            per_row = max(1, batch.nbytes // max(1, batch.num_rows))
            step = max(1, block_bytes // (4 * per_row))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                held.append(part)
                size += part.get_total_buffer_size() if part.num_rows == batch.num_rows else per_row * part.num_rows
                if size >= block_bytes:
                    yield blob(held, first + made)
                    held, size, made = [], 0, made + 1
        if held:
            yield blob(held, first + made)

    return written(df.mapInArrow(cut, BLOCK_SCHEMA), name)


def open_block(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)) as reader:
        return reader.read_all()


def block_stats(blocks: DataFrame) -> tuple[int, int]:
    """Number of blocks and their bytes before compression."""
    row = blocks.agg(F.count("*"), F.coalesce(F.sum("raw"), F.lit(0))).first()
    return int(row[0]), int(row[1])


def part_bits(spark: SparkSession, raw_bytes: int, part_bytes: int) -> int:
    """Bits of a key that choose its exchange partition: partitions cover about
    ``part_bytes`` of input each and number no fewer than Spark's own."""
    parts = max(raw_bytes / part_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    return int(np.ceil(np.log2(parts)))
