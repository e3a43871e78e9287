"""Helpers of the corpus operators: tables, the shared folder, tokenizer files."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors reach: `spark.checkpoint.dir` of the session.

    Only a local session (tests) may leave it unset; it then gets a temporary folder. Elsewhere an
    unset folder is an error, since executors would write to their own disks.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cartwise-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Name of a new folder in the shared folder; the folder's owner clears it after the job."""
    return f"{shared_folder(spark)}/cartwise-{uuid.uuid4().hex}/{name}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(written: DataFrame) -> None:
    """Removes the files of a table that `write_table` returned and nothing reads any more."""
    context = written.sparkSession.sparkContext
    for file in {name.rsplit("/", 1)[0] for name in written.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(file)
        if path.getParent().getName().startswith("cartwise-"):  # a folder made by `new_folder`
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow` with this package made known to the Python workers of all executors."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "cartwise_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="cartwise-"), "cartwise_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("cartwise", os.path.relpath(full, top)))
        context.addPyFile(path)
        context.cartwise_shipped = True
    return df.mapInArrow(work, schema)


@contextlib.contextmanager
def steady_objects() -> Iterator[None]:
    """For loops that make many objects without cycles: the collector would only walk the caches over and over."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        pa.default_memory_pool().release_unused()


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file name, for tasks that write formats Spark has no writer for."""
    return fs.FileSystem.from_uri(uri)


def text_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings that lie one after the other in the data."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the strings, or binary values, and where each starts, with the end of the last; nulls are empty."""
    filled = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if not len(filled):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(filled.buffers()[1], np.int32)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


SLICE_BYTES = 4 << 20  # text that a Python worker takes at a time


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each; a longer text is a part of its own."""
    if batch.num_rows == 0:
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)
