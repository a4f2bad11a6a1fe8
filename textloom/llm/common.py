"""What the operators of this subpackage share: table reads and lineage cuts."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The separators of words: 0x20 and 0x09-0x0D.
SEPARATORS = " \t\n\x0b\x0c\r"


#: Rows of one Arrow batch: documents are long, and a batch exists in the JVM and in Python at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold at most BATCH_ROWS rows: a setting is read when a plan runs, so it cannot be put back before."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, one of our own in local mode (tests) and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        found = "file://" + (own := tempfile.mkdtemp(prefix="textloom-"))
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written to the shared folder and read again: a lost executor costs a read, not the lineage."""
    path = f"{shared_dir(df.sparkSession)}/textloom/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


@functools.cache
def _allocator():
    """The C library's call that returns free memory, where it has one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow; when a task ends its worker gives free memory back, as reused workers wait beside those of later stages."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if _allocator():
                _allocator()(0)

    return whole
