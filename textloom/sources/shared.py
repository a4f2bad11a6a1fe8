"""Tables that cut a plan's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own in local mode (tests) and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        found = "file://" + (own := tempfile.mkdtemp(prefix="tables-"))
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written and read again: a lost executor costs a read, not the lineage."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
