"""Trace operators over a stream of events."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.shared import shared_dir

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
RUNS = "user_id long, events long, errors long, longest_run long, current_run long, solved long"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


def hourly_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events per hour and type; rows later than the watermark are left out."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return rows.groupBy(F.window("at", "1 hour"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Events of a user without a gap."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return rows.groupBy("user_id", F.session_window("at", gap)).agg(F.count("*").alias("events"))


def error_runs(events: DataFrame) -> DataFrame:
    """Per user, with each batch: events, errors, the longest and the current run of errors, solutions. State: five numbers."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, errors, longest, run, solved = state.get if state.exists else (0, 0, 0, 0, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        error, purchase = (rows["event_type"] == "error").to_numpy(), (rows["event_type"] == "purchase").to_numpy()
        # errors since the last purchase, the run that goes on from the batch before included
        total = np.cumsum(error)
        since = np.maximum.accumulate(np.where(purchase, total, -run))
        runs = total - since
        n, errors, solved = n + len(rows), errors + int(error.sum()), solved + int(purchase.sum())
        longest, run = max(longest, int(runs.max(initial=0))), int(runs[-1]) if len(runs) else run
        state.update((n, errors, longest, run, solved))
        yield pd.DataFrame([(key[0], n, errors, longest, run, solved)], columns=[c.split()[0] for c in RUNS.split(", ")])

    return events.groupBy("user_id").applyInPandasWithState(step, RUNS, "n long, errors long, longest long, run long, solved long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, mode: str) -> DataFrame:
    """All that a stream has now, through a table in the folder that driver and executors share."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{base}/out")
