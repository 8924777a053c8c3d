"""The latest state of each key from a stream, kept as a log of changes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lectern.operators.rows import top_per_key


def log_changes(stream: DataFrame, key: str, order: Column, values: list[str], folder: str) -> DataStreamWriter:
    """A writer, to be started, that logs each key's latest row whenever it changes.

    A batch writes only the keys that it changed, under its own number, so a batch that is
    run again after a failure replaces its own files and nothing is counted twice. State is one row a key.
    """
    latest = stream.groupBy(key).agg(F.max(F.struct(order.alias("_order"), *values)).alias("_row")).select(key, "_row.*")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/log/batch={number}")

    return latest.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").foreachBatch(write)


def current(log: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, values): the last state in the log of each key."""
    return top_per_key(log, [key], 1, F.col("batch").desc()).select(key, *values)


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one stream under the shared checkpoint folder; a local master may do without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-lectern-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"
