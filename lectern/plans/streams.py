"""Queries that read a table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.registry import Tables, query
from lectern.streaming import latest


@query("""select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1""")
def streamed_latest(t: Tables) -> DataFrame:
    """The latest event of each user, from the events as a stream."""
    spark, values = t.spark, ["event_id", "event_type"]
    folder = latest.own_folder(spark, "latest")
    log = latest.log_changes(t.stream("events"), "user_id", F.struct("ts", "event_id"), values, folder)
    log.trigger(availableNow=True).start().awaitTermination()
    schema = t.events.select("user_id", *values).schema.add("batch", "long")
    return latest.current(spark.read.schema(schema).parquet(f"{folder}/log"), "user_id", values)
