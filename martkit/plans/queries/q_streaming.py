"""Incremental idempotent append over the ``events`` table read as a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.plans.queries.registry import query, table
from martkit.session import checkpoint_dir
from martkit.sources.store import SnapshotStore
from martkit.streaming.incremental import append_stream, parquet_stream


@query("stream_idempotent_append", sql="""
SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1
""")
def stream_idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    """The events file consumed as a Structured Streaming source (availableNow), appended
    micro-batch by micro-batch with a NOT EXISTS on event_id into a store table under the cluster's checkpoint folder, then
    summarised from that table."""
    schema = table(spark, sf, "events").schema
    root = f"{checkpoint_dir(spark)}/martkit-events-{uuid.uuid4().hex}"
    store = SnapshotStore(spark, root)
    stream = parquet_stream(spark, sf, schema, file_glob="events.parquet")
    q = append_stream(stream, store, "events_fact", ["event_id"], checkpoint_location=f"{root}/_stream_checkpoint",
                      part=F.expr("year(ts) * 100 + month(ts)"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    loaded = store.read("events_fact")
    return loaded.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"))
