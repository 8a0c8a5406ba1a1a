"""Incremental (micro-batch) idempotent append - C10 over a Structured Streaming source.

``append_stream`` removes duplicates inside each micro-batch and appends it to a store table
with a NOT EXISTS on the grain.  No watermark and no stream state: an event may come as late
as it likes and is still loaded once.  A micro-batch that is replayed after a
failure (written but not committed in the checkpoint) therefore adds nothing the second
time, which makes the sink effectively exactly-once.

The grain check of a micro-batch reads only the partitions whose grain summary can hold one of its keys
(``sources/fact_table.py``); the target is plain partitioned Parquet.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martkit.operators.joins import anti_join
from martkit.session import checkpoint_dir
from martkit.sources.store import SnapshotStore


def _append_batch(store: SnapshotStore, table: str, grain: Sequence[str], part: Column):
    def run(batch: DataFrame, epoch_id: int) -> None:
        # The micro-batch is used twice (pruning, append): persist it for this batch only.
        cached = batch.dropDuplicates(list(grain)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fact = store.fact(table, batch.schema, grain, part)
            fact.load(fact.append(anti_join(cached, fact.rows_like(cached), list(grain), null_safe=True)))
        finally:
            cached.unpersist()
    return run


def append_stream(stream: DataFrame, store: SnapshotStore, table: str, grain: Sequence[str],
                  checkpoint_location: str | None = None, part: Column | None = None,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental idempotent append of ``stream`` into ``store``/``table``, partitioned by ``part``
    (a whole number per row, e.g. its day; one partition by default)."""
    location = checkpoint_location or f"{checkpoint_dir(stream.sparkSession)}/martkit-stream-{table}-{uuid.uuid4().hex}"
    writer = stream.writeStream.foreachBatch(_append_batch(store, table, grain, F.lit(0) if part is None else part)) \
        .option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def parquet_stream(spark: SparkSession, directory: str, schema, file_glob: str | None = None,
                   max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """A file stream over a directory of Parquet files (schema given, never inferred)."""
    r = spark.readStream.schema(schema).format("parquet")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)
