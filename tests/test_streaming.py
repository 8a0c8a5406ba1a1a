import datetime as dt
import os

from martkit.sources.store import SnapshotStore
from martkit.streaming.incremental import append_stream, parquet_stream

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _write(spark, path, ids):
    rows = [(i, dt.datetime(2024, 1, 1, 0, i), i % 3, "click", float(i)) for i in ids]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def test_incremental_append_is_exactly_once_under_overlap_and_replay(spark, tmp_root):
    src = os.path.join(tmp_root, "src")
    store = SnapshotStore(spark, os.path.join(tmp_root, "store"))
    ck = os.path.join(tmp_root, "ck")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(checkpoint):
        q = append_stream(parquet_stream(spark, src, schema, file_glob="*.parquet", recursive=True), store, "events", ["event_id"],
                          checkpoint_location=checkpoint)
        q.awaitTermination()
        assert q.exception() is None

    _write(spark, os.path.join(src, "a"), range(1, 6))
    run(ck)
    assert store.read("events").count() == 5
    _write(spark, os.path.join(src, "b"), range(4, 9))  # overlaps events 4 and 5
    run(ck)
    assert sorted(r.event_id for r in store.read("events").collect()) == list(range(1, 9))
    run(os.path.join(tmp_root, "ck_replay"))  # full replay with a fresh checkpoint: nothing added
    assert store.read("events").count() == 8


def test_a_late_event_is_loaded(spark, tmp_root):
    src = os.path.join(tmp_root, "src")
    schema = spark.createDataFrame([], SCHEMA).schema
    store = SnapshotStore(spark, os.path.join(tmp_root, "store"))
    for n, minute in enumerate((50, 51, 52, 1)):  # the last one is late
        ts = dt.datetime(2024, 1, 9 if n < 3 else 1, 0, minute)
        spark.createDataFrame([(n, ts, 1, "click", 1.0)], SCHEMA).coalesce(1).write.parquet(os.path.join(src, str(n)))
    q = append_stream(parquet_stream(spark, src, schema, file_glob="*.parquet", max_files_per_trigger=1, recursive=True),
                      store, "events", ["event_id"], checkpoint_location=os.path.join(tmp_root, "ck"))
    q.awaitTermination()
    assert q.exception() is None
    assert sorted(r.event_id for r in store.read("events").collect()) == [0, 1, 2, 3]
