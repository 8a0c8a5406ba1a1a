"""Command-line run of the whole warehouse load (G7) from a folder of raw CSV files.

    python -m martkit.plans.cli --raw-dir /data/raw --store /data/mart [--load-date 2024-01-01]
        [--batch-id N] [--reload] [--dims-only] [--skip-service] [--skip-workforce] [--skip-staging]

Raw files are found by name (all read as text columns, headers trimmed):
``agency_information.csv``, ``agency_mode_service.csv``, ``ts_<metric>.csv``,
``archive_<metric>.csv``, ``safety_events.csv``, ``employees_<year>.csv``,
``job_openings.csv`` and ``calendar.csv``.
The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit configuration);
``spark.checkpoint.dir`` must name a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession

from martkit.plans.runner import MartRunner
from martkit.sources.raw import read_raw_csv
from martkit.sources.store import SnapshotStore

FEED = re.compile(r"^(agency_information|agency_mode_service|ts_[a-z_]+|archive_[a-z_]+|safety_events|"
                  r"employees_\d{4}|job_openings|calendar)(\.csv)?$")


def discover_feeds(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Map feed name -> all-string DataFrame for every recognised ``*.csv`` file in ``raw_dir``.

    The listing is a ``binaryFile`` scan that selects only the path column (file contents
    are never read); each feed is then read with every column as text."""
    paths = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .load(raw_dir).select("path").collect()]
    feeds = {}
    for path in sorted(paths):
        m = FEED.match(path.rstrip("/").rsplit("/", 1)[-1])
        if m:
            feeds[m.group(1)] = read_raw_csv(spark, path)
    return feeds


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(description="Load all marts from raw CSV feeds")
    ap.add_argument("--raw-dir", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--load-date", default=None)
    ap.add_argument("--batch-id", type=int, default=None)
    ap.add_argument("--reload", action="store_true")
    ap.add_argument("--dims-only", action="store_true")
    ap.add_argument("--skip-service", action="store_true")
    ap.add_argument("--skip-workforce", action="store_true")
    ap.add_argument("--skip-staging", action="store_true")
    ap.add_argument("--skip-step", action="append", default=[], help="a step to leave out, e.g. DimMode")
    ap.add_argument("--append-openings", action="store_true")
    ap.add_argument("--continue-on-opening-error", action="store_true")
    a = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("martkit-load").getOrCreate()
    feeds = discover_feeds(spark, a.raw_dir)
    calendar = feeds.pop("calendar", None)
    load_date = _dt.date.fromisoformat(a.load_date) if a.load_date else _dt.datetime.now(_dt.timezone.utc).date()
    runner = MartRunner(spark, SnapshotStore(spark, a.store), load_date=load_date, batch_id=a.batch_id,
                        reload=a.reload, skip_steps=frozenset(a.skip_step), append_openings=a.append_openings,
                        throw_on_failure=not a.continue_on_opening_error)
    report = runner.run_all(feeds, calendar, skip_staging=a.skip_staging, skip_service=a.skip_service,
                            skip_workforce=a.skip_workforce, dims_only=a.dims_only)
    runner.audit.report().show(200, truncate=False)
    return report


if __name__ == "__main__":
    main()
