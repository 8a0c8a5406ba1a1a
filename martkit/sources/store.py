"""Table store: versioned snapshot publish, append / overwrite sinks, audit log.

A mart table lives in data directories ``<root>/<name>/v=<n>_<token>/`` (Parquet) plus one small
marker per published version under ``<root>/<name>/_versions/<n>`` that lists the directories of
that version.  Publishing writes a brand-new directory and only then adds the marker of a version
that consists of it alone; appending writes a new directory with the new rows and adds the marker
of a version that has the old directories and the new one.  Markers are never rewritten, so

* readers never see a half-written table or a half-written append (a job that fails leaves the
  old version current),
* a load may read the current version and publish the next one in the same job - Spark
  cannot overwrite a Parquet path it is reading from,
* a retried task/stage only rewrites files inside the new version directory.

Facts and logs have no versions: they are plain Parquet rows below ``<root>/<name>/data``, facts partitioned and
checked before they are written there (``sources/fact_table.py``).

All I/O goes through ``spark.read`` / ``df.write`` so any Hadoop-compatible shared file
system works (HDFS, S3, ABFS, or a local folder in tests).
"""

from __future__ import annotations

import datetime as _dt
import functools
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.dates import format_ts, seconds_between
from martkit.operators.joins import anti_join
from martkit.sources.fact_table import PART, FactTable

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("procedure_name", T.StringType()),
    T.StructField("load_date", T.DateType()),
    T.StructField("load_start_time", T.TimestampType()),
    T.StructField("load_end_time", T.TimestampType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_deleted", T.LongType()),
    T.StructField("duplicate_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- version markers ------------------------------------------------------------------
    # Version n becomes current by adding the marker ``_versions/<n>`` after its data is
    # complete; the current version is the highest marker that was completed.
    def _markers(self, name: str) -> str:
        return f"{self.root}/{name}/_versions"

    def _children(self, path: str) -> list[str]:
        """Names below a folder; empty when the folder does not exist.  Any other fault raises."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p)]

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _versions(self, name: str) -> list[int]:
        return sorted((int(n) for n in self._children(self._markers(name)) if n.isdigit()), reverse=True)

    def _read_marker(self, name: str, v: int) -> list[str] | None:
        """Data directories of a version; None for a marker whose writer died."""
        path = f"{self._markers(name)}/{v}"
        if "_SUCCESS" not in self._children(path):
            return None
        row = self.spark.read.text(path).first()
        return row["value"].split(" ")[1].split(",")

    def _current(self, name: str) -> tuple[int, list[str]] | None:
        """(version, data directories) of the published version, or None if there is none.

        Lists the marker names and reads the newest complete one only.  A fault while reading
        raises: a table that cannot be read is never taken for one that was never published.
        """
        for v in self._versions(name):
            dirs = self._read_marker(name, v)
            if dirs is not None:
                return v, dirs
        return None

    def current_version(self, name: str) -> int | None:
        cur = self._current(name)
        return cur[0] if cur else None

    def exists(self, name: str) -> bool:
        return self._current(name) is not None or self._plain(name) is not None

    # --- plain tables: facts (``sources/fact_table.py``) and logs, without versions ------------------
    def _plain(self, name: str) -> DataFrame | None:
        """Rows below ``<name>/data``; None where there are none."""
        try:
            return self.spark.read.parquet(f"{self.root}/{name}/data")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def log(self, name: str, df: DataFrame) -> None:
        """Add rows to a plain table."""
        df.write.mode("append").parquet(f"{self.root}/{name}/data")

    def fact(self, name: str, schema: T.StructType, grain: Sequence[str], part: Column, key_col: str | None = None
             ) -> FactTable:
        """A fact of this store, partitioned by ``part``."""
        return FactTable(self.spark, f"{self.root}/{name}", schema, grain, part, key_col)

    def names(self, prefix: str = "") -> list[str]:
        """Published tables whose names begin with ``prefix``."""
        return sorted(n for n in self._children(self.root) if n.startswith(prefix) and self.exists(n))

    def current_paths(self, name: str) -> list[str]:
        cur = self._current(name)
        if cur is None:
            raise FileNotFoundError(f"table {name!r} has not been published")
        return [f"{self.root}/{name}/{d}" for d in cur[1]]

    # --- read / publish -------------------------------------------------------------
    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        cur = self._current(name)
        if cur is None:
            plain = self._plain(name)
            if plain is not None:
                return plain.drop(PART)
            if schema is None:
                raise FileNotFoundError(f"table {name!r} has not been published")
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/{d}" for d in cur[1]]
        flat = [p for p in paths if not any("=" in c for c in self._children(p))]
        if len(flat) == len(paths):
            return self.spark.read.parquet(*paths)
        # directories with partition folders have a base path each
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                                [self.spark.read.option("basePath", p).parquet(p) for p in paths])

    def _write_dir(self, name: str, v: int, df: DataFrame, partition_by: Sequence[str]) -> str:
        """Write one data directory, unique to this attempt (a failed attempt leaves an orphan)."""
        data_dir = f"v={v}_{uuid.uuid4().hex[:12]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{name}/{data_dir}")
        return data_dir

    def _add_marker(self, name: str, v: int, dirs: Sequence[str]) -> None:
        self.spark.createDataFrame([(f"{v} {','.join(dirs)}",)], "value string").coalesce(1) \
            .write.mode("errorifexists").text(f"{self._markers(name)}/{v}")

    def publish(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version.  Two writers racing for the same version
        fail on the marker."""
        v = max(self._versions(name), default=0) + 1
        self._add_marker(name, v, [self._write_dir(name, v, df, partition_by)])
        return v

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """The next version has the current directories and one with the new rows (no
        existing file is rewritten; readers see all new rows or none)."""
        cur = self._current(name)
        v = max(self._versions(name), default=0) + 1
        self._add_marker(name, v, [*(cur[1] if cur else []), self._write_dir(name, v, df, partition_by)])
        return v

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> int:
        """Replace only the partitions present in ``df`` (e.g. one batch id): the next version
        has the current rows of all other partitions and ``df``."""
        if not self.exists(name):
            return self.publish(name, df, partition_by)
        cols = list(partition_by)
        kept = anti_join(self.read(name), df.select(*cols).distinct(), cols, null_safe=True)
        return self.publish(name, kept.unionByName(df, allowMissingColumns=True).select(*kept.columns), partition_by)

    def expire(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions and the data directories that none of those
        lists (orphans of failed attempts too); returns the deleted directories.  Call it when no
        reader uses an old version and no writer is active."""
        versions = [(v, d) for v in self._versions(name) if (d := self._read_marker(name, v)) is not None]
        used = {d for _, dirs in versions[:max(1, keep)] for d in dirs}
        for v, _ in versions[max(1, keep):]:
            self._delete(f"{self._markers(name)}/{v}")
        gone = [d for d in self._children(f"{self.root}/{name}") if d.startswith("v=") and d not in used]
        for d in gone:
            self._delete(f"{self.root}/{name}/{d}")
        return gone


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S3: full refresh of a staging table."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_staging(df: DataFrame, path: str, truncate_before_load: bool = True) -> None:
    """Staging load with the ``TruncateBeforeLoad`` switch."""
    df.write.mode("overwrite" if truncate_before_load else "append").parquet(path)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Create a database/namespace when absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


class AuditLog:
    """Append-only audit rows per loader step - an ``IN_PROGRESS`` row when it starts
    and a final row (SUCCESS / FAILED, end time, counts, error) when it ends.  A step whose
    driver died keeps only its start row; ``report`` shows the latest row of each step."""

    def __init__(self, store: SnapshotStore, table: str = "etl_load_audit"):
        self.store = store
        self.table = table

    def record(self, run_id: int, procedure: str, load_date: _dt.date, start: _dt.datetime,
               end: _dt.datetime, status: str, processed: int = 0, inserted: int = 0,
               updated: int = 0, deleted: int = 0, duplicates: int = 0, error: str | None = None) -> None:
        row = (run_id, procedure, load_date, start, end, processed, inserted, updated, deleted,
               duplicates, status, error)
        df = self.store.spark.createDataFrame([row], AUDIT_SCHEMA)
        self.store.log(self.table, df)

    def start(self, run_id: int, procedure: str, load_date: _dt.date, start: _dt.datetime) -> None:
        self.record(run_id, procedure, load_date, start, None, "IN_PROGRESS")

    def read(self) -> DataFrame:
        return self.store.read(self.table, AUDIT_SCHEMA)

    def latest(self) -> DataFrame:
        """The latest row of every (run, step): the final row, or the start row if none."""
        from martkit.operators.dedup import keep_first
        return keep_first(self.read(), ["run_id", "procedure_name"], [F.col("load_end_time").desc_nulls_last()])

    def report(self, newest_first: bool = True) -> DataFrame:
        """Audit summary with the run duration in seconds, newest first."""
        a = self.latest()
        out = a.select("procedure_name", "status", "rows_processed", "rows_inserted", "rows_updated",
                       "rows_deleted", "duplicate_count", format_ts("load_start_time").alias("started"),
                       seconds_between("load_start_time", "load_end_time").alias("duration_seconds"), "load_start_time")
        order = F.col("load_start_time").desc() if newest_first else F.col("load_start_time").asc()
        return out.orderBy(order, F.col("procedure_name")).drop("load_start_time")
