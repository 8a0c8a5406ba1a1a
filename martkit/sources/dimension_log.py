"""A type-2 dimension as a log of changed versions (C7): a load writes what it changes and nothing else.

``<path>`` is plain Parquet partitioned by ``load`` (the number of the load).  A load appends the versions that NEW and
CHANGE members get, the versions that they close and the ones it corrects (same-day reruns); a version is known by its
surrogate key, and its row of the latest load counts.  Unchanged members are neither written nor stored in between.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.scd import scd2_delta

LOAD, KIND = "load", "_mk_kind"


class DimensionLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key_col: str):
        self.spark, self.path, self.schema, self.key_col = spark, path.rstrip("/"), schema, key_col

    def _rows(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(LOAD, T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """Every version, as its latest load left it."""
        names = self.schema.fieldNames()
        latest = self._rows().groupBy(self.key_col).agg(F.max_by(F.struct(*names), LOAD).alias("_mk_row"))
        return latest.select("_mk_row.*").select(*names)

    def seed(self, rows: DataFrame) -> None:
        """Versions of load 0, e.g. the unknown member."""
        rows.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{LOAD}=0")

    def load(self, number: int, src: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
             load_date: str | _dt.date, **how) -> dict[str, int]:
        """Append the changes of one load; the counts of what it wrote: new, changed, closed, corrected."""
        delta = scd2_delta(self.read(), src, natural_key, tracked, load_date, self.key_col, kind_col=KIND, **how)
        seen = Observation()
        kinds = ("new", "changed", "closed", "corrected")
        observed = delta.observe(seen, *[F.count_if(F.col(KIND) == k).alias(k) for k in kinds])
        observed.drop(KIND).write.mode("overwrite").parquet(f"{self.path}/{LOAD}={int(number)}")
        return {k: seen.get[k] for k in kinds}
