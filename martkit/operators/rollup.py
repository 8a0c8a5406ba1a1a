"""Incremental rollups (C16): per-key states that add up, stored by batch and merged instead of recomputed.

A state row holds, for one key of one batch, the smallest and largest period, sums, the struct of the best and of the
latest period for each measure, and the counts of a category's values.  States of several batches merge by the same
functions (sum, min, max, max of structs), so a rollup over all loads reads one row a key and batch, never the fact.
A batch that comes again replaces its own states (one partition).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rollup:
    """``period``: what orders the rows of a key; ``sums`` count NULL as 0; ``peaks``: measures whose greatest value
    (NULL as 0, ties: the later period) and latest value are kept; ``category``: its most frequent value is taken
    (ties: the smaller value)."""

    key: Sequence[str]
    period: str
    sums: Sequence[str] = ()
    peaks: Sequence[str] = ()
    category: str | None = None
    not_category: Sequence = field(default_factory=tuple)  # values that do not count

    # --- states ---------------------------------------------------------------------------------
    def state(self, rows: DataFrame) -> DataFrame:
        """One row a key: the state of ``rows``."""
        p = F.col(self.period)
        zero = {m: F.coalesce(F.col(m), F.lit(0)) for m in [*self.sums, *self.peaks]}
        aggs = [F.min(p).alias("first"), F.max(p).alias("last"), F.count(F.lit(1)).alias("n")]
        aggs += [F.sum(zero[m]).alias(f"sum_{m}") for m in self.sums]
        for m in self.peaks:
            aggs += [F.max(F.struct(zero[m].alias("by"), p.alias("at"), F.col(m).alias("value"))).alias(f"peak_{m}"),
                     F.max(F.struct(p.alias("at"), F.col(m).alias("value"))).alias(f"late_{m}")]
        return rows.groupBy(*self.key).agg(*aggs)

    def values(self, rows: DataFrame) -> DataFrame:
        """(key, value, n): how often each value of the category occurs."""
        value = F.col(self.category)
        used = rows.where(value.isNotNull() & ~value.isin(*self.not_category) if self.not_category else value.isNotNull())
        return used.groupBy(*self.key, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))

    def merge(self, states: DataFrame) -> DataFrame:
        aggs = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")]
        aggs += [F.sum(f"sum_{m}").alias(f"sum_{m}") for m in self.sums]
        for m in self.peaks:
            aggs += [F.max(f"peak_{m}").alias(f"peak_{m}"), F.max(f"late_{m}").alias(f"late_{m}")]
        return states.groupBy(*self.key).agg(*aggs)

    def most_frequent(self, values: DataFrame) -> DataFrame:
        """(key, category): the value with the greatest count, the smaller one of equals."""
        total = values.groupBy(*self.key, "value").agg(F.sum("n").alias("n"))
        # one pass: the greatest count first, then the smallest value
        return total.groupBy(*self.key).agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias(self.category))


class RollupStore:
    """States of every batch as plain Parquet, partitioned by batch."""

    def __init__(self, spark: SparkSession, path: str, rollup: Rollup):
        self.spark, self.path, self.rollup = spark, path.rstrip("/"), rollup

    def _put(self, kind: str, rows: DataFrame, batch: int) -> None:
        # the batch's partition alone is written (an empty batch leaves an empty one)
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch}")

    def put(self, batch: int, rows: DataFrame, category_rows: DataFrame | None = None) -> None:
        """Replace the states of ``batch`` by those of ``rows`` (the category may be counted in other rows)."""
        self._put("state", self.rollup.state(rows), batch)
        if self.rollup.category:
            self._put("values", self.rollup.values(rows if category_rows is None else category_rows), batch)

    def _read(self, kind: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{kind}").drop("batch")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def result(self) -> DataFrame:
        """The merged states of all batches, with the category's most frequent value."""
        states = self._read("state")
        if states is None:
            raise FileNotFoundError(f"no batch has been put into {self.path}")
        merged = self.rollup.merge(states)
        values = self._read("values") if self.rollup.category else None
        if values is None:
            return merged
        k = list(self.rollup.key)
        top = self.rollup.most_frequent(values).select(*[F.col(c).alias(f"_mk_{c}") for c in k], self.rollup.category)
        cond = None
        for c in k:
            eq = merged[c].eqNullSafe(top[f"_mk_{c}"])
            cond = eq if cond is None else cond & eq
        return merged.join(top, cond, "left").drop(*[f"_mk_{c}" for c in k])
