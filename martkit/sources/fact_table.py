"""Facts as plain partitioned Parquet: pruned grain checks, checks before a load is visible, touched partitions only.

``<path>/data`` holds the rows, partitioned by ``part`` (a whole number computed from a row when it is inserted, kept when
the row is updated); ``<path>/grain`` holds the grain summaries of the partitions (``operators/grain.py``).  All writes
are ordinary Spark writes: an append, or an overwrite in dynamic mode that replaces the partitions of its rows and
leaves the files of all others alone.

A load is *staged* first: its rows are written once to the shared scratch folder, and that write itself counts changes
and violations of row rules (``observe``).  Uniqueness of the grain is checked among the staged rows alone, references
on their distinct keys alone; what is already in the fact has been compared through the pruned partitions.  Only a load
without violations is published from the staged rows, so a bad batch never becomes current.

The summaries of new rows are added before the rows themselves: a run that dies in between leaves a summary that
promises too much, which costs a read, never a duplicate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.grain import grain_summary, matching_partitions
from martkit.operators.joins import anti_join, semi_join
from martkit.operators.quality import Rule, combine_checks, referential, uniqueness
from martkit.session import checkpoint_dir

PART = "part"
#: Change types that a staged row may carry: inserted, updated, unchanged (rewritten with its partition).
CHANGE, INSERTED, UPDATED, KEPT = "_mk_change", "I", "U", "K"
MAX_LISTED_PARTS = 10_000  # partitions named in a filter; more are found by a join


class LoadRejected(RuntimeError):
    """A staged load broke a check; the fact is as it was."""

    def __init__(self, name: str, violations: Mapping[str, int], staged: str):
        broken = {k: n for k, n in violations.items() if n}
        super().__init__(f"{name}: checks failed: {broken} (rows at {staged})")
        self.violations, self.staged = dict(violations), staged


@dataclass
class LoadCounts:
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    duplicates: int = 0
    violations: dict[str, int] = field(default_factory=dict)


@dataclass
class Staged:
    """Rows (with ``part`` and a change type) that a load is about to write, and the partitions that it replaces.

    ``replace`` None: append.  ``old_rows``: rows that the replaced partitions hold now; ``incoming``: rows that came."""

    rows: DataFrame
    replace: list[int] | None = None
    old_rows: int = 0
    incoming: int | None = None


class FactTable:
    """``schema``: the fact's columns; ``grain``: its unique key; ``part``: a row's partition number."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, grain: Sequence[str], part: Column,
                 key_col: str | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.grain, self.part, self.key_col = list(grain), part, key_col
        self.name = self.path.rsplit("/", 1)[-1]

    # --- reading ------------------------------------------------------------------------------
    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def _load(self, folder: str, schema: T.StructType) -> DataFrame:
        """The Parquet folder, or no rows where it was never written; any other fault raises."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def exists(self) -> bool:
        try:
            self.spark.read.schema(self.stored_schema).parquet(f"{self.path}/data")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(PART, T.LongType())])

    def stored(self) -> DataFrame:
        """All rows with their partition number."""
        return self._load("data", self.stored_schema)

    def read(self) -> DataFrame:
        return self.stored().drop(PART)

    def summary(self) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema).withColumn(PART, F.lit(0).cast("bigint"))
        return self._load("grain", grain_summary(empty, self.grain, PART, self.key_col).schema)

    def largest_key(self) -> DataFrame:
        """One row, ``max_key``: the largest surrogate key, from the summaries."""
        return self.summary().agg(F.max("max_key").alias("max_key"))

    # --- pruning ------------------------------------------------------------------------------
    def in_parts(self, parts: Sequence[int]) -> DataFrame:
        """Rows of the named partitions: a filter on the partition column, so no other file is read."""
        return self.stored().where(F.col(PART).isin(*parts) if parts else F.lit(False))

    def parts_with(self, batch: DataFrame) -> list[int] | None:
        """Partitions that may hold a grain of ``batch``; None if they are too many to be named."""
        if not self.exists():
            return []
        found = [r[0] for r in matching_partitions(self.summary(), batch, self.grain).limit(MAX_LISTED_PARTS + 1).collect()]
        return sorted(found) if len(found) <= MAX_LISTED_PARTS else None

    def rows_like(self, batch: DataFrame) -> DataFrame:
        """Rows with ``part`` of all partitions that may hold a grain of ``batch``."""
        parts = self.parts_with(batch)
        return self.in_parts(parts) if parts is not None else semi_join(
            self.stored(), matching_partitions(self.summary(), batch, self.grain), [PART])

    # --- planning a load ----------------------------------------------------------------------
    def _conform(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return rows.withColumn(PART, F.coalesce(self.part.cast("bigint"), F.lit(-1).cast("bigint")))

    def append(self, rows: DataFrame, incoming: int | None = None) -> Staged:
        """New rows (their grain is not in the fact yet; ``incoming`` counts the batch they were taken from)."""
        return Staged(self._conform(rows).withColumn(CHANGE, F.lit(INSERTED)), None, 0, incoming)

    def _held(self, parts: Sequence[int]) -> int:
        """Rows that partitions hold, from the summaries."""
        return self.summary().where(F.col(PART).isin(*parts)).agg(F.sum("n_rows")).first()[0] or 0 if parts else 0

    def reload(self, rows: DataFrame, parts: Sequence[int] = ()) -> Staged:
        """``rows`` instead of all rows of their grain, and instead of everything in ``parts`` (e.g. a batch's own).

        Only ``parts``, the rows' partitions and those that held a reloaded grain are written again.
        """
        new = _stored_once(self._conform(rows))
        own = set(parts)
        like = self.parts_with(new)
        if like is None:
            like = [r[0] for r in self.summary().select(PART).distinct().collect()]
        others = [p for p in like if p not in own]
        hit = [r[0] for r in semi_join(self.in_parts(others), new, self.grain, null_safe=True).select(PART)
               .distinct().collect()]
        target = {r[0] for r in new.select(PART).distinct().collect()}
        touched = sorted(own | set(hit) | target)
        kept = anti_join(self.in_parts([p for p in touched if p not in own]), new, self.grain, null_safe=True)
        tagged = new.withColumn(CHANGE, F.lit(INSERTED)).unionByName(kept.withColumn(CHANGE, F.lit(KEPT)))
        return Staged(tagged, touched, self._held(touched))

    def upsert(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Staged:
        """Accumulating load: ``merge(old rows, incoming)`` over the touched partitions only.

        Both sides carry ``part``; the result has the fact's columns, ``part`` and the change type.  A matched row
        stays in its partition.  Touched are the partitions that hold an incoming key and those of new rows; written are
        those of them in which a row changes.
        """
        inc = incoming if PART in incoming.columns else incoming.withColumn(
            PART, F.coalesce(self.part.cast("bigint"), F.lit(-1).cast("bigint")))
        inc = _stored_once(inc)
        near = self.rows_like(inc)
        old = semi_join(near, inc, self.grain, null_safe=True)
        fresh = anti_join(inc, near, self.grain, null_safe=True)
        touched = sorted({r[0] for r in old.select(PART).unionByName(fresh.select(PART)).distinct().collect()})
        merged = merge(self.in_parts(touched), inc)
        # a partition whose rows all stay as they are is not written
        changed = sorted({r[0] for r in merged.where(F.col(CHANGE) != KEPT).select(PART).distinct().collect()})
        return Staged(merged.where(F.col(PART).isin(*changed) if changed else F.lit(False)), changed, self._held(changed))

    # --- staging, checks, publishing ------------------------------------------------------------
    def load(self, staged: Staged, rules: Sequence[Rule] = (), keys: Mapping[str, tuple[DataFrame, str]] | None = None
             ) -> LoadCounts:
        """Stage, check and publish a load; ``LoadRejected`` if a row rule, the grain or a reference is broken.

        ``keys``: key column -> (dimension, its key).
        """
        if staged.replace == []:
            return LoadCounts()
        folder = f"{checkpoint_dir(self.spark).rstrip('/')}/load-{self.name}-{uuid.uuid4().hex}"
        seen = Observation(f"load_{uuid.uuid4().hex}")
        change = F.col(CHANGE)
        broken = [F.count_if(~F.coalesce(r.condition, F.lit(r.null_passes)) & (change != KEPT)).alias(f"r{i}")
                  for i, r in enumerate(rules)]
        staged.rows.observe(seen, *[F.count_if(change == c).alias(c) for c in (INSERTED, UPDATED, KEPT)], *broken
                            ).write.parquet(folder)
        rows = self.spark.read.schema(staged.rows.schema).parquet(folder)
        counted = seen.get
        counts = LoadCounts(counted[INSERTED], counted[UPDATED])
        if staged.replace is not None:
            counts.deleted = staged.old_rows - counted[KEPT] - counted[UPDATED]
        if staged.incoming is not None:
            counts.duplicates = staged.incoming - counted[INSERTED]
        counts.violations = {r.name: counted[f"r{i}"] for i, r in enumerate(rules)}
        new = rows.where(change != KEPT)
        checks = [uniqueness(rows, self.grain, name="unique grain")]
        checks += [referential(new.select(k).distinct(), k, dim, pk, name=f"{k} reference")
                   for k, (dim, pk) in (keys or {}).items()]
        counts.violations |= {r["check"]: r["violations"] for r in combine_checks(*checks).collect()}
        if any(counts.violations.values()):
            raise LoadRejected(self.name, counts.violations, folder)
        # partitions that hold no rows yet need no replacing
        self._publish(rows.drop(CHANGE), staged.replace if staged.old_rows else None)
        return counts

    def _publish(self, rows: DataFrame, replace: list[int] | None) -> None:
        described = _stored_once(grain_summary(rows, self.grain, PART, self.key_col))  # a few rows a partition
        described.write.mode("append").partitionBy(PART).parquet(f"{self.path}/grain")
        out = rows.select(*self.columns, PART).hint("rebalance", PART)
        if replace is None:
            out.write.mode("append").partitionBy(PART).parquet(f"{self.path}/data")
            return
        dynamic = out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
        dynamic.partitionBy(PART).parquet(f"{self.path}/data")
        # partitions that lost all their rows are written empty
        left = {r[0] for r in described.select(PART).distinct().collect()}
        for p in replace:
            if p not in left:
                rows.limit(0).drop(PART).write.mode("overwrite").parquet(f"{self.path}/data/{PART}={p}")
                described.limit(0).drop(PART).write.mode("overwrite").parquet(f"{self.path}/grain/{PART}={p}")
        described.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(PART).parquet(
            f"{self.path}/grain")


def _stored_once(rows: DataFrame) -> DataFrame:
    checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)
