"""De-duplication.

``keep_first`` is ``row_number() OVER (PARTITION BY key ORDER BY ...) = 1``.  Spark plans
that filter as a *partial* WindowGroupLimit before the shuffle, so every map task forwards
at most one row per key - a key holding a third of the rows does not land as a third of
the data in one reducer.  The ordering is always completed to a total order (all columns
as a final tie-break) so the surviving row is deterministic (no ``ORDER BY (SELECT NULL)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(df: DataFrame, order_by: Sequence[Column | str], key: Sequence[str], total: bool) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if total:
        used = {c for c in order_by if isinstance(c, str)} | set(key)
        cols += [F.col(c).asc_nulls_last() for c in df.columns
                 if c not in used and _orderable(df, c)]
    return cols


def _orderable(df: DataFrame, c: str) -> bool:
    t = df.schema[c].dataType.typeName()
    return t not in ("map", "variant")


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[Column | str] = (),
               total_order: bool = True) -> DataFrame:
    """One row per ``key``: the first under ``order_by`` (W1-W5).  NULL key values form one
    group, as in SQL PARTITION BY."""
    w = Window.partitionBy(*key).orderBy(*_order(df, order_by, key, total_order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Latest row per key (``ORDER BY by DESC`` with a total tie-break)."""
    return keep_first(df, key, [F.col(c).desc_nulls_last() for c in by])


def dedup_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """One row per grain tuple (any row - use ``keep_first`` when the choice matters).

    ``dropDuplicates`` plans as a hash aggregate with map-side partial aggregation."""
    return df.dropDuplicates(list(grain))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q2/Q5: key values that occur more than once, with their multiplicity."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
