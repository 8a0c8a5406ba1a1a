"""Group aggregates the mart loads need beyond plain SUM/MIN/MAX.

All of them are declarative aggregates with map-side partial aggregation, so a hot group
is pre-combined in every map task before the shuffle:

* ``mode_per_group`` - count per (group, value), then ``min_by(value, (-count, value))``:
  most frequent value, ties to the smallest value (a deterministic rank 1);
* ``arg_extremes`` - first / latest / peak rows per group with ``min_by`` / ``max_by`` over
  struct orderings, instead of one self-join per ranking;
* ``span`` - MAX - MIN + 1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mode_per_group(df: DataFrame, group: Sequence[str], value: str, out: str = "mode",
                   count_out: str | None = None, ignore_nulls: bool = True) -> DataFrame:
    """Most frequent ``value`` per group; ties go to the smallest value."""
    src = df.filter(F.col(value).isNotNull()) if ignore_nulls else df
    counted = src.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    aggs = [pick.alias(out)]
    if count_out:
        aggs.append(F.max("_n").alias(count_out))
    return counted.groupBy(*group).agg(*aggs)


def arg_max(value: str | Column, *order: str | Column) -> Column:
    """The ``value`` of the row with the largest ``order`` tuple (lexicographic)."""
    return F.max_by(_c(value), F.struct(*[_c(o) for o in order]))


def arg_min(value: str | Column, *order: str | Column) -> Column:
    """The ``value`` of the row with the smallest ``order`` tuple (lexicographic)."""
    return F.min_by(_c(value), F.struct(*[_c(o) for o in order]))


def span(col: str | Column) -> Column:
    """MAX(x) - MIN(x) + 1 (e.g. years of service)."""
    return F.max(_c(col)) - F.min(_c(col)) + 1


def sum_zero(col: str | Column) -> Column:
    """SUM(ISNULL(x, 0)) - 0 rather than NULL for an all-NULL group."""
    return F.sum(F.coalesce(_c(col), F.lit(0)))


def min_where(col: str | Column, cond: Column) -> Column:
    """MIN(x) over the rows satisfying ``cond``."""
    return F.min(F.when(cond, _c(col)))


def max_where(col: str | Column, cond: Column) -> Column:
    """MAX(x) over the rows satisfying ``cond``."""
    return F.max(F.when(cond, _c(col)))


def profile(df: DataFrame, key: Sequence[str], label: str = "rows") -> DataFrame:
    """Row count and distinct-key count in one aggregate pass."""
    return df.agg(F.count(F.lit(1)).alias(label),
                  F.count_distinct(*[F.col(k) for k in key]).alias("distinct_keys"))


def grouped(df: DataFrame, group: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    """Group by columns or derived expressions (A4) with named aggregates."""
    return df.groupBy(*[_c(g) for g in group]).agg(*[c.alias(n) for n, c in aggs.items()])


# --- Q9: profiles that merge ---------------------------------------------------------------

SKETCH_BITS = 14  # 2**14 registers: a standard error of about 0.8 %


def profile_state(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows and an HLL sketch of the business key (NULL parts count as values), to be stored by load."""
    text = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    return df.agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(text, SKETCH_BITS).alias("sketch"))


def merge_profiles(states: DataFrame) -> DataFrame:
    """One row: rows and the estimated number of distinct keys over all stored loads, without reading them again."""
    return states.agg(F.sum("rows").cast("bigint").alias("rows"),
                      F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
