"""Reshaping: unpivot, multi-measure unpivot, layout unification, re-pivot.

Unpivots are ``Expand`` / ``Generate`` nodes: narrow, no shuffle.  Multi-source alignment
(R4/J11) is a union of long relations followed by ONE conditional aggregate on the grain -
one shuffle instead of N left joins and a UNION-DISTINCT of key sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_years(df: DataFrame, year: Column) -> list[int]:
    """The years that occur (one small value each), ascending: the columns of a yearly layout."""
    return sorted(r["y"] for r in df.select(year.cast("int").alias("y")).distinct().collect() if r["y"] is not None)


def unpivot_columns(df: DataFrame, ids: Sequence[str], values: Sequence[str], name_col: str,
                    value_col: str, drop_nulls: bool = True) -> DataFrame:
    """Wide value columns -> (name, value) rows.  SQL UNPIVOT drops NULL values; the
    DataFrame ``unpivot`` keeps them, so ``drop_nulls`` (default) restores SQL semantics."""
    out = df.unpivot(list(ids), list(values), name_col, value_col)
    return out.filter(F.col(value_col).isNotNull()) if drop_nulls else out


def unpivot_years(df: DataFrame, ids: Sequence[str], year_columns: Mapping[str, int] | Sequence[str],
                  value_col: str = "value", year_col: str = "year", drop_nulls: bool = True) -> DataFrame:
    """R1 for yearly metric tables: columns like ``y2015``/``2015`` become (year int, value).

    ``year_columns`` is either a list of column names whose digits give the year, or an
    explicit ``{column: year}`` map.
    """
    if isinstance(year_columns, Mapping):
        mapping = dict(year_columns)
    else:
        mapping = {c: int("".join(ch for ch in c if ch.isdigit())) for c in year_columns}
    cols = list(mapping)
    long = unpivot_columns(df, ids, cols, "_col", value_col, drop_nulls)
    year_expr = None
    for c, y in mapping.items():
        cond = F.col("_col") == F.lit(c)
        year_expr = F.when(cond, F.lit(y)) if year_expr is None else year_expr.when(cond, F.lit(y))
    return long.withColumn(year_col, year_expr.cast("int")).drop("_col").select(*ids, year_col, value_col)


def unpivot_measures(df: DataFrame, ids: Sequence[str], variants: Sequence[Mapping[str, Column | str | None]],
                     require_any: Sequence[str] = ()) -> DataFrame:
    """R2: multi-measure unpivot - each variant maps output column -> expression (or source
    column name, or None for NULL); one output row per (input row, variant).

    ``require_any`` keeps a row only if one of those outputs is not NULL (P4).
    """
    names = list(variants[0].keys())
    structs = []
    for v in variants:
        fields = []
        for n in names:
            e = v.get(n)
            c = F.lit(None) if e is None else (F.col(e) if isinstance(e, str) else e)
            fields.append(c.alias(n))
        structs.append(F.struct(*fields))
    out = df.select(*ids, F.inline(F.array(*structs)))
    if require_any:
        out = out.filter(F.coalesce(*[F.col(c) for c in require_any]).isNotNull())
    return out


def union_layouts(frames: Iterable[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL of per-layout projections, matched by column name; columns absent
    from a layout become NULL."""
    frames = list(frames)
    if columns is not None:
        frames = [f.select(*[F.col(c) if c in f.columns else F.lit(None).alias(c) for c in columns]) for f in frames]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct_keys(frames: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """UNION (distinct) of the key sets of several relations (one shuffle)."""
    return union_layouts([f.select(*keys) for f in frames]).distinct()


def align_metrics(sources: Mapping[str, DataFrame], grain: Sequence[str], value_col: str = "value",
                  agg: str = "max") -> DataFrame:
    """Align N long metric relations on a shared grain - one wide row per grain
    member that appears in any source, one column per metric (NULL where a metric is absent).

    Union-long + one conditional aggregate: equivalent to UNION-DISTINCT of the key sets
    followed by N left joins + MAX, but with a single shuffle on the grain (partial
    aggregation happens map-side, so hot grain members are pre-combined).
    NULL grain values group together (they never matched in the join formulation either,
    but here they keep their own row with the measures they carry).
    """
    tagged = [df.select(*grain, F.lit(name).alias("_metric"), F.col(value_col).alias("_v"))
              for name, df in sources.items()]
    long = functools.reduce(lambda a, b: a.unionByName(b), tagged)
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first}[agg]
    aggs = [fn(F.when(F.col("_metric") == name, F.col("_v"))).alias(name) for name in sources]
    return long.groupBy(*grain).agg(*aggs)


def pivot_wide(df: DataFrame, grain: Sequence[str], pivot_col: str, values: Sequence, value_col: str,
               agg: str = "max", prefix: str = "") -> DataFrame:
    """R4 with an explicit value list (no extra pass to discover pivot values)."""
    fn = {"max": F.max, "min": F.min, "sum": F.sum}[agg]
    return df.groupBy(*grain).agg(*[fn(F.when(F.col(pivot_col) == v, F.col(value_col))).alias(f"{prefix}{v}")
                                    for v in values])
