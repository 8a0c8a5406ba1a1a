"""Set-membership joins and update-through-join.

All are ordinary Catalyst joins: ``left_anti`` / ``left_semi`` never duplicate the left
side, and Catalyst decorrelates EXISTS / NOT EXISTS into exactly these joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    cond = None
    for lc, rc in pairs:
        eq = left[lc].eqNullSafe(right[rc]) if null_safe else left[lc] == right[rc]
        cond = eq if cond is None else cond & eq
    return cond


def _pairs(on: Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(c, c) for c in on]


def _prefixed(right: DataFrame, pairs: list[tuple[str, str]], tag: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Project the right side to its key columns under private names (narrow shuffle, no clashes)."""
    r = right.select(*[F.col(rc).alias(f"_{tag}{i}") for i, (_, rc) in enumerate(pairs)])
    return r, [(lc, f"_{tag}{i}") for i, (lc, _) in enumerate(pairs)]


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str],
              null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (NOT EXISTS).

    ``null_safe`` compares with ``<=>`` so NULL grain members match each other, which is what
    an idempotent append on a nullable grain needs.
    """
    pairs = _pairs(on)
    r, rp = _prefixed(right, pairs, "aj")
    return left.join(r, _cond(left, r, rp, null_safe), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str],
              null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (EXISTS / IN (SELECT ...))."""
    pairs = _pairs(on)
    r, rp = _prefixed(right, pairs, "sj")
    return left.join(r, _cond(left, r, rp, null_safe), "left_semi")


def update_from(target: DataFrame, changes: DataFrame, on: Sequence[str],
                set_cols: Mapping[str, str | Column], only_if: Column | None = None) -> DataFrame:
    """``UPDATE t SET c = s.x FROM t JOIN s ON ...`` as a pure function.

    ``set_cols`` maps a target column to a column of ``changes`` (by name) or to an
    expression over ``changes`` columns (which are visible under their own names prefixed
    with ``src_``).  ``only_if`` (over ``src_`` columns and target columns) restricts the
    update to matching rows satisfying it.  Non-matching rows pass through unchanged; a key
    that repeats in ``changes`` raises (it would multiply target rows), NULL keys match nothing.
    """
    from martkit.operators.keys import unique_source
    changes = unique_source(changes.dropna(subset=list(on)), on, "update")
    src = changes.select(*[F.col(c).alias(f"src_{c}") for c in changes.columns])
    cond = None
    for k in on:
        eq = target[k] == src[f"src_{k}"]
        cond = eq if cond is None else cond & eq
    j = target.join(src, cond, "left")
    matched = F.col(f"src_{on[0]}").isNotNull()
    if only_if is not None:
        matched = matched & F.coalesce(only_if, F.lit(False))
    out = j
    for tcol, s in set_cols.items():
        val = F.col(f"src_{s}") if isinstance(s, str) else s
        out = out.withColumn(tcol, F.when(matched, val).otherwise(F.col(tcol)))
    return out.select(*target.columns)


def lateral_values(df: DataFrame, rows: Sequence[Mapping[str, Column]], keep: Sequence[str],
                   drop_all_null: Sequence[str] | None = None) -> DataFrame:
    """``CROSS APPLY (VALUES (...), (...))`` - each input row fans out to one output
    row per entry of ``rows`` (every entry maps output name -> expression).

    Implemented with ``inline(array(struct(...)))`` - a Generate node in the same stage,
    no shuffle.  ``drop_all_null`` keeps an output row only when one of those columns is not
    NULL (``COALESCE(a, b) IS NOT NULL``).
    """
    names = list(rows[0].keys())
    structs = [F.struct(*[r[n].alias(n) for n in names]) for r in rows]
    out = df.select(*keep, F.inline(F.array(*structs)))
    if drop_all_null:
        out = out.filter(F.coalesce(*[F.col(c) for c in drop_all_null]).isNotNull())
    return out
