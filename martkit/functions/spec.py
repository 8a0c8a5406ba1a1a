"""Declarative column specs: raw (all-string, oddly named) -> typed staging projection.

A spec is a list of ``Col(target, source, kind, ...)``.  ``project`` turns it into one
``select`` so the whole raw->staging conversion is a single codegen'd projection that
Catalyst can prune (unused targets never read their source column).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions import cleanse as cl
from martkit.functions import dates as dt


@dataclass(frozen=True)
class Col:
    """One staging column.

    kind: text | code | float_int | float_bigint | float_decimal | float_id | number |
          number_int | number_id | date | us_date | time | flag | literal | expr
    """

    target: str
    source: str | None = None
    kind: str = "text"
    length: int | None = None
    token: str = "None"
    dtype: str | None = None
    value: object = None
    fn: Callable[[Column], Column] | None = field(default=None, compare=False)


def _source(df_cols: set[str], name: str) -> Column:
    if name not in df_cols:
        raise KeyError(f"raw column {name!r} not found")
    return F.col(f"`{name}`")


def column_expr(spec: Col, df_cols: set[str]) -> Column:
    k = spec.kind
    if k == "literal":
        return F.lit(spec.value).cast(spec.dtype or "string")
    src = _source(df_cols, spec.source or spec.target)
    if k == "expr":
        return spec.fn(src)
    if k == "text":
        return cl.clean_text(src, spec.length, spec.token)
    if k == "code":
        return cl.strip_decimal_suffix(src, spec.token) if spec.length is None else \
            cl.truncate(cl.strip_decimal_suffix(src, spec.token), spec.length)
    if k == "float_int":
        return cl.float_text_to_int(cl.null_if_token(src, spec.token), "int")
    if k == "float_bigint":
        return cl.float_text_to_int(cl.null_if_token(src, spec.token), "bigint")
    if k == "float_decimal":
        return cl.float_text_to_decimal(cl.null_if_token(src, spec.token))
    if k == "float_id":
        return cl.float_text_to_id(cl.null_if_token(src, spec.token))
    if k == "number":
        return cl.thousands_number(src, spec.dtype or "decimal(18,2)")
    if k == "number_int":
        return cl.thousands_to_int(src, spec.dtype or "int")
    if k == "number_id":
        return cl.thousands_to_id(src)
    if k == "decimal":
        return cl.null_if_token(src, spec.token).try_cast(spec.dtype or "decimal(18,2)")
    if k == "date":
        return dt.safe_date(src)
    if k == "us_date":
        return dt.parse_date(src)
    if k == "time":
        return dt.safe_time(src)
    if k == "flag":
        return cl.text_to_flag(src)
    if k == "int":
        return cl.null_if_token(src, spec.token).try_cast(spec.dtype or "int")
    raise ValueError(f"unknown column kind {k!r}")


def project(df: DataFrame, specs: Iterable[Col]) -> DataFrame:
    """Raw -> typed staging in one ``select``."""
    cols = set(df.columns)
    return df.select(*[column_expr(s, cols).alias(s.target) for s in specs])


# --- S2: header drift between yearly files --------------------------------------------

def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip leading/trailing blanks from header names (2022+ files pad them)."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename per a layout map (missing keys are ignored) without touching other columns."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def conform_layout(df: DataFrame, mapping: Mapping[str, str], target_columns: Iterable[str]) -> DataFrame:
    """Normalise headers, rename to canonical names and add absent targets as NULL text."""
    out = rename_columns(normalise_headers(df), mapping)
    targets = list(target_columns)
    return out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).cast("string").alias(c)
                        for c in targets])
