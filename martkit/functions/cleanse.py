"""Cleansing column expressions for all-string raw sources.

Every function maps ``Column -> Column`` and stays inside Catalyst (no Python per row),
so a column spec of hundreds of these compiles into one whole-stage-codegen projection.
Raw values arrive as text; ``try_cast`` is used throughout because Spark's ANSI mode makes
a plain ``cast`` raise on bad text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The sentinel tokens the raw feeds use for "no value".
NONE_TOKENS = ("None", "", "undefined")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F7 / F6 / F16: trimming and sentinels ---------------------------------------------

def trimmed(c: ColumnOrName) -> Column:
    """LTRIM(RTRIM(x)) - spaces only, like the source system's TRIM."""
    return F.trim(_c(c))


def null_if_token(c: ColumnOrName, *tokens: str) -> Column:
    """NULLIF(TRIM(x), token) for one or more sentinel tokens ('None', '', 'undefined')."""
    out = trimmed(c)
    for tok in tokens or ("",):
        out = F.when(out == F.lit(tok), F.lit(None).cast("string")).otherwise(out)
    return out


def null_if_blank(c: ColumnOrName) -> Column:
    """NULLIF(TRIM(x), '')."""
    return null_if_token(c, "")


def default_if_blank(c: ColumnOrName, default: str = "Unknown") -> Column:
    """COALESCE(NULLIF(TRIM(x), ''), default)."""
    return F.coalesce(null_if_blank(c), F.lit(default))


# --- F8 / F9 / F10 / F11: text shaping ------------------------------------------------

def truncate(c: ColumnOrName, n: int) -> Column:
    """LEFT(x, n)."""
    return F.substring(_c(c), 1, n)


def clean_text(c: ColumnOrName, n: int | None = None, token: str = "None") -> Column:
    """LEFT(NULLIF(TRIM(x), token), n): the standard staging treatment of a text column."""
    out = null_if_token(c, token)
    return truncate(out, n) if n else out


def strip_decimal_suffix(c: ColumnOrName, token: str = "None") -> Column:
    """Codes that went through a float round-trip ('98104.0' -> '98104').

    When the text holds a '.', keep what precedes the first one; otherwise NULLIF(TRIM, token).
    """
    col = _c(c)
    return F.when(F.instr(col, ".") > 0, F.substring_index(col, ".", 1)).otherwise(null_if_token(col, token))


def norm_key(c: ColumnOrName) -> Column:
    """UPPER(TRIM(x)): the join key the source system compared case- and pad-insensitively."""
    return F.upper(trimmed(c))


# --- F1-F5: safe numeric casts -------------------------------------------------------

def safe_cast(c: ColumnOrName, dtype: str) -> Column:
    """TRY_CAST(x AS dtype): NULL instead of an error."""
    return _c(c).try_cast(dtype)


def float_text_to_int(c: ColumnOrName, dtype: str = "int") -> Column:
    """TRY_CAST(TRY_CAST(x AS FLOAT) AS INT): '416.0' -> 416, '12.9' -> 12 (truncates)."""
    return _c(c).try_cast("double").try_cast(dtype)


def float_text_to_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """TRY_CAST(TRY_CAST(x AS FLOAT) AS DECIMAL(p,s))."""
    return _c(c).try_cast("double").try_cast(f"decimal({precision},{scale})")


def float_text_to_id(c: ColumnOrName) -> Column:
    """CAST(TRY_CAST(TRY_CAST(x AS FLOAT) AS BIGINT) AS VARCHAR): '1234.0' -> '1234'."""
    return _c(c).try_cast("double").try_cast("bigint").cast("string")


def thousands_number(c: ColumnOrName, dtype: str = "decimal(18,2)") -> Column:
    """TRY_CAST(NULLIF(REPLACE(TRIM(x), ',', ''), '') AS dtype): '1,234.5' -> 1234.50."""
    cleaned = F.replace(trimmed(c), F.lit(","), F.lit(""))
    return null_if_blank(cleaned).try_cast(dtype)


def thousands_to_int(c: ColumnOrName, dtype: str = "int") -> Column:
    """Thousands-separated number parsed as decimal(18,2) then cast to an integer (truncates)."""
    return thousands_number(c, "decimal(18,2)").try_cast(dtype)


def thousands_to_id(c: ColumnOrName) -> Column:
    """Id text with separators: decimal(18,0) then VARCHAR ('1,234' -> '1234')."""
    return thousands_number(c, "decimal(18,0)").cast("string")


# --- F12 / F17 / F18 / F19 / F31: code conformance -----------------------------------

def text_to_flag(c: ColumnOrName, true_tokens: Iterable[str] = ("TRUE",),
                 false_tokens: Iterable[str] = ("FALSE",)) -> Column:
    """'true'/'false' (any case, padded) -> True/False, anything else -> NULL."""
    u = norm_key(c)
    return (F.when(u.isin(*list(true_tokens)), F.lit(True))
             .when(u.isin(*list(false_tokens)), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def conform_code(c: ColumnOrName, mapping: Mapping[str, Iterable[str]], default: str | None = None,
                 normalise: bool = True) -> Column:
    """Map many spellings onto a closed code set.

    ``mapping`` is ``{target: [spelling, ...]}``; spellings are compared after UPPER(TRIM()).
    Unmatched values become ``default`` (or stay NULL when ``default`` is None).
    """
    key = norm_key(c) if normalise else _c(c)
    out = None
    for target, spellings in mapping.items():
        cond = key.isin(*[s.upper().strip() if normalise else s for s in spellings])
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    dflt = F.lit(default) if default is not None else F.lit(None).cast("string")
    return dflt if out is None else out.otherwise(dflt)


def classify_like(c: ColumnOrName, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Ordered LIKE classification: the first ``(pattern, code)`` whose pattern matches
    UPPER(x) wins (e.g. ``('%FULL%', 'FT')``)."""
    u = F.upper(_c(c))
    out = None
    for pattern, code in rules:
        cond = u.like(pattern)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    dflt = F.lit(default) if default is not None else F.lit(None).cast("string")
    return dflt if out is None else out.otherwise(dflt)


# --- F23 - F28: null-safe arithmetic and comparison -----------------------------------

def concat_nullsafe(*cols: ColumnOrName, sep: str = "") -> Column:
    """CONCAT treating NULL as '' (the source semantics; Spark's concat yields NULL)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


# Marker for NULL inside a row hash, so NULL and '' hash differently.
NULL_MARKER = "\u0000"


def row_hash(*cols: ColumnOrName, sep: str = "\u001f") -> Column:
    """SHA-256 over a separated, NULL-marked concatenation (separator avoids 'ab|c' == 'a|bc')."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Null-safe inequality: NULL vs NULL is equal, NULL vs value differs."""
    return ~_c(a).eqNullSafe(_c(b))


def any_differs(pairs: Iterable[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | differs(a, b)
    return out


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, dtype: str = "decimal(18,4)") -> Column:
    """num / den only when den > 0, else NULL."""
    d = _c(den)
    return F.when(d > 0, (_c(num) / d).try_cast(dtype)).otherwise(F.lit(None).cast(dtype))


def sum_null_zero(*cols: ColumnOrName) -> Column:
    """ISNULL(a,0) + ISNULL(b,0) + ..."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(_c(c), F.lit(0))
    return out


def clamped_remainder(total: ColumnOrName, *parts: ColumnOrName) -> Column:
    """total - sum(parts) floored at 0; NULL when the total is NULL; NULL parts count as 0."""
    t = _c(total)
    rest = t - sum_null_zero(*parts)
    return F.when(t.isNull(), F.lit(None)).when(rest < 0, F.lit(0)).otherwise(rest)


def keep_if_not_before(milestone: ColumnOrName, anchor: ColumnOrName) -> Column:
    """Keep a milestone date only when it is on/after the anchor date (filled >= posted)."""
    m, a = _c(milestone), _c(anchor)
    return F.when(m.isNotNull() & a.isNotNull() & (m >= a), m)


def status_flag(c: ColumnOrName, true_values: Iterable[str], default: bool = False) -> Column:
    """Status text -> boolean flag, unmatched/NULL -> default."""
    return F.when(_c(c).isin(*list(true_values)), F.lit(True)).otherwise(F.lit(default))
