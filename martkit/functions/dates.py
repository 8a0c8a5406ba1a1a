"""Date parsing, date keys and calendar helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the warehouse calendar convention.
UNKNOWN_DATE_KEY = -1
ONGOING_DATE_KEY = 99991231
HIGH_DATE = "9999-12-31"
LOW_DATE = "1900-01-01"
PLACEHOLDER_DATES = ("1900-01-01", "1899-12-30")
US_DATE_FORMATS = ("M/d/yyyy", "M/d/yy", "yyyy-MM-dd", "M-d-yyyy")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, formats: tuple[str, ...] = US_DATE_FORMATS) -> Column:
    """Locale-tolerant date parse (TRY_PARSE ... USING 'en-US'): the first format that parses wins."""
    text = F.trim(_c(c))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def safe_date(c: ColumnOrName) -> Column:
    """ISO date text -> DATE, bad text -> NULL."""
    return F.trim(_c(c)).try_cast("date")


def safe_time(c: ColumnOrName) -> Column:
    """Time of day kept as 'HH:mm:ss' text when it is a valid time, else NULL."""
    t = F.trim(_c(c))
    ok = t.rlike(r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,7})?)?$")
    padded = F.when(F.length(F.substring_index(t, ":", 1)) == 1, F.concat(F.lit("0"), t)).otherwise(t)
    hhmmss = F.when(F.length(padded) == 5, F.concat(padded, F.lit(":00"))).otherwise(F.substring(padded, 1, 8))
    return F.when(ok, hhmmss)


def valid_date(c: ColumnOrName, placeholders: tuple[str, ...] = PLACEHOLDER_DATES) -> Column:
    """ISDATE-style probe: parse, and turn the 1900-01-01 / 1899-12-30 placeholders into NULL."""
    d = parse_date(c)
    return F.when(~d.isin(*[F.lit(p).cast("date") for p in placeholders]), d)


def date_key(c: ColumnOrName, unknown: int | None = UNKNOWN_DATE_KEY) -> Column:
    """CAST(FORMAT(d, 'yyyyMMdd') AS INT), NULL -> -1 (or NULL when ``unknown`` is None)."""
    d = _c(c)
    key = (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
    return key if unknown is None else F.coalesce(key, F.lit(unknown))


def key_to_date(c: ColumnOrName) -> Column:
    """yyyymmdd int -> DATE (special keys -1 / 99991231 -> NULL / 9999-12-31)."""
    k = _c(c)
    return F.when(k > 0, F.try_to_date(k.cast("string"), "yyyyMMdd"))


def first_of_year(year: ColumnOrName) -> Column:
    """DATEFROMPARTS(y, 1, 1); NULL year -> NULL."""
    y = _c(year)
    return F.when(y.isNotNull(), F.make_date(y, F.lit(1), F.lit(1)))


def asof_date(d: ColumnOrName, year: ColumnOrName) -> Column:
    """COALESCE(event date, Jan-1 of the year): the as-of date of a yearly row."""
    return F.coalesce(_c(d).cast("date"), first_of_year(year))


def open_ended_key(c: ColumnOrName) -> Column:
    """COALESCE(end_date_key, 99991231)."""
    return F.coalesce(_c(c), F.lit(ONGOING_DATE_KEY))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """DATEDIFF(SECOND, a, b) on timestamps."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def batch_id(now: _dt.datetime | None = None) -> int:
    """yyyyMMddHHmmss batch id, computed once on the driver (a literal, not per row)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return int(now.strftime("%Y%m%d%H%M%S"))


def format_ts(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_c(c), fmt)
