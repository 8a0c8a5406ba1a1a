"""Calendar (date) dimension: keys ``yyyymmdd``, special members -1 (unknown) and 99991231.

Built with ``sequence`` + ``explode`` over the date range - every attribute is a column
expression, so a century of dates is one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.dates import date_key

DIM_DATE_COLUMNS = [
    "DateKey", "FullDate", "DayLongName", "DayShortName", "MonthLongName", "MonthShortName",
    "CalendarDay", "CalendarDayInWeek", "CalendarWeek", "CalendarWeekStartDateId", "CalendarWeekEndDateId",
    "CalendarMonth", "CalendarMonthStartDateId", "CalendarMonthEndDateId", "CalendarNumberOfDaysInMonth",
    "CalendarDayInMonth", "CalendarQuarter", "CalendarQuarterStartDateId", "CalendarQuarterEndDateId",
    "CalendarNumberOfDaysInQuarter", "CalendarDayInQuarter", "CalendarYear", "CalendarYearStartDateId",
    "CalendarYearEndDateId", "CalendarNumberOfDaysInYear",
]


def calendar_attributes(d: Column) -> dict[str, Column]:
    """Every DimDate attribute of a DATE column (week starts on Sunday, day-in-week 1..7)."""
    week_start = F.date_sub(d, F.dayofweek(d) - 1)
    month_start = F.trunc(d, "month")
    month_end = F.last_day(d)
    q_start = F.trunc(d, "quarter")
    q_end = F.date_sub(F.add_months(q_start, 3), 1)
    y_start = F.trunc(d, "year")
    y_end = F.date_sub(F.add_months(y_start, 12), 1)
    return {
        "DateKey": date_key(d, unknown=None),
        "FullDate": d,
        "DayLongName": F.date_format(d, "EEEE"),
        "DayShortName": F.date_format(d, "EEE"),
        "MonthLongName": F.date_format(d, "MMMM"),
        "MonthShortName": F.date_format(d, "MMM"),
        "CalendarDay": F.dayofyear(d),
        "CalendarDayInWeek": F.dayofweek(d),
        "CalendarWeek": F.weekofyear(d),
        "CalendarWeekStartDateId": date_key(week_start, unknown=None),
        "CalendarWeekEndDateId": date_key(F.date_add(week_start, 6), unknown=None),
        "CalendarMonth": F.month(d),
        "CalendarMonthStartDateId": date_key(month_start, unknown=None),
        "CalendarMonthEndDateId": date_key(month_end, unknown=None),
        "CalendarNumberOfDaysInMonth": F.dayofmonth(month_end),
        "CalendarDayInMonth": F.dayofmonth(d),
        "CalendarQuarter": F.quarter(d),
        "CalendarQuarterStartDateId": date_key(q_start, unknown=None),
        "CalendarQuarterEndDateId": date_key(q_end, unknown=None),
        "CalendarNumberOfDaysInQuarter": F.datediff(q_end, q_start) + 1,
        "CalendarDayInQuarter": F.datediff(d, q_start) + 1,
        "CalendarYear": F.year(d),
        "CalendarYearStartDateId": date_key(y_start, unknown=None),
        "CalendarYearEndDateId": date_key(y_end, unknown=None),
        "CalendarNumberOfDaysInYear": F.datediff(y_end, y_start) + 1,
    }


def calendar_from_dates(dates: DataFrame, date_col: str) -> DataFrame:
    """Calendar rows for the distinct dates of a column (e.g. every order date)."""
    d = dates.select(F.col(date_col).cast("date").alias("_d")).filter(F.col("_d").isNotNull()).distinct()
    attrs = calendar_attributes(F.col("_d"))
    return d.select(*[attrs[c].alias(c) for c in DIM_DATE_COLUMNS])


def calendar_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date between ``start`` and ``end`` inclusive."""
    one = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("_d"))
    attrs = calendar_attributes(F.col("_d"))
    return one.select(*[attrs[c].alias(c) for c in DIM_DATE_COLUMNS])


def special_dates(spark: SparkSession) -> DataFrame:
    """The unknown member (-1) and the open-ended member (99991231)."""
    # Fixed values of the two special calendar members.
    unknown = [-1, "1900-01-01", "Unknown", "Unk", "Unknown", "Unk"] + [-1] * 19
    ongoing = [99991231, "9999-12-31", "December", "Dec", "December", "Dec",
               365, 3, 53, 99991224, 99991231, 12, 99991201, 99991231, 31, 31,
               4, 99991001, 99991231, 92, 92, 9999, 99990101, 99991231, 365]
    schema = T.StructType([T.StructField(c, T.StringType() if i in (1, 2, 3, 4, 5) else T.IntegerType())
                           for i, c in enumerate(DIM_DATE_COLUMNS)])
    df = spark.createDataFrame([[str(v) if i in (1, 2, 3, 4, 5) else v for i, v in enumerate(r)]
                                for r in (unknown, ongoing)], schema)
    return df.withColumn("FullDate", F.col("FullDate").cast("date"))


def with_special_dates(calendar: DataFrame) -> DataFrame:
    spark = calendar.sparkSession
    cal = calendar.select(*[F.col(c).cast("date" if c == "FullDate" else ("string" if c.endswith("Name") else "int")).alias(c)
                            for c in DIM_DATE_COLUMNS])
    return special_dates(spark).select(*DIM_DATE_COLUMNS).unionByName(cal)
