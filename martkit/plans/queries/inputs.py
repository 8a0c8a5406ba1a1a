"""Stand-in inputs derived from the test tables by plain row rules.

They only shape rows into the schemas the mart operators expect (a day-1 and a day-2
customer snapshot, a calendar, ...).  The operators under test run unchanged on them and
never use how they were derived.  The SQL fragments below build the same inputs for the
DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.scd import scd2_apply, seed_dimension
from martkit.plans.calendar import calendar_from_dates, with_special_dates
from martkit.plans.queries.registry import table

SCD_LOAD_DATE = "1998-01-01"
TRACKED = ["c_name", "c_nationkey", "c_mktsegment"]


def customer_day1(spark: SparkSession, sf: str) -> DataFrame:
    """Day-1 customer feed: the customers known before the second load."""
    return table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0) \
        .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def customer_day2(spark: SparkSession, sf: str) -> DataFrame:
    """Day-2 customer feed: every customer; high-balance customers re-segmented."""
    c = table(spark, sf, "customer")
    seg = F.when(F.col("c_acctbal") > 9000, F.lit("AUTOMOBILE")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", "c_name", "c_nationkey", seg.alias("c_mktsegment"))


def customer_specials(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(-1, None, "Unknown", -1, "Unknown")],
        "customer_key bigint, c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    ).withColumns({"EffectiveDate": F.lit("1900-01-01").cast("date"),
                   "ExpirationDate": F.lit("9999-12-31").cast("date"),
                   "CurrentFlag": F.lit(True)})


def customer_dim_v1(spark: SparkSession, sf: str) -> DataFrame:
    """Initial SCD2 customer dimension (keys 1..n by natural key, unknown member -1)."""
    d1 = customer_day1(spark, sf)
    dim = seed_dimension(d1, ["c_custkey"], "customer_key", eff_col="EffectiveDate",
                         exp_col="ExpirationDate", cur_col="CurrentFlag", effective="1900-01-01")
    dim = dim.select("customer_key", "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                     "EffectiveDate", "ExpirationDate", "CurrentFlag")
    return customer_specials(spark).unionByName(dim)


def customer_dim_v2(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension after the day-2 SCD2 load."""
    return scd2_apply(customer_dim_v1(spark, sf), customer_day2(spark, sf), ["c_custkey"], TRACKED,
                      SCD_LOAD_DATE, "customer_key")


def order_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar over every order and ship date, with the special members."""
    o = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    li = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return with_special_dates(calendar_from_dates(o.unionByName(li), "d"))


# --- SQL twins ---------------------------------------------------------------------

SQL_CUSTOMER_DIM = """
d1 AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0),
d2 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal > 9000 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment
       FROM customer),
v1 AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key, d1.* FROM d1),
cls AS (SELECT d2.*, v1.customer_key AS old_key,
               CASE WHEN v1.customer_key IS NULL THEN 'NEW'
                    WHEN v1.c_name IS DISTINCT FROM d2.c_name
                      OR v1.c_nationkey IS DISTINCT FROM d2.c_nationkey
                      OR v1.c_mktsegment IS DISTINCT FROM d2.c_mktsegment THEN 'CHANGE'
                    ELSE 'NO_CHANGE' END AS change_type
        FROM d2 LEFT JOIN v1 ON v1.c_custkey = d2.c_custkey),
v2new AS (SELECT (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY c_custkey) AS customer_key,
                 c_custkey, c_name, c_nationkey, c_mktsegment,
                 DATE '1998-01-01' AS EffectiveDate, DATE '9999-12-31' AS ExpirationDate, TRUE AS CurrentFlag
          FROM cls WHERE change_type IN ('NEW', 'CHANGE')),
dim AS (
  SELECT CAST(-1 AS BIGINT) AS customer_key, CAST(NULL AS BIGINT) AS c_custkey, 'Unknown' AS c_name,
         -1 AS c_nationkey, 'Unknown' AS c_mktsegment,
         DATE '1900-01-01' AS EffectiveDate, DATE '9999-12-31' AS ExpirationDate, TRUE AS CurrentFlag
  UNION ALL
  SELECT v1.customer_key, v1.c_custkey, v1.c_name, v1.c_nationkey, v1.c_mktsegment, DATE '1900-01-01',
         CASE WHEN cls.change_type = 'CHANGE' THEN DATE '1997-12-31' ELSE DATE '9999-12-31' END,
         cls.change_type IS DISTINCT FROM 'CHANGE'
  FROM v1 LEFT JOIN cls ON cls.c_custkey = v1.c_custkey
  UNION ALL
  SELECT * FROM v2new)
"""

SQL_CALENDAR_DATES = """
cal_dates AS (SELECT DISTINCT d FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem) x WHERE d IS NOT NULL),
cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
               EXTRACT(doy FROM d) AS CalendarDay, EXTRACT(year FROM d) AS CalendarYear FROM cal_dates
        UNION ALL SELECT -1, DATE '1900-01-01', -1, -1
        UNION ALL SELECT 99991231, DATE '9999-12-31', 365, 9999)
"""
