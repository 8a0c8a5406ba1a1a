"""Cleansing, safe casting, code conformance, date parsing, filters and DQ gating
(S1, P1-P10, F1-F31, Q4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions import cleanse as cl
from martkit.functions import dates as dt
from martkit.functions.spec import Col, project
from martkit.operators.quality import Rule, flag_rows
from martkit.plans.calendar import DIM_DATE_COLUMNS
from martkit.plans.queries.inputs import order_calendar
from martkit.plans.queries.registry import query, table


@query("typed_staging_projection", sql="""
WITH raw AS (
  SELECT '  ' || CAST(c_custkey AS VARCHAR) || '.0' AS "Customer Id",
         ' ' || c_name || '  ' AS "Customer Name",
         CAST(c_nationkey AS VARCHAR) AS "Nation",
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS "Account Balance",
         CASE WHEN c_acctbal < 0 THEN 'None' ELSE c_mktsegment END AS "Segment"
  FROM customer)
SELECT CAST(CAST(trunc(TRY_CAST(NULLIF(trim("Customer Id"), 'None') AS DOUBLE)) AS BIGINT) AS VARCHAR) AS cust_id,
       left(NULLIF(trim("Customer Name"), 'None'), 12) AS cust_name,
       TRY_CAST(NULLIF(trim("Nation"), 'None') AS INTEGER) AS nation_key,
       CAST(TRY_CAST(NULLIF(trim("Account Balance"), 'None') AS DECIMAL(18,2)) AS DOUBLE) AS acctbal,
       left(NULLIF(trim("Segment"), 'None'), 5) AS segment
FROM raw
""")
def typed_staging_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Raw all-string customer feed (padded, float-formatted ids, 'None' sentinels) ->
    typed, trimmed, truncated staging columns through one declarative column spec."""
    c = table(spark, sf, "customer")
    raw = c.select(
        F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(".0")).alias("Customer Id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("Customer Name"),
        F.col("c_nationkey").cast("string").alias("Nation"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("Account Balance"),
        F.when(F.col("c_acctbal") < 0, F.lit("None")).otherwise(F.col("c_mktsegment")).alias("Segment"))
    staged = project(raw, [
        Col("cust_id", "Customer Id", "float_id"),
        Col("cust_name", "Customer Name", "text", length=12),
        Col("nation_key", "Nation", "int"),
        Col("acctbal", "Account Balance", "decimal"),
        Col("segment", "Segment", "text", length=5),
    ])
    return staged.withColumn("acctbal", F.col("acctbal").cast("double"))


@query("safe_numeric_cast", sql="""
WITH raw AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_quantity AS VARCHAR) AS qty_text,
         format('{:,.2f}', l_extendedprice) AS price_text,
         CASE WHEN l_returnflag = 'R' THEN 'None' WHEN l_returnflag = 'A' THEN ' '
              ELSE CAST(l_discount AS VARCHAR) END AS disc_text,
         CASE WHEN l_linestatus = 'O' THEN CAST(l_tax AS VARCHAR) || 'x' ELSE CAST(l_tax AS VARCHAR) END AS tax_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CAST(trunc(TRY_CAST(qty_text AS DOUBLE)) AS INTEGER) AS qty,
       CAST(TRY_CAST(NULLIF(replace(trim(price_text), ',', ''), '') AS DECIMAL(18,2)) AS DOUBLE) AS price,
       CAST(trunc(TRY_CAST(NULLIF(replace(trim(price_text), ',', ''), '') AS DECIMAL(18,2))) AS INTEGER) AS price_int,
       TRY_CAST(NULLIF(NULLIF(trim(disc_text), 'None'), '') AS DOUBLE) AS discount,
       CAST(TRY_CAST(tax_text AS DECIMAL(18,2)) AS DOUBLE) AS tax
FROM raw
""")
def safe_numeric_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Line-item numbers rendered as text ('17.0', '68,423.46', 'None', '', '0.02x') and
    parsed back with the safe casts: float-text -> int (truncating), thousands-separated ->
    decimal and -> int, sentinel -> NULL, malformed -> NULL."""
    li = table(spark, sf, "lineitem")
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("string").alias("qty_text"),
        F.format_number("l_extendedprice", 2).alias("price_text"),
        F.when(F.col("l_returnflag") == "R", F.lit("None")).when(F.col("l_returnflag") == "A", F.lit(" "))
         .otherwise(F.col("l_discount").cast("string")).alias("disc_text"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.col("l_tax").cast("string"), F.lit("x")))
         .otherwise(F.col("l_tax").cast("string")).alias("tax_text"))
    return raw.select(
        "l_orderkey", "l_linenumber",
        cl.float_text_to_int("qty_text").alias("qty"),
        cl.thousands_number("price_text").cast("double").alias("price"),
        cl.thousands_to_int("price_text").alias("price_int"),
        cl.safe_cast(cl.null_if_token("disc_text", "None", ""), "double").alias("discount"),
        cl.safe_cast("tax_text", "decimal(18,2)").cast("double").alias("tax"))


@query("sentinel_to_null_default", sql="""
WITH raw AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'None' WHEN c_acctbal < 100 THEN '   ' ELSE ' ' || c_mktsegment END AS seg
  FROM customer)
SELECT coalesce(NULLIF(NULLIF(trim(seg), 'None'), ''), 'Unknown') AS segment, count(*) AS n
FROM raw GROUP BY 1
""")
def sentinel_to_null_default(spark: SparkSession, sf: str) -> DataFrame:
    """Sentinel text ('None', blank) -> NULL -> default member 'Unknown'."""
    c = table(spark, sf, "customer")
    raw = (F.when(F.col("c_acctbal") < 0, F.lit("None")).when(F.col("c_acctbal") < 100, F.lit("   "))
            .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))))
    seg = cl.default_if_blank(cl.null_if_token(raw, "None", ""), "Unknown")
    return c.groupBy(seg.alias("segment")).agg(F.count(F.lit(1)).alias("n"))


# Priority spellings -> conformed names, and LIKE classification rules.
PRIORITY_MAP = {"Urgent": ["1-URGENT"], "High": ["2-HIGH"], "Medium": ["3-MEDIUM"], "Low": ["5-LOW"]}
PRIORITY_CLASSES = [("%URGENT%", "U"), ("%HIGH%", "H"), ("%LOW%", "L")]
STATUS_NAMES = {"Finished": ["F"], "Open": ["O"]}


@query("code_conformance", sql="""
WITH raw AS (
  SELECT o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN lower(o_orderpriority)
              WHEN o_orderstatus = 'O' THEN '  ' || o_orderpriority || ' '
              ELSE o_orderpriority END AS prio
  FROM orders)
SELECT CASE WHEN upper(trim(prio)) IN ('1-URGENT') THEN 'Urgent'
            WHEN upper(trim(prio)) IN ('2-HIGH') THEN 'High'
            WHEN upper(trim(prio)) IN ('3-MEDIUM') THEN 'Medium'
            WHEN upper(trim(prio)) IN ('5-LOW') THEN 'Low'
            ELSE 'Not Specified' END AS priority,
       CASE WHEN upper(prio) LIKE '%URGENT%' THEN 'U'
            WHEN upper(prio) LIKE '%HIGH%' THEN 'H'
            WHEN upper(prio) LIKE '%LOW%' THEN 'L'
            ELSE 'N' END AS priority_class,
       CASE WHEN upper(trim(o_orderstatus)) = 'F' THEN 'Finished'
            WHEN upper(trim(o_orderstatus)) = 'O' THEN 'Open'
            ELSE 'Pending' END AS status_name,
       count(*) AS n
FROM raw GROUP BY 1, 2, 3
""")
def code_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """Many spellings (case, padding) -> closed code set with a default bucket; ordered
    LIKE classification; status code expansion."""
    o = table(spark, sf, "orders")
    prio = (F.when(F.col("o_orderstatus") == "F", F.lower("o_orderpriority"))
             .when(F.col("o_orderstatus") == "O", F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
             .otherwise(F.col("o_orderpriority")))
    return o.groupBy(
        cl.conform_code(prio, PRIORITY_MAP, default="Not Specified").alias("priority"),
        cl.classify_like(prio, PRIORITY_CLASSES, default="N").alias("priority_class"),
        cl.conform_code("o_orderstatus", STATUS_NAMES, default="Pending").alias("status_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("code_strip_suffix", sql="""
SELECT p_partkey,
       substring(p_brand, 7) AS brand_no,
       CASE WHEN strpos(CAST(p_retailprice AS VARCHAR), '.') > 0
            THEN left(CAST(p_retailprice AS VARCHAR), strpos(CAST(p_retailprice AS VARCHAR), '.') - 1)
            ELSE NULLIF(trim(CAST(p_retailprice AS VARCHAR)), 'None') END AS price_code
FROM part
""")
def code_strip_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Code extraction: substring after the 'Brand#' prefix; decimal suffix stripped from a
    code that went through a float ('900.1' -> '900')."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.expr("substring(p_brand, 7)").alias("brand_no"),
                    cl.strip_decimal_suffix(F.col("p_retailprice").cast("string")).alias("price_code"))


@query("parse_locale_date", sql="""
WITH raw AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%-m/%-d/%Y')
              WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE 'n/a ' || strftime(o_orderdate, '%Y') END AS txt
  FROM orders)
SELECT o_orderkey,
       coalesce(CAST(strftime(coalesce(try_strptime(txt, '%m/%d/%Y'), try_strptime(txt, '%Y-%m-%d')), '%Y%m%d') AS INTEGER), -1)
         AS order_date_key
FROM raw
""")
def parse_locale_date(spark: SparkSession, sf: str) -> DataFrame:
    """US 'M/d/yyyy' and ISO date text parsed back (locale-tolerant), bad text -> NULL,
    then the yyyymmdd date key with -1 for unknown."""
    o = table(spark, sf, "orders")
    txt = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))
            .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.concat(F.lit("n/a "), F.date_format("o_orderdate", "yyyy"))))
    return o.select("o_orderkey", dt.date_key(dt.parse_date(txt)).alias("order_date_key"))


@query("date_key_calendar", sql="""
WITH dts AS (SELECT DISTINCT d FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem) x WHERE d IS NOT NULL),
c AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey,
         dayname(d) AS DayLongName, strftime(d, '%a') AS DayShortName,
         monthname(d) AS MonthLongName, strftime(d, '%b') AS MonthShortName,
         CAST(dayofyear(d) AS INTEGER) AS CalendarDay, CAST(dayofweek(d) + 1 AS INTEGER) AS CalendarDayInWeek,
         CAST(weekofyear(d) AS INTEGER) AS CalendarWeek,
         CAST(strftime(d - CAST(dayofweek(d) AS INTEGER), '%Y%m%d') AS INTEGER) AS CalendarWeekStartDateId,
         CAST(month(d) AS INTEGER) AS CalendarMonth,
         CAST(strftime(date_trunc('month', d), '%Y%m%d') AS INTEGER) AS CalendarMonthStartDateId,
         CAST(strftime(last_day(d), '%Y%m%d') AS INTEGER) AS CalendarMonthEndDateId,
         CAST(day(last_day(d)) AS INTEGER) AS CalendarNumberOfDaysInMonth,
         CAST(quarter(d) AS INTEGER) AS CalendarQuarter,
         CAST(strftime(date_trunc('quarter', d), '%Y%m%d') AS INTEGER) AS CalendarQuarterStartDateId,
         CAST(date_diff('day', CAST(date_trunc('quarter', d) AS DATE),
                        CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE)) AS INTEGER) AS CalendarNumberOfDaysInQuarter,
         CAST(date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1 AS INTEGER) AS CalendarDayInQuarter,
         CAST(year(d) AS INTEGER) AS CalendarYear,
         CAST(CASE WHEN (year(d) % 4 = 0 AND year(d) % 100 <> 0) OR year(d) % 400 = 0 THEN 366 ELSE 365 END AS INTEGER)
           AS CalendarNumberOfDaysInYear
  FROM dts)
SELECT * FROM c
UNION ALL SELECT -1, 'Unknown', 'Unk', 'Unknown', 'Unk', -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1
UNION ALL SELECT 99991231, 'December', 'Dec', 'December', 'Dec', 365, 3, 53, 99991224, 12, 99991201, 99991231, 31,
                 4, 99991001, 92, 92, 9999, 365
""")
def date_key_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar dimension over every order/ship date (yyyymmdd keys and calendar
    attributes) plus the unknown (-1) and open-ended (99991231) members."""
    cols = ["DateKey", "DayLongName", "DayShortName", "MonthLongName", "MonthShortName", "CalendarDay",
            "CalendarDayInWeek", "CalendarWeek", "CalendarWeekStartDateId", "CalendarMonth",
            "CalendarMonthStartDateId", "CalendarMonthEndDateId", "CalendarNumberOfDaysInMonth",
            "CalendarQuarter", "CalendarQuarterStartDateId", "CalendarNumberOfDaysInQuarter",
            "CalendarDayInQuarter", "CalendarYear", "CalendarNumberOfDaysInYear"]
    assert set(cols) <= set(DIM_DATE_COLUMNS)
    return order_calendar(spark, sf).select(*cols)


@query("null_safe_compare", sql="""
WITH a AS (SELECT c_custkey, c_nationkey,
                  CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
b AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL
                             WHEN c_acctbal > 9000 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS seg FROM customer)
SELECT a.c_nationkey,
       count(*) AS n_rows,
       sum(CASE WHEN a.seg IS DISTINCT FROM b.seg THEN 1 ELSE 0 END) AS n_changed_null_safe,
       sum(CASE WHEN a.seg <> b.seg THEN 1 ELSE 0 END) AS n_changed_naive
FROM a JOIN b ON a.c_custkey = b.c_custkey
GROUP BY a.c_nationkey
""")
def null_safe_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Null-safe inequality between two snapshots of an attribute vs. the naive '<>'
    (which misses every change to or from NULL)."""
    c = table(spark, sf, "customer")
    a = c.select("c_custkey", "c_nationkey",
                 F.when(F.col("c_acctbal") > 9500, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg_a"))
    b = c.select(F.col("c_custkey").alias("k"),
                 F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_acctbal") > 9000, F.lit("AUTOMOBILE"))
                  .otherwise(F.col("c_mktsegment")).alias("seg_b"))
    j = a.join(b, a["c_custkey"] == b["k"])
    return j.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(cl.differs("seg_a", "seg_b"), 1).otherwise(0)).alias("n_changed_null_safe"),
        F.sum(F.when(F.col("seg_a") != F.col("seg_b"), 1).otherwise(0)).alias("n_changed_naive"))


@query("guarded_ratio", sql="""
SELECT l_returnflag, l_linestatus,
       count(*) FILTER (WHERE NOT (l_quantity - 1 > 0)) AS n_guarded,
       min(CASE WHEN l_quantity - 1 > 0 THEN l_extendedprice / (l_quantity - 1) END) AS min_ratio,
       max(CASE WHEN l_quantity - 1 > 0 THEN l_extendedprice / (l_quantity - 1) END) AS max_ratio
FROM lineitem GROUP BY 1, 2
""")
def guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Price per extra unit with a zero-denominator guard (denominator <= 0 -> NULL)."""
    li = table(spark, sf, "lineitem")
    r = cl.guarded_ratio("l_extendedprice", F.col("l_quantity") - 1, dtype="double")
    return li.withColumn("r", r).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.when(F.col("r").isNull(), 1)).alias("n_guarded"),
        F.min("r").alias("min_ratio"), F.max("r").alias("max_ratio"))


@query("clamped_remainder", sql="""
WITH b AS (
  SELECT l_returnflag, l_linestatus,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS total,
         l_linenumber AS a, CAST(round(l_discount * 100) AS INTEGER) AS d
  FROM lineitem),
c AS (SELECT *, coalesce(a, 0) + coalesce(d, 0) AS parts FROM b)
SELECT l_returnflag, l_linestatus,
       sum(parts) AS parts_total,
       sum(CASE WHEN total IS NULL THEN NULL WHEN total - parts < 0 THEN 0 ELSE total - parts END) AS other_total,
       count(*) FILTER (WHERE total IS NOT NULL AND total - parts < 0) AS n_clamped,
       count(*) FILTER (WHERE total IS NULL) AS n_null_total
FROM c GROUP BY 1, 2
""")
def clamped_remainder(spark: SparkSession, sf: str) -> DataFrame:
    """NULL-as-zero sum of parts and 'other = total - parts' floored at 0 (NULL total stays NULL)."""
    li = table(spark, sf, "lineitem")
    b = li.select("l_returnflag", "l_linestatus",
                  F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_quantity").cast("int")).alias("total"),
                  F.col("l_linenumber").alias("a"), F.round(F.col("l_discount") * 100).cast("int").alias("d"))
    c = b.withColumns({"parts": cl.sum_null_zero("a", "d"), "other": cl.clamped_remainder("total", "a", "d")})
    return c.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("parts").alias("parts_total"), F.sum("other").alias("other_total"),
        F.count(F.when(F.col("total").isNotNull() & (F.col("total") - F.col("parts") < 0), 1)).alias("n_clamped"),
        F.count(F.when(F.col("total").isNull(), 1)).alias("n_null_total"))


@query("non_blank_filter", sql="""
WITH raw AS (
  SELECT CASE WHEN event_type = 'error' THEN '  ' ELSE event_type || ' ' END AS etype,
         CASE WHEN event_type = 'purchase' THEN replace(replace(props, '{"k": ', ''), '}', '') || '?'
              ELSE replace(replace(props, '{"k": ', ''), '}', '') END AS k_text,
         CASE WHEN value > 50 THEN value END AS big_value, CASE WHEN user_id < 20 THEN user_id END AS vip
  FROM events)
SELECT trim(etype) AS event_type, count(*) AS n, sum(TRY_CAST(k_text AS INTEGER)) AS k_total
FROM raw
WHERE etype IS NOT NULL AND trim(etype) <> ''
  AND TRY_CAST(k_text AS INTEGER) IS NOT NULL
  AND coalesce(big_value, vip) IS NOT NULL
GROUP BY 1
""")
def non_blank_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Non-blank key filter, keep-only-castable filter and 'any measure present' filter."""
    e = table(spark, sf, "events")
    k = F.replace(F.replace("props", F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit(""))
    raw = e.select(
        F.when(F.col("event_type") == "error", F.lit("  ")).otherwise(F.concat("event_type", F.lit(" "))).alias("etype"),
        F.when(F.col("event_type") == "purchase", F.concat(k, F.lit("?"))).otherwise(k).alias("k_text"),
        F.when(F.col("value") > 50, F.col("value")).alias("big_value"),
        F.when(F.col("user_id") < 20, F.col("user_id")).alias("vip"))
    kept = (raw.filter(F.trim("etype") != "")
               .filter(cl.safe_cast("k_text", "int").isNotNull())
               .filter(F.coalesce(F.col("big_value"), F.col("vip").cast("double")).isNotNull()))
    return kept.groupBy(F.trim("etype").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cl.safe_cast("k_text", "int")).alias("k_total"))


@query("membership_filter", sql="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 100000
GROUP BY 1, 2
""")
def membership_filter(spark: SparkSession, sf: str) -> DataFrame:
    """IN-list membership and positive-measure filters (pushed into the Parquet scan)."""
    o = table(spark, sf, "orders")
    kept = o.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_totalprice") > 100000))
    return kept.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query("reject_split", sql="""
SELECT CASE WHEN NOT (l.l_shipdate >= o.o_orderdate) THEN 'ship_before_order'
            WHEN NOT (l.l_discount <= 0.08) THEN 'discount_out_of_range'
            WHEN NOT (l.l_tax BETWEEN 0 AND 0.07) THEN 'tax_out_of_range'
            ELSE 'VALID' END AS dq_reason,
       count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1
""")
def reject_split(spark: SparkSession, sf: str) -> DataFrame:
    """Row-level DQ flags (date sequence, discount and tax ranges), valid/reject split with
    the first failing rule kept as the reject reason."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    rules = [Rule("ship_before_order", F.col("l_shipdate") >= F.col("o_orderdate")),
             Rule("discount_out_of_range", F.col("l_discount") <= 0.08),
             Rule("tax_out_of_range", F.col("l_tax").between(0, 0.07))]
    flagged = flag_rows(j, rules)
    return flagged.groupBy(F.coalesce(F.col("dq_reason"), F.lit("VALID")).alias("dq_reason")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("milestone_guard", sql="""
WITH s AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem GROUP BY 1)
SELECT o.o_orderkey,
       CASE WHEN s.first_ship IS NOT NULL AND s.first_ship >= CAST(o.o_orderdate AS DATE)
            THEN CAST(strftime(s.first_ship, '%Y%m%d') AS INTEGER) END AS first_ship_key
FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey
""")
def milestone_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional milestone: an order's first-ship date key is kept only when the ship date
    is not before the order date (otherwise unknown)."""
    li = table(spark, sf, "lineitem")
    s = li.groupBy("l_orderkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("first_ship"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("od"))
    j = o.join(s, o["o_orderkey"] == s["l_orderkey"], "left")
    return j.select("o_orderkey",
                    dt.date_key(cl.keep_if_not_before("first_ship", "od"), unknown=None).alias("first_ship_key"))


@query("text_flag_and_time", sql="""
WITH raw AS (
  SELECT CASE event_type WHEN 'click' THEN ' TRUE' WHEN 'view' THEN 'false ' WHEN 'error' THEN 'maybe' ELSE '' END AS flag_text,
         CASE WHEN event_type = 'signup' THEN 'n/a' ELSE strftime(ts, '%-H:%M') END AS time_text
  FROM events)
SELECT CASE upper(trim(flag_text)) WHEN 'TRUE' THEN 1 WHEN 'FALSE' THEN 0 END AS flag,
       CASE WHEN regexp_matches(trim(time_text), '^([01]?[0-9]|2[0-3]):[0-5][0-9]$')
            THEN substring(lpad(trim(time_text), 5, '0'), 1, 2) END AS hour,
       count(*) AS n
FROM raw GROUP BY 1, 2
""")
def text_flag_and_time(spark: SparkSession, sf: str) -> DataFrame:
    """Text booleans ('TRUE' / 'false', padded, anything else -> NULL) and time-of-day text
    ('7:05' -> '07:05:00', invalid -> NULL) from the event stream."""
    e = table(spark, sf, "events")
    flag_text = (F.when(F.col("event_type") == "click", F.lit(" TRUE")).when(F.col("event_type") == "view", F.lit("false "))
                  .when(F.col("event_type") == "error", F.lit("maybe")).otherwise(F.lit("")))
    time_text = F.when(F.col("event_type") == "signup", F.lit("n/a")).otherwise(F.date_format("ts", "H:mm"))
    parsed = e.select(cl.text_to_flag(flag_text).cast("int").alias("flag"), dt.safe_time(time_text).alias("t"))
    return parsed.groupBy("flag", F.substring("t", 1, 2).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("placeholder_dates", sql="""
WITH raw AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN '1900-01-01'
              WHEN o_orderpriority = '5-LOW' THEN '12/30/1899'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt
  FROM orders),
p AS (SELECT coalesce(try_strptime(txt, '%m/%d/%Y'), try_strptime(txt, '%Y-%m-%d'))::DATE AS d FROM raw)
SELECT CAST(year(CASE WHEN d IN (DATE '1900-01-01', DATE '1899-12-30') THEN NULL ELSE d END) AS INTEGER) AS year,
       count(*) AS n
FROM p GROUP BY 1
""")
def placeholder_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Date validity probe: parse, and treat the 1900-01-01 / 1899-12-30 placeholders (and
    unparseable text) as unknown."""
    o = table(spark, sf, "orders")
    txt = (F.when(F.col("o_orderstatus") == "P", F.lit("1900-01-01"))
            .when(F.col("o_orderpriority") == "5-LOW", F.lit("12/30/1899"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("unknown"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.groupBy(F.year(dt.valid_date(txt)).alias("year")).agg(F.count(F.lit(1)).alias("n"))
