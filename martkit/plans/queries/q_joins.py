"""Lookups and joins: unknown member, SCD2 as-of (closed / half-open), fallback as-of
date, role-playing dates, normalised / mapped / composite / cast keys, pre-aggregated
left joins, anti / semi joins, update through join, lateral values (J1-J22, C9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions import dates as dt
from martkit.operators.aggregates import max_where, min_where
from martkit.operators import joins as jn
from martkit.operators.joins import anti_join, semi_join, update_from
from martkit.operators.keys import assign_keys
from martkit.operators.lookup import Lookup, bounded_broadcast, mapped_key, resolve_keys
from martkit.plans.queries.inputs import SQL_CALENDAR_DATES, SQL_CUSTOMER_DIM, customer_dim_v2, order_calendar
from martkit.plans.queries.registry import query, table

# A calendar is bounded by its date range (366 rows per year), not by data volume, so it is
# broadcast as is; dimensions that grow with the data get a row-count check or AQE.


@query("lookup_unknown_member", sql="""
WITH dim AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key, c_custkey
             FROM customer WHERE c_acctbal >= 0)
SELECT o.o_orderkey, coalesce(d.customer_key, -1) AS customer_key
FROM orders o LEFT JOIN dim d ON o.o_custkey = d.c_custkey
""")
def lookup_unknown_member(spark: SparkSession, sf: str) -> DataFrame:
    """Natural key -> surrogate key lookup; orders of customers missing from the
    dimension resolve to the unknown member -1."""
    dim = assign_keys(customer_day_known(spark, sf), ["c_custkey"], "customer_key")
    o = table(spark, sf, "orders")
    return resolve_keys(o, [Lookup(dim, [("o_custkey", "c_custkey")], "customer_key", "customer_key")]) \
        .select("o_orderkey", "customer_key")


def customer_day_known(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0).select("c_custkey")


def _asof_orders(spark: SparkSession, sf: str, interval: str, asof) -> DataFrame:
    dim = customer_dim_v2(spark, sf)
    o = table(spark, sf, "orders")
    return resolve_keys(o, [Lookup(dim, [("o_custkey", "c_custkey")], "customer_key", "customer_key",
                                   asof=asof, interval=interval)]).select("o_orderkey", "customer_key")


@query("scd2_lookup_closed", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT o.o_orderkey, coalesce(d.customer_key, -1) AS customer_key
FROM orders o LEFT JOIN dim d ON o.o_custkey = d.c_custkey
  AND CAST(o.o_orderdate AS DATE) >= d.EffectiveDate AND CAST(o.o_orderdate AS DATE) <= d.ExpirationDate
""")
def scd2_lookup_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Effective-dated lookup, closed interval eff <= d <= exp."""
    return _asof_orders(spark, sf, "closed", F.col("o_orderdate").cast("date"))


@query("scd2_lookup_half_open", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT o.o_orderkey, coalesce(d.customer_key, -1) AS customer_key
FROM orders o LEFT JOIN dim d ON o.o_custkey = d.c_custkey
  AND CAST(o.o_orderdate AS DATE) >= d.EffectiveDate AND CAST(o.o_orderdate AS DATE) < d.ExpirationDate
""")
def scd2_lookup_half_open(spark: SparkSession, sf: str) -> DataFrame:
    """Effective-dated lookup, half-open interval eff <= d < exp (the last valid day of an
    expired version misses)."""
    return _asof_orders(spark, sf, "half_open", F.col("o_orderdate").cast("date"))


@query("asof_fallback_date", sql=f"""
WITH {SQL_CUSTOMER_DIM},
o AS (SELECT o_orderkey, o_custkey,
             coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END,
                      make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1)) AS asof
      FROM orders)
SELECT o.o_orderkey, coalesce(d.customer_key, -1) AS customer_key
FROM o LEFT JOIN dim d ON o.o_custkey = d.c_custkey AND o.asof BETWEEN d.EffectiveDate AND d.ExpirationDate
""")
def asof_fallback_date(spark: SparkSession, sf: str) -> DataFrame:
    """As-of lookup where a missing event date falls back to January 1st of its year."""
    event_date = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderdate").cast("date"))
    return _asof_orders(spark, sf, "closed", dt.asof_date(event_date, F.year("o_orderdate")))


@query("role_playing_dates", sql=f"""
WITH {SQL_CALENDAR_DATES},
ships AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship
          FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey,
       coalesce(c1.DateKey, -1) AS order_date_key,
       coalesce(c2.DateKey, -1) AS first_ship_key,
       coalesce(c3.DateKey, -1) AS last_ship_key
FROM orders o
LEFT JOIN ships s ON s.l_orderkey = o.o_orderkey
LEFT JOIN cal c1 ON c1.FullDate = CAST(o.o_orderdate AS DATE) AND c1.DateKey > 0
LEFT JOIN cal c2 ON c2.FullDate = s.first_ship AND c2.DateKey > 0
LEFT JOIN cal c3 ON c3.FullDate = s.last_ship AND c3.DateKey > 0
""")
def role_playing_dates(spark: SparkSession, sf: str) -> DataFrame:
    """One calendar dimension joined in three roles (order date, first ship, last ship)."""
    cal = order_calendar(spark, sf).filter(F.col("DateKey") > 0).select("DateKey", "FullDate")
    li = table(spark, sf, "lineitem")
    ships = li.groupBy("l_orderkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("first_ship"),
                                         F.max(F.col("l_shipdate").cast("date")).alias("last_ship"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    fact = o.join(ships, o["o_orderkey"] == ships["l_orderkey"], "left")
    roles = [("order_date", "order_date_key"), ("first_ship", "first_ship_key"), ("last_ship", "last_ship_key")]
    fact = resolve_keys(fact, [Lookup(cal, [(src, "FullDate")], "DateKey", out, broadcast=True)
                               for src, out in roles])
    return fact.select("o_orderkey", "order_date_key", "first_ship_key", "last_ship_key")


@query("preagg_left_join", sql="""
WITH agg AS (
  SELECT l_orderkey, count(*) AS n_lines,
         min(CASE WHEN l_returnflag = 'R' THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END) AS first_return_key,
         max(CASE WHEN l_returnflag = 'A' THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END) AS last_accept_key
  FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, coalesce(a.n_lines, 0) AS n_lines,
       coalesce(a.first_return_key, -1) AS first_return_key, coalesce(a.last_accept_key, 99991231) AS last_accept_key
FROM orders o LEFT JOIN agg a ON a.l_orderkey = o.o_orderkey
""")
def preagg_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Left join to a pre-aggregated relation with filtered MIN / MAX (one aggregate pass),
    counts defaulting to 0, open-ended dates to 99991231."""
    li = table(spark, sf, "lineitem")
    key = dt.date_key("l_shipdate", unknown=None)
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        min_where(key, F.col("l_returnflag") == "R").alias("first_return_key"),
        max_where(key, F.col("l_returnflag") == "A").alias("last_accept_key"))
    o = table(spark, sf, "orders").select("o_orderkey")
    j = o.join(agg, o["o_orderkey"] == agg["l_orderkey"], "left")
    return j.select("o_orderkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                    F.coalesce("first_return_key", F.lit(-1)).alias("first_return_key"),
                    dt.open_ended_key("last_accept_key").alias("last_accept_key"))


@query("normalized_text_join", sql="""
WITH raw AS (
  SELECT c.c_custkey,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN lower(n.n_name)
              WHEN c.c_mktsegment = 'MACHINERY' THEN '  ' || n.n_name || ' '
              ELSE n.n_name END AS nation_text
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
SELECT r.c_custkey, coalesce(n.n_nationkey, -1) AS nation_key
FROM raw r LEFT JOIN nation n ON upper(trim(r.nation_text)) = upper(trim(n.n_name))
""")
def normalized_text_join(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup on normalised text (UPPER(TRIM())) of mixed-case / padded names."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    nations = bounded_broadcast(n.select("n_nationkey", "n_name"), 10_000)
    raw = c.join(nations, c["c_nationkey"] == nations["n_nationkey"]).select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("n_name"))
         .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
         .otherwise(F.col("n_name")).alias("nation_text"))
    return resolve_keys(raw, [Lookup(n, [("nation_text", "n_name")], "n_nationkey", "nation_key",
                                     normalise=True, broadcast=10_000)]).select("c_custkey", "nation_key")


# Status code -> status name mapping used by the lookup.
STATUS_CODE_TO_NAME = {"F": "Fulfilled", "O": "Open"}


@query("mapped_key_join", sql="""
WITH sdim AS (SELECT * FROM (VALUES ('Fulfilled', 1), ('Open', 2), ('P', 3)) t(status_name, status_key))
SELECT o.o_orderkey, coalesce(a.status_key, -1) AS status_key, coalesce(b.status_key, -1) AS status_key_strict
FROM orders o
LEFT JOIN sdim a ON a.status_name = CASE o.o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
                                                         ELSE o.o_orderstatus END
LEFT JOIN sdim b ON b.status_name = CASE o.o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
                                                         ELSE 'Unknown' END
""")
def mapped_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Join on a CASE-mapped key with the two ELSE rules (keep the input / map to 'Unknown')."""
    sdim = spark.createDataFrame([("Fulfilled", 1), ("Open", 2), ("P", 3)], "status_name string, status_key int")
    o = table(spark, sf, "orders")
    fact = o.select("o_orderkey",
                    mapped_key("o_orderstatus", STATUS_CODE_TO_NAME, F.col("o_orderstatus")).alias("k1"),
                    mapped_key("o_orderstatus", STATUS_CODE_TO_NAME, "Unknown").alias("k2"))
    return resolve_keys(fact, [Lookup(sdim, [("k1", "status_name")], "status_key", "status_key", broadcast=True),
                               Lookup(sdim, [("k2", "status_name")], "status_key", "status_key_strict",
                                      broadcast=True)]).select("o_orderkey", "status_key", "status_key_strict")


def _band(v: str = "value") -> F.Column:
    return (F.when(F.col(v) < 10, F.lit("low")).when(F.col(v) < 50, F.lit("mid")).otherwise(F.lit("high")))


SQL_BAND = "CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END"


@query("composite_lookup", sql=f"""
WITH combos AS (SELECT DISTINCT event_type, {SQL_BAND} AS band FROM events WHERE ts < TIMESTAMP '2024-01-16'),
dim AS (SELECT CAST(row_number() OVER (ORDER BY event_type, band) AS BIGINT) AS type_band_key, * FROM combos)
SELECT e.event_id, coalesce(d.type_band_key, -1) AS type_band_key
FROM events e LEFT JOIN dim d ON d.event_type = e.event_type AND d.band = {SQL_BAND.replace('value', 'e.value')}
""")
def composite_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Composite-key (type x value band) dimension keyed from the first half of the month,
    then every event resolved on both columns."""
    e = table(spark, sf, "events")
    combos = e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) \
        .select("event_type", _band().alias("band")).distinct()
    dim = assign_keys(combos, ["event_type", "band"], "type_band_key")
    fact = e.select("event_id", "event_type", _band().alias("band"))
    return resolve_keys(fact, [Lookup(dim, [("event_type", "event_type"), ("band", "band")], "type_band_key",
                                      "type_band_key", broadcast=100_000)]).select("event_id", "type_band_key")


@query("cast_key_join", sql="""
WITH dim AS (SELECT CAST(row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR)) AS BIGINT) AS doc_key,
                    CAST(doc_id AS VARCHAR) AS source_doc_id FROM documents)
SELECT l.doc_id, coalesce(d.doc_key, -1) AS doc_key
FROM labels l LEFT JOIN dim d ON d.source_doc_id = CAST(l.doc_id AS VARCHAR)
""")
def cast_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Join on a BIGINT id cast to the dimension's VARCHAR natural key."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("source_doc_id"))
    dim = assign_keys(docs, ["source_doc_id"], "doc_key")
    lab = table(spark, sf, "labels")
    return resolve_keys(lab, [Lookup(dim, [(F.col("doc_id").cast("string"), "source_doc_id")], "doc_key",
                                     "doc_key")]).select("doc_id", "doc_key")


@query("anti_join_new_rows", sql="""
SELECT c_mktsegment, count(*) AS n_without_orders
FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                                                AND o.o_orderpriority = '1-URGENT')
GROUP BY 1
""")
def anti_join_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """NOT EXISTS on a single key (customers without an urgent order)."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return anti_join(c, o, {"c_custkey": "o_custkey"}).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("n_without_orders"))


@query("anti_join_grain", sql="""
WITH loaded AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT l_returnflag, count(*) AS n_new
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM loaded x WHERE x.l_orderkey = l.l_orderkey AND x.l_linenumber = l.l_linenumber
                  AND x.l_partkey = l.l_partkey)
GROUP BY 1
""")
def anti_join_grain(spark: SparkSession, sf: str) -> DataFrame:
    """NOT EXISTS on a composite grain (3 columns): incoming line items not yet loaded."""
    li = table(spark, sf, "lineitem")
    loaded = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    grain = ["l_orderkey", "l_linenumber", "l_partkey"]
    return anti_join(li, loaded.select(*grain), grain).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_new"))


@query("null_safe_anti_join", sql="""
WITH g AS (SELECT user_id, event_type, CASE WHEN value < 1 THEN NULL ELSE CAST(floor(value / 25) AS INTEGER) END AS band,
                  ts FROM events),
existing AS (SELECT DISTINCT user_id, event_type, band FROM g WHERE ts < TIMESTAMP '2024-01-10'),
incoming AS (SELECT DISTINCT user_id, event_type, band FROM g)
SELECT i.* FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.user_id = i.user_id AND e.event_type = i.event_type
                  AND e.band IS NOT DISTINCT FROM i.band)
""")
def null_safe_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """NOT EXISTS on a nullable grain with NULL-safe equality (NULL matches NULL), so grains
    containing NULL are not re-inserted."""
    e = table(spark, sf, "events")
    g = e.select("user_id", "event_type",
                 F.when(F.col("value") < 1, F.lit(None)).otherwise(F.floor(F.col("value") / 25).cast("int")).alias("band"),
                 "ts")
    grain = ["user_id", "event_type", "band"]
    existing = g.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).select(*grain).distinct()
    incoming = g.select(*grain).distinct()
    return anti_join(incoming, existing, grain, null_safe=True)


@query("semi_join_exists", sql="""
SELECT o_orderstatus, count(*) AS n_with_returns
FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
GROUP BY 1
""")
def semi_join_exists(spark: SparkSession, sf: str) -> DataFrame:
    """EXISTS as a left-semi join (orders with a returned line)."""
    o = table(spark, sf, "orders")
    ret = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return semi_join(o, ret, {"o_orderkey": "l_orderkey"}).groupBy("o_orderstatus") \
        .agg(F.count(F.lit(1)).alias("n_with_returns"))


@query("semi_join_in", sql="""
SELECT c_mktsegment, count(*) AS n_urgent_customers
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY 1
""")
def semi_join_in(spark: SparkSession, sf: str) -> DataFrame:
    """IN (SELECT ...) as a left-semi join."""
    c = table(spark, sf, "customer")
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return semi_join(c, urgent, {"c_custkey": "o_custkey"}).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("n_urgent_customers"))


@query("update_from_join", sql="""
WITH bm AS (SELECT p_brand, max(p_retailprice) AS brand_max FROM part GROUP BY p_brand)
SELECT p.p_partkey, p.p_size,
       CASE WHEN p.p_size > 25 THEN bm.brand_max ELSE p.p_retailprice END AS p_retailprice
FROM part p LEFT JOIN bm ON bm.p_brand = p.p_brand
""")
def update_from_join(spark: SparkSession, sf: str) -> DataFrame:
    """UPDATE ... FROM target JOIN changes: large parts take their brand's top price."""
    p = table(spark, sf, "part")
    changes = p.groupBy("p_brand").agg(F.max("p_retailprice").alias("brand_max"))
    out = update_from(p, changes, ["p_brand"], {"p_retailprice": "brand_max"}, only_if=F.col("p_size") > 25)
    return out.select("p_partkey", "p_size", "p_retailprice")


@query("lateral_values", sql="""
WITH v AS (
  SELECT l.l_returnflag, x.measure, x.value
  FROM lineitem l,
       LATERAL (VALUES ('quantity', CAST(l.l_quantity AS DECIMAL(18,2))),
                       ('price', CAST(l.l_extendedprice AS DECIMAL(18,2))),
                       ('discount', CASE WHEN l.l_discount > 0 THEN CAST(l.l_discount AS DECIMAL(18,2)) END)) x(measure, value)
  WHERE x.value IS NOT NULL)
SELECT l_returnflag, measure, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total
FROM v GROUP BY 1, 2
""")
def lateral_values(spark: SparkSession, sf: str) -> DataFrame:
    """CROSS APPLY (VALUES ...): each line fans out to (measure, value) rows; NULL values dropped."""
    li = table(spark, sf, "lineitem")
    rows = [{"measure": F.lit("quantity"), "value": F.col("l_quantity").cast("decimal(18,2)")},
            {"measure": F.lit("price"), "value": F.col("l_extendedprice").cast("decimal(18,2)")},
            {"measure": F.lit("discount"),
             "value": F.when(F.col("l_discount") > 0, F.col("l_discount").cast("decimal(18,2)"))}]
    long = jn.lateral_values(li, rows, keep=["l_returnflag"], drop_all_null=["value"])
    return long.groupBy("l_returnflag", "measure").agg(F.count(F.lit(1)).alias("n"),
                                                        F.sum("value").cast("double").alias("total"))
