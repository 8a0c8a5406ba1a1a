"""Reshaping, aggregates, de-duplication windows, ordering and set operations
(R1-R4, J11, J12, A1-A15, W1-W8, O1-O5, S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.spec import conform_layout
from martkit.operators import aggregates as ag
from martkit.operators.dedup import dedup_grain, keep_first, latest_per_key
from martkit.operators.reshape import align_metrics, distinct_years, pivot_wide, union_layouts, unpivot_years
from martkit.plans.queries.registry import query, table


def _money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)")


def _supplier_year_revenue(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")) \
        .agg(F.sum(_money("l_extendedprice")).alias("revenue"))


@query("unpivot_years", sql="""
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem GROUP BY 1, 2
""")
def unpivot_years_q(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly revenue pivoted wide (one column per year, like the yearly metric files) and
    unpivoted back to (year, value) rows with NULL cells dropped."""
    revenue = _supplier_year_revenue(spark, sf)
    years = distinct_years(table(spark, sf, "lineitem"), F.year("l_shipdate"))
    wide = pivot_wide(revenue, ["l_suppkey"], "year", years, "revenue", prefix="y")
    long = unpivot_years(wide, ["l_suppkey"], [f"y{y}" for y in years], value_col="revenue")
    return long.withColumn("revenue", F.col("revenue").cast("double"))


@query("metric_alignment", sql="""
WITH q AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS v
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
p AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
      FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
d AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS v
      FROM lineitem WHERE coalesce(l_returnflag, 'N') NOT IN ('R', 'A') GROUP BY 1, 2),
k AS (SELECT l_suppkey, year FROM q UNION SELECT l_suppkey, year FROM p UNION SELECT l_suppkey, year FROM d)
SELECT k.l_suppkey, k.year, CAST(q.v AS BIGINT) AS qty, CAST(p.v AS DOUBLE) AS price, d.v AS n_discounted
FROM k LEFT JOIN q ON q.l_suppkey = k.l_suppkey AND q.year = k.year
       LEFT JOIN p ON p.l_suppkey = k.l_suppkey AND p.year = k.year
       LEFT JOIN d ON d.l_suppkey = k.l_suppkey AND d.year = k.year
""")
def metric_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Three metric relations (the lines split by return flag, so that they cover different
    (supplier, year) keys) aligned into one wide row per key: union-long + one conditional aggregate (one shuffle)."""
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    g = ["l_suppkey", "year"]
    q = li.filter(F.col("l_returnflag") == "R").groupBy(*g) \
        .agg(F.sum("l_quantity").alias("value"))
    p = li.filter(F.col("l_returnflag") == "A").groupBy(*g) \
        .agg(F.sum(_money("l_extendedprice")).cast("double").alias("value"))
    d = li.filter(~F.coalesce("l_returnflag", F.lit("N")).isin("R", "A")).groupBy(*g) \
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    wide = align_metrics({"qty": q, "price": p, "n_discounted": d}, g)
    return wide.select("l_suppkey", "year", F.col("qty").cast("bigint").alias("qty"), "price",
                       F.col("n_discounted").cast("bigint").alias("n_discounted"))


@query("peak_first_latest", sql="""
WITH y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
           FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY revenue DESC, year DESC) AS rk_peak,
                row_number() OVER (PARTITION BY l_suppkey ORDER BY year ASC) AS rk_first,
                row_number() OVER (PARTITION BY l_suppkey ORDER BY year DESC) AS rk_latest FROM y)
SELECT p.l_suppkey, f.year AS first_year, CAST(f.revenue AS DOUBLE) AS first_revenue,
       l.year AS latest_year, CAST(l.revenue AS DOUBLE) AS latest_revenue,
       p.year AS peak_year, CAST(p.revenue AS DOUBLE) AS peak_revenue
FROM r p JOIN r f ON f.l_suppkey = p.l_suppkey AND f.rk_first = 1
         JOIN r l ON l.l_suppkey = p.l_suppkey AND l.rk_latest = 1
WHERE p.rk_peak = 1
""")
def peak_first_latest(spark: SparkSession, sf: str) -> DataFrame:
    """First, latest and peak year per supplier (with their revenue) in ONE aggregate using
    min_by / max_by instead of a self-join per ranking."""
    y = _supplier_year_revenue(spark, sf)
    return y.groupBy("l_suppkey").agg(
        F.min("year").alias("first_year"), ag.arg_min("revenue", "year").cast("double").alias("first_revenue"),
        F.max("year").alias("latest_year"), ag.arg_max("revenue", "year").cast("double").alias("latest_revenue"),
        ag.arg_max("year", "revenue", "year").alias("peak_year"),
        F.max("revenue").cast("double").alias("peak_revenue"))


@query("groupby_min_max", sql="""
SELECT upper(trim(p_type)) AS part_type, max(p_retailprice) AS max_price, min(p_retailprice) AS min_price,
       min(p_size) AS min_size, max(p_size) AS max_size, min(p_name) AS first_name, max(p_name) AS last_name
FROM part GROUP BY 1
""")
def groupby_min_max(spark: SparkSession, sf: str) -> DataFrame:
    """Group-by MIN / MAX on cleaned expressions (one row per cleaned type)."""
    p = table(spark, sf, "part")
    return ag.grouped(p, [F.upper(F.trim("p_type")).alias("part_type")], {
        "max_price": F.max("p_retailprice"), "min_price": F.min("p_retailprice"),
        "min_size": F.min("p_size"), "max_size": F.max("p_size"),
        "first_name": F.min("p_name"), "last_name": F.max("p_name")})


@query("two_level_max", sql="""
WITH pp AS (SELECT l_suppkey, l_partkey, max(l_extendedprice) AS m FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, max(m) AS max_price, count(*) AS n_parts FROM pp GROUP BY 1
""")
def two_level_max(spark: SparkSession, sf: str) -> DataFrame:
    """MAX per (supplier, part), then MAX per supplier (MAX of MAX) with the part count."""
    li = table(spark, sf, "lineitem")
    pp = li.groupBy("l_suppkey", "l_partkey").agg(F.max("l_extendedprice").alias("m"))
    return pp.groupBy("l_suppkey").agg(F.max("m").alias("max_price"), F.count(F.lit(1)).alias("n_parts"))


@query("having_filter", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM lineitem GROUP BY 1, 2 HAVING l_returnflag <> 'N'
""")
def having_filter(spark: SparkSession, sf: str) -> DataFrame:
    """HAVING on a group key, evaluated as a filter before the aggregation (pushed to the scan)."""
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag") != "N")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"))


@query("sum_null_zero", sql="""
SELECT o_orderstatus, o_orderpriority,
       CAST(sum(coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END, 0)) AS DOUBLE)
         AS urgent_revenue
FROM orders GROUP BY 1, 2
""")
def sum_null_zero(spark: SparkSession, sf: str) -> DataFrame:
    """SUM(ISNULL(x, 0)): groups whose values are all NULL report 0, not NULL."""
    o = table(spark, sf, "orders")
    x = F.when(F.col("o_orderpriority") == "1-URGENT", _money("o_totalprice"))
    return o.groupBy("o_orderstatus", "o_orderpriority").agg(ag.sum_zero(x).cast("double").alias("urgent_revenue"))


@query("year_span", sql="""
SELECT o_custkey, CAST(max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS INTEGER) AS active_years,
       count(*) AS n_orders
FROM orders GROUP BY 1
""")
def year_span(spark: SparkSession, sf: str) -> DataFrame:
    """MAX(year) - MIN(year) + 1 per customer."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(ag.span(F.year("o_orderdate")).cast("int").alias("active_years"),
                                      F.count(F.lit(1)).alias("n_orders"))


@query("count_by_group", sql="""
SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n
FROM lineitem GROUP BY 1, 2, 3
""")
def count_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """COUNT(*) per group."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("mode_per_group", sql="""
WITH c AS (SELECT l.l_suppkey, p.p_type, count(*) AS n
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type ASC) AS rk FROM c)
SELECT l_suppkey, p_type AS top_part_type, n AS top_count FROM r WHERE rk = 1
""")
def mode_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent part type per supplier (ties -> smallest type): count, then min_by."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    return ag.mode_per_group(j, ["l_suppkey"], "p_type", out="top_part_type", count_out="top_count")


@query("count_distinct", sql="""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers,
       count(DISTINCT (o_custkey, o_orderstatus)) AS n_customer_status
FROM orders GROUP BY 1
""")
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """COUNT(DISTINCT) on one and on two columns."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("n_customers"),
        F.count_distinct("o_custkey", "o_orderstatus").alias("n_customer_status"))


@query("avg_summary", sql="""
SELECT c.c_mktsegment, count(*) AS n_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1 ORDER BY n_orders DESC
""")
def avg_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AVG / COUNT summary by category ordered by count (average = exact sum / count)."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    out = j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"),
                                        F.sum(_money("o_totalprice")).cast("double").alias("_s"))
    return out.select("c_mktsegment", "n_orders", (F.col("_s") / F.col("n_orders")).alias("avg_price")) \
        .orderBy(F.desc("n_orders"))


@query("distinct_grain", sql="""
SELECT DISTINCT l.l_suppkey, p.p_type, CAST(year(l.l_shipdate) AS INTEGER) AS year
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def distinct_grain(spark: SparkSession, sf: str) -> DataFrame:
    """DISTINCT projection of a grain (supplier x part type x year)."""
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return li.join(p, li["l_partkey"] == p["p_partkey"]) \
        .select("l_suppkey", "p_type", F.year("l_shipdate").alias("year")).distinct()


@query("latest_per_key", sql="""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1
""")
def latest_per_key_q(spark: SparkSession, sf: str) -> DataFrame:
    """Latest row per key (ts DESC with an id tie-break)."""
    e = table(spark, sf, "events")
    return latest_per_key(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("dedup_grain", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_grain_q(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (order, line number) grain - the test data repeats that grain."""
    li = table(spark, sf, "lineitem")
    return dedup_grain(li, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("dedup_nulls_last", sql="""
WITH s AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS ship,
                  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
           FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY ship ASC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                            l_discount, l_tax, l_returnflag, l_linestatus, ship ASC NULLS LAST) AS rn
      FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       coalesce(CAST(strftime(ship, '%Y%m%d') AS INTEGER), -1) AS ship_key
FROM r WHERE rn = 1
""")
def dedup_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """Keep the earliest-shipped row per grain with unknown dates ordered last, ties
    broken by every column (a deterministic total order)."""
    li = table(spark, sf, "lineitem")
    s = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_shipdate").cast("date")).alias("ship"),
                  "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus")
    kept = keep_first(s, ["l_orderkey", "l_linenumber"], [F.col("ship").asc_nulls_last()])
    from martkit.functions.dates import date_key
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                       date_key("ship").alias("ship_key"))


@query("first_per_code", sql="""
SELECT p_brand, p_name, p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS rn FROM part) x
WHERE rn = 1
""")
def first_per_code(spark: SparkSession, sf: str) -> DataFrame:
    """First name per classified code (brand), ties by id."""
    p = table(spark, sf, "part")
    return keep_first(p, ["p_brand"], ["p_name", "p_partkey"]).select("p_brand", "p_name", "p_partkey")


@query("order_desc_report", sql="""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n_orders
FROM orders GROUP BY 1 ORDER BY revenue DESC, o_custkey ASC
""")
def order_desc_report(spark: SparkSession, sf: str) -> DataFrame:
    """Full report ordered by an aggregate descending (total order: id tie-break)."""
    o = table(spark, sf, "orders")
    agg = o.groupBy("o_custkey").agg(F.sum(_money("o_totalprice")).cast("double").alias("revenue"),
                                     F.count(F.lit(1)).alias("n_orders"))
    return agg.orderBy(F.desc("revenue"), F.asc("o_custkey"))


@query("limit_sample", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1
""")
def limit_sample(spark: SparkSession, sf: str) -> DataFrame:
    """TOP 1 sample row, made deterministic (earliest order, id tie-break)."""
    o = table(spark, sf, "orders")
    return o.orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_custkey", "o_orderstatus")


# Per-layout header maps of the two half-year order files (raw name -> canonical name).
LAYOUT_H1 = {"Order Key": "order_key", "Customer": "cust_key", "Total Price": "total_price"}
LAYOUT_H2 = {"OrderKey": "order_key", "CustKey": "cust_key", "TotalPrice": "total_price", "Priority": "priority"}
CANONICAL = ["order_key", "cust_key", "total_price", "priority", "half"]


@query("layout_union", sql="""
WITH u AS (
  SELECT o_orderkey AS order_key, CAST(o_totalprice AS VARCHAR) AS total_price, NULL AS priority, 1 AS half
  FROM orders WHERE month(o_orderdate) <= 6
  UNION ALL
  SELECT o_orderkey, CAST(o_totalprice AS VARCHAR), o_orderpriority, 2 FROM orders WHERE month(o_orderdate) > 6)
SELECT half, count(*) AS n, count(priority) AS n_with_priority,
       CAST(sum(CAST(TRY_CAST(total_price AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM u GROUP BY half
""")
def layout_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two yearly-file layouts with different (padded) header names conformed to one
    canonical layout and unioned by name; absent columns become NULL."""
    o = table(spark, sf, "orders")
    h1 = o.filter(F.month("o_orderdate") <= 6).select(
        F.col("o_orderkey").cast("string").alias(" Order Key "), F.col("o_custkey").cast("string").alias("Customer"),
        F.col("o_totalprice").cast("string").alias("Total Price  "), F.lit("1").alias("half"))
    h2 = o.filter(F.month("o_orderdate") > 6).select(
        F.col("o_orderkey").cast("string").alias("OrderKey"), F.col("o_custkey").cast("string").alias("CustKey"),
        F.col("o_totalprice").cast("string").alias("TotalPrice"), F.col("o_orderpriority").alias("Priority"),
        F.lit("2").alias("half"))
    u = union_layouts([conform_layout(h1, LAYOUT_H1, CANONICAL), conform_layout(h2, LAYOUT_H2, CANONICAL)])
    return u.groupBy(F.col("half").cast("int").alias("half")).agg(
        F.count(F.lit(1)).alias("n"), F.count("priority").alias("n_with_priority"),
        F.sum(F.col("total_price").try_cast("double").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query("multi_measure_unpivot", sql="""
WITH v AS (
  SELECT l_linestatus, x.kind, x.qty, x.price
  FROM lineitem,
       LATERAL (VALUES
         ('returned', CASE WHEN l_returnflag = 'R' THEN l_quantity END,
                      CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END),
         ('accepted', CASE WHEN l_returnflag = 'A' THEN l_quantity END,
                      CASE WHEN l_returnflag = 'A' AND l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END),
         ('discounted', NULL, CASE WHEN l_discount >= 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)
       ) x(kind, qty, price)
  WHERE coalesce(x.qty, CAST(x.price AS DOUBLE)) IS NOT NULL)
SELECT l_linestatus, kind, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(price) AS DOUBLE) AS price
FROM v GROUP BY 1, 2
""")
def multi_measure_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-measure unpivot: every line fans out into (kind, quantity, price) variants and a
    variant is kept only when one of its measures is present."""
    from martkit.operators.reshape import unpivot_measures
    li = table(spark, sf, "lineitem")
    flag, disc = F.col("l_returnflag"), F.col("l_discount")
    price = _money("l_extendedprice")
    variants = [
        {"kind": F.lit("returned"), "qty": F.when(flag == "R", F.col("l_quantity")), "price": F.when(flag == "R", price)},
        {"kind": F.lit("accepted"), "qty": F.when(flag == "A", F.col("l_quantity")),
         "price": F.when((flag == "A") & (disc > 0), price)},
        {"kind": F.lit("discounted"), "qty": F.lit(None).cast("double"), "price": F.when(disc >= 0.05, price)},
    ]
    long = unpivot_measures(li, ["l_linestatus"], variants)
    long = long.filter(F.coalesce(F.col("qty"), F.col("price").cast("double")).isNotNull())
    return long.groupBy("l_linestatus", "kind").agg(F.count(F.lit(1)).alias("n"),
                                                     F.sum("qty").cast("bigint").alias("qty"),
                                                     F.sum("price").cast("double").alias("price"))


@query("union_key_sets", sql="""
SELECT l_suppkey, year FROM (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE l_returnflag = 'R'
  UNION SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R'
  UNION SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) FROM orders) u
""")
def union_key_sets(spark: SparkSession, sf: str) -> DataFrame:
    """UNION (distinct) of the (party, year) key sets of three relations - the master grain of
    a multi-source fact."""
    from martkit.operators.reshape import union_distinct_keys
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("l_suppkey"),
                                          F.year("o_orderdate").alias("year"))
    returned = F.col("l_returnflag").eqNullSafe("R")
    return union_distinct_keys([li.filter(returned), li.filter(~returned), o], ["l_suppkey", "year"])
