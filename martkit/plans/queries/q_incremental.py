"""Loads that merge instead of recompute, and reads of raw text: stored rollup states, dimension logs, profile sketches,
checked CSV files (C7, C16, Q8, Q9, A11, S1, S9, S12, S13)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import date_key
from martkit.operators.aggregates import merge_profiles, profile_state
from martkit.operators.rollup import Rollup, RollupStore
from martkit.plans.queries.inputs import (SCD_LOAD_DATE, SQL_CUSTOMER_DIM, TRACKED, customer_day2, customer_dim_v1)
from martkit.plans.queries.registry import query, table
from martkit.session import checkpoint_dir
from martkit.sources.dimension_log import DimensionLog
from martkit.sources.raw import read_yearly_checked


def _folder(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query("incremental_rollup", sql="""
WITH y AS (SELECT l_suppkey, year(l_shipdate) AS yr, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue,
                  sum(CAST(l_quantity AS BIGINT)) AS units FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY revenue DESC, yr DESC) AS best,
             row_number() OVER (PARTITION BY l_suppkey ORDER BY yr DESC) AS late FROM y),
t AS (SELECT l_suppkey, p_type, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, p_type) AS rk
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT r.l_suppkey, min(yr) AS first_year, max(yr) AS last_year, CAST(max(yr) - min(yr) + 1 AS INTEGER) AS active_span,
       max(yr) FILTER (best = 1) AS peak_year, CAST(max(revenue) FILTER (best = 1) AS DOUBLE) AS peak_revenue,
       CAST(max(revenue) FILTER (late = 1) AS DOUBLE) AS latest_revenue, CAST(sum(units) AS BIGINT) AS units,
       any_value(t.p_type) AS top_part_type
FROM r JOIN t ON t.l_suppkey = r.l_suppkey AND t.rk = 1 GROUP BY 1
""")
def incremental_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A supplier's lifecycle from the stored states of three batches; one batch is sent wrong first and again right,
    which replaces its states alone."""
    li = table(spark, sf, "lineitem").withColumn("yr", F.year("l_shipdate"))
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    store = RollupStore(spark, _folder(spark, "rollup"), Rollup(
        ["l_suppkey"], "yr", sums=["units"], peaks=["revenue"], category="p_type"))

    def put(batch: int, lines: DataFrame) -> None:
        years = lines.groupBy("l_suppkey", "yr").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
                                                     F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
        store.put(batch, years, lines.join(part, F.col("l_partkey") == F.col("p_partkey")))

    put(1, li.where("yr < 1997"))
    put(2, li.where("yr < 2001"))
    put(3, li.where("yr >= 2000"))
    put(2, li.where("yr >= 1997 AND yr < 2000"))
    return store.result().select(
        "l_suppkey", F.col("first").alias("first_year"), F.col("last").alias("last_year"),
        (F.col("last") - F.col("first") + 1).cast("int").alias("active_span"), F.col("peak_revenue.at").alias("peak_year"),
        F.col("peak_revenue.value").cast("double").alias("peak_revenue"),
        F.col("late_revenue.value").cast("double").alias("latest_revenue"), F.col("sum_units").alias("units"),
        F.col("p_type").alias("top_part_type"))


def _customer_log(spark: SparkSession, sf: str) -> tuple[DimensionLog, dict[str, int]]:
    """The customer dimension as a log: the first feed, then the second; the counts of the second load."""
    first = customer_dim_v1(spark, sf)
    log = DimensionLog(spark, _folder(spark, "customer-log"), first.schema, "customer_key")
    log.seed(first)
    return log, log.load(1, customer_day2(spark, sf), ["c_custkey"], TRACKED, SCD_LOAD_DATE)


@query("scd2_delta_load", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT customer_key, c_custkey, c_name, c_mktsegment,
       CAST(strftime(EffectiveDate, '%Y%m%d') AS INTEGER) AS effective_key,
       CAST(strftime(ExpirationDate, '%Y%m%d') AS INTEGER) AS expiration_key,
       CASE WHEN CurrentFlag THEN 1 ELSE 0 END AS current_flag
FROM dim
""")
def scd2_delta_load(spark: SparkSession, sf: str) -> DataFrame:
    """The type-2 load that writes only new, changed and closed versions; the log read as a whole dimension."""
    log, _ = _customer_log(spark, sf)
    return log.read().select("customer_key", "c_custkey", "c_name", "c_mktsegment",
                             date_key("EffectiveDate").alias("effective_key"),
                             date_key("ExpirationDate").alias("expiration_key"),
                             F.col("CurrentFlag").cast("int").alias("current_flag"))


@query("load_change_counters", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT 'new' AS change, count(*) FILTER (change_type = 'NEW') AS n FROM cls
UNION ALL SELECT 'changed', count(*) FILTER (change_type = 'CHANGE') FROM cls
UNION ALL SELECT 'closed', count(*) FILTER (change_type = 'CHANGE') FROM cls
UNION ALL SELECT 'corrected', 0
UNION ALL SELECT 'unchanged', count(*) FILTER (change_type = 'NO_CHANGE') FROM cls
""")
def load_change_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What the dimension load counted while it wrote (conditional metrics of that write); what the source holds
    besides is unchanged."""
    _, counts = _customer_log(spark, sf)
    counts["unchanged"] = customer_day2(spark, sf).count() - counts["new"] - counts["changed"] - counts["corrected"]
    return spark.createDataFrame(list(counts.items()), "change string, n long")


@query("mergeable_profile", sql="""
SELECT CAST(year(l_shipdate) AS INTEGER) AS load, count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       1 AS within_3_percent FROM lineitem GROUP BY 1
UNION ALL SELECT 0, count(*), count(DISTINCT (l_orderkey, l_linenumber)), 1 FROM lineitem
""")
def mergeable_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches stored by yearly load and merged to the profile of all loads (load 0), beside the exact counts: every
    estimate is within 3 % of the exact number."""
    li = table(spark, sf, "lineitem").withColumn("load", F.year("l_shipdate"))
    key = ["l_orderkey", "l_linenumber"]
    path = _folder(spark, "profiles")
    states = li.groupBy("load").agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.to_json(F.struct(*key)), 14).alias("sketch"))
    states.write.parquet(path)
    states = spark.read.parquet(path)
    merged = states.select("load", "rows", F.hll_sketch_estimate("sketch").alias("estimate")).unionByName(
        merge_profiles(states).select(F.lit(0).alias("load"), "rows", F.col("distinct_estimate").alias("estimate")))
    exact = li.groupBy("load").agg(F.count_distinct(*key).alias("distinct_keys")).unionByName(
        li.agg(F.count_distinct(*key).alias("distinct_keys")).select(F.lit(0).alias("load"), "distinct_keys"))
    near = F.abs(F.col("estimate") / F.col("distinct_keys") - 1) <= 0.03
    return merged.join(exact, "load").select("load", "rows", "distinct_keys", near.cast("int").alias("within_3_percent"))


#: Header of every year's file -> column; the files differ in names, order and padding.
ORDER_HEADERS = {1995: {"Order": "order_id", " Total Price ": "amount", "Customer": "customer"},
                 1996: {"order id": "order_id", "customer id": "customer", "amount": "amount"},
                 1997: {"amount": "amount", "customer": "customer", "order_id": "order_id", "note": "note"}}


def _write_text(orders: DataFrame, year: int, path: str) -> None:
    """A year's orders as CSV lines under its header; some lines have a field too many or too few."""
    values: dict[str, Column] = {
        "order_id": F.col("o_orderkey").cast("string"), "customer": F.concat(F.lit('"'), "o_custkey", F.lit(', Inc."')),
        "amount": F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "note": F.lit("")}
    headers = ORDER_HEADERS[year]
    line = F.concat_ws(",", *[values[c] for c in headers.values()])
    line = F.when(F.col("o_orderkey") % 97 == 5, F.concat(line, F.lit(",surplus"))).when(
        F.col("o_orderkey") % 89 == 7, values["order_id"]).otherwise(line)
    # one column whose name is the header line, written as it is
    orders.where(F.year("o_orderdate") == year).select(line.alias(",".join(headers))).write.option("header", True).option(
        "sep", "\u0001").option("quote", "\u0000").csv(path)


@query("raw_text_ingest", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS ReportYear,
       count(*) FILTER (NOT bad) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (NOT bad) AS DOUBLE) AS amount,
       count(DISTINCT o_custkey) FILTER (NOT bad) AS n_customers, count(*) FILTER (bad) AS rejects
FROM (SELECT *, o_orderkey % 97 = 5 OR o_orderkey % 89 = 7 AS bad FROM orders WHERE year(o_orderdate) <= 1997) GROUP BY 1
""")
def raw_text_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly CSV files with headers of their own read as text, lines of a wrong length kept as rejects, the rest
    conformed to one layout and cast."""
    orders = table(spark, sf, "orders")
    root = _folder(spark, "raw-orders")
    paths = {y: f"{root}/{y}" for y in ORDER_HEADERS}
    for year, path in paths.items():
        _write_text(orders, year, path)
    layouts = {y: {h.strip(): c for h, c in m.items()} for y, m in ORDER_HEADERS.items()}
    rows, rejects = read_yearly_checked(spark, paths, layouts, ["order_id", "customer", "amount"])
    good = rows.groupBy("ReportYear").agg(
        F.count("order_id").alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
        F.count_distinct("customer").alias("n_customers"))
    bad = rejects.groupBy("ReportYear").agg(F.count(F.lit(1)).alias("rejects"))
    return good.join(bad, "ReportYear", "left").withColumn("rejects", F.coalesce("rejects", F.lit(0)))
