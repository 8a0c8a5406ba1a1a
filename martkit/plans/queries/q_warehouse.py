"""Warehouse operators: surrogate keys, SCD 0/1/2, effective-dated lookups, fact loads,
accumulating snapshots, periodic snapshot, lifecycle rollup (C1-C16, J1-J5, S10-S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.lookup import Lookup, resolve_keys
from martkit.plans.queries.inputs import SQL_CUSTOMER_DIM, customer_dim_v2
from martkit.plans.queries.registry import query, table
from martkit.session import checkpoint_dir


def _revenue(col: str) -> F.Column:
    """Money is summed as decimal(18,2) (exact in every engine) and reported as double."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


@query("scd2_revenue_by_version", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT coalesce(d.c_mktsegment, 'Unknown') AS segment,
       CASE WHEN d.customer_key IS NULL THEN 'unknown' WHEN d.CurrentFlag THEN 'current' ELSE 'expired' END AS version,
       count(*) AS order_count,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders o
LEFT JOIN dim d ON o.o_custkey = d.c_custkey
               AND CAST(o.o_orderdate AS DATE) BETWEEN d.EffectiveDate AND d.ExpirationDate
GROUP BY 1, 2
""")
def scd2_revenue_by_version(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: SCD2 customer dimension (seed + day-2 change load), orders resolved to the
    customer version valid on the order date (closed interval, miss -> -1), revenue by
    segment and version state."""
    dim = customer_dim_v2(spark, sf)
    orders = table(spark, sf, "orders")
    fact = resolve_keys(orders, [Lookup(dim, [("o_custkey", "c_custkey")], "customer_key", "customer_key",
                                        asof=F.col("o_orderdate").cast("date"),
                                        extra=("c_mktsegment", "CurrentFlag"))])
    version = (F.when(F.col("customer_key") == -1, "unknown")
                .when(F.col("CurrentFlag"), "current").otherwise("expired"))
    return fact.groupBy(F.coalesce(F.col("c_mktsegment"), F.lit("Unknown")).alias("segment"),
                        version.alias("version")) \
        .agg(F.count(F.lit(1)).alias("order_count"), _revenue("o_totalprice").alias("revenue"))


# ---------------------------------------------------------------------------------------
# Surrogate keys and slowly changing dimensions
# ---------------------------------------------------------------------------------------

from martkit.functions.dates import date_key, first_of_year  # noqa: E402
from martkit.operators.aggregates import arg_max, mode_per_group, profile, span  # noqa: E402
from martkit.operators.dedup import dedup_grain, duplicate_keys  # noqa: E402
from martkit.operators.facts import (  # noqa: E402
    accumulating_conditional, accumulating_replace, append_idempotent, new_rows, reload_by_batch, reload_by_grain,
)
from martkit.operators.keys import assign_keys  # noqa: E402
from martkit.operators.lookup import drop_unresolved, year_start_lookup  # noqa: E402
from martkit.operators.quality import Rule, check_rules, combine_checks, not_null, referential, uniqueness  # noqa: E402
from martkit.operators.reshape import align_metrics, unpivot_columns  # noqa: E402
from martkit.operators.scd import (  # noqa: E402
    change_counts, insert_new, scd1_counts, scd1_upsert, scd2_classify, seed_dimension, verify_static,
)
from martkit.plans.queries.inputs import (  # noqa: E402
    SQL_CALENDAR_DATES, TRACKED, customer_day1, customer_day2, customer_dim_v1, order_calendar,
)

SQL_D1_D2_V1 = """
d1 AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0),
d2 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal > 9000 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment FROM customer),
v1 AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key, d1.* FROM d1)
"""


@query("surrogate_keys", sql="""
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key FROM customer
""")
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Dense surrogate keys 1..n in natural-key order, without a single-partition window."""
    c = table(spark, sf, "customer").select("c_custkey")
    return assign_keys(c, ["c_custkey"], "customer_key")


@query("surrogate_keys_composite", sql="""
SELECT p_partkey, CAST(1000 + row_number() OVER (ORDER BY p_brand, p_name, p_partkey) AS BIGINT) AS part_key FROM part
""")
def surrogate_keys_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Keys continuing after an existing maximum (1000), ordered by a composite natural key."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return assign_keys(p, ["p_brand", "p_name", "p_partkey"], "part_key", start_after=1000) \
        .select("p_partkey", "part_key")


@query("scd0_insert_only", sql="""
WITH seed AS (SELECT DISTINCT p_name FROM part WHERE p_size <= 10),
d0 AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) AS BIGINT) AS name_key FROM seed),
nw AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM seed))
SELECT p_name, name_key FROM d0
UNION ALL
SELECT p_name, (SELECT count(*) FROM seed) + row_number() OVER (ORDER BY p_name) FROM nw
""")
def scd0_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-only dimension: members seeded from small parts, then every part name loaded;
    existing members keep their keys, new ones are keyed after the maximum."""
    p = table(spark, sf, "part")
    dim = seed_dimension(p.filter(F.col("p_size") <= 10).select("p_name").distinct(), ["p_name"], "name_key")
    return insert_new(dim, p.select("p_name").distinct(), ["p_name"], "name_key")


def _customer_scd1_dim(spark: SparkSession, sf: str) -> DataFrame:
    return seed_dimension(customer_day1(spark, sf), ["c_custkey"], "customer_key") \
        .select("customer_key", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("scd1_upsert", sql=f"""
WITH {SQL_D1_D2_V1}
SELECT v1.customer_key, v1.c_custkey, d2.c_name, d2.c_nationkey, d2.c_mktsegment
FROM v1 JOIN d2 ON d2.c_custkey = v1.c_custkey
UNION ALL
SELECT (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_nationkey, c_mktsegment
FROM d2 WHERE c_custkey NOT IN (SELECT c_custkey FROM d1)
""")
def scd1_upsert_q(spark: SparkSession, sf: str) -> DataFrame:
    """Type-1 upsert: changed attributes overwritten in place, new members inserted."""
    return scd1_upsert(_customer_scd1_dim(spark, sf), customer_day2(spark, sf), ["c_custkey"], "customer_key", TRACKED)


@query("scd1_change_counts", sql=f"""
WITH {SQL_D1_D2_V1}
SELECT count(*) FILTER (WHERE v1.c_custkey IS NULL) AS inserted,
       count(*) FILTER (WHERE v1.c_custkey IS NOT NULL AND (v1.c_name IS DISTINCT FROM d2.c_name
                        OR v1.c_nationkey IS DISTINCT FROM d2.c_nationkey
                        OR v1.c_mktsegment IS DISTINCT FROM d2.c_mktsegment)) AS updated,
       count(*) FILTER (WHERE v1.c_custkey IS NOT NULL AND NOT (v1.c_name IS DISTINCT FROM d2.c_name
                        OR v1.c_nationkey IS DISTINCT FROM d2.c_nationkey
                        OR v1.c_mktsegment IS DISTINCT FROM d2.c_mktsegment)) AS unchanged
FROM d2 LEFT JOIN v1 ON v1.c_custkey = d2.c_custkey
""")
def scd1_change_counts(spark: SparkSession, sf: str) -> DataFrame:
    """(inserted, updated, unchanged) of a type-1 upsert in one aggregate."""
    return scd1_counts(_customer_scd1_dim(spark, sf), customer_day2(spark, sf), ["c_custkey"], TRACKED)


@query("scd2_classify", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT change_type AS ChangeType, count(*) AS n FROM cls GROUP BY 1
""")
def scd2_classify_q(spark: SparkSession, sf: str) -> DataFrame:
    """NEW / CHANGE / NO_CHANGE per source row against the current versions: text
    attributes through a SHA-256 row hash, numbers compared null-safely."""
    classified = scd2_classify(customer_dim_v1(spark, sf), customer_day2(spark, sf), ["c_custkey"],
                               tracked=["c_nationkey"], key_col="customer_key", hashed=["c_name", "c_mktsegment"])
    return change_counts(classified)


@query("scd2_apply", sql=f"""
WITH {SQL_CUSTOMER_DIM}
SELECT customer_key, c_custkey, c_name, c_mktsegment,
       CAST(strftime(EffectiveDate, '%Y%m%d') AS INTEGER) AS effective_key,
       CAST(strftime(ExpirationDate, '%Y%m%d') AS INTEGER) AS expiration_key,
       CASE WHEN CurrentFlag THEN 1 ELSE 0 END AS current_flag
FROM dim
""")
def scd2_apply_q(spark: SparkSession, sf: str) -> DataFrame:
    """Type-2 apply: changed members' current versions expire on load_date - 1 and new
    versions start on load_date; new members get their first version; keys after the max."""
    dim = customer_dim_v2(spark, sf)
    return dim.select("customer_key", "c_custkey", "c_name", "c_mktsegment",
                      date_key("EffectiveDate").alias("effective_key"),
                      date_key("ExpirationDate").alias("expiration_key"),
                      F.col("CurrentFlag").cast("int").alias("current_flag"))


@query("static_reference_check", sql="""
SELECT 'order_priority' AS dimension, count(DISTINCT o_orderpriority) AS rows, 5 AS expected,
       CASE WHEN count(DISTINCT o_orderpriority) = 5 THEN 1 ELSE 0 END AS ok FROM orders
UNION ALL
SELECT 'order_status', count(DISTINCT o_orderstatus), 4,
       CASE WHEN count(DISTINCT o_orderstatus) = 4 THEN 1 ELSE 0 END FROM orders
UNION ALL
SELECT 'return_flag', count(DISTINCT l_returnflag), 3,
       CASE WHEN count(DISTINCT l_returnflag) = 3 THEN 1 ELSE 0 END FROM lineitem
""")
def static_reference_check(spark: SparkSession, sf: str) -> DataFrame:
    """Static code dimensions verified by row count against their expected size."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    checks = [verify_static(o.select("o_orderpriority").distinct(), 5, "order_priority"),
              verify_static(o.select("o_orderstatus").distinct(), 4, "order_status"),
              verify_static(li.select("l_returnflag").distinct(), 3, "return_flag")]
    out = checks[0].unionByName(checks[1]).unionByName(checks[2])
    return out.withColumn("ok", F.col("ok").cast("int"))


# ---------------------------------------------------------------------------------------
# Fact loads
# ---------------------------------------------------------------------------------------

@query("idempotent_append", sql="""
SELECT 1 AS run, o_orderstatus, count(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 2 AS run, o_orderstatus, count(*) AS n FROM orders GROUP BY 2
""")
def idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append with NOT EXISTS on the grain, run twice: the second run adds nothing."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    loaded = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    first = append_idempotent(loaded, o, ["o_orderkey"])
    second = append_idempotent(first, o, ["o_orderkey"])
    runs = [r.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.lit(i))
            for i, r in ((1, first), (2, second))]
    return runs[0].unionByName(runs[1]).select("run", "o_orderstatus", "n")


def _order_amounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    fact = o.select("o_orderkey", F.year("o_orderdate").alias("year"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    li = table(spark, sf, "lineitem")
    recomputed = li.join(o.select("o_orderkey", "o_orderdate"), li["l_orderkey"] == o["o_orderkey"]) \
        .groupBy("o_orderkey", F.year("o_orderdate").alias("year")) \
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"))
    return fact, recomputed


@query("reload_by_grain", sql="""
WITH fact AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
rl AS (SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INTEGER) AS year,
              sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS amount
       FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
       WHERE year(o.o_orderdate) = 2000 GROUP BY 1, 2),
nxt AS (SELECT * FROM fact WHERE o_orderkey NOT IN (SELECT o_orderkey FROM rl) UNION ALL SELECT * FROM rl)
SELECT year, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM nxt GROUP BY year
""")
def reload_by_grain_q(spark: SparkSession, sf: str) -> DataFrame:
    """Delete-by-grain then reload: year-2000 orders replaced by amounts recomputed from lines."""
    fact, recomputed = _order_amounts(spark, sf)
    nxt = reload_by_grain(fact, recomputed.filter(F.col("year") == 2000), ["o_orderkey"])
    return nxt.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@query("reload_by_batch", sql="""
WITH fact AS (SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS batch_id,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
rl AS (SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS BIGINT) AS batch_id,
              sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS amount
       FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
       WHERE year(o.o_orderdate) = 1998 GROUP BY 1, 2),
nxt AS (SELECT * FROM fact WHERE batch_id <> 1998 UNION ALL SELECT * FROM rl)
SELECT batch_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM nxt GROUP BY batch_id
""")
def reload_by_batch_q(spark: SparkSession, sf: str) -> DataFrame:
    """Delete-by-batch then reload: every row of batch 1998 replaced by that batch's new rows."""
    fact, recomputed = _order_amounts(spark, sf)
    fact = fact.withColumn("batch_id", F.col("year").cast("bigint")).drop("year")
    rows = recomputed.filter(F.col("year") == 1998).withColumn("batch_id", F.col("year").cast("bigint")).drop("year")
    nxt = reload_by_batch(fact, rows, "batch_id", 1998)
    return nxt.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


def _order_milestones(orders: DataFrame, lines: DataFrame) -> DataFrame:
    agg = lines.groupBy("l_orderkey").agg(F.min(date_key("l_shipdate", None)).alias("f"),
                                          F.max(date_key("l_shipdate", None)).alias("l"),
                                          F.count(F.lit(1)).alias("n"))
    j = orders.join(agg, orders["o_orderkey"] == agg["l_orderkey"], "left")
    return j.select("o_orderkey", F.coalesce("f", F.lit(-1)).alias("first_ship_key"),
                    F.coalesce("l", F.lit(-1)).alias("last_ship_key"), F.col("n").alias("n_lines"))


SQL_MILESTONES = """
SELECT o.o_orderkey, coalesce(a.f, -1) AS first_ship_key, coalesce(a.l, -1) AS last_ship_key, a.n AS n_lines
FROM orders o LEFT JOIN (
  SELECT l_orderkey, min(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS f,
         max(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS l, count(*) AS n
  FROM lineitem WHERE {lines} GROUP BY 1) a ON a.l_orderkey = o.o_orderkey
WHERE {orders}
"""


@query("accumulating_conditional", sql=f"""
WITH e AS ({SQL_MILESTONES.format(lines="l_shipdate < TIMESTAMP '1999-01-01'", orders="o.o_orderdate < TIMESTAMP '1999-01-01'")}),
i AS ({SQL_MILESTONES.format(lines="l_shipdate >= TIMESTAMP '1998-06-01'", orders="o.o_orderdate >= TIMESTAMP '1998-01-01'")})
SELECT coalesce(e.o_orderkey, i.o_orderkey) AS o_orderkey,
       CASE WHEN i.o_orderkey IS NULL THEN e.first_ship_key
            WHEN e.o_orderkey IS NOT NULL AND (i.first_ship_key IS NULL OR i.first_ship_key = -1) THEN e.first_ship_key
            ELSE i.first_ship_key END AS first_ship_key,
       CASE WHEN i.o_orderkey IS NULL THEN e.last_ship_key
            WHEN e.o_orderkey IS NOT NULL AND (i.last_ship_key IS NULL OR i.last_ship_key = -1) THEN e.last_ship_key
            ELSE i.last_ship_key END AS last_ship_key,
       CASE WHEN i.o_orderkey IS NULL THEN e.n_lines
            WHEN e.o_orderkey IS NOT NULL AND i.n_lines IS NULL THEN e.n_lines
            ELSE i.n_lines END AS n_lines
FROM e FULL OUTER JOIN i ON e.o_orderkey = i.o_orderkey
""")
def accumulating_conditional_q(spark: SparkSession, sf: str) -> DataFrame:
    """Order-lifecycle accumulating snapshot upsert: a milestone keeps its old value when
    the incoming one is unknown (-1/NULL), measures keep theirs when the new one is NULL,
    unmatched rows on either side survive."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    existing = _order_milestones(o.filter(F.col("o_orderdate") < cut), li.filter(F.col("l_shipdate") < cut))
    incoming = _order_milestones(o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")),
                                 li.filter(F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")))
    return accumulating_conditional(existing, incoming, ["o_orderkey"], ["first_ship_key", "last_ship_key"], ["n_lines"])


def _supplier_life(lines: DataFrame, batch: int) -> DataFrame:
    return lines.groupBy("l_suppkey").agg(
        F.min(F.year("l_shipdate")).alias("first_year"), F.max(F.year("l_shipdate")).alias("last_year"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue")).withColumn("loaded_batch", F.lit(batch))


@query("accumulating_replace", sql="""
WITH e AS (SELECT l_suppkey, CAST(min(year(l_shipdate)) AS INTEGER) AS first_year,
                  CAST(max(year(l_shipdate)) AS INTEGER) AS last_year,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, 1 AS loaded_batch
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1),
i AS (SELECT l_suppkey, CAST(min(year(l_shipdate)) AS INTEGER) AS first_year,
             CAST(max(year(l_shipdate)) AS INTEGER) AS last_year,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, 2 AS loaded_batch
      FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE year(l_shipdate) = 2001 AND l_returnflag = 'R')
      GROUP BY 1)
SELECT i.l_suppkey, i.first_year, i.last_year, CAST(i.revenue AS DOUBLE) AS revenue,
       coalesce(e.loaded_batch, i.loaded_batch) AS loaded_batch
FROM i LEFT JOIN e ON e.l_suppkey = i.l_suppkey
UNION ALL
SELECT l_suppkey, first_year, last_year, CAST(revenue AS DOUBLE), loaded_batch FROM e
WHERE l_suppkey NOT IN (SELECT l_suppkey FROM i)
""")
def accumulating_replace_q(spark: SparkSession, sf: str) -> DataFrame:
    """Full replace on the business key, retaining the original load batch of replaced rows."""
    li = table(spark, sf, "lineitem")
    existing = _supplier_life(li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")), 1)
    active = li.filter((F.year("l_shipdate") == 2001) & (F.col("l_returnflag") == "R")).select("l_suppkey")
    incoming = _supplier_life(li.join(active.distinct(), "l_suppkey", "left_semi"), 2)
    out = accumulating_replace(existing, incoming, ["l_suppkey"], retain=["loaded_batch"])
    return out.withColumn("revenue", F.col("revenue").cast("double"))


def _supplier_dim(spark: SparkSession, sf: str) -> DataFrame:
    return assign_keys(table(spark, sf, "supplier").select("s_suppkey"), ["s_suppkey"], "supplier_key")


def _coverage(lines: DataFrame, part: DataFrame, sdim: DataFrame, cal: DataFrame, sdim_fits: bool) -> DataFrame:
    g = lines.filter(F.col("l_quantity") > 0).join(part, lines["l_partkey"] == part["p_partkey"]) \
        .select("l_suppkey", "p_type", F.year("l_shipdate").alias("year")).distinct()
    g = resolve_keys(g, [Lookup(sdim, [("l_suppkey", "s_suppkey")], "supplier_key", "supplier_key",
                                broadcast=True if sdim_fits else None)])
    g = year_start_lookup(drop_unresolved(g, "supplier_key"), "year", cal, "year_start_key")
    return dedup_grain(g.select("supplier_key", "p_type", "year_start_key"),
                       ["supplier_key", "p_type", "year_start_key"])


@query("factless_coverage", sql=f"""
WITH {SQL_CALENDAR_DATES},
sk AS (SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS supplier_key FROM supplier),
ys AS (SELECT CalendarYear, DateKey FROM cal WHERE CalendarDay = 1),
cov AS (SELECT DISTINCT sk.supplier_key, p.p_type, coalesce(ys.DateKey, -1) AS year_start_key,
               l.l_shipdate < TIMESTAMP '1998-01-01' AS early
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN sk ON sk.s_suppkey = l.l_suppkey
        LEFT JOIN ys ON ys.CalendarYear = year(l.l_shipdate)
        WHERE l.l_quantity > 0),
allc AS (SELECT DISTINCT supplier_key, p_type, year_start_key FROM cov),
old AS (SELECT DISTINCT supplier_key, p_type, year_start_key FROM cov WHERE early)
SELECT * FROM allc a WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.supplier_key = a.supplier_key
                                       AND o.p_type = a.p_type AND o.year_start_key = a.year_start_key)
""")
def factless_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Factless coverage fact (supplier x part type x year): distinct grain with a positive
    measure -> key resolution (supplier, year-start date via the calendar) -> dedup of the
    resolved grain -> only rows not already covered by the earlier load."""
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    sdim = _supplier_dim(spark, sf)
    # One size check for both coverage passes: broadcast the supplier keys only if they fit.
    sdim_fits = sdim.count() <= 1_000_000
    cal = order_calendar(spark, sf)
    existing = _coverage(li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")), part, sdim, cal,
                         sdim_fits)
    incoming = _coverage(li, part, sdim, cal, sdim_fits)
    return new_rows(existing, incoming, ["supplier_key", "p_type", "year_start_key"])


@query("periodic_snapshot", sql="""
WITH sk AS (SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS supplier_key FROM supplier),
y AS (SELECT l_suppkey, year(l_shipdate) AS yr, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue,
             sum(l_quantity) AS qty, count(*) AS n_lines
      FROM lineitem GROUP BY 1, 2)
SELECT coalesce(sk.supplier_key, -1) AS supplier_key, CAST(y.yr * 10000 + 101 AS INTEGER) AS date_key,
       CAST(y.revenue AS DOUBLE) AS revenue, CAST(y.qty AS BIGINT) AS quantity, y.n_lines
FROM y LEFT JOIN sk ON sk.s_suppkey = y.l_suppkey
""")
def periodic_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic snapshot of three yearly metrics: aggregated once to (supplier, year), which
    aligns them without a pivot or a list of years, keys resolved, rows aggregated to the
    declared grain and appended idempotently to the earlier snapshot."""
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    aligned = li.groupBy("l_suppkey", "year").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.sum("l_quantity").cast("double").alias("quantity"), F.count(F.lit(1)).cast("double").alias("n_lines"))
    keyed = resolve_keys(aligned, [Lookup(_supplier_dim(spark, sf), [("l_suppkey", "s_suppkey")], "supplier_key",
                                          "supplier_key", broadcast=1_000_000)])
    keyed = keyed.withColumn("date_key", date_key(first_of_year("year")))
    grain = ["supplier_key", "date_key"]
    fact_rows = keyed.groupBy(*grain).agg(F.max("revenue").alias("revenue"),
                                          F.max("quantity").cast("bigint").alias("quantity"),
                                          F.max("n_lines").cast("bigint").alias("n_lines"))
    checkpoint_dir(spark)
    fact_rows = fact_rows.checkpoint(eager=True)  # read three times below
    earlier = fact_rows.filter(F.col("date_key") < 19980101)
    return append_idempotent(earlier, fact_rows, grain, materialize=False)


@query("lifecycle_rollup", sql="""
WITH y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY 1, 2),
pk AS (SELECT l_suppkey, yr AS peak_year FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY revenue DESC, yr DESC) AS rk FROM y) x WHERE rk = 1),
life AS (SELECT l_suppkey, min(yr) AS first_year, max(yr) AS last_year, CAST(max(yr) - min(yr) + 1 AS INTEGER) AS active_span,
                CAST(sum(revenue) AS DOUBLE) AS total_revenue FROM y GROUP BY 1),
md AS (SELECT l_suppkey, p_type AS top_part_type FROM (
         SELECT l.l_suppkey, p.p_type, count(*) AS n,
                row_number() OVER (PARTITION BY l.l_suppkey ORDER BY count(*) DESC, p.p_type) AS rk
         FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2) x WHERE rk = 1),
rt AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND year(l_shipdate) >= 2001 GROUP BY 1)
SELECT life.l_suppkey, life.first_year, life.last_year, life.active_span, pk.peak_year, life.total_revenue,
       md.top_part_type, coalesce(rt.n, 0) AS recent_returns
FROM life JOIN pk ON pk.l_suppkey = life.l_suppkey
LEFT JOIN md ON md.l_suppkey = life.l_suppkey
LEFT JOIN rt ON rt.l_suppkey = life.l_suppkey
""")
def lifecycle_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """One row per supplier: first / last year, span, peak year (arg-max), lifetime revenue,
    most frequent part type (mode) and recent returns defaulting to 0 - one grouped
    aggregate plus two small left joins instead of a self-join per ranking."""
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    y = li.groupBy("l_suppkey", F.year("l_shipdate").alias("yr")) \
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"))
    life = y.groupBy("l_suppkey").agg(
        F.min("yr").alias("first_year"), F.max("yr").alias("last_year"), span("yr").cast("int").alias("active_span"),
        arg_max("yr", "revenue", "yr").alias("peak_year"), F.sum("revenue").cast("double").alias("total_revenue"))
    md = mode_per_group(li.join(part, li["l_partkey"] == part["p_partkey"]), ["l_suppkey"], "p_type",
                        out="top_part_type")
    rt = li.filter((F.col("l_returnflag") == "R") & (F.year("l_shipdate") >= 2001)).groupBy("l_suppkey") \
        .agg(F.count(F.lit(1)).alias("recent_returns"))
    out = life.join(md, "l_suppkey", "left").join(rt, "l_suppkey", "left")
    return out.withColumn("recent_returns", F.coalesce("recent_returns", F.lit(0)).cast("bigint"))


# ---------------------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------------------

@query("dq_checks", sql="""
SELECT 'quantity_range' AS rule, count(*) FILTER (WHERE NOT coalesce(l_quantity BETWEEN 1 AND 50, TRUE)) AS violations FROM lineitem
UNION ALL SELECT 'discount_max', count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08, TRUE)) FROM lineitem
UNION ALL SELECT 'tax_non_negative', count(*) FILTER (WHERE NOT coalesce(l_tax >= 0, TRUE)) FROM lineitem
UNION ALL SELECT 'return_flag_domain', count(*) FILTER (WHERE NOT coalesce(l_returnflag IN ('A', 'N', 'R'), TRUE)) FROM lineitem
UNION ALL SELECT 'line_number_max', count(*) FILTER (WHERE NOT coalesce(l_linenumber <= 6, TRUE)) FROM lineitem
UNION ALL SELECT 'l_shipdate_not_null', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
""")
def dq_checks(spark: SparkSession, sf: str) -> DataFrame:
    """CHECK-style domain rules and NOT NULL, all evaluated in one aggregate pass."""
    li = table(spark, sf, "lineitem")
    rules = [Rule("quantity_range", F.col("l_quantity").between(1, 50)),
             Rule("discount_max", F.col("l_discount") <= 0.08),
             Rule("tax_non_negative", F.col("l_tax") >= 0),
             Rule("return_flag_domain", F.col("l_returnflag").isin("A", "N", "R")),
             Rule("line_number_max", F.col("l_linenumber") <= 6)] + not_null("l_shipdate")
    return check_rules(li, rules)


@query("dq_uniqueness", sql="""
SELECT 'unique_l_orderkey_l_linenumber' AS "check", count(*) AS violations FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x
UNION ALL SELECT 'unique_o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) x
UNION ALL SELECT 'unique_returned_line', count(*) FROM (
  SELECT 1 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x
""")
def dq_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    """Uniqueness (plain and filtered) as duplicate-key counts."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    return combine_checks(uniqueness(li, ["l_orderkey", "l_linenumber"]),
                          uniqueness(o, ["o_orderkey"]),
                          uniqueness(li, ["l_orderkey", "l_linenumber"], where=F.col("l_returnflag") == "R",
                                     name="unique_returned_line"))


@query("dq_referential", sql="""
SELECT 'fk_l_partkey' AS "check", count(*) AS violations FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'fk_o_custkey', count(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)
UNION ALL SELECT 'fk_l_orderkey', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
""")
def dq_referential(spark: SparkSession, sf: str) -> DataFrame:
    """Referential integrity fact -> dimension as orphan counts (anti joins)."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return combine_checks(referential(li, "l_partkey", table(spark, sf, "part"), "p_partkey"),
                          referential(o, "o_custkey", c, "c_custkey"),
                          referential(li, "l_orderkey", o.filter(F.col("o_orderstatus") != "P"), "o_orderkey"))


@query("dq_duplicates", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate business keys with their multiplicity."""
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("load_profile", sql="""
SELECT 'lineitem' AS tbl, count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys FROM lineitem
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey) FROM customer
""")
def load_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Row count and distinct business keys per table, one aggregate pass each."""
    parts = [profile(table(spark, sf, t), k).withColumn("tbl", F.lit(t))
             for t, k in (("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]),
                          ("customer", ["c_custkey"]))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("tbl", "rows", "distinct_keys")


@query("row_hash_change", sql="""
WITH a AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer),
b AS (SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_acctbal > 9000 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment FROM customer)
SELECT a.c_nationkey,
       count(*) FILTER (WHERE a.c_name IS DISTINCT FROM b.c_name OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment)
         AS n_changed,
       count(*) FILTER (WHERE NOT (a.c_name IS DISTINCT FROM b.c_name OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment))
         AS n_unchanged
FROM a JOIN b ON a.c_custkey = b.c_custkey GROUP BY 1
""")
def row_hash_change(spark: SparkSession, sf: str) -> DataFrame:
    """Change detection through a SHA-256 row hash of the text attributes (separator and
    NULL marker, so 'ab'+'c' and 'a'+'bc' differ) of two snapshots."""
    from martkit.functions.cleanse import row_hash
    a = table(spark, sf, "customer").select("c_custkey", "c_nationkey",
                                            row_hash("c_name", "c_mktsegment").alias("h_a"))
    b = customer_day2(spark, sf).select(F.col("c_custkey").alias("k"), row_hash("c_name", "c_mktsegment").alias("h_b"))
    j = a.join(b, a["c_custkey"] == b["k"])
    changed = F.col("h_a") != F.col("h_b")
    return j.groupBy("c_nationkey").agg(F.count(F.when(changed, 1)).alias("n_changed"),
                                        F.count(F.when(~changed, 1)).alias("n_unchanged"))


@query("scd2_same_day_rerun", sql=f"""
WITH {SQL_CUSTOMER_DIM},
d3 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal > 9500 THEN 'MACHINERY' WHEN c_acctbal > 9000 THEN 'AUTOMOBILE'
                   ELSE c_mktsegment END AS c_mktsegment FROM customer),
cur AS (SELECT * FROM dim WHERE CurrentFlag AND customer_key <> -1),
chg AS (SELECT cur.customer_key AS ck, cur.EffectiveDate AS eff, d3.*
        FROM cur JOIN d3 ON d3.c_custkey = cur.c_custkey
        WHERE cur.c_name IS DISTINCT FROM d3.c_name OR cur.c_nationkey IS DISTINCT FROM d3.c_nationkey
           OR cur.c_mktsegment IS DISTINCT FROM d3.c_mktsegment),
newv AS (SELECT (SELECT max(customer_key) FROM dim) + row_number() OVER (ORDER BY c_custkey) AS customer_key,
                c_custkey, c_mktsegment, DATE '1998-01-01' AS EffectiveDate, DATE '9999-12-31' AS ExpirationDate,
                TRUE AS CurrentFlag
         FROM chg WHERE eff <> DATE '1998-01-01'),
outp AS (
  SELECT d.customer_key, d.c_custkey,
         CASE WHEN c.ck IS NOT NULL AND c.eff = DATE '1998-01-01' THEN c.c_mktsegment ELSE d.c_mktsegment END AS c_mktsegment,
         d.EffectiveDate,
         CASE WHEN c.ck IS NOT NULL AND c.eff <> DATE '1998-01-01' THEN DATE '1997-12-31' ELSE d.ExpirationDate END
           AS ExpirationDate,
         CASE WHEN c.ck IS NOT NULL AND c.eff <> DATE '1998-01-01' THEN FALSE ELSE d.CurrentFlag END AS CurrentFlag
  FROM dim d LEFT JOIN chg c ON c.ck = d.customer_key
  UNION ALL SELECT * FROM newv)
SELECT customer_key, c_custkey, c_mktsegment,
       CAST(strftime(EffectiveDate, '%Y%m%d') AS INTEGER) AS effective_key,
       CAST(strftime(ExpirationDate, '%Y%m%d') AS INTEGER) AS expiration_key,
       CASE WHEN CurrentFlag THEN 1 ELSE 0 END AS current_flag
FROM outp
""")
def scd2_same_day_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A second SCD2 load on the same load date: versions that started that day are
    corrected in place (same key, no zero-length version), older current versions expire
    and get a new version as usual."""
    from martkit.operators.scd import scd2_apply
    from martkit.plans.queries.inputs import SCD_LOAD_DATE
    c = table(spark, sf, "customer")
    seg = (F.when(F.col("c_acctbal") > 9500, F.lit("MACHINERY")).when(F.col("c_acctbal") > 9000, F.lit("AUTOMOBILE"))
            .otherwise(F.col("c_mktsegment")))
    day3 = c.select("c_custkey", "c_name", "c_nationkey", seg.alias("c_mktsegment"))
    dim = scd2_apply(customer_dim_v2(spark, sf), day3, ["c_custkey"], TRACKED, SCD_LOAD_DATE, "customer_key")
    return dim.select("customer_key", "c_custkey", "c_mktsegment",
                      date_key("EffectiveDate").alias("effective_key"),
                      date_key("ExpirationDate").alias("expiration_key"),
                      F.col("CurrentFlag").cast("int").alias("current_flag"))


@query("fact_surrogate_keys", sql="""
SELECT count(*) AS n_rows, CAST(1000001 AS BIGINT) AS min_key, 1000000 + count(*) AS max_key,
       count(*) AS n_distinct_keys, CAST(1000000 * count(*) + count(*) * (count(*) + 1) / 2 AS BIGINT) AS key_sum
FROM lineitem
""")
def fact_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Fact surrogate keys for every line item after an existing maximum of 1,000,000:
    hash-bucketed dense keys (no checkpoint, no driver action) - verified as exactly the
    range max+1 .. max+n, each key once."""
    from martkit.operators.keys import assign_keys_hashed
    li = table(spark, sf, "lineitem")
    existing = spark.range(1).select(F.lit(1_000_000).cast("bigint").alias("fact_key"))
    keyed = assign_keys_hashed(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "fact_key",
                               existing=existing)
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.min("fact_key").alias("min_key"),
                     F.max("fact_key").alias("max_key"), F.count_distinct("fact_key").alias("n_distinct_keys"),
                     F.sum("fact_key").alias("key_sum"))
