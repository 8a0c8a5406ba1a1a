"""Facts as plain partitioned Parquet: pruned grain checks, checked loads, touched partitions.

Each query loads ``orders`` into a fact under the cluster's checkpoint folder, loads it again in the way that it is about,
and shows what the fact then holds beside what the load counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import date_key
from martkit.operators.facts import (accumulating_conditional, accumulating_replace, load_accumulating, load_new)
from martkit.operators.quality import Rule, not_null
from martkit.plans.queries.registry import query, table
from martkit.session import checkpoint_dir
from martkit.sources.fact_table import CHANGE, FactTable, LoadCounts, LoadRejected, Staged

_SCHEMA = "order_fact_key bigint, o_orderkey bigint, cust bigint, order_date_key int, amount decimal(18,2), batch_id bigint"
#: The batch that is sent again.
RELOADED = 1998


def order_fact(spark: SparkSession, part: str) -> FactTable:
    return FactTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/order-fact-{uuid.uuid4().hex}",
                     spark.createDataFrame([], _SCHEMA).schema, ["o_orderkey"], F.expr(part), "order_fact_key")


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_custkey").alias("cust"), date_key("o_orderdate", None).alias("order_date_key"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                    F.year("o_orderdate").cast("bigint").alias("batch_id"))


def _put(fact: FactTable, rows: DataFrame, **how) -> LoadCounts:
    return fact.load(load_new(fact, rows, fact.grain, fact.key_col, lambda df: df, **how))


def _shown(fact: FactTable, counts: LoadCounts) -> DataFrame:
    """Per batch its rows, amount and keys; the counts of the last load on every row."""
    return fact.read().groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"),
        F.count_distinct("order_fact_key").alias("n_keys")).select(
        "*", *[F.lit(getattr(counts, k)).cast("bigint").alias(k) for k in ("inserted", "updated", "deleted", "duplicates")])


_ROWS = """
WITH o AS (SELECT o_orderkey, o_custkey AS cust, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(year(o_orderdate) AS BIGINT) AS batch_id FROM orders)
"""


@query("partitioned_batch_reload", sql=_ROWS + """,
again AS (SELECT o_orderkey, cust, order_date_key, amount * 2 AS amount, CAST(1998 AS BIGINT) AS batch_id FROM o
          WHERE (batch_id = 1998 AND o_orderkey % 3 <> 0) OR (batch_id = 2000 AND o_orderkey % 50 = 0)),
nxt AS (SELECT * FROM o WHERE batch_id <> 1998 AND o_orderkey NOT IN (SELECT o_orderkey FROM again)
        UNION ALL SELECT * FROM again)
SELECT batch_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n_keys,
       (SELECT count(*) FROM again) AS inserted, CAST(0 AS BIGINT) AS updated,
       (SELECT count(*) FROM o WHERE batch_id = 1998 OR (batch_id = 2000 AND o_orderkey % 50 = 0)) AS deleted,
       CAST(0 AS BIGINT) AS duplicates
FROM nxt GROUP BY batch_id
""")
def partitioned_batch_reload(spark: SparkSession, sf: str) -> DataFrame:
    """A batch is sent again: a third of its orders is withdrawn, some of another batch move to it.  Only the
    partitions of the two batches are written."""
    rows = order_rows(spark, sf)
    fact = order_fact(spark, "batch_id")
    _put(fact, rows)
    again = rows.where(((F.col("batch_id") == RELOADED) & (F.col("o_orderkey") % 3 != 0))
                       | ((F.col("batch_id") == 2000) & (F.col("o_orderkey") % 50 == 0)))
    again = again.withColumns({"amount": F.col("amount") * 2, "batch_id": F.lit(RELOADED).cast("bigint")})
    return _shown(fact, _put(fact, again, reload=True, parts=[RELOADED]))


@query("pruned_grain_append", sql=_ROWS + """,
sent AS (SELECT * FROM o WHERE order_date_key // 100 IN (199703, 199704) OR (batch_id = 2001 AND o_orderkey % 4 = 0))
SELECT batch_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n_keys,
       (SELECT count(*) FROM sent WHERE order_date_key // 100 = 199704 OR batch_id = 2001) AS inserted,
       CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted,
       (SELECT count(*) FROM sent WHERE order_date_key // 100 = 199703) AS duplicates
FROM o WHERE batch_id <> 2001 OR o_orderkey % 4 = 0 GROUP BY batch_id
""")
def pruned_grain_append(spark: SparkSession, sf: str) -> DataFrame:
    """Idempotent append to a fact partitioned by month: one month of the batch is known already.  The grain
    check reads the partitions that the summaries name; the largest key comes from the summaries too."""
    rows = order_rows(spark, sf)
    month = F.expr("order_date_key div 100")
    fact = order_fact(spark, "order_date_key div 100")
    _put(fact, rows.where((F.col("batch_id") != 2001) & (month != 199704)))
    sent = rows.where(month.isin(199703, 199704) | ((F.col("batch_id") == 2001) & (F.col("o_orderkey") % 4 == 0)))
    return _shown(fact, _put(fact, sent))


_LIFE = """
WITH m AS (SELECT o.o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ordered,
                  CAST(strftime(min(l_shipdate), '%Y%m%d') AS INTEGER) AS shipped, count(l_orderkey) AS n_lines
           FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o_orderdate),
first AS (SELECT o_orderkey, ordered, CASE WHEN shipped % 100 < 16 THEN shipped END AS shipped, n_lines FROM m
          WHERE ordered < 20010000),
sent AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE ordered END AS ordered, shipped,
                CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE n_lines + 1 END AS n_lines
         FROM m WHERE ordered // 100 IN (199806, 199907, 200102))
"""


def _milestones(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(first load, second load) of orders with their milestones."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min(date_key("l_shipdate", None)).alias("shipped"), F.count(F.lit(1)).alias("n_lines"))
    m = table(spark, sf, "orders").select("o_orderkey", date_key("o_orderdate", None).alias("ordered")).join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.lit(None).cast("bigint").alias("k"), "o_orderkey", "ordered", "shipped",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"))
    first = m.where("ordered < 20010000").withColumn("shipped", F.when(F.col("shipped") % 100 < 16, F.col("shipped")))
    sent = m.where(F.expr("ordered div 100").isin(199806, 199907, 200102)).withColumns({
        "ordered": F.when(F.col("o_orderkey") % 7 == 0, -1).otherwise(F.col("ordered")),
        "n_lines": F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("n_lines") + 1)})
    return first, sent


def _life_fact(spark: SparkSession) -> FactTable:
    schema = spark.createDataFrame([], "k bigint, o_orderkey bigint, ordered int, shipped int, n_lines bigint").schema
    return FactTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/life-fact-{uuid.uuid4().hex}", schema, ["o_orderkey"],
                     F.expr("ordered div 100"), "k")


def _life_shown(fact: FactTable, c: LoadCounts) -> DataFrame:
    return fact.read().groupBy(F.expr("ordered div 10000").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("n_keys"), F.count("shipped").alias("n_shipped"),
        F.sum("n_lines").alias("n_lines"), F.sum(F.col("shipped").cast("bigint")).alias("shipped_sum")).select(
        "*", F.lit(c.inserted).cast("bigint").alias("inserted"), F.lit(c.updated).cast("bigint").alias("updated"))


_LIFE_SHOWN = """
SELECT ordered // 10000 AS year, count(*) AS n, count(*) AS n_keys, count(shipped) AS n_shipped,
       CAST(sum(n_lines) AS BIGINT) AS n_lines, CAST(sum(shipped) AS BIGINT) AS shipped_sum,
       (SELECT count(*) FROM sent WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first)) AS inserted,
"""


@query("touched_partition_upsert", sql=_LIFE + """,
nxt AS (SELECT f.o_orderkey, CASE WHEN s.ordered <> -1 THEN s.ordered ELSE f.ordered END AS ordered,
               CASE WHEN s.shipped IS NOT NULL AND s.shipped <> -1 THEN s.shipped ELSE f.shipped END AS shipped,
               coalesce(s.n_lines, f.n_lines) AS n_lines,
               s.o_orderkey IS NOT NULL AND ((s.ordered <> -1 AND s.ordered <> f.ordered)
                 OR (s.shipped IS NOT NULL AND s.shipped <> -1 AND s.shipped IS DISTINCT FROM f.shipped)
                 OR (s.n_lines IS NOT NULL AND s.n_lines IS DISTINCT FROM f.n_lines)) AS upd
        FROM first f LEFT JOIN sent s USING (o_orderkey)
        UNION ALL SELECT o_orderkey, ordered, shipped, n_lines, FALSE FROM sent
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first))
""" + _LIFE_SHOWN + "(SELECT count(*) FROM nxt WHERE upd) AS updated FROM nxt GROUP BY 1")
def touched_partition_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Accumulating snapshot, field by field: the second load joins and writes only the months that hold its orders."""
    first, sent = _milestones(spark, sf)
    fact = _life_fact(spark)

    def put(rows: DataFrame) -> LoadCounts:
        return fact.load(load_accumulating(fact, rows, ["o_orderkey"], "k", lambda old, inc: accumulating_conditional(
            old, inc, ["o_orderkey"], ["ordered", "shipped"], ["n_lines"], change_col=CHANGE)))

    put(first)
    return _life_shown(fact, put(sent))


@query("touched_partition_replace", sql=_LIFE + """,
nxt AS (SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM sent) UNION ALL SELECT * FROM sent)
""" + _LIFE_SHOWN + "(SELECT count(*) FROM sent WHERE o_orderkey IN (SELECT o_orderkey FROM first)) AS updated FROM nxt GROUP BY 1")
def touched_partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Accumulating snapshot, whole rows: matched rows are replaced in the partition that holds them."""
    first, sent = _milestones(spark, sf)
    fact = _life_fact(spark)

    def put(rows: DataFrame) -> LoadCounts:
        return fact.load(load_accumulating(fact, rows, ["o_orderkey"], "k", lambda old, inc: accumulating_replace(
            old, inc, ["o_orderkey"], ["k", "part"], CHANGE)))

    put(first)
    return _life_shown(fact, put(sent))


@query("checked_load", sql=_ROWS + """,
sent AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cust END AS cust, order_date_key,
                CASE WHEN o_orderkey % 13 = 0 THEN -amount ELSE amount END AS amount FROM o WHERE batch_id = 1999
         UNION ALL SELECT o_orderkey, cust, order_date_key, amount FROM o WHERE batch_id = 1999 AND o_orderkey % 17 = 0)
SELECT c.*, (SELECT count(*) FROM o WHERE batch_id <> 1999) AS rows_in_fact FROM (
    SELECT 'amount not negative' AS "check", count(*) AS violations FROM sent WHERE amount < 0
    UNION ALL SELECT 'cust_not_null', count(*) FROM sent WHERE cust IS NULL
    UNION ALL SELECT 'order_date_key_not_null', 0
    UNION ALL SELECT 'unique grain', count(*) FROM (SELECT o_orderkey FROM sent GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'cust reference', count(DISTINCT cust) FROM sent
              WHERE cust NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) c
""")
def checked_load(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with negative amounts, missing and unknown customers and repeated orders is staged, counted and refused;
    the fact holds what it held before.  Row rules are counted by the write of the staged rows."""
    rows = order_rows(spark, sf)
    fact = order_fact(spark, "batch_id")
    _put(fact, rows.where("batch_id <> 1999"))
    own = rows.where("batch_id = 1999")
    sent = own.withColumns({"cust": F.when(F.col("o_orderkey") % 11 != 0, F.col("cust")),
                            "amount": F.when(F.col("o_orderkey") % 13 == 0, -F.col("amount")).otherwise(F.col("amount"))})
    sent = sent.unionByName(own.where("o_orderkey % 17 = 0"))
    rules = [Rule("amount not negative", F.col("amount") >= 0), *not_null("cust", "order_date_key")]
    good = table(spark, sf, "customer").where("c_acctbal >= 0")
    staged: Staged = load_new(fact, sent, fact.grain, fact.key_col, lambda df: df)
    try:
        found = fact.load(staged, rules, {"cust": (good, "c_custkey")}).violations
    except LoadRejected as e:
        found = e.violations
    report = spark.createDataFrame(list(found.items()), "check string, violations long")
    return report.withColumn("rows_in_fact", F.lit(fact.read().count()).cast("bigint"))
