from pyspark.sql import functions as F

from martkit.operators import aggregates as ag
from martkit.operators.dedup import duplicate_keys, keep_first, latest_per_key
from martkit.operators.facts import (
    accumulating_conditional, accumulating_replace, append_idempotent, reload_by_batch, reload_by_grain,
)
from martkit.operators.quality import Rule, check_rules, not_null, referential, split_rejects, uniqueness
from martkit.operators.reshape import align_metrics, union_layouts, unpivot_measures, unpivot_years

from conftest import rows


def test_idempotent_append_null_grain(spark):
    fact = spark.createDataFrame([(1, None, 10)], "a int, b string, v int")
    inc = spark.createDataFrame([(1, None, 99), (2, "x", 5)], "a int, b string, v int")
    once = append_idempotent(fact, inc, ["a", "b"])
    twice = append_idempotent(once, inc, ["a", "b"])
    assert rows(once) == rows(twice) == [(1, None, 10), (2, "x", 5)]


def test_reloads(spark):
    fact = spark.createDataFrame([(1, 2020, 1), (2, 2021, 1), (3, 2021, 1)], "k int, batch int, v int")
    new = spark.createDataFrame([(2, 2021, 9)], "k int, batch int, v int")
    assert rows(reload_by_grain(fact, new, ["k"])) == [(1, 2020, 1), (2, 2021, 9), (3, 2021, 1)]
    assert rows(reload_by_batch(fact, new, "batch", 2021)) == [(1, 2020, 1), (2, 2021, 9)]


def test_accumulating_conditional(spark):
    ex = spark.createDataFrame([(1, 20200101, 20200105, 3), (2, 20200201, -1, None)], "k int, m1 int, m2 int, n int")
    inc = spark.createDataFrame([(1, -1, 20200110, None), (2, 20200202, 20200210, 4), (3, 20200301, -1, 1)],
                                "k int, m1 int, m2 int, n int")
    out = accumulating_conditional(ex, inc, ["k"], ["m1", "m2"], ["n"])
    assert rows(out) == [(1, 20200101, 20200110, 3), (2, 20200202, 20200210, 4), (3, 20200301, -1, 1)]


def test_accumulating_replace_retains(spark):
    ex = spark.createDataFrame([(1, 100, "old"), (2, 200, "keep")], "k int, sk int, v string")
    inc = spark.createDataFrame([(1, None, "new"), (3, None, "ins")], "k int, sk int, v string")
    out = accumulating_replace(ex, inc, ["k"], retain=["sk"])
    assert rows(out) == [(1, 100, "new"), (2, 200, "keep"), (3, None, "ins")]


def test_quality(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (2, -1.0, None)], "id int, x double, c string")
    res = dict(rows(check_rules(df, [Rule("x_pos", F.col("x") > 0)] + not_null("c"))))
    assert res == {"x_pos": 1, "c_not_null": 1}
    valid, rej = split_rejects(df, [Rule("x_pos", F.col("x") > 0)])
    assert valid.count() == 2 and rows(rej.select("id", "dq_reason")) == [(2, "x_pos")]
    assert uniqueness(df, ["id"]).first().violations == 1
    dim = spark.createDataFrame([(1,)], "id int")
    assert referential(df, "id", dim, "id").first().violations == 2
    assert rows(duplicate_keys(df, ["id"])) == [(2, 2)]


def test_reshape(spark):
    wide = spark.createDataFrame([(1, 5.0, None), (2, None, 7.0)], "id int, y2015 double, y2016 double")
    assert rows(unpivot_years(wide, ["id"], ["y2015", "y2016"])) == [(1, 2015, 5.0), (2, 2016, 7.0)]
    m = unpivot_measures(wide, ["id"], [{"kind": F.lit("a"), "v": "y2015"}, {"kind": F.lit("b"), "v": "y2016"}],
                         require_any=["v"])
    assert rows(m) == [(1, "a", 5.0), (2, "b", 7.0)]
    a = spark.createDataFrame([(1, 2020, 1.0), (None, 2020, 3.0)], "k int, y int, value double")
    b = spark.createDataFrame([(1, 2020, 2.0), (2, 2021, 4.0)], "k int, y int, value double")
    assert rows(align_metrics({"a": a, "b": b}, ["k", "y"])) == [(1, 2020, 1.0, 2.0), (2, 2021, None, 4.0),
                                                                 (None, 2020, 3.0, None)]
    u = union_layouts([spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "z")], "x int, y string")],
                      ["x", "y"])
    assert rows(u) == [(1, None), (2, "z")]


def test_dedup_and_aggregates(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 3, "a"), (1, 1, "z"), (2, None, "q"), (2, 5, "r")],
                               "k int, t int, v string")
    # tie on t=3: the remaining columns (ascending) break it deterministically
    assert rows(latest_per_key(df, ["k"], ["t"]).select("k", "v")) == [(1, "a"), (2, "r")]
    assert rows(keep_first(df, ["k"], [F.col("t").asc_nulls_last()]).select("k", "v")) == [(1, "z"), (2, "r")]
    m = ag.mode_per_group(spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, "b"), (2, "a")], "g int, v string"),
                          ["g"], "v", count_out="n")
    assert rows(m) == [(1, "y", 2), (2, "a", 1)]
    y = spark.createDataFrame([(1, 2019, 5), (1, 2020, 9), (1, 2021, 9)], "g int, y int, r int")
    out = y.groupBy("g").agg(ag.arg_max("y", "r", "y").alias("peak"), ag.span("y").alias("span"),
                             ag.arg_min("r", "y").alias("first_r")).first()
    assert (out.peak, out.span, out.first_r) == (2021, 3, 5)
