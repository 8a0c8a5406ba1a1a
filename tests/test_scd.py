import datetime as dt

from pyspark.sql import functions as F

from martkit.operators.scd import (
    change_counts, insert_new, scd1_counts, scd1_upsert, scd2_apply, scd2_classify, seed_dimension,
)

from conftest import rows

D = dt.date
SCHEMA = "nk string, city string, pop int"


def _day1(spark):
    return spark.createDataFrame([("A", "X", 1), ("B", "Y", None), ("C", "Z", 3)], SCHEMA)


def _seed(spark):
    specials = spark.createDataFrame([(-1, None, "Unknown", None, D(1900, 1, 1), D(9999, 12, 31), True)],
                                     "k bigint, nk string, city string, pop int, eff date, exp date, cur boolean")
    return seed_dimension(_day1(spark), ["nk"], "k", specials=specials, eff_col="eff", exp_col="exp", cur_col="cur")


def _apply(spark, dim, src, day):
    return scd2_apply(dim, src, ["nk"], ["city", "pop"], day, "k", eff_col="eff", exp_col="exp", cur_col="cur")


def _check_invariants(dim):
    cur = dim.filter("cur AND k <> -1").groupBy("nk").count().filter("count <> 1").count()
    assert cur == 0, "exactly one current version per member"
    a, b = dim.alias("a"), dim.alias("b")
    overlap = a.join(b, (F.col("a.nk") == F.col("b.nk")) & (F.col("a.k") < F.col("b.k")) &
                     (F.col("a.eff") <= F.col("b.exp")) & (F.col("b.eff") <= F.col("a.exp")))
    assert overlap.count() == 0, "validity intervals must not overlap"
    assert dim.filter("exp < eff").count() == 0


def test_two_day_scd2(spark):
    dim0 = _seed(spark)
    day2 = spark.createDataFrame([("A", "X", 1), ("B", "Y", 2), ("C", "Q", 3), ("D", "W", 4)], SCHEMA)
    cls = scd2_classify(dim0, day2, ["nk"], ["city", "pop"], current_flag="cur", key_col="k")
    assert rows(change_counts(cls)) == [("CHANGE", 2), ("NEW", 1), ("NO_CHANGE", 1)]
    dim1 = _apply(spark, dim0, day2, "2024-03-01")
    _check_invariants(dim1)
    got = rows(dim1.select("k", "nk", "city", "pop", "eff", "exp", "cur"))
    assert got == [
        (-1, None, "Unknown", None, D(1900, 1, 1), D(9999, 12, 31), True),
        (1, "A", "X", 1, D(1900, 1, 1), D(9999, 12, 31), True),
        (2, "B", "Y", None, D(1900, 1, 1), D(2024, 2, 29), False),
        (3, "C", "Z", 3, D(1900, 1, 1), D(2024, 2, 29), False),
        (4, "B", "Y", 2, D(2024, 3, 1), D(9999, 12, 31), True),
        (5, "C", "Q", 3, D(2024, 3, 1), D(9999, 12, 31), True),
        (6, "D", "W", 4, D(2024, 3, 1), D(9999, 12, 31), True),
    ]
    # rerun of the same source: nothing changes (idempotent)
    again = _apply(spark, dim1, day2, "2024-03-01")
    assert rows(again) == rows(dim1)
    # same-day correction: the version that started today is corrected in place
    fix = spark.createDataFrame([("C", "R", 3)], SCHEMA)
    dim2 = _apply(spark, dim1, fix, "2024-03-01")
    _check_invariants(dim2)
    assert dim2.count() == dim1.count()
    assert rows(dim2.filter("nk = 'C' AND cur").select("k", "city")) == [(5, "R")]
    # next-day change: expire + new version, history untouched
    dim3 = _apply(spark, dim2, fix.withColumn("city", F.lit("S")), "2024-03-02")
    _check_invariants(dim3)
    assert rows(dim3.filter("nk = 'C'").select("k", "city", "exp", "cur")) == [
        (3, "Z", D(2024, 2, 29), False), (5, "R", D(2024, 3, 1), False), (7, "S", D(9999, 12, 31), True)]


def test_initial_effective_for_new_members(spark):
    dim0 = _seed(spark)
    src = spark.createDataFrame([("E", "V", 9)], SCHEMA)
    out = scd2_apply(dim0, src, ["nk"], ["city"], "2024-05-01", "k", eff_col="eff", exp_col="exp", cur_col="cur",
                     initial_effective="1900-01-01")
    assert rows(out.filter("nk = 'E'").select("k", "eff")) == [(4, D(1900, 1, 1))]


def test_insert_only_and_scd1(spark):
    dim = seed_dimension(_day1(spark), ["nk"], "k")
    src = spark.createDataFrame([("A", "X2", 1), ("D", "W", 4)], SCHEMA)
    ins = insert_new(dim, src, ["nk"], "k")
    assert rows(ins.select("k", "nk", "city")) == [(1, "A", "X"), (2, "B", "Y"), (3, "C", "Z"), (4, "D", "W")]
    up = scd1_upsert(dim, src, ["nk"], "k", ["city", "pop"])
    assert rows(up.select("k", "nk", "city")) == [(1, "A", "X2"), (2, "B", "Y"), (3, "C", "Z"), (4, "D", "W")]
    c = scd1_counts(dim, src, ["nk"], ["city", "pop"]).first()
    assert (c.inserted, c.updated, c.unchanged) == (1, 1, 0)


def test_materialized_and_lazy_paths_agree(spark):
    dim0 = _seed(spark)
    day2 = spark.createDataFrame([("A", "X", 1), ("B", "Y", 2), ("C", "Q", 3), ("D", "W", 4)], SCHEMA)
    kw = dict(eff_col="eff", exp_col="exp", cur_col="cur")
    a = scd2_apply(dim0, day2, ["nk"], ["city", "pop"], "2024-03-01", "k", materialize=True, **kw)
    b = scd2_apply(dim0, day2, ["nk"], ["city", "pop"], "2024-03-01", "k", materialize=False, **kw)
    assert rows(a) == rows(b)
    d1 = seed_dimension(_day1(spark), ["nk"], "k")
    assert rows(scd1_upsert(d1, day2, ["nk"], "k", ["city", "pop"], materialize=True)) == \
        rows(scd1_upsert(d1, day2, ["nk"], "k", ["city", "pop"], materialize=False))
