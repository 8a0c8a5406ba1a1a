"""Key contracts, store safety and loaders against rows written out by hand."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martkit.operators.facts import accumulating_conditional
from martkit.operators.joins import update_from
from martkit.operators.keys import key_report
from martkit.operators.lookup import Lookup, resolve_keys
from martkit.operators.reshape import distinct_years, pivot_wide, unpivot_years
from martkit.operators.scd import insert_new, scd1_upsert, scd2_apply
from martkit.plans.marts import workforce
from martkit.sources.store import SnapshotStore

DIM = "k int, a string, b string, v string, EffectiveDate date, ExpirationDate date, CurrentFlag boolean"


def test_part_null_keys_match_and_null_keys_are_left_out(spark):
    dim = spark.createDataFrame([], DIM)
    src = spark.createDataFrame([("x", None, "1"), ("x", "y", "2"), (None, None, "3")], "a string, b string, v string")
    one = scd2_apply(dim, src, ["a", "b"], ["v"], "2024-01-01", "k")
    two = scd2_apply(one, src, ["a", "b"], ["v"], "2024-02-01", "k")
    assert sorted((r.a, r.b or "", r.v, r.CurrentFlag) for r in two.collect()) == [("x", "", "1", True),
                                                                                   ("x", "y", "2", True)]
    assert key_report(src.unionByName(src), ["a", "b"]).first() == (2, 2)
    flat = spark.createDataFrame([], "k int, a string, b string, v string")
    again = scd1_upsert(scd1_upsert(flat, src, ["a", "b"], "k", ["v"]), src, ["a", "b"], "k", ["v"])
    assert again.count() == 2


def test_repeated_source_keys_raise(spark):
    src = spark.createDataFrame([("x", "y", "1"), ("x", "y", "2")], "a string, b string, v string")
    flat = spark.createDataFrame([], "k int, a string, b string, v string")
    with pytest.raises(PySparkException, match="repeats"):
        scd2_apply(spark.createDataFrame([], DIM), src, ["a", "b"], ["v"], "2024-01-01", "k").collect()
    with pytest.raises(PySparkException, match="repeats"):
        scd1_upsert(flat, src, ["a", "b"], "k", ["v"]).collect()
    with pytest.raises(PySparkException, match="repeats"):
        insert_new(flat, src, ["a", "b"], "k").collect()
    with pytest.raises(PySparkException, match="repeats"):
        update_from(flat.unionByName(spark.createDataFrame([(1, "x", "y", "0")], flat.schema)), src, ["a"],
                    {"v": "v"}).collect()


def test_a_dimension_that_would_multiply_facts_raises(spark):
    fact = spark.createDataFrame([("x", dt.date(2024, 1, 5)), (None, None)], "a string, d date")
    dim = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None)], "k int, a string")
    with pytest.raises(PySparkException, match="repeats"):
        resolve_keys(fact, [Lookup(dim, [("a", "a")], "k", "k")]).collect()
    assert sorted(r.k for r in resolve_keys(fact, [Lookup(dim.where("k > 1"), [("a", "a")], "k", "k")]).collect()) == [-1, 2]
    versions = [(1, "x", "1900-01-01", "2024-01-04"), (2, "x", "2024-01-05", "9999-12-31")]
    cols = "k int, a string, e string, x string"

    def asof(rows, interval="closed"):
        d = spark.createDataFrame(rows, cols).selectExpr("k", "a", "date(e) EffectiveDate", "date(x) ExpirationDate")
        return sorted(r.k for r in resolve_keys(fact, [Lookup(d, [("a", "a")], "k", "k", asof="d", interval=interval)])
                      .collect())

    assert asof(versions) == [-1, 2]
    touching = [(1, "x", "1900-01-01", "2024-01-05"), versions[1]]
    assert asof(touching, "half_open") == [-1, 2]
    with pytest.raises(PySparkException, match="overlap"):
        asof(touching)


def test_null_safe_lookup_without_broadcast(spark):
    fact = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "a string, n int").repartition(3)
    dim = spark.createDataFrame([(1, "x"), (7, None)], "k int, a string")
    got = resolve_keys(fact, [Lookup(dim, [("a", "a")], "k", "k", null_safe=True)]).collect()
    assert sorted((r.n, r.k) for r in got) == [(1, 1), (2, 7), (3, 7)]


def test_accumulating_keys(spark):
    schema = "id string, m int, q int"
    old = spark.createDataFrame([("a", 20240101, 1)], schema)
    new = spark.createDataFrame([("a", -1, 2), (None, 20240202, 9), ("b", 20240303, 3)], schema)
    got = accumulating_conditional(old, new, ["id"], ["m"], ["q"]).collect()
    assert sorted((r.id, r.m, r.q) for r in got) == [("a", 20240101, 2), ("b", 20240303, 3)]


def test_every_year_of_the_data_becomes_a_column(spark):
    df = spark.createDataFrame([(1, 1990, 5.0), (1, 1995, 6.0), (2, 2031, 7.0)], "id int, year int, v double")
    years = distinct_years(df, F.col("year"))
    long = unpivot_years(pivot_wide(df, ["id"], "year", years, "v", prefix="y"), ["id"], [f"y{y}" for y in years], "v")
    assert sorted((r.id, r.year, r.v) for r in long.collect()) == [(1, 1990, 5.0), (1, 1995, 6.0), (2, 2031, 7.0)]


def test_read_faults_raise(spark, tmp_root, monkeypatch):
    store = SnapshotStore(spark, tmp_root)
    assert not store.exists("t")
    store.publish("t", spark.range(2))

    def broken(*_):
        raise OSError("injected")

    monkeypatch.setattr(SnapshotStore, "_read_marker", broken)
    with pytest.raises(OSError, match="injected"):
        store.exists("t")


def test_appends_become_visible_through_a_marker(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.append("t", spark.range(2))
    before = store.read("t")
    with pytest.raises(PySparkException):
        store.append("t", spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")))
    assert store.read("t").count() == 2 and store.current_version("t") == 1
    assert store.append("t", spark.range(5, 6)) == 2
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 5] and before.count() == 2
    assert store.append("t", spark.createDataFrame([(9, 1)], "id long, p int"), ["p"]) == 3
    assert sorted(r.id for r in store.read("t").select("id").collect()) == [0, 1, 5, 9]
    store.publish("t", spark.range(1))
    store.publish("u", spark.range(1))
    assert store.names("t") == ["t"] and len(store.expire("t", keep=1)) == 4
    assert store.read("t").count() == 1 and store.current_version("t") == 4


def test_overwrite_partitions_keeps_the_session(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    store.publish("t", spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, p int"), ["p"])
    store.overwrite_partitions("t", spark.createDataFrame([(20, 2)], "id int, p int"), ["p"])
    assert sorted((r.id, r.p or 0) for r in store.read("t").collect()) == [(1, 1), (3, 0), (20, 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


# headers of the 2019-2024 files that do not follow the naming of their neighbours, written out
FT_2019 = ["Total Full Time Operator (Operating Labor) Hours Worked", "Total Full Time Non-Operator (Operating Labor) Hours Worked",
           "Total Full Time (Operating Labor) Hours Worked", "Full Time Operator (Capital Labor) Hours Worked",
           "Full Time Non-Operator (Capital Labor) Hours Worked", "Total Full Time (Capital Labor) Hours Worked",
           "Total Full Time Operator Hours Worked", "Total Full Time Non-Operator Hours Worked",
           "Total Full Time Hours Worked", "Total Part Time Operator Hours Worked",
           "Total Part Time Non-Operator Hours Worked", "Total Part Time Hours Worked", "Total Full Time Employee Count",
           "Total Part Time Employee Count", "Full Time Operator (Vehicle Operations) Hours Worked",
           "Full Time Non-Operator (Vehicle Operations) Hours Worked",
           "Full Time Operator (Vehicle Operations) Employee Count", "Total Full Time Operator Employee Count",
           "Total Full Time Non-Operator Employee Count", "Part Time Operator (Vehicle Operations) Hours Worked",
           "Part Time Non-Operator (Vehicle Operations) Hours Worked", "Total Part Time Operator Employee Count",
           "Total Part Time Non-Operator Employee Count"]


def test_2019_measures_combine_at_the_snapshot_grain(spark):
    assert set(FT_2019) <= set(workforce.employee_layout(2019).values())
    assert set(workforce.employee_layout(2024).values()) == set(workforce.employee_layout(2019).values())
    values = {"NTD ID": "1", "Mode": "MB", "TOS": "DO", **{h: str(10 ** (i % 3) * (i + 1)) for i, h in enumerate(FT_2019)}}
    cols = list(workforce.employee_layout(2019).values())
    raw = spark.createDataFrame([tuple(values.get(c) for c in cols)],
                                ", ".join(f"`{c}` string" for c in cols))
    unified = workforce.unify_employees({2019: workforce.stage_employees(raw, 2019)})
    rows = {(r.EmploymentType, r.DepartmentName): r for r in workforce.combine_operator_split(unified).collect()}
    v = {h: int(values[h]) for h in FT_2019}
    ft, pt = rows["FullTime", "Vehicle Operations"], rows["PartTime", "Vehicle Operations"]
    assert ft.TotalEmployees == v["Total Full Time Employee Count"]
    assert ft.TotalHours == v["Total Full Time Operator Hours Worked"] + v["Total Full Time Non-Operator Hours Worked"]
    assert ft.CapitalHours == (v["Full Time Operator (Capital Labor) Hours Worked"]
                               + v["Full Time Non-Operator (Capital Labor) Hours Worked"])
    assert ft.HoursWorked == (v["Full Time Operator (Vehicle Operations) Hours Worked"]
                              + v["Full Time Non-Operator (Vehicle Operations) Hours Worked"])
    assert pt.TotalHours == v["Total Part Time Hours Worked"]
    assert pt.TotalEmployees == v["Total Part Time Employee Count"]
    assert pt.OperatingHours == v["Total Part Time Operator Hours Worked"] + v["Total Part Time Non-Operator Hours Worked"]
