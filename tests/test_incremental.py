import os

import pytest
from pyspark.sql import functions as F

from martkit.operators.aggregates import merge_profiles, profile_state
from martkit.operators.rollup import Rollup, RollupStore
from martkit.operators.scd import apply_delta, scd2_apply, scd2_delta
from martkit.sources.dimension_log import DimensionLog
from martkit.sources.raw import HeaderMismatch, check_headers, read_raw_checked, read_yearly_checked

ROWS = [("a", 1, 5, "x"), ("a", 2, 9, "y"), ("a", 3, 9, "y"), ("a", 4, None, "x"), ("b", 2, None, None), ("b", 1, -3, "z"),
        (None, 7, 1, "q"), ("c", 9, 2, "skip")]


def rollup_frame(spark, rows):
    return spark.createDataFrame(rows, "k string, p int, m int, c string")


def test_states_merge_to_the_whole(spark, tmp_root):
    r = Rollup(["k"], "p", sums=["m"], peaks=["m"], category="c", not_category=("skip",))
    store = RollupStore(spark, f"{tmp_root}/r", r)
    with pytest.raises(FileNotFoundError):
        store.result()
    store.put(1, rollup_frame(spark, ROWS[:3]))
    store.put(2, rollup_frame(spark, ROWS))          # sent wrong
    store.put(3, rollup_frame(spark, ROWS[5:]))
    store.put(2, rollup_frame(spark, ROWS[3:5]))     # and again
    store.put(4, rollup_frame(spark, []))
    got = {x.k: x for x in store.result().collect()}
    assert set(got) == {"a", "b", "c", None}
    a, b = got["a"], got["b"]
    assert (a["first"], a["last"], a.n, a.sum_m, a.c) == (1, 4, 4, 23, "x")   # x and y twice each: the smaller one
    assert (a.peak_m.at, a.peak_m.value) == (3, 9) and (a.late_m.at, a.late_m.value) == (4, None)
    assert (b.peak_m.at, b.peak_m.value, b.sum_m, b.c) == (2, None, -3, "z")  # NULL counts as 0
    assert got[None].c == "q" and got["c"].c is None


def dim_frame(spark, rows):
    return spark.createDataFrame(rows, "sk int, id int, name string, EffectiveDate string, ExpirationDate string, CurrentFlag boolean"
                                 ).withColumns({c: F.col(c).cast("date") for c in ("EffectiveDate", "ExpirationDate")})


DIM = [(-1, None, "Unknown", "1900-01-01", "9999-12-31", True), (1, 1, "a", "1900-01-01", "9999-12-31", True),
       (2, 2, "b", "1900-01-01", "2019-12-31", False), (3, 2, "bb", "2020-01-01", "9999-12-31", True),
       (4, 3, "c", "2024-01-01", "9999-12-31", True), (5, 9, "gone", "1900-01-01", "9999-12-31", True)]
SRC = [(1, "a"), (2, "bbb"), (3, "cc"), (4, "new")]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_a_delta_holds_the_changes_only(spark):
    dim, src = dim_frame(spark, DIM), spark.createDataFrame(SRC, "id int, name string")
    delta = scd2_delta(dim, src, ["id"], ["name"], "2024-01-01", "sk")
    assert sorted((r._mk_kind, r.sk, r.id) for r in delta.collect()) == [
        ("changed", 6, 2), ("closed", 3, 2), ("corrected", 4, 3), ("new", 7, 4)]
    whole = scd2_apply(dim, src, ["id"], ["name"], "2024-01-01", "sk")
    assert rows_of(apply_delta(dim, delta, "sk").select(dim.columns)) == rows_of(whole.select(dim.columns))
    assert scd2_delta(dim, src.where("id = 1"), ["id"], ["name"], "2024-01-01", "sk").count() == 0


def test_the_log_keeps_old_loads(spark, tmp_root):
    dim = dim_frame(spark, DIM)
    log = DimensionLog(spark, f"{tmp_root}/d", dim.schema, "sk")
    assert log.read().count() == 0
    log.seed(dim)
    before = sorted(os.listdir(f"{tmp_root}/d/load=0"))
    src = spark.createDataFrame(SRC, "id int, name string")
    assert log.load(1, src, ["id"], ["name"], "2024-01-01") == {"new": 1, "changed": 1, "closed": 1, "corrected": 1}
    assert rows_of(log.read()) == rows_of(scd2_apply(dim, src, ["id"], ["name"], "2024-01-01", "sk").select(dim.columns))
    assert log.load(2, src, ["id"], ["name"], "2024-02-01") == {"new": 0, "changed": 0, "closed": 0, "corrected": 0}
    assert sorted(os.listdir(f"{tmp_root}/d/load=0")) == before
    assert spark.read.parquet(f"{tmp_root}/d/load=1").count() == 4


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_raw_lines_of_a_wrong_length_are_rejects(spark, tmp_root):
    a = write(f"{tmp_root}/a.csv", " id ,name,amount", "1,one,10", '2,"t,wo",20', "3,three", "4,four,40,extra", ",,", "")
    b = write(f"{tmp_root}/b.csv", "id,name,amount", "5,five,50")
    rows, rejects = read_raw_checked(spark, [a, b], ["id", "name", "amount"])
    assert sorted((r.id or "", r.name, r.amount) for r in rows.collect()) == [
        ("", None, None), ("1", "one", "10"), ("2", "t,wo", "20"), ("5", "five", "50")]
    assert sorted(r.line for r in rejects.collect()) == ["3,three", "4,four,40,extra"]
    assert rows.select("name").where("name IS NOT NULL").count() == 3  # judged by the whole line whatever is selected
    assert {os.path.basename(r._source_file) for r in rows.collect()} == {"a.csv", "b.csv"}
    c = write(f"{tmp_root}/c.csv", "id,amount,note", "6,1,x")
    with pytest.raises(HeaderMismatch, match="missing.*name.*unexpected.*note"):
        read_raw_checked(spark, [a, c], ["id", "name", "amount"])
    with pytest.raises(HeaderMismatch, match="other order"):
        check_headers(spark, [write(f"{tmp_root}/d.csv", "name,id", "x,1")], ["id", "name"])


def test_yearly_files_with_their_own_headers(spark, tmp_root):
    paths = {2014: write(f"{tmp_root}/14.csv", "Id Number,Name", "1,one", "2"),
             2015: write(f"{tmp_root}/15.csv", "Name,ID,More", "two,2,x")}
    rows, rejects = read_yearly_checked(spark, paths, {2014: {"Id Number": "id", "Name": "name"},
                                                       2015: {"ID": "id", "Name": "name"}}, ["id", "name"])
    assert sorted(map(tuple, rows.collect())) == [("1", "one", 2014), ("2", "two", 2015)]
    assert [(r.line, r.ReportYear) for r in rejects.collect()] == [("2", 2014)]


def test_profiles_merge(spark):
    df = spark.range(3000).selectExpr("id % 2000 AS a", "CASE WHEN id % 2 = 0 THEN 'x' END AS b")
    states = profile_state(df.where("a < 1200"), ["a", "b"]).unionByName(profile_state(df.where("a >= 800"), ["a", "b"]))
    r = merge_profiles(states).first()
    assert r.rows == df.where("a < 1200").count() + df.where("a >= 800").count()
    assert abs(r.distinct_estimate / df.distinct().count() - 1) < 0.03
