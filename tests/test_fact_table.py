import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.facts import accumulating_conditional, accumulating_replace, load_accumulating, load_new
from martkit.operators.grain import grain_summary, matching_partitions
from martkit.operators.keys import assign_keys_hashed
from martkit.operators.quality import Rule, not_null
from martkit.operators.scd import scd2_classify
from martkit.sources.fact_table import CHANGE, FactTable, LoadRejected

SCHEMA = "fact_key bigint, day int, code string, amount int, batch bigint"


def fact(spark, root, part="day", grain=("day", "code")):
    schema = spark.createDataFrame([], SCHEMA).schema
    return FactTable(spark, f"{root}/fact", schema, grain, F.expr(part), "fact_key")


def batch(spark, rows):
    return spark.createDataFrame(rows, "day int, code string, amount int")


def stamp(n):
    return lambda df: df.withColumn("batch", F.lit(n).cast("bigint"))


def files(root, part=None):
    return sorted(glob.glob(f"{root}/fact/data/part={'*' if part is None else part}/*.parquet"))


def load(f, rows, n, **kw):
    return f.load(load_new(f, rows, f.grain, "fact_key", stamp(n), **kw))


def content(f):
    return sorted(((r.day, r.code, r.amount, r.batch) for r in f.read().collect()), key=str)


def test_append_reads_only_partitions_that_can_hold_the_batch(spark, tmp_root):
    f = fact(spark, tmp_root)
    assert not f.exists() and f.read().count() == 0
    first = batch(spark, [(d, f"c{i}", i, ) for d in range(20) for i in range(30)])
    c = load(f, first, 1)
    assert (c.inserted, c.duplicates, c.updated, c.deleted) == (600, 0, 0, 0)
    again = batch(spark, [(3, "c5", 99), (3, "new", 1), (25, "c1", 1), (None, None, 7)])
    assert f.parts_with(again) == [3]
    plan = f.rows_like(again)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [part" in plan
    assert f.rows_like(again).select("_metadata.file_path").distinct().count() == 1
    old = files(tmp_root)
    c = load(f, again, 2)
    assert (c.inserted, c.duplicates) == (3, 1) and set(old) <= set(files(tmp_root))
    assert load(f, again, 3).inserted == 0  # the NULL grain matches itself
    keys = [r.fact_key for r in f.read().collect()]
    assert sorted(keys) == list(range(1, 604))


def test_partitions_are_never_missed(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), rng.choice(["a", "b", None, "ccc"]), rng.randrange(3000)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "p long, code string, n int")
    summary = grain_summary(df, ["code", "n"], "p").unionByName(grain_summary(df.where("p < 5"), ["code", "n"], "p"))
    for _ in range(4):
        wanted = [(rng.choice(["a", None, "ccc", "zz"]), rng.randrange(4000)) for _ in range(15)]
        got = {r.part for r in matching_partitions(summary, spark.createDataFrame(wanted, "code string, n int"),
                                                   ["code", "n"]).collect()}
        exact = {p for p, c, n in rows if (c, n) in set(wanted)}
        assert exact <= got and len(got) < len(exact) + 8
    none = spark.createDataFrame([], "code string, n int")
    assert matching_partitions(summary, none, ["code", "n"]).count() == 0


def test_batch_reload_writes_the_batch_alone(spark, tmp_root):
    f = fact(spark, tmp_root, part="batch")
    for b in range(1, 5):
        load(f, batch(spark, [(b, f"c{i}", i) for i in range(50)]), b)
    kept = {b: files(tmp_root, b) for b in (1, 3, 4)}
    # batch 2 comes again: one row changed, one new, the others withdrawn
    c = load(f, batch(spark, [(2, "c1", 100), (2, "x", 1)]), 2, reload=True, parts=[2])
    assert (c.inserted, c.deleted) == (2, 50)
    assert {b: files(tmp_root, b) for b in kept} == kept
    assert [r for r in content(f) if r[0] == 2] == [(2, "c1", 100, 2), (2, "x", 1, 2)]
    # a grain of batch 1 sent by batch 2: batch 1's partition is written again, 3 and 4 are not
    c = load(f, batch(spark, [(1, "c7", 700)]), 2, reload=True, parts=[2])
    assert {b: files(tmp_root, b) for b in (3, 4)} == {b: kept[b] for b in (3, 4)}
    assert (c.inserted, c.deleted) == (1, 3) and f.read().count() == 150
    # an empty batch leaves nothing behind, and its partition can be loaded again
    c = load(f, batch(spark, []), 2, reload=True, parts=[2])
    assert (c.inserted, c.deleted) == (0, 1) and f.read().where("batch = 2").count() == 0
    assert load(f, batch(spark, [(1, "c7", 8)]), 2).inserted == 1
    assert load(f, batch(spark, [(1, "c7", 9)]), 5).inserted == 0


def test_a_bad_batch_never_becomes_current(spark, tmp_root):
    f = fact(spark, tmp_root)
    load(f, batch(spark, [(1, "a", 1)]), 1)
    before, names = content(f), files(tmp_root)
    dim = spark.createDataFrame([("a",), ("b",)], "code string")
    rules = [Rule("amount not negative", F.col("amount") >= 0), *not_null("code")]
    bad = batch(spark, [(2, "a", -1), (2, "b", 1), (2, "b", 2), (3, "zz", 1), (3, None, 1)])
    with pytest.raises(LoadRejected) as e:
        f.load(load_new(f, bad, f.grain, "fact_key", stamp(2)), rules, {"code": (dim, "code")})
    assert e.value.violations == {"amount not negative": 1, "code_not_null": 1, "unique grain": 1, "code reference": 1}
    assert content(f) == before and files(tmp_root) == names
    assert spark.read.parquet(e.value.staged).count() == 5
    good = batch(spark, [(2, "a", 1), (2, "b", None)])
    c = f.load(load_new(f, good, f.grain, "fact_key", stamp(2)), rules[:1], {"code": (dim, "code")})
    assert c.inserted == 2 and not any(c.violations.values())


def test_upsert_touches_the_partitions_of_its_keys(spark, tmp_root):
    schema = spark.createDataFrame([], "k bigint, id string, start int, ended int, n int").schema
    f = FactTable(spark, f"{tmp_root}/fact", schema, ["id"], F.expr("start div 100"), "k")

    def rows(data):
        return spark.createDataFrame(data, "k bigint, id string, start int, ended int, n int")

    def merge(old, inc):
        return accumulating_conditional(old, inc, ["id"], ["start", "ended"], ["n"], change_col=CHANGE)

    def put(data):
        return f.load(load_accumulating(f, rows(data), ["id"], "k", merge))

    c = put([(None, f"i{m}-{j}", m * 100 + j, None, 1) for m in range(1, 9) for j in range(10)])
    assert c.inserted == 80 and sorted(r.k for r in f.read().collect()) == list(range(1, 81))
    before = {p: files(tmp_root, p) for p in range(1, 9)}
    c = put([(None, "i3-2", 302, 399, 5), (None, "i3-3", -1, -1, None), (None, "new", 401, None, 2)])
    assert (c.inserted, c.updated, c.deleted) == (1, 1, 0)
    after = {p: files(tmp_root, p) for p in range(1, 9)}
    assert {p for p in before if before[p] != after[p]} == {3, 4}
    got = {r.id: r for r in f.stored().collect()}
    assert len(got) == 81 and (got["i3-2"].ended, got["i3-2"].n, got["i3-3"].start, got["i3-3"].n) == (399, 5, 303, 1)
    # a milestone that moves does not move the row
    put([(None, "i5-1", 700, None, 1)])
    assert {r.id: (r.start, r.part) for r in f.stored().collect()}["i5-1"] == (700, 5)
    before = files(tmp_root)
    again = put([(None, "i5-1", 700, None, 1)])
    assert files(tmp_root) == before  # nothing changes, nothing is written
    assert (again.inserted, again.updated) == (0, 0) and f.read().count() == 81


def test_full_replace_checks_its_keys(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, id int, v string")
    new = spark.createDataFrame([(None, 2, "c"), (None, 3, "d")], "k int, id int, v string")
    got = accumulating_replace(old, new, ["id"], ["k"], change_col="ch")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [(1, 1, "a", "K"), (2, 2, "c", "U"), (None, 3, "d", "I")]
    for bad, word in ([(None, None, "x")], "NULL"), ([(None, 3, "x"), (None, 3, "y")], "repeats"):
        with pytest.raises(Exception, match=word):
            accumulating_replace(old, spark.createDataFrame(bad, old.schema), ["id"], ["k"]).collect()


def test_fact_keys_of_repeated_grains_spread(spark):
    # half of the rows share one grain, a sixth of all rows are equal
    rows = [(1 if i % 2 else i, i % 7 if i % 3 else 0) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, v int").withColumn("u", F.col("v") * 0 + F.monotonically_increasing_id() % 50)
    base = spark.createDataFrame([(41,)], "k long")
    keyed = assign_keys_hashed(df, ["g"], "k", existing=base, expected_rows=6000)
    assert sorted(r.k for r in keyed.collect()) == list(range(42, 6042))
    assert sorted(map(str, keyed.drop("k").collect())) == sorted(map(str, df.collect()))
    assert [r.k for r in assign_keys_hashed(df.limit(0), ["g"], "k").collect()] == []


def test_classify_is_null_safe(spark):
    dim = spark.createDataFrame([(1, "a", None, 5, True), (2, None, "x", 6, True)], "k int, p string, q string, v int, CurrentFlag boolean")
    src = spark.createDataFrame([("a", None, 5), (None, "x", 7), (None, None, 1)], "p string, q string, v int")
    got = {(r.p, r.q): r.ChangeType for r in scd2_classify(dim, src, ["p", "q"], ["v"]).collect()}
    assert got == {("a", None): "NO_CHANGE", (None, "x"): "CHANGE", (None, None): "NEW"}


def test_a_missing_folder_is_empty_and_another_fault_raises(spark, tmp_root):
    f = fact(spark, tmp_root)
    os.makedirs(f"{tmp_root}/fact/data/part=1")
    with open(f"{tmp_root}/fact/data/part=1/x.parquet", "wb") as out:
        out.write(b"not parquet")
    with pytest.raises(Exception, match="x.parquet"):
        f.read().collect()
