from pyspark.sql import functions as F

from martkit.operators.keys import assign_keys, max_key


def test_dense_keys_in_natural_key_order(spark):
    df = spark.createDataFrame([(k, f"n{k}") for k in [50, 3, 17, 8, 99, 1]], "nk int, name string")
    out = {r.nk: r.k for r in assign_keys(df, ["nk"], "k").collect()}
    assert out == {1: 1, 3: 2, 8: 3, 17: 4, 50: 5, 99: 6}


def test_keys_independent_of_input_partitioning(spark):
    base = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).alias("nk"))
    a = {r.nk: r.k for r in assign_keys(base.repartition(13), ["nk"], "k", start_after=100).collect()}
    b = {r.nk: r.k for r in assign_keys(base.coalesce(1), ["nk"], "k", start_after=100, num_partitions=3).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(101, 5101))


def test_string_and_composite_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 9), ("b", 1)], "s string, n int")
    out = [(r.s, r.n, r.k) for r in assign_keys(df, ["s", "n"], "k").orderBy("k").collect()]
    assert out == [("a", 9, 1), ("b", 1, 2), ("b", 2, 3)]


def test_max_key_floor(spark):
    df = spark.createDataFrame([(-1,), (4,)], "k int")
    assert max_key(df, "k") == 4
    assert max_key(df.filter("k < 0"), "k") == 0


def test_hashed_keys_dense_unique_deterministic_lazy(spark):
    from martkit.operators.keys import assign_keys_hashed
    base = spark.range(0, 3000).select((F.col("id") * 7919 % 10007).alias("nk"), (F.col("id") % 7).alias("v"))
    existing = spark.createDataFrame([(-1,), (41,)], "k bigint")
    a = assign_keys_hashed(base.repartition(11), ["nk"], "k", existing=existing, buckets=8)
    b = assign_keys_hashed(base.coalesce(1), ["nk"], "k", existing=existing, buckets=8)
    ka = {r.nk: r.k for r in a.collect()}
    assert ka == {r.nk: r.k for r in b.collect()}
    assert sorted(ka.values()) == list(range(42, 3042))
    sc = spark.sparkContext
    sc.setJobGroup("hashed-keys-lazy", "plan only")
    try:
        assign_keys_hashed(base, ["nk"], "k", existing=existing, buckets=8)
        assert list(sc.statusTracker().getJobIdsForGroup("hashed-keys-lazy")) == []  # no eager job, no checkpoint
    finally:
        sc.setJobGroup("", "")
    empty = assign_keys_hashed(base, ["nk"], "k", start_after=5)
    assert empty.agg(F.min("k")).first()[0] == 6
