"""C1 - surrogate key generation without a global single-partition window.

Keys are dense, start right after the largest existing key and follow the order of the
natural key, so a rerun over the same input yields the same keys.

Plan: range-partition + sort by the ordering columns (one shuffle, balanced by sampling),
tag each row with ``monotonically_increasing_id`` (partition index in the upper bits, row
position in the lower 33 bits), cut the lineage with a reliable checkpoint (so a lost
executor cannot re-sample different range bounds), count rows per partition (one row per
partition), turn the counts into offsets with a window over that tiny table and join the
offsets back by broadcast.  Nothing but the existing maximum key reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.session import checkpoint_dir

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def max_key(df: DataFrame, key_col: str, floor: int = 0) -> int:
    """Largest existing key (scalar aggregate), never below ``floor``; sentinel -1 ignored."""
    row = df.agg(F.max(F.col(key_col)).alias("m")).first()
    m = row["m"] if row is not None else None
    return max(int(m) if m is not None else floor, floor)


def _base_row(spark, existing: DataFrame | None, key_col: str, start_after: int) -> DataFrame:
    """One row (part -1, n = current maximum key) that seeds the offsets table lazily."""
    if existing is None:
        return spark.range(1).select(F.lit(-1).cast("bigint").alias("_mk_part"),
                                     F.lit(start_after).cast("bigint").alias("_mk_n"))
    return existing.agg(F.coalesce(F.max(F.col(key_col)), F.lit(0)).cast("bigint").alias("_m")).select(
        F.lit(-1).cast("bigint").alias("_mk_part"), F.greatest("_m", F.lit(start_after).cast("bigint")).alias("_mk_n"))


def assign_keys(df: DataFrame, order_by: Sequence[str | Column], key_col: str,
                start_after: int = 0, num_partitions: int | None = None,
                key_type: str = "bigint", existing: DataFrame | None = None,
                existing_key: str | None = None) -> DataFrame:
    """Add ``key_col`` = base + 1, 2, ... in ``order_by`` order, where base is the largest
    key of ``existing`` (if given, evaluated lazily inside the same plan) or ``start_after``.

    ``order_by`` must be a total order over the rows (a unique natural key, or the natural
    key plus tie-break columns) for the keys to be reproducible.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mk_id", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = (tagged.groupBy(F.shiftright("_mk_id", _ROW_BITS).alias("_mk_part"))
                    .agg(F.count(F.lit(1)).alias("_mk_n")))
    base = _base_row(spark, existing, existing_key or key_col, start_after)
    # Tiny table (one row per partition + the base row): a global window over it is cheap.
    offsets = counts.unionByName(base).select(
        "_mk_part",
        F.coalesce(F.sum("_mk_n").over(Window.orderBy("_mk_part")
                                       .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_mk_off"))
    keyed = tagged.join(F.broadcast(offsets), F.shiftright(tagged["_mk_id"], _ROW_BITS) == offsets["_mk_part"])
    key = (F.col("_mk_off") + F.col("_mk_id").bitwiseAND(F.lit(_ROW_MASK)) + 1).cast(key_type)
    return keyed.withColumn(key_col, key).drop("_mk_id", "_mk_part", "_mk_off")


FINE_BUCKETS = 256        # fine buckets of each coarse one
ROWS_PER_TASK = 4_000_000  # rows that a task ranks, where the number of rows is known


def assign_keys_hashed(df: DataFrame, order_by: Sequence[str], key_col: str,
                       existing: DataFrame | None = None, existing_key: str | None = None,
                       start_after: int = 0, buckets: int | None = None, key_type: str = "bigint",
                       expected_rows: int | None = None) -> DataFrame:
    """Dense keys without a checkpoint, a sample or any driver action - for fact tables,
    whose surrogate keys only need to be unique and stable, not in natural-key order.

    Rows are dealt over ``buckets`` coarse buckets (shuffle partitions by default) of FINE_BUCKETS fine ones each by a
    hash of the whole row, so rows that repeat ``order_by`` do not gather in one; they are ranked inside their
    fine bucket (one shuffle, small sorts).  Two prefix sums place them: coarse sizes over all coarse buckets, fine sizes
    inside each coarse one; the largest key of ``existing`` joins the coarse sums as one more row.  The sizes come from
    the ranked rows themselves, so the upstream plan is computed once (the shuffle is reused).  Every value
    depends only on the data, so a recomputed task after an executor loss yields the same keys.  With
    ``expected_rows`` the rows are dealt over as many tasks as ROWS_PER_TASK asks for.
    """
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coarse = buckets or shuffle
    fine = coarse * FINE_BUCKETS
    ties = [f.name for f in df.schema.fields if f.name not in order_by and not f.dataType.simpleString().startswith("map")]
    hashed = df.withColumn("_mk_b", F.pmod(F.xxhash64(*[F.col(c) for c in [*order_by, *ties]]), F.lit(fine)).cast("int"))
    tasks = -(-(expected_rows or 0) // ROWS_PER_TASK)
    if tasks > shuffle:
        hashed = hashed.repartition(tasks, "_mk_b")
    ranked = hashed.withColumn("_mk_rn", F.row_number().over(Window.partitionBy("_mk_b").orderBy(
        *[F.col(c).asc_nulls_last() for c in [*order_by, *ties]])))
    sizes = ranked.groupBy("_mk_b").agg(F.max("_mk_rn").cast("bigint").alias("_mk_n")).withColumn(
        "_mk_c", F.expr(f"_mk_b div {FINE_BUCKETS}").cast("int"))
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(F.col(existing_key or key_col)), F.lit(0)).cast("bigint").alias("_mk_n")) \
            .select(F.lit(-1).cast("int").alias("_mk_c"), F.greatest("_mk_n", F.lit(start_after)).alias("_mk_n"))
    else:
        base = spark.range(1).select(F.lit(-1).cast("int").alias("_mk_c"), F.lit(start_after).cast("bigint").alias("_mk_n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # Tiny table (coarse buckets + 1 rows): a global window over it is cheap.
    tops = sizes.groupBy("_mk_c").agg(F.sum("_mk_n").alias("_mk_n")).unionByName(base).select(
        F.col("_mk_c").alias("_mk_oc"), F.sum("_mk_n").over(before.orderBy("_mk_c")).alias("_mk_top"))
    inner = sizes.select("_mk_c", F.col("_mk_b").alias("_mk_ob"), F.coalesce(
        F.sum("_mk_n").over(before.partitionBy("_mk_c").orderBy("_mk_b")), F.lit(0)).alias("_mk_in"))
    # at most ``fine`` rows, a parameter
    off = inner.join(F.broadcast(tops), inner["_mk_c"] == tops["_mk_oc"], "left").select(
        "_mk_ob", (F.col("_mk_top") + F.col("_mk_in")).alias("_mk_off"))
    # Left join (every bucket has an offset row): an inner join would let the optimizer push
    # an inferred filter into this branch only, and the shuffle could no longer be reused.
    keyed = ranked.join(F.broadcast(off), ranked["_mk_b"] == off["_mk_ob"], "left")
    return keyed.withColumn(key_col, (F.col("_mk_off") + F.col("_mk_rn")).cast(key_type)) \
        .drop("_mk_b", "_mk_ob", "_mk_rn", "_mk_off")


def unique_source(src: DataFrame, key: Sequence[str], what: str) -> DataFrame:
    """``src`` without rows whose key parts are all NULL; a key that repeats raises when the plan runs.

    The check is part of the plan (one aggregate on the key, which the following join needs
    partitioned alike), so it costs no extra job.
    """
    k = list(key)
    rest = [c for c in src.columns if c not in k]
    any_key = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in k], F.lit(False))
    grouped = src.where(any_key).groupBy(*k).agg(
        F.count(F.lit(1)).alias("_mk_rows"), F.first(F.struct(*rest, F.lit(1).alias("_mk_one"))).alias("_mk_rest"))
    message = F.concat(F.lit(f"{what}: key ({', '.join(k)}) repeats: "), F.to_json(F.struct(*k)))
    # the error is a value of the row, so no projection can drop the check
    checked = F.when(F.col("_mk_rows") > 1, F.raise_error(message).cast("int")).otherwise(F.lit(0))
    return grouped.withColumn("_mk_check", checked).where("_mk_check = 0").select(
        *[F.col(c) if c in k else F.col(f"_mk_rest.`{c}`").alias(c) for c in src.columns])


def key_report(src: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows without any key part, and keys that repeat."""
    k = list(key)
    per_key = src.groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
    no_key = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(False)) for c in k], F.lit(True))
    return per_key.agg(F.coalesce(F.sum(F.when(no_key, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
                       F.coalesce(F.sum(F.when(~no_key & (F.col("n") > 1), 1)), F.lit(0)).cast("bigint").alias(
                           "repeated_keys"))
