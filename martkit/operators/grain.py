"""Summaries of a fact's grain by partition, so that a grain check reads only partitions that can hold a key.

A summary row describes the rows of one partition whose grain hash falls into one bucket of 32,768: a bitmap of their
hashes (``bitmap_construct_agg``), the smallest and largest value of every grain column, the number of rows and the
largest surrogate key.  A batch of keys is summarised alike; a partition whose bitmaps share no bit with the batch's, or
whose value ranges miss it, holds none of its keys.  Summaries of several loads of one partition add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 22  # 128 buckets: at most 0.5 MB of bitmaps a partition


def _hash(grain: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in grain]).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _ranges(grain: Sequence[str]) -> list[Column]:
    return [x for i, c in enumerate(grain) for x in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
                                                     F.bool_or(F.col(c).isNull()).alias(f"null{i}"))]


def grain_summary(rows: DataFrame, grain: Sequence[str], part: str, key_col: str | None = None) -> DataFrame:
    """Summary rows of ``rows``: part, bucket, bits, ranges by grain column, n_rows, max_key."""
    key = F.max(key_col) if key_col else F.lit(None)
    hashed = rows.withColumn("_mk_h", _hash(grain))
    return hashed.groupBy(F.col(part).alias("part"), F.bitmap_bucket_number("_mk_h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_mk_h")).alias("bits"), *_ranges(grain),
        F.count(F.lit(1)).alias("n_rows"), key.cast("bigint").alias("max_key"))


def _merged(summary: DataFrame, width: int) -> DataFrame:
    ranges = [x for i in range(width) for x in (F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"),
                                                F.bool_or(f"null{i}").alias(f"null{i}"))]
    return summary.groupBy("part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), *ranges)


def matching_partitions(summary: DataFrame, batch: DataFrame, grain: Sequence[str]) -> DataFrame:
    """(part): partitions that may hold a grain of ``batch``; no other partition does.

    NULL parts of a grain match each other, as in the null-safe checks that follow.
    """
    g = list(grain)
    hashed = batch.select(*g).withColumn("_mk_h", _hash(g))
    mine = hashed.groupBy(F.bitmap_bucket_number("_mk_h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_mk_h")).alias("b_bits"),
        *[c.alias(f"b_{n}") for c, n in zip(_ranges(g), [f"{p}{i}" for i in range(len(g)) for p in ("lo", "hi", "null")],
                                            strict=True)])
    j = _merged(summary, len(g)).join(mine, "bucket")
    for i in range(len(g)):
        within = (F.col(f"lo{i}") <= F.col(f"b_hi{i}")) & (F.col(f"hi{i}") >= F.col(f"b_lo{i}"))
        j = j.where(F.coalesce(within, F.lit(False)) | (F.col(f"null{i}") & F.col(f"b_null{i}")))
    both = j.select("part", "bucket", (F.bitmap_count("bits") + F.bitmap_count("b_bits")).alias("n"),
                    F.explode(F.array("bits", "b_bits")).alias("one"))
    shared = both.groupBy("part", "bucket").agg(F.first("n").alias("n"), F.bitmap_or_agg("one").alias("either"))
    return shared.where(F.col("n") > F.bitmap_count("either")).select("part").distinct()
