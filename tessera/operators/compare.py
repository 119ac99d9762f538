"""Comparison of two large tables by trees of digests: only ranges of keys that differ are looked into."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_dir
from .joins import small

STEP = 4  # bits from a level to the next


def leaf(keys: list[str], bits: int) -> Column:
    """The range, of 2^bits, that the hash of the keys falls into."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def digests(df: DataFrame, keys: list[str], bits: int = 12) -> DataFrame:
    """leaf, n, s, x: rows of each range and two sums of their hashes, whatever their order; rows with other rows differ.

    Sums are taken by task first; a table has 2^bits rows of them at most.  They may be kept beside a run, so that later
    comparisons don't read it again where it is the same.
    """
    row = F.struct(*sorted(df.columns))
    wide = lambda h, k: F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(k)
    text = F.to_json(row, {"ignoreNullFields": "false"})  # nulls and their places count
    return df.groupBy(leaf(keys, bits).alias("leaf")).agg(F.count("*").alias("n"), wide(F.xxhash64(text), "s"), wide(F.xxhash64(F.lit(1), text), "x"))


def differing(a: DataFrame, b: DataFrame, bits: int = 12) -> DataFrame:
    """Ranges whose digests differ, from the root down: below a range that is equal nothing is compared."""
    shift = bits
    ranges = None
    while True:
        shift = max(shift - STEP, 0)
        level = []
        for side in (a, b):
            x = side.withColumn("at", F.shiftright("leaf", shift))
            if ranges is not None:
                x = x.withColumn("up", F.shiftright("leaf", min(shift + STEP, bits))).join(small(ranges), "up", "left_semi")
            level.append(x.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("x").alias("x")))
        left, right = (side.select("at", F.struct("n", "s", "x").alias(name)) for side, name in zip(level, "ab", strict=True))
        ranges = left.join(right, "at", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("at").alias("up"))
        if not shift:
            return ranges.select(F.col("up").alias("leaf"))


def compare(a: DataFrame, b: DataFrame, keys: list[str], bits: int = 12) -> DataFrame:
    """keys and why: only in a, only in b, or differs; keys are unique in each, nulls among them equal.

    Only rows of ranges that differ are shuffled, so the join grows with the differences, the digests with neither.
    """
    spark = a.sparkSession
    at = f"{shared_dir(spark)}/digests-{uuid.uuid4().hex}"
    for side, name in ((a, "a"), (b, "b")):
        digests(side, keys, bits).write.parquet(f"{at}/{name}")
    differing(spark.read.parquet(f"{at}/a"), spark.read.parquet(f"{at}/b"), bits).write.parquet(f"{at}/ranges")
    ranges = small(spark.read.parquet(f"{at}/ranges"))
    values = sorted(a.columns)

    def near(side: DataFrame, name: str) -> DataFrame:
        x = side.withColumn("leaf", leaf(keys, bits)).join(ranges, "leaf", "left_semi")
        return x.select(*(F.col(k).alias(f"{name}_{k}") for k in keys), F.struct(*values).alias(name))

    same = F.lit(True)
    for k in keys:
        same &= F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    x = near(a, "a").join(near(b, "b"), same, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return x.select(*(F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys), F.when(F.col("b").isNull(), "only in a").when(F.col("a").isNull(), "only in b").otherwise("differs").alias("why"))
