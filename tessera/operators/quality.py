"""Expectations: each returns the rows that violate it; assert_empty turns rows into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import safe_divide


def expect_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def expect_covered(df: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of source that df lacks."""
    return source.select(*keys).distinct().join(df.select(*keys), keys, "left_anti")


def expect_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(F.col(col).isNull() | ~F.col(col).between(lo, hi))


def expect_ratio(df: DataFrame, by: list, ok: Column, floor: float) -> DataFrame:
    """Groups in which the share of rows that are ok is below the floor."""
    share = safe_divide(F.count_if(ok), F.count("*"))
    return df.groupBy(*by).agg(F.count("*").alias("n"), share.alias("ratio")).where(F.col("ratio") < floor)


def expect_no_gap(df: DataFrame, cal: DataFrame, date: str = "d") -> DataFrame:
    """Open days, between the first and the last of df, that df lacks."""
    ends = df.agg(F.min(date).alias("_a"), F.max(date).alias("_b"))  # one row
    return cal.select(date).join(F.broadcast(ends), F.col(date).between(F.col("_a"), F.col("_b"))).select(date).join(df.select(date).distinct(), date, "left_anti")


def assert_empty(df: DataFrame, name: str) -> None:
    bad = df.limit(3).collect()
    if bad:
        raise ValueError(f"{name}: {bad}")
