"""Joins over time: skeletons, intervals, as-of, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CALENDAR_ROWS = 100_000  # a calendar of up to so many days goes to all executors (some 2 MB)


def small(df: DataFrame, rows: int = CALENDAR_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows it to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def skeleton(cal: DataFrame, entities: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """One row for each entity and open day in [start, end): days listed per entity, then kept if open."""
    listed = entities.select(key, F.explode(F.sequence(start, F.date_sub(end, 1))).alias("d"))
    return listed.join(small(cal.select("d")), "d", "left_semi").select(key, "d")


def interval_join(left: DataFrame, right: DataFrame, key: str, point: str, lo: str, hi: str, how: str = "left") -> DataFrame:
    """Rows of right whose half-open [lo, hi) holds point, of the same key."""
    r = right.withColumnRenamed(key, "_k")
    return left.join(r, (left[key] == r["_k"]) & (left[point] >= r[lo]) & (left[point] < r[hi]), how).drop("_k")


def asof_join(left: DataFrame, right: DataFrame, key: str, point: str, visible: str, tiebreak: list, lookback_days: int, row: list[str]) -> DataFrame:
    """For each left row (named by columns row) the best right row visible at point and at most lookback_days old."""
    r = right.withColumnRenamed(key, "_k")
    near = left.join(r, (left[key] == r["_k"]) & (r[visible] <= left[point]) & (r[visible] >= F.date_sub(left[point], lookback_days))).drop("_k")
    best = near.withColumn("_r", F.row_number().over(Window.partitionBy(*row).orderBy(*tiebreak))).where("_r = 1").drop("_r")
    rest = [c for c in best.columns if c not in left.columns]
    return left.join(best.select(*row, *rest), row, "left")


def full_diff(a: DataFrame, b: DataFrame, keys: list[str], col: str, tol: float = 0.0) -> DataFrame:
    """Rows that are in one side only, or whose col differs by more than tol."""
    joined = a.select(*keys, F.col(col).alias("a")).join(b.select(*keys, F.col(col).alias("b")), keys, "full")
    return joined.where(F.col("a").isNull() | F.col("b").isNull() | (F.abs(F.col("a") - F.col("b")) > tol))


def latest_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def merge_upsert(old: DataFrame, new: DataFrame, keys: list[str], written: list) -> DataFrame:
    """old with the rows of new in place of those of equal keys (nulls equal); of several in new the last written stays."""
    last = latest_by(new, keys, [F.desc(c) if isinstance(c, str) else c for c in written])
    side = last.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return old.join(side, same, "left_anti").unionByName(last)
