"""One-to-one matching of events in time, within tolerances."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again."""
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def candidates(a: DataFrame, b: DataFrame, key: str, days: int, tolerance: Column) -> DataFrame:
    """key, a_id, b_id, far (days apart), off: pairs of one key at most so many days apart, off by no more than tolerance.

    a and b: key, id, d, size; tolerance may use a_size and b_size.  Rows meet in windows of `days` days, each a in its
    own and b in its own and both neighbours, so a key of many rows isn't joined to itself.
    """
    cell = lambda c: F.floor(F.unix_date(c) / max(days, 1))
    left = a.select(key, F.col("id").alias("a_id"), F.col("d").alias("a_d"), F.col("size").alias("a_size"), cell("d").alias("_cell"))
    right = b.select(key, F.col("id").alias("b_id"), F.col("d").alias("b_d"), F.col("size").alias("b_size"), F.explode(F.array(*(cell("d") + k for k in (-1, 0, 1)))).alias("_cell"))
    x = left.join(right, [key, "_cell"]).withColumns({"far": F.abs(F.datediff("a_d", "b_d")), "off": F.abs(F.col("a_size") - F.col("b_size"))})
    return x.where((F.col("far") <= days) & (F.col("off") <= tolerance)).select(key, "a_id", "b_id", "far", "off")


def match(a: DataFrame, b: DataFrame, key: str, days: int, tolerance: Column) -> DataFrame:
    """key, a_id, b_id, far, off: each a and each b in one pair at most, the nearest pair first.

    Pairs are taken in the order of days apart, size apart, a_id, b_id, as one after another would take them: each round
    keeps those that are first for both sides and drops what they use, until none is left.
    """
    order = F.struct("far", "off", "a_id", "b_id")
    open_, taken = saved(candidates(a, b, key, days, tolerance), "candidates"), None
    while not open_.isEmpty():
        best_a = open_.groupBy(key, "a_id").agg(F.min(order).alias("x")).select(key, "x.*")
        best_b = open_.groupBy(key, "b_id").agg(F.min(order).alias("x")).select(key, F.col("x.a_id").alias("a_id"), "b_id")
        now = saved(best_a.join(best_b, [key, "a_id", "b_id"]).select(key, "a_id", "b_id", "far", "off"), "matched")
        taken = now if taken is None else taken.unionByName(now)
        open_ = saved(open_.join(now.select(key, "a_id"), [key, "a_id"], "left_anti").join(now.select(key, "b_id"), [key, "b_id"], "left_anti"), "candidates")
    return taken if taken is not None else open_
