"""Exact quantiles of large groups, and ranks over a whole table, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins

ACCURACY, MARGIN, FEW = 10_000, 0.0005, 10_000  # of the sketch; ranks to either side that are kept; rows of a small group


def exact_quantiles(df: DataFrame, by: list[str], col: str, ps: dict[str, float]) -> DataFrame:
    """by and a column for each of ps: the quantile with linear interpolation; nulls don't count.

    A sketch brackets each quantile; rows below the bracket are counted, and those inside, a thousandth of a group,
    are counted by value, so that the window over them holds few rows however large the group or frequent a value.
    """
    keys = by or ["_all"]
    rows = df.where(F.col(col).isNotNull()).select(*(by or [F.lit(0).alias("_all")]), F.col(col).cast("double").alias("_v"))
    points = [(name, p) for name, p in ps.items()]
    sketch = F.percentile_approx("_v", [x for _, p in points for x in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))], ACCURACY)
    stats = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), sketch.alias("_s"))
    small = F.col("_n") <= FEW
    asked = [F.struct(F.lit(name).alias("_name"), (F.lit(p) * (F.col("_n") - 1)).alias("_at"), F.when(small, F.col("_min")).otherwise(F.col("_s")[2 * i]).alias("_lo"), F.when(small, F.col("_max")).otherwise(F.col("_s")[2 * i + 1]).alias("_hi")) for i, (name, p) in enumerate(points)]
    asked = stats.select(*keys, F.inline(F.array(*asked)))
    # with a hint where there are few groups: rows dealt by group would be few large tasks
    met = rows.join(joins.small(asked), keys)
    counted = met.groupBy(*keys, "_name", "_at", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_x")).agg(F.count_if(F.col("_v") <= F.col("_hi")).alias("_k"))
    # rows below a bracket have no value, and come first
    upto = F.sum("_k").over(Window.partitionBy(*keys, "_name").orderBy(F.asc_nulls_first("_x")))
    placed = counted.where("_k > 0").withColumn("_to", upto)
    at = lambda rank: F.min(F.when(F.col("_to") > rank, F.col("_x")))
    share = F.first("_at") - F.floor(F.first("_at"))
    value = at(F.floor("_at")) * (1 - share) + at(F.ceil("_at")) * share
    return placed.groupBy(*keys, "_name").agg(value.alias("_q")).groupBy(*keys).pivot("_name", [n for n, _ in points]).agg(F.first("_q")).select(*by, *(n for n, _ in points))


def place_overall(df: DataFrame, first: Column, score: str, rest: list, out: str, parts: int = 64) -> DataFrame:
    """Places from 1 in the order of first (false before true), score (highest first, nulls last) and rest.

    Rows are dealt to ranges of score between approximate quantiles; each range is ranked by itself, behind the rows
    of the ranges before it.  Rows of one score share a range.
    """
    cuts = df.agg(F.percentile_approx(score, [i / parts for i in range(1, parts)], 1000).alias("_cuts"))  # one row
    above = F.size(F.filter("_cuts", lambda c: c > F.col(score)))
    part = first.cast("int") * (parts + 1) + F.when(F.col(score).isNull(), parts).otherwise(above)
    x = df.crossJoin(F.broadcast(cuts)).withColumn("_part", part).drop("_cuts")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = x.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))  # a row a range
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc_nulls_last(score), *rest))
    return x.join(F.broadcast(before), "_part").withColumn(out, (F.col("_before") + within).cast("long")).drop("_part", "_before")
