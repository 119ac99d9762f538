"""Trading calendars: ordinals, neighbours, offsets, rebalance dates, refresh windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import small


def with_ordinal(cal: DataFrame, date: str = "d") -> DataFrame:
    """seq (from 1), prev_d and next_d; a calendar has one row a day and stays small whatever the facts hold."""
    w = Window.orderBy(date)
    return cal.withColumns({"seq": F.row_number().over(w).cast("long"), "prev_d": F.lag(date).over(w), "next_d": F.lead(date).over(w)})


def next_open(df: DataFrame, cal: DataFrame, date: str, out: str, inclusive: bool = True, date_cal: str = "d") -> DataFrame:
    """The first open day at or after (or after) `date`: a dense map of days, joined by equality."""
    days = cal.agg(F.min(date_cal).alias("a"), F.max(date_cal).alias("b")).select(F.explode(F.sequence(F.date_sub("a", 366), "b")).alias("day"))
    marked = days.join(cal.select(F.col(date_cal).alias("day"), F.col(date_cal).alias("o")), "day", "left")
    ahead = Window.orderBy("day").rowsBetween(0 if inclusive else 1, Window.unboundedFollowing)
    dense = marked.select(F.col("day").alias(date), F.first("o", True).over(ahead).alias(out))
    return df.join(small(dense), date, "left")


def offset_date(df: DataFrame, cal: DataFrame, date: str, k: int, out: str) -> DataFrame:
    """The open day k places after `date` by ordinal, null beyond the calendar."""
    seq = cal.select(F.col("d").alias(date), "seq")
    to = cal.select((F.col("seq") - k).alias("seq"), F.col("d").alias(out))
    return df.join(small(seq), date, "left").join(small(to), "seq", "left").drop("seq")


def rebalance_dates(cal: DataFrame, freq: str = "weekly", date: str = "d") -> DataFrame:
    """The last open day of each ISO week, of every other week counted from the first, or of each month."""
    if freq == "monthly":
        return cal.groupBy(F.trunc(date, "month").alias("m")).agg(F.max(date).alias(date)).select(date)
    weeks = cal.groupBy(F.extract(F.lit("YEAROFWEEK"), date).alias("y"), F.weekofyear(date).alias("w")).agg(F.max(date).alias(date))
    if freq == "biweekly":
        weeks = weeks.withColumn("i", F.row_number().over(Window.orderBy(date))).where(F.col("i") % 2 == 1)
    return weeks.select(date)


@dataclass(frozen=True)
class RefreshWindow:
    write_from: object
    write_to: object
    read_from: object
    label_from: object


def plan_refresh_window(cal: DataFrame, date_from, date_to, read_back: int = 60, label_back: int = 20) -> RefreshWindow:
    """Days to write, and how far before them features are read and labels rewritten, in open days."""
    numbered = with_ordinal(cal.select("d").distinct()).select("d", "seq")
    inside = numbered.where(F.col("d").between(F.lit(date_from), F.lit(date_to)))
    first, write_from, write_to = inside.agg(F.min("seq"), F.min("d"), F.max("d")).first()
    if first is None:
        raise ValueError("the calendar has no open day in the window")
    want = [max(1, first - read_back), max(1, first - label_back)]
    day = {r["seq"]: r["d"] for r in numbered.where(F.col("seq").isin(want)).collect()}  # two rows
    return RefreshWindow(write_from, write_to, day[want[0]], day[want[1]])
