"""Fits, folds, score evaluation, overlays and share counts of factor research."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr, safe_divide
from .quantiles import exact_quantiles

STD_FLOOR = 1e-12


@dataclass
class WinsorZScore:
    """Median fill, winsorising at two quantiles, z-scores; fitted on training rows only, applied to all."""

    cols: tuple[str, ...]
    lo: float = 0.01
    hi: float = 0.99
    zscore: bool = True
    fitted: DataFrame | None = None

    def fit(self, train: DataFrame) -> WinsorZScore:
        each = [exact_quantiles(train, [], c, {f"_{c}_lo": self.lo, f"_{c}_hi": self.hi, f"_{c}_mid": 0.5}) for c in self.cols]
        cuts = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), each)  # a row each
        filled = train.crossJoin(F.broadcast(cuts)).select(*(self._clip(c).alias(c) for c in self.cols))  # one row
        moments = filled.agg(*(f for c in self.cols for f in (F.avg(c).alias(f"_{c}_mean"), F.stddev_pop(c).alias(f"_{c}_std"))))
        self.fitted = cuts.crossJoin(moments)
        return self

    def _clip(self, c: str) -> Column:
        filled = F.coalesce(F.col(c), F.col(f"_{c}_mid")) if self.zscore else F.col(c)
        return F.when(filled.isNotNull(), F.greatest(F.least(filled, F.col(f"_{c}_hi")), F.col(f"_{c}_lo")))

    def transform(self, df: DataFrame) -> DataFrame:
        x = df.crossJoin(F.broadcast(self.fitted))  # one row
        std = lambda c: F.when(F.col(f"_{c}_std") > STD_FLOOR, F.col(f"_{c}_std")).otherwise(1.0)
        done = {c: (self._clip(c) - F.col(f"_{c}_mean")) / std(c) if self.zscore else self._clip(c) for c in self.cols}
        return x.select(*(done[c].alias(c) if c in done else F.col(c) for c in df.columns))


def cv_folds(train_years: list[int], max_folds: int = 3, min_years: int = 2) -> list[tuple[list[int], int]]:
    """Expanding folds (years to train on, year to validate on): the last max_folds years with enough before them."""
    years = sorted(set(train_years))
    return [(years[:i], years[i]) for i in range(min_years, len(years))][-max_folds:]


def evaluate_scores(df: DataFrame, by: str, score: str, target: str, tiebreak: str, top_n: int) -> DataFrame:
    """For each by: mean target of the top_n scores, and of the top fifth less the bottom fifth."""
    w = Window.partitionBy(by).orderBy(F.desc_nulls_last(score), tiebreak)
    x = df.withColumns({"_r": F.row_number().over(w), "_q": F.ntile(5).over(w)})
    mean = lambda p: F.avg(F.when(p, F.col(target)))
    return x.groupBy(by).agg(mean(F.col("_r") <= top_n).alias("top_mean"), (mean(F.col("_q") == 1) - mean(F.col("_q") == 5)).alias("spread"))


def newey_west(df: DataFrame, order: str, value: str, lag: int) -> DataFrame:
    """n, mean and t of one series with autocovariances up to lag, weights falling linearly; a row a day, one window."""
    x = df.where(F.col(value).isNotNull()).withColumn("_e", F.col(value) - F.avg(value).over(Window.partitionBy()))
    w = Window.orderBy(order)
    x = x.withColumns({f"_p{k}": F.col("_e") * F.lag("_e", k).over(w) for k in range(1, lag + 1)})
    long_run = F.sum(F.col("_e") * F.col("_e"))
    for k in range(1, lag + 1):
        long_run = long_run + 2 * (1 - k / (lag + 1)) * F.coalesce(F.sum(f"_p{k}"), F.lit(0.0))
    se = F.sqrt(F.greatest(long_run, F.lit(0.0))) / F.count("*")
    return x.agg(F.count("*").alias("n"), F.avg(value).alias("mean"), safe_divide(F.avg(value), se).alias("t"))


def two_state(df: DataFrame, key: str, order: str, off: Column, e_low: float, out: str = "exposure") -> DataFrame:
    """e_low on the day after each day that is off, else 1."""
    before = F.coalesce(F.lag(off).over(Window.partitionBy(key).orderBy(order)), F.lit(False))
    return df.withColumn(out, F.when(before, e_low).otherwise(1.0))


def hysteresis(df: DataFrame, key: str, order: str, regime: str, e_low: float, out: str = "exposure") -> DataFrame:
    """Risk goes off with risk_off and comes back only with risk_on, a day later; neutral days keep the state."""
    turn = F.when(F.col(regime) == "risk_off", True).when(F.col(regime) == "risk_on", False)
    held = F.last(turn, True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.when(F.coalesce(held, F.lit(False)), e_low).otherwise(1.0))


def min_buy_shares(nav: Column, weight: Column, price: Column, lot: int = 100) -> Column:
    """Whole lots that reach the weight."""
    return (F.ceil(safe_divide(nav * weight, price) / lot) * lot).cast("long")


def transfer_coefficient(a: DataFrame, b: DataFrame, by: str, key: str, weight: str) -> DataFrame:
    """Correlation of two books' weights for each by, over names in either; a missing weight is 0."""
    x = a.select(by, key, F.col(weight).alias("_a")).join(b.select(by, key, F.col(weight).alias("_b")), [by, key], "full").fillna(0.0, ["_a", "_b"])
    return x.groupBy(by).agg(F.count("*").alias("n"), safe_corr("_a", "_b").alias("tc"))


def stitch(df: DataFrame, manifest: list[tuple], date: str = "d") -> DataFrame:
    """Rows with the run whose half-open window holds their date; windows are a literal list that doesn't overlap."""
    run = F.lit(None).cast("string")
    for name, lo, hi in manifest:
        run = F.when((F.col(date) >= F.lit(lo).cast("date")) & (F.col(date) < F.lit(hi).cast("date")), name).otherwise(run)
    return df.withColumn("run", run).where("run is not null")
