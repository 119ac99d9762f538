"""Performance, rank-IC definitions, attribution, drawdown contribution, overlays, reason policies, parity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr, safe_divide
from . import panel
from .joins import small

DAYS = 252.0


def performance(df: DataFrame, key: str, date: str, nav: str, benchmark: str | None = None, peak: str = "last") -> DataFrame:
    """A row a key: periods (NAV rows less one), total, arithmetic and compound annual return, vol, both Sharpe ratios,
    drawdown with its peak (last or first day at that height) and trough, Calmar, and with a benchmark's returns the
    information ratio.
    """
    w = Window.partitionBy(key).orderBy(date)
    x = df.withColumn("_r", safe_divide(nav, F.lag(nav).over(w)) - 1)
    x = x.withColumn("_peak", F.max(nav).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("_dd", safe_divide(nav, "_peak") - 1)
    # the day of the running peak: where the peak rises, or is met again
    at = F.when(F.col(nav) == F.col("_peak"), F.col(date)) if peak == "last" else F.when(F.coalesce(F.col("_peak") > F.lag("_peak").over(w), F.lit(True)), F.col(date))
    x = x.withColumn("_at", F.last(at, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    worst = F.min(F.struct("_dd", F.col(date).alias("trough"), F.col("_at").alias("peak")))
    extra = [F.avg(F.col("_r") - F.col(benchmark)).alias("_em"), F.stddev_samp(F.col("_r") - F.col(benchmark)).alias("_es")] if benchmark else []
    s = x.groupBy(key).agg((F.count("*") - 1).alias("periods"), (safe_divide(F.max_by(nav, date), F.min_by(nav, date)) - 1).alias("total"), F.avg("_r").alias("_m"), F.stddev_samp("_r").alias("_s"), worst.alias("_w"), *extra)
    vol = F.col("_s") * F.sqrt(F.lit(DAYS))
    cagr = F.when(F.col("total") > -1, F.pow(1 + F.col("total"), safe_divide(F.lit(DAYS), "periods")) - 1)
    s = s.withColumns({"annual": F.col("_m") * DAYS, "cagr": cagr, "vol": vol, "drawdown": F.col("_w._dd"), "peak": F.col("_w.peak"), "trough": F.col("_w.trough")})
    s = s.withColumns({"sharpe": safe_divide("annual", "vol"), "compound_sharpe": safe_divide("cagr", "vol"), "calmar": safe_divide(F.col("cagr"), -F.col("drawdown"))})
    if benchmark:
        s = s.withColumn("ir", safe_divide(F.col("_em") * F.sqrt(F.lit(DAYS)), "_es"))
    return s.drop("_m", "_s", "_w", "_em", "_es")


def rank_ics(df: DataFrame, by: str, score: str, target: str, tiebreak: str, min_n: int) -> DataFrame:
    """Correlations of a day under five definitions: dense, plain, percent and average ranks, and raw values."""
    x = df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
    kinds = ("dense", "rank", "percent", "average")
    for k in kinds:
        x = panel.xs_rank(panel.xs_rank(x, by, score, k, tiebreak, f"_s_{k}"), by, target, k, tiebreak, f"_t_{k}")
    ics = [safe_corr(f"_s_{k}", f"_t_{k}").alias(f"ic_{k}") for k in kinds]
    return x.groupBy(by).agg(F.count("*").alias("n"), *ics, safe_corr(score, target).alias("ic_raw")).where(F.col("n") >= min_n)


def monotonicity(buckets: DataFrame, bucket: str, value: str) -> DataFrame:
    """One row: how many neighbouring buckets don't rise, of how many, and the correlation of bucket and value."""
    down = F.col(value) >= F.lead(value).over(Window.orderBy(bucket))  # a row a bucket
    return buckets.withColumn("_d", down).agg(F.count("_d").alias("pairs"), F.count_if("_d").alias("falling"), safe_corr(bucket, value).alias("corr"))


def factor_attribution(df: DataFrame, by: str, key: str, factors: list[str], target: str) -> DataFrame:
    """factor, days, ic (mean of daily correlations), icir, lift (top less bottom fifth), coefficient (of the standardised
    factor), exposure (mean of the top fifth in standard deviations) and contribution (their product).
    """
    long = df.unpivot([by, key, target], factors, "factor", "x").where(F.col("x").isNotNull() & F.col(target).isNotNull())
    w = Window.partitionBy("factor", by)
    z = safe_divide(F.col("x") - F.avg("x").over(w), F.stddev_pop("x").over(w))
    x = long.withColumn("_z", z).withColumn("_q", F.ntile(5).over(w.orderBy(F.desc("x"), key)))
    top, low = F.col("_q") == 1, F.col("_q") == 5
    day = x.groupBy("factor", by).agg(safe_corr("x", target).alias("_ic"), (F.avg(F.when(top, F.col(target))) - F.avg(F.when(low, F.col(target)))).alias("_lift"), safe_divide(F.covar_pop("_z", target), F.var_pop("_z")).alias("_b"), F.avg(F.when(top, F.col("_z"))).alias("_e"))
    return day.groupBy("factor").agg(F.count("*").alias("days"), F.avg("_ic").alias("ic"), safe_divide(F.avg("_ic"), F.stddev_samp("_ic")).alias("icir"), F.avg("_lift").alias("lift"), F.avg("_b").alias("coefficient"), F.avg("_e").alias("exposure"), F.avg(F.col("_b") * F.col("_e")).alias("contribution"))


def correlation_groups(df: DataFrame, factors: list[str], least: float = 0.75) -> DataFrame:
    """factor, group_of: factors linked by |correlation| >= least share the first of them by name.  A handful of factors."""
    pairs = [(a, b) for i, a in enumerate(factors) for b in factors[i + 1 :]]
    row = df.agg(*(safe_corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs))).first()
    group = {f: f for f in factors}
    for _ in factors:
        for i, (a, b) in enumerate(pairs):
            if row[i] is not None and abs(row[i]) >= least:
                group[a] = group[b] = min(group[a], group[b])
    return df.sparkSession.createDataFrame(sorted(group.items()), "factor string, group_of string")


def drawdown_window(df: DataFrame, key: str, date: str, nav: str) -> DataFrame:
    """key, peak_day, trough of the deepest drawdown."""
    return panel.max_drawdown(df, key, date, nav).select(key, "peak_day", "trough")


def drawdown_contribution(positions: DataFrame, windows: DataFrame, run: str, name: str, date: str, contribution: Column) -> DataFrame:
    """run, name, days, contribution: what each name added inside its run's own window (after the peak, to the trough)."""
    w = windows.select(F.col(run).alias("_run"), "peak_day", "trough")
    inside = (F.col(run) == F.col("_run")) & (F.col(date) > F.col("peak_day")) & (F.col(date) <= F.col("trough"))
    return positions.join(small(w), inside).groupBy(run, name).agg(F.count("*").alias("days"), F.sum(contribution).alias("contribution"))


def common_losers(contributions: DataFrame, run: str, name: str, runs: int) -> DataFrame:
    """Names that lost in the drawdowns of at least so many runs, with the sum."""
    return contributions.where("contribution < 0").groupBy(name).agg(F.count("*").alias("runs"), F.sum("contribution").alias("contribution")).where(F.col("runs") >= runs)


def vol_target(df: DataFrame, key: str, date: str, ret: str, target: float, rows: int = 20, out: str = "exposure") -> DataFrame:
    """Exposure of at most 1 that would have had the target volatility over the rows before this one; 1 until they are full."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(-rows, -1)
    vol = F.stddev_samp(ret).over(w) * F.sqrt(F.lit(DAYS))
    return df.withColumn(out, F.when(F.count(ret).over(w) < rows, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(safe_divide(F.lit(target), vol), F.lit(1.0)))))


def drawdown_derisk(df: DataFrame, key: str, date: str, nav: str, limit: float, low: float, out: str = "exposure") -> DataFrame:
    """low on days whose day before was below its running peak by more than limit, else 1."""
    w = Window.partitionBy(key).orderBy(date)
    x = panel.running_drawdown(df, key, date, nav)
    return x.withColumn(out, F.when(F.lag("drawdown").over(w) < -limit, low).otherwise(1.0)).drop("peak", "drawdown")


def overlay_return(df: DataFrame, key: str, date: str, ret: str, exposure: str, cost_bps: float, out: str = "net") -> DataFrame:
    """Exposure times return less the cost of changing the exposure (from 1 at first)."""
    change = F.abs(F.col(exposure) - F.lag(exposure, 1, 1.0).over(Window.partitionBy(key).orderBy(date)))
    return df.withColumn(out, F.col(exposure) * F.coalesce(ret, F.lit(0.0)) - change * (cost_bps / 1e4))


def rolling_drawdown(df: DataFrame, key: str, date: str, nav: str, rows: int, out: str) -> DataFrame:
    """The deepest drawdown inside the last `rows` rows; null until there are so many, or where one of them is null.

    Stretches combine: the worst of two is the worse of both, or the second's low against the first's high.  A window is
    the end of one block of `rows` rows and the beginning of the next, whose highs, lows and worsts are running ones, so
    the work for a row doesn't grow with the window.
    """
    by = Window.partitionBy(key).orderBy(date)
    x = df.withColumn("_v", F.col(nav).cast("double")).withColumn("_i", F.row_number().over(by) - 1).withColumn("_b", F.expr(f"_i div {rows}"))
    to_here = Window.partitionBy(key, "_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy(key, "_b").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"_high": F.max("_v").over(to_here), "_low": F.min("_v").over(to_here), "_known": F.count("_v").over(to_here)})
    x = x.withColumn("_worst", F.min(F.col("_v") / F.col("_high") - 1).over(to_here))
    x = x.withColumns({"_high_on": F.max("_v").over(from_here), "_low_on": F.min("_v").over(from_here), "_known_on": F.count("_v").over(from_here)})
    x = x.withColumn("_worst_on", F.min(F.col("_low_on") / F.col("_v") - 1).over(from_here))
    x = x.withColumn("_end", F.lag(F.struct("_high_on", "_worst_on", "_known_on"), rows - 1).over(by))
    whole = (F.col("_i") + 1) % rows == 0  # the window is one block
    worst = F.when(whole, F.col("_worst")).otherwise(F.least("_worst", "_end._worst_on", F.col("_low") / F.col("_end._high_on") - 1))
    known = F.when(whole, F.col("_known")).otherwise(F.col("_known") + F.col("_end._known_on"))
    return x.withColumn(out, F.when((F.col("_i") >= rows - 1) & (known == rows), worst)).select(*df.columns, out)


def reason_policy(df: DataFrame, by: str, reasons: str, groups: dict[str, str], policy: str, saturation: float) -> DataFrame:
    """groups (of the reasons, sorted, joined by ;) and blocked under a policy: none; full, any reason; shape_only, a reason
    of the group shape.  Where more than `saturation` of a by would be blocked, nothing is.
    """
    known = F.create_map(*(F.lit(x) for kv in groups.items() for x in kv))
    mine = F.transform(F.filter(F.split(reasons, ";"), lambda r: r != ""), lambda r: F.coalesce(known[r], F.lit("other")))
    hit = {"none": F.lit(False), "full": F.size("_g") > 0, "shape_only": F.array_contains("_g", "shape")}[policy]
    x = df.withColumn("_g", F.array_sort(F.array_distinct(mine))).withColumn("_hit", hit)
    share = F.avg(F.col("_hit").cast("double")).over(Window.partitionBy(by))
    return x.withColumns({"groups": F.array_join("_g", ";"), "blocked": F.col("_hit") & ~(share > saturation)}).drop("_g", "_hit")


def orientation(ics: DataFrame, by: Column, ic: str, least: float = 0.01) -> DataFrame:
    """by, days, mean_ic, orientation (forward, reversed, undecided) and kind (stable if two days in three agree)."""
    mean, up = F.avg(ic), F.avg(F.when(F.col(ic) > 0, 1.0).otherwise(0.0))
    x = ics.where(F.col(ic).isNotNull()).groupBy(by).agg(F.count("*").alias("days"), mean.alias("mean_ic"), up.alias("_up"))
    way = F.when(F.col("mean_ic") >= least, "forward").when(F.col("mean_ic") <= -least, "reversed").otherwise("undecided")
    agree = F.when(way == "forward", F.col("_up")).when(way == "reversed", 1 - F.col("_up"))
    return x.withColumns({"orientation": way, "kind": F.when(agree >= 2 / 3, "stable").otherwise("mixed")}).drop("_up")


def first_match(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds; one whose inputs are unknown doesn't."""
    return reduce(lambda rest, r: F.when(F.coalesce(r[1], F.lit(False)), r[0]).otherwise(rest), reversed(rules), F.lit(otherwise))


def parity(pairs: DataFrame, metrics: dict[str, tuple[float, float]]) -> DataFrame:
    """For rows with base_m and new_m of each metric m: m_ok where new isn't below base by more than the larger of an
    absolute tolerance and a share of base; state skipped where either is unknown, else passed or failed.
    """
    ok = {f"{m}_ok": F.col(f"new_{m}") >= F.col(f"base_{m}") - F.greatest(F.lit(a), F.abs(F.col(f"base_{m}")) * s) for m, (a, s) in metrics.items()}
    x = pairs.withColumns(ok)
    unknown = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in ok))
    return x.withColumn("state", F.when(unknown, "skipped").when(reduce(lambda a, b: a & b, (F.col(k) for k in ok)), "passed").otherwise("failed"))
