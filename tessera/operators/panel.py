"""Windows over entity-by-day panels and over the cross-sections of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr


def lags(df: DataFrame, key: str, order: str, col: str, ks) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(w) for k in ks})


def rolling(df: DataFrame, key: str, order: str, spec: dict[str, tuple[str, str, int]], shift: int = 0) -> DataFrame:
    """out: (function, column, rows): over the last rows up to this one, or up to `shift` rows before."""
    fn = {"avg": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumns({out: fn[f](c).over(w.rowsBetween(-(n - 1) - shift, -shift)) for out, (f, c, n) in spec.items()})


def gap_return(df: DataFrame, key: str, order: str, price: str) -> DataFrame:
    """Return against the last known price before this row, whatever gaps lie between."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("ret", F.try_divide(price, F.last(price, True).over(before)) - 1)


def bounded_ffill(df: DataFrame, key: str, order: str, col: str, max_age: int) -> DataFrame:
    """The last known value of col, unless it is more than max_age rows old."""
    w = Window.partitionBy(key).orderBy(order)
    n = df.withColumn("_n", F.row_number().over(w))
    held = F.last(F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), F.col("_n").alias("n"))), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return n.withColumn("_h", held).withColumn(f"{col}_ffill", F.when(F.col("_n") - F.col("_h.n") <= max_age, F.col("_h.v"))).drop("_n", "_h")


def bounded_ffill_all(df: DataFrame, key: str, order: str, cols: list[str], max_age: int) -> DataFrame:
    """bounded_ffill of many columns where they stand, by one sort and one window."""
    w = Window.partitionBy(key).orderBy(order)
    n = df.withColumn("_n", F.row_number().over(w))
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    n = n.withColumns({f"_h_{c}": F.last(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_n").alias("n"))), True).over(back) for c in cols})
    return n.withColumns({c: F.when(F.col("_n") - F.col(f"_h_{c}.n") <= max_age, F.col(f"_h_{c}.v")) for c in cols}).drop("_n", *(f"_h_{c}" for c in cols))


def turnover(weights: DataFrame, book: str, name: str, date: str, weight: str, tasks: int | None = None) -> DataFrame:
    """book, date, turnover: half the sum of changes of weights since the book's day before; a name that is gone has 0.

    Each weight counts once on its day and, negative, on the book's next day, so no days are joined to each other; the
    first day's is half its own weights.  Weights are dealt by book and name to so many tasks, where given.
    """
    days = weights.select(book, date).distinct().withColumn("_next", F.lead(date).over(Window.partitionBy(book).orderBy(date)))
    each = weights.join(days, [book, date]).select(book, name, F.inline(F.array(F.struct(F.col(date).alias("_at"), F.col(weight).alias("_w")), F.struct(F.col("_next").alias("_at"), (-F.col(weight)).alias("_w")))))
    each = each.where("_at is not null")
    if tasks:
        each = each.repartition(tasks, book, name)
    moved = each.groupBy(book, name, "_at").agg(F.sum("_w").alias("_w"))
    return moved.groupBy(book, F.col("_at").alias(date)).agg((F.sum(F.abs("_w")) / 2).alias("turnover"))


def running_drawdown(df: DataFrame, key: str, order: str, nav: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("peak", F.max(nav).over(w)).withColumn("drawdown", F.try_divide(nav, "peak") - 1)


def max_drawdown(df: DataFrame, key: str, order: str, nav: str) -> DataFrame:
    """The deepest drawdown of each key, its earliest trough, and the last day before at its peak."""
    dd = running_drawdown(df, key, order, nav)
    worst = dd.groupBy(key).agg(F.min(F.struct("drawdown", F.col(order).alias("trough"), "peak")).alias("w")).select(key, "w.*")
    at = df.join(worst.withColumnRenamed("peak", "_p"), key).where((F.col(order) <= F.col("trough")) & (F.col(nav) == F.col("_p")))
    return worst.join(at.groupBy(key).agg(F.max(order).alias("peak_day")), key).select(key, "drawdown", "trough", "peak_day")


def drawdown_episodes(df: DataFrame, key: str, order: str, nav: str) -> DataFrame:
    """Stretches below a running peak: first and last day, number of days, depth."""
    dd = running_drawdown(df, key, order, nav)
    w = Window.partitionBy(key).orderBy(order)
    at_peak = dd.withColumn("g", F.sum(F.when(F.col(nav) == F.col("peak"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return at_peak.where(F.col(nav) < F.col("peak")).groupBy(key, "g").agg(F.min(order).alias("first_day"), F.max(order).alias("last_day"), F.count("*").alias("days"), F.min("drawdown").alias("depth")).drop("g")


def xs_rank(df: DataFrame, by: str, score: str, method: str, tiebreak: str, out: str) -> DataFrame:
    """Rank of score, highest first, within by: row, rank, dense, percent, average."""
    w = Window.partitionBy(by).orderBy(F.desc_nulls_last(score))
    row = Window.partitionBy(by).orderBy(F.desc_nulls_last(score), F.asc(tiebreak))
    if method == "average":
        ties = F.count("*").over(Window.partitionBy(by, score))
        return df.withColumn(out, F.rank().over(w) + (ties - 1) / 2)
    return df.withColumn(out, {"row": F.row_number().over(row), "rank": F.rank().over(w), "dense": F.dense_rank().over(w), "percent": F.percent_rank().over(w)}[method])


def xs_bucket(df: DataFrame, by: str, score: str, n: int, tiebreak: str, out: str) -> DataFrame:
    return df.withColumn(out, F.ntile(n).over(Window.partitionBy(by).orderBy(F.desc_nulls_last(score), F.asc(tiebreak))))


def xs_demean(df: DataFrame, by: str, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col) - F.avg(col).over(Window.partitionBy(by)))


def xs_minmax_weight(df: DataFrame, by: str, col: str, out: str) -> DataFrame:
    w = Window.partitionBy(by)
    return df.withColumn(out, 1 + 2 * F.try_divide(F.col(col) - F.min(col).over(w), F.max(col).over(w) - F.min(col).over(w)))


def rank_ic(df: DataFrame, by: str, score: str, target: str, tiebreak: str, method: str = "average", min_n: int = 5) -> DataFrame:
    """Correlation of the ranks of score and target for each by with enough rows."""
    both = df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
    r = xs_rank(xs_rank(both, by, score, method, tiebreak, "_s"), by, target, method, tiebreak, "_t")
    return r.groupBy(by).agg(F.count("*").alias("n"), safe_corr("_s", "_t").alias("ic")).where(F.col("n") >= min_n)


def neutralize(df: DataFrame, by: str, y: str, x: str, out: str) -> DataFrame:
    """Residual of y on x, by least squares within by."""
    w = Window.partitionBy(by)
    slope = F.try_divide(F.covar_samp(y, x).over(w), F.var_samp(x).over(w))
    return df.withColumn("_b", slope).withColumn(out, F.col(y) - F.avg(y).over(w) - F.col("_b") * (F.col(x) - F.avg(x).over(w))).drop("_b")
