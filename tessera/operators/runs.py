"""Folds, models, costs, acceptance and reconciliation of research runs."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_divide


def fold_roles(df: DataFrame, date: str, folds: list[tuple[list[int], int]], embargo_days: int = 0) -> DataFrame:
    """A row for each fold (from 1) that a row takes part in, with its role, train or valid.

    Training rows of the last embargo_days days before the validation year are left out.
    """
    year, roles = F.year(date), []
    for i, (train, valid) in enumerate(folds, 1):
        early = F.col(date) < F.date_sub(F.make_date(F.lit(valid), F.lit(1), F.lit(1)), embargo_days)
        role = F.when(year == valid, "valid").when(year.isin(train) & early, "train")
        roles.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    return df.select("*", F.inline(F.array(*roles))).where("role is not null")


def auc_log_loss(df: DataFrame, by: str, label: str, prob: str) -> DataFrame:
    """n, auc (ties count half) and log_loss for each by; rows are counted by score first, so a task holds scores."""
    y = F.col(label)
    loss = -F.log(F.when(y == 1, F.col(prob)).otherwise(1 - F.col(prob)))
    s = df.groupBy(by, prob).agg(F.count("*").alias("_n"), F.sum(y).alias("_pos"), F.sum(loss).alias("_loss"))
    s = s.withColumn("_neg", F.col("_n") - F.col("_pos"))
    before = Window.partitionBy(by).orderBy(prob).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_won", F.col("_pos") * (F.coalesce(F.sum("_neg").over(before), F.lit(0)) + F.col("_neg") / 2))
    pairs = F.sum("_pos") * F.sum("_neg")
    return s.groupBy(by).agg(F.sum("_n").alias("n"), safe_divide(F.sum("_won"), pairs).alias("auc"), safe_divide(F.sum("_loss"), F.sum("_n")).alias("log_loss"))


def _assembled(df: DataFrame, cols: list[str], out: str = "_x") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def _fitted(estimator, train: DataFrame, cols: list[str], label: str):
    """The model of rows that are made once.

    A fit plans and reads its rows several times over, each time from the sources; it keeps its own blocks of them in
    memory, so ours lie on disk, until it is done.
    """
    rows = train.select(*cols, label).persist(StorageLevel.DISK_ONLY)
    try:
        return estimator.fit(_assembled(rows, cols))
    finally:
        rows.unpersist()


def fit_logistic(train: DataFrame, cols: list[str], label: str, reg: float = 0.01, elastic: float = 0.0):
    """A logistic regression with an L2 or elastic-net penalty; columns hold no nulls."""
    from pyspark.ml.classification import LogisticRegression

    return _fitted(LogisticRegression(featuresCol="_x", labelCol=label, regParam=reg, elasticNetParam=elastic), train, cols, label)


def fit_trees(train: DataFrame, cols: list[str], label: str, rounds: int = 10, depth: int = 3, seed: int = 42):
    """Gradient-boosted regression trees; columns hold no nulls."""
    from pyspark.ml.regression import GBTRegressor

    return _fitted(GBTRegressor(featuresCol="_x", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed), train, cols, label)


def predict(model, df: DataFrame, cols: list[str], out: str = "score") -> DataFrame:
    """Scores: the probability of 1 from a classifier, the prediction from a regressor."""
    from pyspark.ml.functions import vector_to_array

    x = model.transform(_assembled(df, cols))
    score = vector_to_array("probability")[1] if "probability" in x.columns else F.col("prediction")
    return x.select(*df.columns, score.alias(out))


def importances(spark, model, cols: list[str]) -> DataFrame:
    """feature, importance; a row a feature."""
    return spark.createDataFrame(list(zip(cols, model.featureImportances.toArray().tolist(), strict=True)), "feature string, importance double")


def trade_costs(df: DataFrame, side: str, traded: str, commission_bps: float = 1.0, least: float = 5.0, tax_bps: float = 5.0, slippage_bps: float = 5.0) -> DataFrame:
    """commission (at least `least`), tax on sales, fee (both), slippage (the part of the traded amount that is slip)."""
    t, sold = F.col(traded), F.col(side) == "sell"
    commission = F.greatest(t * (commission_bps / 1e4), F.lit(least))
    tax = F.when(sold, t * (tax_bps / 1e4)).otherwise(0.0)
    slip = t * slippage_bps / F.when(sold, 1e4 - slippage_bps).otherwise(1e4 + slippage_bps)
    return df.withColumns({"commission": commission, "tax": tax, "fee": commission + tax, "slippage": slip})


def decide(df: DataFrame, gates: list[tuple[str, str, Column]]) -> DataFrame:
    """failed (names of gates not met, joined by ;) and status for gates (name, metric, condition).

    incomplete where a metric is null, accepted where all conditions hold, else rejected.
    """
    failed = F.array_compact(F.array(*(F.when(~ok, name) for name, _, ok in gates)))
    unknown = reduce(lambda a, b: a | b, (F.col(m).isNull() for _, m, _ in gates))
    status = F.when(unknown, "incomplete").when(F.size(failed) == 0, "accepted").otherwise("rejected")
    return df.withColumns({"failed": F.array_join(failed, ";"), "status": status})


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], only_a: str, only_b: str) -> DataFrame:
    """keys and status: matched, or which side alone has them; keys are distinct in each side."""
    both = a.select(*keys, F.lit(True).alias("_a")).join(b.select(*keys, F.lit(True).alias("_b")), keys, "full")
    return both.select(*keys, F.when(F.col("_b").isNull(), only_a).when(F.col("_a").isNull(), only_b).otherwise("matched").alias("status"))


def relative_returns(df: DataFrame, key: str, date: str, ret: str) -> DataFrame:
    """excess over the equal-weight mean of the same days, and that mean's own sum, for each key."""
    mean = df.groupBy(date).agg(F.round(F.avg(ret), 8).alias("_m"))  # a row a day
    return df.where(F.col(ret).isNotNull()).join(mean, date).groupBy(key).agg(F.sum(F.col(ret) - F.col("_m")).alias("excess"), F.sum("_m").alias("benchmark"))


def sub_window_performance(df: DataFrame, key: str, window: str, date: str, nav: str) -> DataFrame:
    """days, total return and maximum drawdown inside each key's window."""
    w = Window.partitionBy(key, window).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn("_dd", safe_divide(nav, F.max(nav).over(w)) - 1)
    return x.groupBy(key, window).agg(F.count("*").alias("days"), (safe_divide(F.max_by(nav, date), F.min_by(nav, date)) - 1).alias("total"), F.min("_dd").alias("drawdown"))


def ledger_violations(nav: DataFrame) -> DataFrame:
    """rule, bad: how many days of a ledger break it; the sums are one row."""
    rules = {"cash at least -1": F.col("cash") < -1, "exposure at most 1": F.col("holdings") > F.col("nav") + 1, "nav = cash + holdings": F.abs(F.col("cash") + F.col("holdings") - F.col("nav")) > 1e-6}
    one = nav.agg(*(F.count_if(bad).alias(rule) for rule, bad in rules.items()))
    return one.unpivot([], [f"`{r}`" for r in rules], "rule", "bad")
