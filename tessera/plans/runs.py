"""Further queries over the driver tables: folds, models, costs, attribution, acceptance, run-scoped checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import rounded, safe_divide
from ..operators import calendar as cal_
from ..operators import ledger, panel, quantiles, research, runs
from ..sources.tables import table
from .market import BARS, CAL, CANDIDATES, LABELS, NAV, QUERIES, RANKED, bars, calendar, candidates, forward, labels, ledger_rows, navs, query, scored

FOLDS = research.cv_folds([1996, 1997, 1998, 1999, 2000])


@query("d21_winsor_only", "WITH t AS (SELECT quantile_cont(o_totalprice, 0.001) AS lo, quantile_cont(o_totalprice, 0.999) AS hi FROM orders WHERE o_orderdate < DATE '1999-01-01') SELECT o_orderkey, round(greatest(least(o_totalprice, hi), lo), 3) AS o_totalprice FROM orders, t")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    fitted = research.WinsorZScore(("o_totalprice",), 0.001, 0.999, zscore=False).fit(o.where(F.to_date("o_orderdate") < F.lit("1999-01-01").cast("date")))
    return fitted.transform(o).select("o_orderkey", F.round("o_totalprice", 3).alias("o_totalprice"))


@query("d24_cv_folds", "SELECT fold, CASE WHEN year(d) = v THEN 'valid' ELSE 'train' END AS role, count(*) AS n FROM (SELECT o_orderdate::DATE AS d FROM orders) o JOIN (VALUES (1, 1998), (2, 1999), (3, 2000)) f(fold, v) ON year(d) BETWEEN 1996 AND v WHERE year(d) = v OR d < make_date(v, 1, 1) - 5 GROUP BY 1, 2")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    return runs.fold_roles(o, "d", FOLDS, 5).groupBy("fold", "role").agg(F.count("*").alias("n"))


@query(
    "d26_auc_log_loss",
    """WITH s AS (SELECT o_orderpriority AS g, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, greatest(least(o_totalprice / 500000, 0.99::DOUBLE), 0.01::DOUBLE) AS p FROM orders WHERE o_orderstatus <> 'P'),
    r AS (SELECT *, rank() OVER (PARTITION BY g ORDER BY p) + (count(*) OVER (PARTITION BY g, p) - 1) / 2.0::DOUBLE AS rk FROM s)
    SELECT g, count(*) AS n, round((sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / NULLIF(sum(y)::DOUBLE * (count(*) - sum(y))::DOUBLE, 0), 6) AS auc, round(-avg(ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)), 6) AS log_loss FROM r GROUP BY g""",
)
def _(spark, sf):
    p = F.greatest(F.least(F.col("o_totalprice") / 500000, F.lit(0.99)), F.lit(0.01))
    s = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderpriority").alias("g"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), p.alias("p"))
    return rounded(runs.auc_log_loss(s, "g", "y", "p"), 6)


FEATURES = ["ret_1", "ret_5", "rel"]


def model_rows(spark, sf):
    """Features of bars, which are read once, with the sign of their later return."""
    x = panel.rolling(panel.lags(bars(spark, sf, by_sec=True), "sec", "d", "close", (1, 5)), "sec", "d", {"m": ("avg", "amount", 20)})
    rets = [(safe_divide("close", f"close_lag{k}") - 1).alias(f"ret_{k}") for k in (1, 5)]
    x = x.select("sec", "d", "close", *rets, safe_divide("amount", "m").alias("rel"))
    x = forward(spark, sf, x).where("entry is not null and exit is not null").select("sec", "d", *FEATURES, "fwd")
    return x.dropna(subset=["sec", "d", *FEATURES]).withColumn("up", (F.col("fwd") > 0).cast("double"))


@query("d23_logistic_scores")
def _(spark, sf):
    """Trained on the years before 1999, applied to the later ones; an iterative fit, beyond SQL."""
    x = model_rows(spark, sf)
    early = F.col("d") < F.lit("1999-01-01").cast("date")
    model = runs.fit_logistic(x.where(early), FEATURES, "up")
    return runs.predict(model, x.where(~early), FEATURES).select("sec", "d", F.round("score", 4).alias("score"))


@query("d30_feature_importance")
def _(spark, sf):
    x = model_rows(spark, sf).where(F.col("d") < F.lit("1999-01-01").cast("date"))
    return rounded(runs.importances(spark, runs.fit_trees(x, FEATURES, "fwd"), FEATURES))


COSTS = """c AS (SELECT year(l_shipdate) AS y, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side, greatest(l_extendedprice * (1 / 1e4::DOUBLE), 5) AS commission,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (5 / 1e4::DOUBLE) ELSE 0 END AS tax, l_extendedprice * 5 / CASE WHEN l_returnflag = 'R' THEN 9995 ELSE 10005 END::DOUBLE AS slippage, l_orderkey, l_linenumber FROM lineitem)"""


def costs(spark, sf):
    side = F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy")
    return runs.trade_costs(table(spark, sf, "lineitem").withColumns({"side": side, "y": F.year("l_shipdate").cast("long")}), "side", "l_extendedprice")


@query("d38_trade_costs", f"WITH {COSTS} SELECT l_orderkey, l_linenumber, side, round(commission, 7) AS commission, round(tax, 7) AS tax, round(commission + tax, 7) AS fee, round(slippage, 7) AS slippage FROM c")
def _(spark, sf):
    return rounded(costs(spark, sf).select("l_orderkey", "l_linenumber", "side", "commission", "tax", "fee", "slippage"), 7)


@query("d83_cost_breakdown", f"WITH {COSTS} SELECT y, side, count(*) AS trades, round(sum(commission), 2) AS commission, round(sum(tax), 2) AS tax, round(sum(slippage), 2) AS slippage FROM c GROUP BY 1, 2")
def _(spark, sf):
    return rounded(costs(spark, sf).groupBy("y", "side").agg(F.count("*").alias("trades"), *(F.sum(c).alias(c) for c in ("commission", "tax", "slippage"))), 2)


@query("d28_candidate_ranking", RANKED + ", i AS (SELECT sec, round(corr(score, fwd), 4) AS ic, count(*) AS n FROM sc GROUP BY 1), j AS (SELECT sec, n, CASE WHEN NOT isnan(ic) THEN ic END AS ic FROM i) SELECT sec, n, ic, row_number() OVER (ORDER BY n < 20, ic DESC NULLS LAST, sec) AS place FROM j")
def _(spark, sf):
    """One row a candidate, ranked over all."""
    x = scored(spark, sf).groupBy("sec").agg(F.round(safe_divide(F.covar_samp("score", "fwd"), F.stddev_samp("score") * F.stddev_samp("fwd")), 4).alias("ic"), F.count("*").alias("n"))
    return quantiles.place_overall(x, F.col("n") < 20, "ic", ["sec"], "place")


@query("d42_signal_monitor", f"WITH {BARS}, {CAL}, s AS (SELECT sec, d, close FROM bars QUALIFY row_number() OVER (PARTITION BY d ORDER BY amount DESC, sec) <= 5) SELECT s.sec, s.d, CASE WHEN b.d IS NULL THEN 'no trading' WHEN b.close >= s.close * 1.1 THEN 'limit up' ELSE 'buyable' END AS state FROM s JOIN cal c ON c.d = s.d LEFT JOIN cal n ON n.seq = c.seq + 1 LEFT JOIN bars b ON b.sec = s.sec AND b.d = n.d")
def _(spark, sf):
    b = bars(spark, sf)
    s = panel.xs_rank(b, "d", "amount", "row", "sec", "k").where("k <= 5").select("sec", "d", "close")
    after = b.select("sec", F.col("d").alias("next_d"), F.col("close").alias("then"))
    x = cal_.offset_date(s, calendar(spark, sf), "d", 1, "next_d").join(after, ["sec", "next_d"], "left")
    return x.select("sec", "d", F.when(F.col("then").isNull(), "no trading").when(F.col("then") >= F.col("close") * 1.1, "limit up").otherwise("buyable").alias("state"))


@query("d49_decile_contribution", RANKED + ", q AS (SELECT *, ntile(10) OVER (PARTITION BY d ORDER BY score DESC, sec) AS decile FROM sc), m AS (SELECT decile, count(*) AS n, avg(fwd) AS v FROM q GROUP BY 1), a AS (SELECT avg(fwd) AS a FROM sc) SELECT decile, n, round(v, 4) AS mean_fwd, round(v - a, 4) AS contribution FROM m, a")
def _(spark, sf):
    x = panel.xs_bucket(scored(spark, sf), "d", "score", 10, "sec", "decile").groupBy(F.col("decile").cast("long").alias("decile")).agg(F.count("*").alias("n"), F.avg("fwd").alias("mean_fwd"))
    everything = F.sum(F.col("mean_fwd") * F.col("n")).over(Window.partitionBy()) / F.sum("n").over(Window.partitionBy())  # ten rows
    return rounded(x.withColumn("contribution", F.col("mean_fwd") - everything))


@query("d55_limit_down_exposure", f"WITH {BARS}, r AS (SELECT sec, d, amount, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars) SELECT d, count(*) AS names, count(*) FILTER (ret IS NULL) AS no_source, count(*) FILTER (ret <= -0.095) AS down, round(coalesce(sum(amount) FILTER (ret <= -0.095), 0) / sum(amount), 4) AS exposure FROM r GROUP BY d")
def _(spark, sf):
    down = F.col("ret") <= -0.095
    x = panel.gap_return(bars(spark, sf), "sec", "d", "close")
    return rounded(x.groupBy("d").agg(F.count("*").alias("names"), F.count_if(F.col("ret").isNull()).alias("no_source"), F.count_if(down).alias("down"), safe_divide(F.sum(F.when(down, F.col("amount")).otherwise(0.0)), F.sum("amount")).alias("exposure")))


@query("d59_adjustment_leak", f"WITH {BARS}, f AS (SELECT sec, d, close, close * CASE WHEN d >= DATE '1998-01-01' THEN 1.1 ELSE 1 END::DOUBLE AS adj FROM bars), r AS (SELECT sec, close / lag(close) OVER w - 1 AS raw, adj / lag(adj) OVER w - 1 AS adj FROM f WINDOW w AS (PARTITION BY sec ORDER BY d)) SELECT sec, round(sum(raw), 5) AS raw, round(sum(adj), 5) AS adjusted, count(*) FILTER (abs(adj - raw) > 0.000001) AS leak_days FROM r GROUP BY sec")
def _(spark, sf):
    factor = F.when(F.col("d") >= F.lit("1998-01-01").cast("date"), 1.1).otherwise(1.0)
    x = bars(spark, sf).withColumn("adj", F.col("close") * factor)
    w = Window.partitionBy("sec").orderBy("d")
    x = x.select("sec", *((safe_divide(c, F.lag(c).over(w)) - 1).alias(n) for c, n in (("close", "raw"), ("adj", "adjusted"))))
    return rounded(x.groupBy("sec").agg(F.sum("raw").alias("raw"), F.sum("adjusted").alias("adjusted"), F.count_if(F.abs(F.col("adjusted") - F.col("raw")) > 0.000001).alias("leak_days")), 5)


@query("d63_pool_benchmark", f"WITH {BARS}, r AS (SELECT sec, d, close / lag(close) OVER w - 1 AS ret, lag(volume) OVER w > 20 AS pool FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d)), m AS (SELECT d, round(avg(greatest(least(ret, 0.1), -0.1)), 8) AS v FROM r WHERE pool GROUP BY d) SELECT d, round(sum(ln(1 + v)) OVER (ORDER BY d), 6) AS log_nav, round(sum(ln(1 + v - 0.0001)) OVER (ORDER BY d), 6) AS log_costed FROM m")
def _(spark, sf):
    """The last windows hold one row a day."""
    x = panel.gap_return(bars(spark, sf), "sec", "d", "close").withColumn("pool", F.lag("volume").over(Window.partitionBy("sec").orderBy("d")) > 20)
    m = x.where("pool").groupBy("d").agg(F.round(F.avg(F.greatest(F.least("ret", F.lit(0.1)), F.lit(-0.1))), 8).alias("v"))
    w = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return rounded(m.select("d", F.sum(F.log(1 + F.col("v"))).over(w).alias("log_nav"), F.sum(F.log(1 + F.col("v") - 0.0001)).over(w).alias("log_costed")), 6)


RETURNS = NAV + ", x AS (SELECT sec, d, nav, nav / lag(nav) OVER (PARTITION BY sec ORDER BY d) - 1 AS r, nav / max(nav) OVER (PARTITION BY sec ORDER BY d) - 1 AS dd FROM nav)"


@query("d64_acceptance", RETURNS + """, p AS (SELECT sec, round(arg_max(nav, d) - 1, 5) AS total, round(min(dd), 5) AS mdd, round(stddev_samp(r) * sqrt(252), 4) AS vol FROM x GROUP BY sec)
    SELECT sec, concat_ws(';', CASE WHEN total <= 0 THEN 'total' END, CASE WHEN mdd < -0.9 THEN 'drawdown' END, CASE WHEN vol > 1.2 THEN 'volatility' END) AS failed,
    CASE WHEN total IS NULL OR mdd IS NULL OR vol IS NULL THEN 'incomplete' WHEN total > 0 AND mdd >= -0.9 AND vol <= 1.2 THEN 'accepted' ELSE 'rejected' END AS status FROM p""")
def _(spark, sf):
    x = panel.running_drawdown(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", "nav")
    p = x.groupBy("sec").agg(F.round(F.max_by("nav", "d") - 1, 5).alias("total"), F.round(F.min("drawdown"), 5).alias("mdd"), F.round(F.stddev_samp("ret") * F.sqrt(F.lit(252.0)), 4).alias("vol"))
    gates = [("total", "total", F.col("total") > 0), ("drawdown", "mdd", F.col("mdd") >= -0.9), ("volatility", "vol", F.col("vol") <= 1.2)]
    return runs.decide(p, gates).select("sec", "failed", "status")


@query("d65_relative_gate", RETURNS + ", b AS (SELECT d, round(avg(r), 8) AS m FROM x GROUP BY d), e AS (SELECT sec, round(sum(r - m), 4) AS excess, round(sum(m), 4) AS benchmark FROM x JOIN b USING (d) WHERE r IS NOT NULL GROUP BY sec) SELECT sec, excess, benchmark, CASE WHEN excess > 0 THEN 'ahead' WHEN benchmark < 0 AND excess > -0.05 THEN 'near in a falling market' ELSE 'behind' END AS branch FROM e")
def _(spark, sf):
    x = rounded(runs.relative_returns(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", "ret"))
    branch = F.when(F.col("excess") > 0, "ahead").when((F.col("benchmark") < 0) & (F.col("excess") > -0.05), "near in a falling market").otherwise("behind")
    return x.withColumn("branch", branch)


@query("d67_jump_reconciliation", f"WITH {BARS}, j AS (SELECT sec, d FROM (SELECT sec, d, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS r FROM bars) WHERE abs(r) > 0.3), a AS (SELECT DISTINCT l_suppkey AS sec, l_shipdate::DATE AS d FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) SELECT coalesce(j.sec, a.sec) AS sec, coalesce(j.d, a.d) AS d, CASE WHEN a.sec IS NULL THEN 'jump without action' WHEN j.sec IS NULL THEN 'action without jump' ELSE 'matched' END AS status FROM j FULL JOIN a ON j.sec = a.sec AND j.d = a.d")
def _(spark, sf):
    jumps = panel.gap_return(bars(spark, sf), "sec", "d", "close").where("abs(ret) > 0.3").select("sec", "d")
    actions = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_suppkey").alias("sec"), F.to_date("l_shipdate").alias("d")).distinct()
    return runs.reconcile(jumps, actions, ["sec", "d"], "jump without action", "action without jump")


@query("d70_loss_attribution", f"WITH {BARS}, r AS (SELECT sec, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars), l AS (SELECT s_nationkey AS nation, sec, round(sum(least(ret, 0)), 6) AS loss FROM r JOIN supplier ON sec = s_suppkey GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY loss, sec) AS k FROM l WHERE loss < 0) SELECT nation, count(*) AS names, round(sum(loss), 4) AS loss, min(sec) FILTER (k = 1) AS worst, round(sum(loss) FILTER (k <= 3) / sum(loss), 4) AS coverage FROM k GROUP BY nation")
def _(spark, sf):
    x = panel.gap_return(bars(spark, sf), "sec", "d", "close").join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_nationkey").alias("nation")), "sec")
    x = x.groupBy("nation", "sec").agg(F.round(F.sum(F.when(F.col("ret") < 0, F.col("ret")).when(F.col("ret").isNotNull(), 0.0)), 6).alias("loss")).where("loss < 0")
    x = x.withColumn("k", F.row_number().over(Window.partitionBy("nation").orderBy("loss", "sec")))
    share = safe_divide(F.sum(F.when(F.col("k") <= 3, F.col("loss"))), F.sum("loss"))
    return rounded(x.groupBy("nation").agg(F.count("*").alias("names"), F.sum("loss").alias("loss"), F.min(F.when(F.col("k") == 1, F.col("sec"))).alias("worst"), share.alias("coverage")))


@query("d79_sub_window_performance", NAV + ", y AS (SELECT sec, year(d) AS y, d, nav, nav / max(nav) OVER (PARTITION BY sec, year(d) ORDER BY d) - 1 AS dd FROM nav) SELECT sec, y, count(*) AS days, round(arg_max(nav, d) / arg_min(nav, d) - 1, 5) AS total, round(min(dd), 5) AS drawdown FROM y GROUP BY 1, 2")
def _(spark, sf):
    return rounded(runs.sub_window_performance(navs(spark, sf).withColumn("y", F.year("d").cast("long")), "sec", "y", "d", "nav"), 5)


@query("d80_comparison_table", "WITH s AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1), e AS (SELECT user_id, arg_max(json_extract_string(props, '$.k')::BIGINT, event_id) AS k FROM events GROUP BY 1) SELECT c_custkey, c_name, coalesce(n, 0) AS n, total, k FROM customer LEFT JOIN s ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey")
def _(spark, sf):
    s = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by(F.get_json_object("props", "$.k").try_cast("long"), "event_id").alias("k"))
    x = table(spark, sf, "customer").select("c_custkey", "c_name").join(s, "c_custkey", "left").join(e, "c_custkey", "left")
    return x.withColumn("n", F.coalesce("n", F.lit(0)))


@query("qa5_recompute_label", LABELS + f", y AS (SELECT sec, d, close, lead(close, 1) OVER w AS a, lead(close, 5) OVER w AS b FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d)), z AS (SELECT sec, d, b / NULLIF(a, 0) - 1 AS other FROM y) SELECT year(d) AS y, count(*) AS n, count(*) FILTER (other IS NULL OR abs(fwd - other) > 0.00001) AS differing FROM lab JOIN z USING (sec, d) GROUP BY 1")
def _(spark, sf):
    """Labels by open days against labels by traded days: they differ where a name didn't trade."""
    w = Window.partitionBy("sec").orderBy("d")
    other = bars(spark, sf).select("sec", "d", (safe_divide(F.lead("close", 5).over(w), F.lead("close", 1).over(w)) - 1).alias("other"))
    bad = F.col("other").isNull() | (F.abs(F.col("fwd") - F.col("other")) > 0.00001)
    return labels(spark, sf).join(other, ["sec", "d"]).groupBy(F.year("d").cast("long").alias("y")).agg(F.count("*").alias("n"), F.count_if(bad).alias("differing"))


@query("qa6_no_look_ahead", "SELECT o_orderkey, o_orderdate::DATE AS d, min(l_shipdate)::DATE AS first_known FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2 HAVING min(l_shipdate)::DATE > o_orderdate::DATE + 90")
def _(spark, sf):
    first = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.min("l_shipdate")).alias("first_known"))
    x = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).join(first, "o_orderkey")
    return x.where(F.col("first_known") > F.date_add("d", 90))


@query("d39_resumed_ledger")
def _(spark, sf):
    """The ledger of d34 from 1999 on, resumed from the books at the end of 1998; a fold, beyond SQL."""
    rows, early = ledger_rows(spark, sf), F.col("d") < F.lit("1999-01-01").cast("date")
    return ledger.run_ledger(rows.where(~early), start=ledger.snapshot(rows.where(early)))


@query("d36_fractional_ledger")
def _(spark, sf):
    """The ledger of d34 with fractions of shares."""
    return ledger.run_ledger(ledger_rows(spark, sf), lot=0)


@query("qa11_ledger_invariants")
def _(spark, sf):
    return runs.ledger_violations(QUERIES["d34_ledger"](spark, sf))


@query("qa12_run_equality", "WITH a AS (SELECT o_orderkey, md5(concat_ws('|', o_custkey, o_orderstatus, o_orderpriority)) AS f FROM orders), b AS (SELECT o_orderkey, md5(concat_ws('|', o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END, o_orderpriority)) AS f FROM orders WHERE o_orderkey % 89 <> 0) SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.f IS NULL THEN 'only in a' WHEN a.f IS NULL THEN 'only in b' ELSE 'differs' END AS why FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.f IS DISTINCT FROM b.f")
def _(spark, sf):
    print_of = lambda df: df.select("o_orderkey", F.md5(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority")).alias("f"))
    o = table(spark, sf, "orders")
    changed = o.where("o_orderkey % 89 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus")))
    x = print_of(o).withColumnRenamed("f", "a").join(print_of(changed).withColumnRenamed("f", "b"), "o_orderkey", "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return x.select("o_orderkey", F.when(F.col("b").isNull(), "only in a").when(F.col("a").isNull(), "only in b").otherwise("differs").alias("why"))


@query("qa13_rebalance_expected", f"WITH {CAL}, e AS (SELECT max(d) AS d FROM cal GROUP BY date_trunc('month', d)), a AS (SELECT max(o_orderdate::DATE) AS d FROM orders GROUP BY date_trunc('month', o_orderdate)) SELECT coalesce(e.d, a.d) AS d, CASE WHEN a.d IS NULL THEN 'missing' WHEN e.d IS NULL THEN 'unexpected' ELSE 'matched' END AS status FROM e FULL JOIN a ON e.d = a.d")
def _(spark, sf):
    expected = cal_.rebalance_dates(calendar(spark, sf), "monthly")
    actual = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("m")).agg(F.max(F.to_date("o_orderdate")).alias("d"))
    return runs.reconcile(expected, actual, ["d"], "missing", "unexpected")


@query("qa14_duplicate_steps", "SELECT user_id, (ts::DATE) AS d, event_type, count(*) AS n, count(DISTINCT props) AS payloads FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1 AND count(DISTINCT props) > 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("props").alias("payloads")).where("n > 1 and payloads > 1")


@query("qa16_stitched_stream", f"WITH {BARS}, {CAL}, s AS (SELECT CASE WHEN d < DATE '1997-01-01' THEN 'run_a' ELSE 'run_b' END AS run, sec, d FROM bars WHERE d >= DATE '1996-01-01' AND d < DATE '2000-01-01'), o AS (SELECT CASE WHEN d < DATE '1997-01-01' THEN 'run_a' ELSE 'run_b' END AS run, count(*) AS open_days FROM cal WHERE d >= DATE '1996-01-01' AND d < DATE '2000-01-01' GROUP BY 1) SELECT run, open_days, count(*) AS n, count(*) - count(DISTINCT (sec, d)) AS repeated, open_days - count(DISTINCT d) AS missing_days FROM s JOIN o USING (run) GROUP BY 1, 2")
def _(spark, sf):
    windows = [("run_a", "1996-01-01", "1997-01-01"), ("run_b", "1997-01-01", "2000-01-01")]
    n = research.stitch(bars(spark, sf), windows).groupBy("run", "sec", "d").agg(F.count("*").alias("k")).groupBy("run").agg(F.sum("k").alias("n"), (F.sum("k") - F.count("*")).alias("repeated"), F.count_distinct("d").alias("days"))
    days = research.stitch(calendar(spark, sf).select("d"), windows).groupBy("run").agg(F.count("*").alias("open_days"))
    return n.join(days, "run").select("run", "open_days", "n", "repeated", (F.col("open_days") - F.col("days")).alias("missing_days"))


@query("qa17_day_coverage", f"WITH {CAL}, p AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) SELECT year(cal.d) AS y, count(*) AS open_days, count(p.d) AS covered, min(cal.d) AS first_day, max(cal.d) AS last_day FROM cal LEFT JOIN p ON p.d = cal.d GROUP BY 1")
def _(spark, sf):
    p = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"), F.lit(1).alias("has")).distinct()
    x = calendar(spark, sf).select("d").join(p, "d", "left")
    return x.groupBy(F.year("d").cast("long").alias("y")).agg(F.count("*").alias("open_days"), F.count("has").alias("covered"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))


@query("qa18_required_elements", "WITH s AS (SELECT o_custkey, list(DISTINCT o_orderstatus) AS have FROM orders GROUP BY 1) SELECT o_custkey, array_to_string(list_filter(['F', 'O', 'P'], lambda x: NOT list_contains(have, x)), ';') AS missing FROM s WHERE NOT list_has_all(have, ['F', 'O', 'P'])")
def _(spark, sf):
    need = F.array(F.lit("F"), F.lit("O"), F.lit("P"))
    s = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_except(need, F.collect_set("o_orderstatus")).alias("gap"))
    return s.where(F.size("gap") > 0).select("o_custkey", F.array_join("gap", ";").alias("missing"))


@query("qa21_unexplained_decrease", f"WITH {BARS}, x AS (SELECT sec, d, volume, lag(volume) OVER (PARTITION BY sec ORDER BY d) AS before FROM bars), a AS (SELECT DISTINCT l_suppkey AS sec, l_shipdate::DATE AS d FROM lineitem WHERE l_returnflag = 'R') SELECT sec, d, before - volume AS fell FROM x ANTI JOIN a USING (sec, d) WHERE volume < before")
def _(spark, sf):
    x = bars(spark, sf).withColumn("before", F.lag("volume").over(Window.partitionBy("sec").orderBy("d"))).where("volume < before")
    why = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("sec"), F.to_date("l_shipdate").alias("d")).distinct()
    return x.join(why, ["sec", "d"], "left_anti").select("sec", "d", (F.col("before") - F.col("volume")).alias("fell"))


@query("qa22_rank_depth", CANDIDATES + " SELECT d, count(*) AS depth, max(rk) - count(*) AS holes FROM cand GROUP BY d HAVING count(*) < 10 OR max(rk) <> count(*)")
def _(spark, sf):
    x = candidates(spark, sf).groupBy("d").agg(F.count("*").alias("depth"), F.max("rk").cast("long").alias("top"))
    return x.where("depth < 10 or top <> depth").select("d", "depth", (F.col("top") - F.col("depth")).alias("holes"))


@query("qa23_benchmark_coverage", f"WITH {BARS}, {CAL}, b AS (SELECT d, close, lag(d) OVER (ORDER BY d) AS before FROM bars WHERE sec = 1) SELECT cal.d, CASE WHEN b.d IS NULL THEN 'missing' WHEN b.before IS NULL THEN 'no prior close' ELSE 'prior close is old' END AS why FROM cal LEFT JOIN b ON b.d = cal.d LEFT JOIN cal p ON p.seq = cal.seq - 1 WHERE b.d IS NULL OR b.before IS NULL OR b.before <> p.d")
def _(spark, sf):
    """One benchmark's series: a row a day."""
    b = bars(spark, sf).where("sec = 1").select("d", F.lag("d").over(Window.orderBy("d")).alias("before"), F.lit(True).alias("has"))
    x = calendar(spark, sf).select("d", "prev_d").join(b, "d", "left")
    return x.where("has is null or before is null or before <> prev_d").select("d", F.when(F.col("has").isNull(), "missing").when(F.col("before").isNull(), "no prior close").otherwise("prior close is old").alias("why"))


@query("qa26_split_exclusivity", "SELECT o_custkey, o_orderdate::DATE AS d, count(DISTINCT CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'valid' END) AS splits FROM orders GROUP BY 1, 2 HAVING count(DISTINCT CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'valid' END) > 1")
def _(spark, sf):
    split = F.when(F.col("o_orderkey") % 10 < 8, "train").otherwise("valid")
    return table(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


@query("qa27_payload_completeness", "SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS with_k, count(json_extract_string(props, '$.version')) AS with_version FROM events GROUP BY 1")
def _(spark, sf):
    has = lambda key: F.count(F.get_json_object("props", f"$.{key}")).alias(f"with_{key}")
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), has("k"), has("version"))
