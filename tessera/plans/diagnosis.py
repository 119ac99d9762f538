"""Performance, rank-IC definitions, attribution, drawdown contribution, overlays, policies and parity."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import compound_annual, gross_from_returns, log_positive, required, rounded, safe_corr, safe_divide, zero_safe_ratio
from ..operators import diagnosis as dx
from ..operators import panel, runs
from ..operators import warehouse as wh
from ..sources.tables import table
from .market import BARS, CANDIDATES, NAV, RANKED, bars, candidates, navs, query, scored
from .runs import FEATURES, model_rows
from .warehouse import FIVE, five_masks

BENCH = NAV + """, x AS (SELECT sec, d, nav, nav / lag(nav) OVER (PARTITION BY sec ORDER BY d) - 1 AS r, max(nav) OVER (PARTITION BY sec ORDER BY d) AS peak FROM nav), y AS (SELECT *, round(avg(r) OVER (PARTITION BY d), 8) AS bench, nav / peak - 1 AS dd FROM x)"""


@query(
    "d41_performance",
    BENCH + """, s AS (SELECT sec, count(*) - 1 AS periods, arg_max(nav, d) / arg_min(nav, d) - 1 AS total, avg(r) AS m, stddev_samp(r) AS s, avg(r - bench) AS em, stddev_samp(r - bench) AS es FROM y GROUP BY sec), w AS (SELECT sec, d AS trough, dd, peak FROM y QUALIFY row_number() OVER (PARTITION BY sec ORDER BY dd, d) = 1),
    p AS (SELECT w.sec, w.trough, w.dd, max(nav.d) AS peak_last FROM w JOIN nav ON nav.sec = w.sec AND nav.d <= w.trough AND nav.nav = w.peak GROUP BY 1, 2, 3)
    SELECT s.sec, periods, round(total, 5) AS total, round(m * 252, 4) AS annual, round(pow(1 + total, 252.0::DOUBLE / periods) - 1, 5) AS cagr, round(s * sqrt(252), 4) AS vol, round(dd, 5) AS drawdown, peak_last AS peak, trough, round(m * 252 / (s * sqrt(252)), 3) AS sharpe, round((pow(1 + total, 252.0::DOUBLE / periods) - 1) / (s * sqrt(252)), 3) AS compound_sharpe, round((pow(1 + total, 252.0::DOUBLE / periods) - 1) / -dd, 3) AS calmar, round(em * sqrt(252) / es, 3) AS ir FROM s JOIN p ON s.sec = p.sec""",
)
def _(spark, sf):
    """Both Sharpe ratios, the drawdown's dates, Calmar, and the information ratio against the day's mean."""
    x = panel.gap_return(navs(spark, sf), "sec", "d", "nav")
    x = x.withColumn("bench", F.round(F.avg("ret").over(Window.partitionBy("d")), 8))
    p = dx.performance(x, "sec", "d", "nav", "bench")
    digits = {"total": 5, "annual": 4, "cagr": 5, "vol": 4, "drawdown": 5, "sharpe": 3, "compound_sharpe": 3, "calmar": 3, "ir": 3}
    return p.select("sec", "periods", "peak", "trough", *(F.round(c, n).alias(c) for c, n in digits.items()))


@query("d53_deepest_episodes", NAV + ", p AS (SELECT *, max(nav) OVER (PARTITION BY sec ORDER BY d) AS peak FROM nav), g AS (SELECT *, sum(CASE WHEN nav = peak THEN 1 ELSE 0 END) OVER (PARTITION BY sec ORDER BY d) AS g FROM p), e AS (SELECT sec, min(d) AS first_day, count(*) AS days, round(min(nav / peak - 1), 5) AS depth FROM g WHERE nav < peak GROUP BY sec, g.g) SELECT *, row_number() OVER w AS place FROM e WHERE depth <= -0.01 WINDOW w AS (PARTITION BY sec ORDER BY depth, first_day) QUALIFY row_number() OVER w <= 3")
def _(spark, sf):
    """The three deepest of at least one per cent."""
    e = panel.drawdown_episodes(navs(spark, sf), "sec", "d", "nav").select("sec", "first_day", "days", F.round("depth", 5).alias("depth")).where("depth <= -0.01")
    return e.withColumn("place", F.row_number().over(Window.partitionBy("sec").orderBy("depth", "first_day")).cast("long")).where("place <= 3")


@query(
    "d43_rank_ic_definitions",
    RANKED + """, r AS (SELECT d, score, fwd, dense_rank() OVER a AS sd, dense_rank() OVER b AS td, rank() OVER a AS sr, rank() OVER b AS tr, percent_rank() OVER a AS sp, percent_rank() OVER b AS tp, rank() OVER a + (count(*) OVER (PARTITION BY d, score) - 1) / 2.0::DOUBLE AS sa, rank() OVER b + (count(*) OVER (PARTITION BY d, fwd) - 1) / 2.0::DOUBLE AS ta FROM sc WINDOW a AS (PARTITION BY d ORDER BY score DESC), b AS (PARTITION BY d ORDER BY fwd DESC))
    SELECT d, count(*) AS n, round(corr(sd, td), 4) AS ic_dense, round(corr(sr, tr), 4) AS ic_rank, round(corr(sp, tp), 4) AS ic_percent, round(corr(sa, ta), 4) AS ic_average, round(corr(score, fwd), 4) AS ic_raw FROM r GROUP BY d HAVING count(*) >= 5""",
)
def _(spark, sf):
    return rounded(dx.rank_ics(scored(spark, sf), "d", "score", "fwd", "sec", 5))


BUCKETS = RANKED + ", b AS (SELECT *, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS bucket FROM sc), m AS (SELECT bucket, count(*) AS n, round(avg(fwd), 6) AS v, round(avg(score), 4) AS score FROM b GROUP BY 1)"


@query("d44_monotonicity", BUCKETS + ", l AS (SELECT *, v >= lead(v) OVER (ORDER BY bucket) AS down FROM m) SELECT count(down) AS pairs, count(*) FILTER (down) AS falling, round(corr(bucket, v), 4) AS corr FROM l")
def _(spark, sf):
    x = panel.xs_bucket(scored(spark, sf), "d", "score", 5, "sec", "bucket")
    return rounded(dx.monotonicity(x.groupBy("bucket").agg(F.round(F.avg("fwd"), 6).alias("v")), "bucket", "v"))


@query("d44_calibration", BUCKETS + " SELECT 6 - bucket AS bucket_from_bottom, n, score AS mean_score, round(v, 4) AS mean_fwd FROM m")
def _(spark, sf):
    """Buckets counted from the bottom, with what was predicted beside what came."""
    x = panel.xs_bucket(scored(spark, sf), "d", "score", 5, "sec", "bucket")
    m = x.groupBy("bucket").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.avg("fwd").alias("mean_fwd"))
    return rounded(m.select((6 - F.col("bucket")).cast("long").alias("bucket_from_bottom"), "n", "mean_score", F.round("mean_fwd", 6).alias("mean_fwd")))


FACTORS = """fac AS (SELECT lab.sec, lab.d, lab.fwd, b.close, ln(b.amount) AS size, b.high - b.low AS range, b.volume FROM lab JOIN bars b ON b.sec = lab.sec AND b.d = lab.d WHERE b.amount > 0)"""
NAMES = ("close", "size", "range", "volume")


def factors(spark, sf):
    x = scored(spark, sf, "amount", "high", "low", "volume").where("amount > 0")
    return x.select("sec", "d", "fwd", F.col("score").alias("close"), log_positive("amount").alias("size"), (F.col("high") - F.col("low")).alias("range"), "volume")


@query(
    "d57_factor_attribution",
    RANKED + f""", {FACTORS}, u AS (UNPIVOT fac ON close, size, range, volume INTO NAME factor VALUE x), z AS (SELECT *, (x - avg(x) OVER w) / NULLIF(stddev_pop(x) OVER w, 0) AS z, ntile(5) OVER (PARTITION BY factor, d ORDER BY x DESC, sec) AS q FROM u WINDOW w AS (PARTITION BY factor, d)),
    day AS (SELECT factor, d, covar_samp(x, fwd) / NULLIF(stddev_samp(x) * stddev_samp(fwd), 0) AS ic, avg(fwd) FILTER (q = 1) - avg(fwd) FILTER (q = 5) AS lift, covar_pop(z, fwd) / NULLIF(var_pop(z), 0) AS b, avg(z) FILTER (q = 1) AS e FROM z GROUP BY 1, 2)
    SELECT factor, count(*) AS days, round(avg(ic), 3) AS ic, round(avg(lift), 3) AS lift, round(avg(b), 3) AS coefficient, round(avg(e), 3) AS exposure, round(avg(b * e), 3) AS contribution FROM day GROUP BY 1""",
)
def _(spark, sf):
    """One unpivoted pass for all factors."""
    return rounded(dx.factor_attribution(factors(spark, sf), "d", "sec", list(NAMES), "fwd").drop("icir"), 3)


@query("d57_correlation_groups", RANKED + f", {FACTORS}, c AS (SELECT abs(corr(size, volume)) AS sv, abs(corr(close, range)) AS cr, abs(corr(close, size)) AS cs, abs(corr(close, volume)) AS cv, abs(corr(range, size)) AS rs, abs(corr(range, volume)) AS rv FROM fac) SELECT factor, CASE factor WHEN 'close' THEN 'close' WHEN 'range' THEN CASE WHEN cr >= 0.75 THEN 'close' ELSE 'range' END WHEN 'size' THEN CASE WHEN cs >= 0.75 OR (sv >= 0.75 AND cv >= 0.75) THEN 'close' WHEN rs >= 0.75 OR (sv >= 0.75 AND rv >= 0.75) THEN 'range' ELSE 'size' END WHEN 'volume' THEN CASE WHEN cv >= 0.75 OR (sv >= 0.75 AND cs >= 0.75) THEN 'close' WHEN rv >= 0.75 OR (sv >= 0.75 AND rs >= 0.75) THEN 'range' WHEN sv >= 0.75 THEN 'size' ELSE 'volume' END END AS group_of FROM c, (VALUES ('close'), ('range'), ('size'), ('volume')) f(factor)")
def _(spark, sf):
    return dx.correlation_groups(factors(spark, sf), sorted(NAMES))


POOLS = f"""WITH {BARS}, q AS (SELECT sec, d, volume, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS x FROM bars), r AS (SELECT *, CASE WHEN x IS NOT NULL THEN greatest(least(x, 0.1), -0.1) END AS ret FROM q), p AS (SELECT 'all' AS run, sec, d, ret FROM r WHERE ret IS NOT NULL UNION ALL SELECT 'liquid', sec, d, ret FROM r WHERE ret IS NOT NULL AND volume > 20),
  c AS (SELECT *, count(*) OVER (PARTITION BY run, d) AS n FROM p), m AS (SELECT run, d, round(avg(ret), 8) AS v FROM p GROUP BY 1, 2), nv AS (SELECT run, d, round(exp(sum(ln(1 + v)) OVER (PARTITION BY run ORDER BY d)), 8) AS nav FROM m), pk AS (SELECT *, max(nav) OVER (PARTITION BY run ORDER BY d) AS peak FROM nv),
  w AS (SELECT run, d AS trough, peak FROM pk QUALIFY row_number() OVER (PARTITION BY run ORDER BY nav / peak - 1, d) = 1), win AS (SELECT w.run, w.trough, max(nv.d) AS peak_day FROM w JOIN nv ON nv.run = w.run AND nv.d <= w.trough AND nv.nav = w.peak GROUP BY 1, 2),
  con AS (SELECT c.run, c.sec, count(*) AS days, round(sum(ret / n), 6) AS contribution FROM c JOIN win ON c.run = win.run AND c.d > win.peak_day AND c.d <= win.trough GROUP BY 1, 2)"""


def contributions(spark, sf):
    """What each name added to two equally weighted pools inside each pool's deepest drawdown."""
    r = panel.gap_return(bars(spark, sf), "sec", "d", "close").where("ret is not null").withColumn("ret", F.greatest(F.least("ret", F.lit(0.1)), F.lit(-0.1)))
    pool = F.array_compact(F.array(F.lit("all"), F.when(F.col("volume") > 20, "liquid")))
    p = r.select("sec", "d", "ret", F.explode(pool).alias("run"))
    m = p.groupBy("run", "d").agg(F.round(F.avg("ret"), 8).alias("v"))
    nv = m.withColumn("nav", F.round(F.exp(F.sum(F.log(1 + F.col("v"))).over(Window.partitionBy("run").orderBy("d"))), 8))
    windows = dx.drawdown_window(nv, "run", "d", "nav")
    n = F.count("*").over(Window.partitionBy("run", "d"))
    return dx.drawdown_contribution(p.withColumn("part", F.col("ret") / n), windows, "run", "sec", "d", F.col("part")).withColumn("contribution", F.round("contribution", 6))


@query("d54_drawdown_contribution", POOLS + " SELECT * FROM con")
def _(spark, sf):
    return contributions(spark, sf)


@query("d54_contribution_by_group", POOLS + " SELECT run, n_name, count(*) AS names, round(sum(contribution), 4) AS contribution FROM con JOIN supplier ON sec = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2")
def _(spark, sf):
    of = table(spark, sf, "supplier").join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("sec"), "n_name")  # 25 nations
    return rounded(contributions(spark, sf).join(of, "sec").groupBy("run", "n_name").agg(F.count("*").alias("names"), F.sum("contribution").alias("contribution")))


@query("d76_common_crash_holdings", POOLS + " SELECT sec, count(*) AS runs, round(sum(contribution), 6) AS contribution FROM con WHERE contribution < 0 GROUP BY 1 HAVING count(*) >= 2")
def _(spark, sf):
    return rounded(dx.common_losers(contributions(spark, sf), "run", "sec", 2), 6)


@query("d56_selected_against_pool", CANDIDATES + " SELECT d, count(*) AS pool, count(*) FILTER (rk <= 10) AS selected, round(avg(m.close) FILTER (rk <= 10) - avg(m.close), 4) AS close_gap, max(m.close) FILTER (rk <= 10) AS highest, min(m.close) FILTER (rk <= 10) AS lowest FROM cand JOIN m USING (sec, d) GROUP BY d")
def _(spark, sf):
    """Profile of the picks beside that of the pool they were picked from, with extremes."""
    picked = F.when(F.col("rk") <= 10, F.col("close"))
    x = candidates(spark, sf).groupBy("d").agg(F.count("*").alias("pool"), F.count(picked).alias("selected"), (F.avg(picked) - F.avg("close")).alias("close_gap"), F.max(picked).alias("highest"), F.min(picked).alias("lowest"))
    return x.withColumn("close_gap", F.round("close_gap", 4))


OVER = NAV + ", x AS (SELECT sec, d, nav, nav / lag(nav) OVER w - 1 AS r, nav / max(nav) OVER (PARTITION BY sec ORDER BY d) - 1 AS dd FROM nav WINDOW w AS (PARTITION BY sec ORDER BY d))"


@query("d58_vol_target_overlay", OVER + ", e AS (SELECT sec, d, r, CASE WHEN count(r) OVER v < 20 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, coalesce(0.3 / NULLIF(stddev_samp(r) OVER v * sqrt(252), 0), 1.0::DOUBLE)) END AS exposure FROM x WINDOW v AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) SELECT sec, d, round(exposure, 4) AS exposure, round(exposure * coalesce(r, 0) - abs(exposure - lag(exposure, 1, 1.0) OVER (PARTITION BY sec ORDER BY d)) * 0.002, 5) AS net FROM e")
def _(spark, sf):
    x = dx.vol_target(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", "ret", 0.3)
    return dx.overlay_return(x, "sec", "d", "ret", "exposure", 20.0).select("sec", "d", F.round("exposure", 4).alias("exposure"), F.round("net", 5).alias("net"))


@query("d58_drawdown_derisk_overlay", OVER + ", e AS (SELECT sec, d, r, CASE WHEN lag(dd) OVER (PARTITION BY sec ORDER BY d) < -0.25 THEN 0.5 ELSE 1.0 END::DOUBLE AS exposure FROM x) SELECT sec, d, exposure, round(exposure * coalesce(r, 0) - abs(exposure - lag(exposure, 1, 1.0) OVER (PARTITION BY sec ORDER BY d)) * 0.004, 5) AS net FROM e")
def _(spark, sf):
    x = dx.drawdown_derisk(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", "nav", 0.25, 0.5)
    return dx.overlay_return(x, "sec", "d", "ret", "exposure", 40.0).select("sec", "d", "exposure", F.round("net", 5).alias("net"))


@query("wn24_rolling_drawdown", NAV + ", n AS (SELECT *, row_number() OVER (PARTITION BY sec ORDER BY d) AS i FROM nav), p AS (SELECT a.sec, a.d, a.i, b.nav, max(b.nav) OVER (PARTITION BY a.sec, a.i ORDER BY b.i) AS peak FROM n a JOIN n b ON a.sec = b.sec AND b.i BETWEEN a.i - 59 AND a.i) SELECT sec, d, CASE WHEN i >= 60 THEN round(min(nav / peak - 1), 5) END AS drawdown FROM p GROUP BY sec, d, i")
def _(spark, sf):
    """Nested: the drawdown inside each window, by windows of 60 rows."""
    x = dx.rolling_drawdown(navs(spark, sf), "sec", "d", "nav", 60, "drawdown")
    return x.select("sec", "d", F.round("drawdown", 5).alias("drawdown"))


@query(
    "flt8_reason_policy",
    """WITH r AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m, concat_ws(';', CASE WHEN o_totalprice < 150000 THEN 'small' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'low' END) AS reasons FROM orders),
    g AS (SELECT *, concat_ws(';', CASE WHEN reasons LIKE '%low%' THEN 'other' END, CASE WHEN reasons LIKE '%small%' THEN 'shape' END, CASE WHEN reasons LIKE '%pending%' THEN 'state' END) AS groups FROM r), h AS (SELECT 'full' AS policy, *, groups <> '' AS hit FROM g UNION ALL SELECT 'shape_only', *, groups LIKE '%shape%' FROM g UNION ALL SELECT 'none', *, false FROM g)
    SELECT policy, o_orderkey, groups, hit AND NOT (avg(hit::INTEGER) OVER (PARTITION BY policy, m) > 0.6) AS blocked FROM h""",
)
def _(spark, sf):
    why = F.array_compact(F.array(F.when(F.col("o_totalprice") < 150000, "small"), F.when(F.col("o_orderstatus") == "P", "pending"), F.when(F.col("o_orderpriority").startswith("5"), "low")))
    r = table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("m"), F.array_join(why, ";").alias("reasons"))
    each = [dx.reason_policy(r, "m", "reasons", {"small": "shape", "pending": "state"}, p, 0.6).select(F.lit(p).alias("policy"), "o_orderkey", "groups", "blocked") for p in ("full", "shape_only", "none")]
    return each[0].unionByName(each[1]).unionByName(each[2])


ICS = RANKED + ", ics AS (SELECT d, round(covar_samp(score, fwd) / NULLIF(stddev_samp(score) * stddev_samp(fwd), 0), 6) AS ic FROM sc GROUP BY d HAVING count(*) >= 5)"


def ics(spark, sf):
    x = scored(spark, sf).groupBy("d").agg(F.count("*").alias("n"), F.round(safe_corr("score", "fwd"), 6).alias("ic"))
    return x.where("n >= 5 and ic is not null").select("d", "ic")


@query("d27_orientation", ICS + " SELECT year(d) AS y, count(ic) AS days, round(avg(ic), 4) AS mean_ic, CASE WHEN avg(ic) >= 0.01 THEN 'forward' WHEN avg(ic) <= -0.01 THEN 'reversed' ELSE 'undecided' END AS orientation, CASE WHEN (avg(ic) >= 0.01 AND avg((ic > 0)::INTEGER) >= 2 / 3.0::DOUBLE) OR (avg(ic) <= -0.01 AND 1 - avg((ic > 0)::INTEGER) >= 2 / 3.0::DOUBLE) THEN 'stable' ELSE 'mixed' END AS kind FROM ics WHERE ic IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rounded(dx.orientation(ics(spark, sf), F.year("d").cast("long").alias("y"), "ic"))


@query("d46_primary_diagnosis", ICS + ", y AS (SELECT year(d) AS y, count(ic) AS n, round(avg(ic), 6) AS m, round(stddev_samp(ic), 6) AS s FROM ics WHERE ic IS NOT NULL GROUP BY 1) SELECT y, n, CASE WHEN n < 200 THEN 'too few days' WHEN m < -0.3 THEN 'inverted' WHEN m / NULLIF(s, 0) < -0.5 THEN 'against the signal' WHEN abs(m) < 0.02 THEN 'no signal' ELSE 'no finding' END AS diagnosis FROM y")
def _(spark, sf):
    """The first rule that holds names the year."""
    y = ics(spark, sf).groupBy(F.year("d").cast("long").alias("y")).agg(F.count("ic").alias("n"), F.round(F.avg("ic"), 6).alias("m"), F.round(F.stddev_samp("ic"), 6).alias("s"))
    rules = [("too few days", F.col("n") < 200), ("inverted", F.col("m") < -0.3), ("against the signal", safe_divide("m", "s") < -0.5), ("no signal", F.abs("m") < 0.02)]
    return y.select("y", "n", dx.first_match(rules, "no finding").alias("diagnosis"))


@query("d82_quality_parity", ICS + ", y AS (SELECT year(d) AS y, round(avg(ic), 6) AS ic, count(ic)::DOUBLE AS coverage FROM ics WHERE ic IS NOT NULL GROUP BY 1), p AS (SELECT b.y, b.ic AS new_ic, a.ic AS base_ic, b.coverage AS new_coverage, a.coverage AS base_coverage FROM y b LEFT JOIN y a ON a.y = b.y - 1) SELECT y, CASE WHEN base_ic IS NULL THEN 'skipped' WHEN new_ic >= base_ic - 0.02 AND new_coverage >= base_coverage - greatest(5, base_coverage * 0.05) THEN 'passed' ELSE 'failed' END AS state FROM p")
def _(spark, sf):
    """Each year against the year before; skipped where there is none."""
    y = ics(spark, sf).groupBy(F.year("d").cast("long").alias("y")).agg(F.round(F.avg("ic"), 6).alias("ic"), F.count("ic").cast("double").alias("coverage"))
    base = y.select((F.col("y") + 1).alias("y"), F.col("ic").alias("base_ic"), F.col("coverage").alias("base_coverage"))
    pairs = y.withColumnsRenamed({"ic": "new_ic", "coverage": "new_coverage"}).join(base, "y", "left")
    return dx.parity(pairs, {"ic": (0.02, 0.0), "coverage": (5.0, 0.05)}).select("y", "state")


@query("ud1_scalar_helpers", "SELECT user_id, CASE WHEN min(1 + value / 1000 - 0.04) > 0 THEN round(exp(sum(ln(1 + value / 1000 - 0.04))), 6) END AS gross, round(pow(exp(sum(ln(1 + value / 1000 - 0.04))), 252.0::DOUBLE / count(*)) - 1, 4) AS annual, CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN round(count(*) / count(*) FILTER (event_type = 'error')::DOUBLE, 6) ELSE 'inf'::DOUBLE END AS per_error, coalesce(max(value) > 90, false) AS high FROM events GROUP BY 1")
def _(spark, sf):
    x = table(spark, sf, "events").withColumn("r", F.col("value") / 1000 - 0.04)
    s = x.groupBy("user_id").agg(gross_from_returns("r").alias("g"), F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e"), F.max("value").alias("top"))
    return s.select("user_id", F.round("g", 6).alias("gross"), F.round(compound_annual("g", "n"), 4).alias("annual"), F.round(zero_safe_ratio(F.col("n").cast("double"), F.col("e").cast("double")), 6).alias("per_error"), required("top", F.col("top") > 90).alias("high"))


@query("ud4_model_weights")
def _(spark, sf):
    """Coefficients of the logistic model of d23, as a table; an iterative fit, beyond SQL."""
    x = model_rows(spark, sf)
    model = runs.fit_logistic(x.where(F.col("d") < F.lit("1999-01-01").cast("date")), FEATURES, "up")
    return spark.createDataFrame([*zip(FEATURES, model.coefficients.toArray().tolist(), strict=True), ("intercept", float(model.intercept))], "feature string, weight double")


DECIDED = NAV + ", s AS (SELECT sec, round(arg_max(nav, d) - 1, 5) AS total, round(min(nav / pk) - 1, 5) AS mdd FROM (SELECT *, max(nav) OVER (PARTITION BY sec ORDER BY d) AS pk FROM nav) GROUP BY sec), v AS (SELECT sec, total, mdd, CASE WHEN total > 0 AND mdd > -0.9 THEN 'accepted' ELSE 'rejected' END AS status FROM s)"


def decided(spark, sf):
    s = panel.running_drawdown(navs(spark, sf), "sec", "d", "nav").groupBy("sec").agg(F.round(F.max_by("nav", "d") - 1, 5).alias("total"), F.round(F.min("drawdown"), 5).alias("mdd"))
    return runs.decide(s, [("total", "total", F.col("total") > 0), ("drawdown", "mdd", F.col("mdd") > -0.9)])


@query("qa19_acceptance_consistency", DECIDED + " SELECT 'accepted has all gates' AS rule, count(*) FILTER (status = 'accepted' AND NOT (total > 0 AND mdd > -0.9)) AS bad, count(*) AS seen FROM v UNION ALL SELECT 'status is terminal', count(*) FILTER (status NOT IN ('accepted', 'rejected')), count(*) FROM v")
def _(spark, sf):
    x = decided(spark, sf)
    accepted = F.col("status") == "accepted"
    one = x.agg(F.count_if(accepted & ~((F.col("total") > 0) & (F.col("mdd") > -0.9))).alias("accepted has all gates"), F.count_if(~F.col("status").isin("accepted", "rejected")).alias("status is terminal"), F.count("*").alias("seen"))
    return one.unpivot(["seen"], ["`accepted has all gates`", "`status is terminal`"], "rule", "bad").select("rule", "bad", "seen")


@query("qa25_orientation_identity", RANKED + ", q AS (SELECT d, sec, row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) AS rk, row_number() OVER (PARTITION BY d ORDER BY -score, sec) AS again FROM sc) SELECT count(*) AS n, count(*) FILTER (rk <> again) AS differ FROM q")
def _(spark, sf):
    """Ranks by the score and by its reversed opposite are one."""
    x = panel.xs_rank(scored(spark, sf), "d", "score", "row", "sec", "rk").withColumn("other", F.row_number().over(Window.partitionBy("d").orderBy(F.asc(-F.col("score")), "sec")))
    return x.agg(F.count("*").alias("n"), F.count_if(F.col("rk") != F.col("other")).alias("differ"))


@query("d60_composite_by_size", RANKED + ", z AS (SELECT sc.sec, sc.d, fwd, ntile(3) OVER (PARTITION BY sc.d ORDER BY amount DESC, sc.sec) AS bucket, (score - avg(score) OVER w) / NULLIF(stddev_pop(score) OVER w, 0) - (volume - avg(volume) OVER w) / NULLIF(stddev_pop(volume) OVER w, 0) AS comp FROM sc JOIN bars ON bars.sec = sc.sec AND bars.d = sc.d WINDOW w AS (PARTITION BY sc.d)) SELECT bucket, count(comp) AS n, round(covar_samp(comp, fwd) / (stddev_samp(CASE WHEN comp IS NOT NULL THEN comp END) * stddev_samp(CASE WHEN comp IS NOT NULL THEN fwd END)), 4) AS ic FROM z GROUP BY 1")
def _(spark, sf):
    """A composite of two z-scores of the day, by thirds of size."""
    w = Window.partitionBy("d")
    z = lambda c: safe_divide(F.col(c) - F.avg(c).over(w), F.stddev_pop(c).over(w))
    x = scored(spark, sf, "amount", "volume").withColumn("comp", z("score") - z("volume"))
    x = panel.xs_bucket(x, "d", "amount", 3, "sec", "bucket")
    return x.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("comp").alias("n"), F.round(safe_corr("comp", "fwd"), 4).alias("ic"))


@query("d60_long_short_sharpe", RANKED + ", q AS (SELECT *, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS q FROM sc), day AS (SELECT d, avg(fwd) FILTER (q = 1) - avg(fwd) FILTER (q = 5) AS ls FROM q GROUP BY d), s AS (SELECT ls, row_number() OVER (ORDER BY d) AS i FROM day WHERE ls IS NOT NULL) SELECT count(*) AS periods, round(avg(ls), 4) AS mean, round(avg(ls) / stddev_samp(ls) * sqrt(252 / 5.0::DOUBLE), 3) AS sharpe FROM s WHERE i % 5 = 1")
def _(spark, sf):
    """Top less bottom fifth on every fifth day, so that holding periods don't overlap; a row a day in the window."""
    q = panel.xs_bucket(scored(spark, sf), "d", "score", 5, "sec", "q")
    side = lambda k: F.avg(F.when(F.col("q") == k, F.col("fwd")))
    day = q.groupBy("d").agg((side(1) - side(5)).alias("ls")).where("ls is not null")
    s = day.withColumn("i", F.row_number().over(Window.orderBy("d"))).where("i % 5 = 1")
    return s.agg(F.count("*").alias("periods"), F.round(F.avg("ls"), 4).alias("mean"), F.round(F.avg("ls") / F.stddev_samp("ls") * F.sqrt(F.lit(252 / 5.0)), 3).alias("sharpe"))


@query("d62_skip_reasons", f"WITH {BARS}, x AS (SELECT sec, d, close / 100 AS price, volume FROM bars), y AS (SELECT *, floor(100000 * 0.05 / price / 100) * 100 AS shares FROM x) SELECT CASE WHEN price > 100 THEN 'too dear' WHEN shares < 100 THEN 'below a lot' WHEN volume < 5 THEN 'no volume' ELSE 'bought' END AS reason, count(*) AS n, round(avg(price), 4) AS mean_price FROM y GROUP BY 1")
def _(spark, sf):
    price = F.col("close") / 100
    shares = F.floor(safe_divide(F.lit(5000.0), price) / 100) * 100
    why = dx.first_match([("too dear", price > 100), ("below a lot", shares < 100), ("no volume", F.col("volume") < 5)], "bought")
    return bars(spark, sf).groupBy(why.alias("reason")).agg(F.count("*").alias("n"), F.round(F.avg(price), 4).alias("mean_price"))


@query("d68_alert_union", "SELECT 'failed' AS alert, user_id, count(*) AS n FROM events WHERE event_type = 'error' AND value > 80 GROUP BY 2 UNION ALL SELECT 'silent', user_id, count(*) FROM events GROUP BY 2 HAVING max(ts) < TIMESTAMP '2024-01-28 00:00:00' UNION ALL SELECT 'missing downstream', user_id, 0 FROM events GROUP BY 2 HAVING count(*) FILTER (event_type = 'purchase') = 0 AND count(*) FILTER (event_type = 'view') > 0")
def _(spark, sf):
    """All alerts of a user from one aggregation."""
    is_ = lambda k: F.col("event_type") == k
    u = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(is_("error") & (F.col("value") > 80)).alias("failed"), F.max("ts").alias("last"), F.count_if(is_("purchase")).alias("bought"), F.count_if(is_("view")).alias("seen"))
    alert = lambda when, name, n: F.when(when, F.struct(F.lit(name).alias("alert"), n.cast("long").alias("n")))
    found = F.array(alert(F.col("failed") > 0, "failed", F.col("failed")), alert(F.col("last") < F.lit("2024-01-28").cast("timestamp_ntz"), "silent", F.col("n")), alert((F.col("bought") == 0) & (F.col("seen") > 0), "missing downstream", F.lit(0)))
    return u.select("user_id", F.inline(F.array_compact(found))).select("alert", "user_id", "n")


@query(
    "d9_canonical_dividends",
    "SELECT o_custkey AS c, date_trunc('quarter', o_orderdate)::DATE AS period, sum(o_totalprice::DECIMAL(18, 4))::DOUBLE AS cash, sum(CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE 0 END)::DOUBLE AS bonus, 0::DOUBLE AS conversion, count(*) AS events, max(o_orderdate::DATE) AS record, string_agg(DISTINCT o_orderdate::DATE::VARCHAR, ';' ORDER BY o_orderdate::DATE::VARCHAR) AS announced, arg_min(o_orderkey, struct_pack(a := o_orderdate, k := o_orderkey)) AS first_id FROM orders GROUP BY 1, 2",
)
def _(spark, sf):
    d = F.to_date("o_orderdate")
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("c"), F.trunc("o_orderdate", "quarter").alias("period"), F.col("o_totalprice").cast("string").alias("cash"), F.when(F.col("o_orderstatus") == "F", "0.5").alias("bonus"), F.lit(None).cast("string").alias("conversion"), d.alias("record"), d.alias("announced"), F.col("o_orderkey").alias("id"))
    x = wh.canonical_dividends(e, ["c", "period"])
    return x.withColumns({k: F.col(k).cast("double") for k in ("cash", "bonus", "conversion")})


@query(
    "d31_guarded_candidates",
    f"WITH {BARS}, {FIVE}, g AS (SELECT m.*, close / lag(close, 5) OVER (PARTITION BY m.sec ORDER BY m.d) - 1 AS ret_5 FROM m JOIN bars b USING (sec, d)), h AS (SELECT sec, d, b.close, concat_ws(';', CASE WHEN NOT pass_limit THEN 'limit' END, CASE WHEN NOT pass_board THEN 'board' END, CASE WHEN ret_5 > 0.5 THEN 'run-up' END) AS guards FROM g JOIN bars b USING (sec, d) WHERE pass_age AND pass_liquid) SELECT d, sec, guards, CASE WHEN guards = '' THEN row_number() OVER (PARTITION BY d, guards = '' ORDER BY close DESC, sec) END AS rk FROM h",
)
def _(spark, sf):
    """Candidates of the universe with what guards against them; only those without are ranked."""
    x = five_masks(spark, sf).withColumn("ret_5", safe_divide("close", F.lag("close", 5).over(Window.partitionBy("sec").orderBy("d"))) - 1)
    why = F.array_compact(F.array(F.when(~F.col("pass_limit"), "limit"), F.when(~F.col("pass_board"), "board"), F.when(F.col("ret_5") > 0.5, "run-up")))
    x = x.where("pass_age and pass_liquid").withColumn("guards", F.array_join(why, ";"))
    free = F.col("guards") == ""
    return x.select("d", "sec", "guards", F.when(free, F.row_number().over(Window.partitionBy("d", free).orderBy(F.desc("close"), "sec"))).cast("long").alias("rk"))


@query(
    "d55_exposure_with_fallback",
    f"WITH {BARS}, r AS (SELECT sec, d, amount, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS own FROM bars), m AS (SELECT *, round(avg(own) OVER (PARTITION BY d), 6) AS market FROM r), f AS (SELECT *, coalesce(own, market) AS ret, CASE WHEN own IS NOT NULL THEN 'own' WHEN market IS NOT NULL THEN 'market' ELSE 'none' END AS source FROM m) SELECT year(d) AS y, source, count(*) AS n, count(*) FILTER (ret <= -0.095) AS down, round(coalesce(sum(amount) FILTER (ret <= -0.095), 0) / sum(amount), 5) AS exposure FROM f GROUP BY 1, 2",
)
def _(spark, sf):
    """Falls by where the return was taken from: the name's own, the day's mean, or nowhere."""
    x = panel.gap_return(bars(spark, sf), "sec", "d", "close").withColumn("market", F.round(F.avg("ret").over(Window.partitionBy("d")), 6))
    source = F.when(F.col("ret").isNotNull(), "own").when(F.col("market").isNotNull(), "market").otherwise("none")
    down = F.coalesce("ret", "market") <= -0.095
    x = x.groupBy(F.year("d").cast("long").alias("y"), source.alias("source")).agg(F.count("*").alias("n"), F.count_if(down).alias("down"), safe_divide(F.sum(F.when(down, F.col("amount")).otherwise(0.0)), F.sum("amount")).alias("exposure"))
    return rounded(x, 5)


@query(
    "d59_weighted_leak",
    f"WITH {BARS}, f AS (SELECT sec, d, amount / sum(amount) OVER (PARTITION BY d) AS w, close, close * CASE WHEN d >= DATE '1998-01-01' THEN 1.1 ELSE 1 END::DOUBLE AS adj FROM bars), r AS (SELECT sec, d, lag(w) OVER o AS w, close / lag(close) OVER o - 1 AS raw, adj / lag(adj) OVER o - 1 AS adj FROM f WINDOW o AS (PARTITION BY sec ORDER BY d)) SELECT year(d) AS y, round(sum(w * raw), 4) AS raw, round(sum(w * adj), 4) AS adjusted, round(sum(w * (adj - raw)), 5) AS leak FROM r GROUP BY 1",
)
def _(spark, sf):
    """What an adjustment adds to returns weighted by the share of the day before."""
    w = Window.partitionBy("sec").orderBy("d")
    x = bars(spark, sf).withColumns({"adj": F.col("close") * F.when(F.col("d") >= F.lit("1998-01-01").cast("date"), 1.1).otherwise(1.0), "w": F.col("amount") / F.sum("amount").over(Window.partitionBy("d"))})
    back = lambda c: safe_divide(c, F.lag(c).over(w)) - 1
    x = x.select(F.year("d").cast("long").alias("y"), F.lag("w").over(w).alias("w"), back("close").alias("raw"), back("adj").alias("adjusted"))
    s = x.groupBy("y").agg(F.sum(F.col("w") * F.col("raw")).alias("raw"), F.sum(F.col("w") * F.col("adjusted")).alias("adjusted"), F.sum(F.col("w") * (F.col("adjusted") - F.col("raw"))).alias("leak"))
    return s.select("y", F.round("raw", 4).alias("raw"), F.round("adjusted", 4).alias("adjusted"), F.round("leak", 5).alias("leak"))
