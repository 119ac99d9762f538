"""Row-level labels, the risk panel, turnover and costs, biweekly overlays, pool profiles, fuller diagnosis and parity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import log_positive, rounded, safe_divide
from ..operators import calendar as cal_
from ..operators import diagnosis as dx
from ..operators import joins, panel, runs
from ..operators import warehouse as wh
from ..sources.tables import table
from .diagnosis import CANDIDATES, ICS, candidates, ics
from .market import BARS, CAL, NAV, bars, calendar, forward, navs, query, tasks
from .warehouse import FIVE, HORIZONS, five_masks

# ---------------------------------------------------------------- labels and panels


@query(
    "d13_label_rows",
    f"WITH {BARS}, {CAL}, {FIVE}, u AS (SELECT sec, d FROM m WHERE pass_age AND pass_liquid), l AS (" + " UNION ALL ".join(f"SELECT {h}::BIGINT AS h, b.sec, b.d, f.close / e.close - 1 AS fwd FROM bars b JOIN cal c ON b.d = c.d JOIN cal c1 ON c1.seq = c.seq + 1 JOIN bars e ON e.sec = b.sec AND e.d = c1.d JOIN cal ch ON ch.seq = c.seq + {h} JOIN bars f ON f.sec = b.sec AND f.d = ch.d" for h in HORIZONS) + """),
    y AS (SELECT l.*, u.sec IS NOT NULL AS in_u FROM l LEFT JOIN u ON l.sec = u.sec AND l.d = u.d)
    SELECT h, sec, d, in_u, round(fwd, 6) AS fwd, round(fwd - avg(CASE WHEN in_u THEN fwd END) OVER (PARTITION BY h, d), 6) AS excess, CASE WHEN in_u THEN round(percent_rank() OVER (PARTITION BY h, d, in_u ORDER BY fwd), 6) END AS pct FROM y""",
)
def _(spark, sf):
    """A row for each horizon, name and day: return from the next open day, excess over the universe, place within it."""
    b = five_masks(spark, sf).join(joins.small(calendar(spark, sf).select("d", "seq")), "d").withColumn("in_u", F.col("pass_age") & F.col("pass_liquid"))
    on = lambda k: F.max("close").over(Window.partitionBy("sec").orderBy("seq").rangeBetween(k, k))
    x = b.withColumn("entry", on(1)).withColumns({f"e{h}": on(h) for h in HORIZONS})
    x = x.select("sec", "d", "in_u", F.inline(F.array(*(F.struct(F.lit(h).cast("long").alias("h"), (safe_divide(f"e{h}", "entry") - 1).alias("fwd")) for h in HORIZONS)))).where("fwd is not null")
    x = x.withColumn("excess", F.col("fwd") - F.avg(F.when(F.col("in_u"), F.col("fwd"))).over(Window.partitionBy("h", "d")))
    return rounded(x.withColumn("pct", F.when(F.col("in_u"), F.percent_rank().over(Window.partitionBy("h", "d", "in_u").orderBy("fwd")))).select("h", "sec", "d", "in_u", "fwd", "excess", "pct"), 6)


CARRIED = {"ret_5": 5, "ret_20": 20, "vol_20": 20, "range_20": 20, "liq_20": 20, "dd_60": 60}
INTERACTIONS = {"ret_5_x_vol": ("ret_5", "vol_20"), "ret_20_x_dd": ("ret_20", "dd_60"), "range_x_liq": ("range_20", "liq_20"), "vol_x_dd": ("vol_20", "dd_60")}


def risk_features(spark, sf):
    """Features of a day, each known only where its own rows are enough, from one sort of the bars."""
    b = panel.gap_return(bars(spark, sf), "sec", "d", "close")
    w = Window.partitionBy("sec").orderBy("d")
    last = lambda n: w.rowsBetween(1 - n, 0)
    enough = lambda n, c, x: F.when(F.count(c).over(last(n)) == n, x)
    b = b.withColumns({
        "ret_5": F.when(F.col("amount") > 20000, safe_divide("close", F.lag("close", 5).over(w)) - 1),
        "ret_20": F.when(F.col("amount") > 10000, safe_divide("close", F.lag("close", 20).over(w)) - 1),
        "vol_20": enough(20, "ret", F.stddev_samp("ret").over(last(20))),
        "range_20": enough(20, "close", F.avg(F.col("high") / F.col("low") - 1).over(last(20))),
        "liq_20": enough(20, "amount", log_positive(F.avg("amount").over(last(20)))),
        "dd_60": enough(60, "close", safe_divide("close", F.max("close").over(last(60))) - 1),
    })
    return b.select("sec", "d", "amount", "close", *CARRIED)


RISK = f"""WITH {BARS}, {CAL}, g AS (SELECT *, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars),
  f AS (SELECT sec, d, amount, CASE WHEN amount > 20000 THEN close / lag(close, 5) OVER w - 1 END AS ret_5, CASE WHEN amount > 10000 THEN close / lag(close, 20) OVER w - 1 END AS ret_20, CASE WHEN count(ret) OVER t = 20 THEN stddev_samp(ret) OVER t END AS vol_20,
    CASE WHEN count(*) OVER t = 20 THEN avg(high / low - 1) OVER t END AS range_20, CASE WHEN count(*) OVER t = 20 THEN ln(avg(amount) OVER t) END AS liq_20, CASE WHEN count(*) OVER s = 60 THEN close / max(close) OVER s - 1 END AS dd_60, row_number() OVER w AS i
    FROM g WINDOW w AS (PARTITION BY sec ORDER BY d), t AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), s AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
  k AS (SELECT *, {', '.join(f"max(CASE WHEN {c} IS NOT NULL THEN i END) OVER (PARTITION BY sec ORDER BY d) AS at_{c}" for c in CARRIED)} FROM f),
  h AS (SELECT k.sec, k.d, k.amount, {', '.join(f"o_{c}.{c}" for c in CARRIED)} FROM k {' '.join(f"LEFT JOIN f o_{c} ON o_{c}.sec = k.sec AND o_{c}.i = k.at_{c} AND k.i - k.at_{c} <= 5" for c in CARRIED)}),
  l AS (SELECT b.sec, b.d, g.close / e.close - 1 AS fwd FROM bars b JOIN cal c ON b.d = c.d JOIN cal c1 ON c1.seq = c.seq + 1 JOIN bars e ON e.sec = b.sec AND e.d = c1.d JOIN cal c5 ON c5.seq = c.seq + 5 JOIN bars g ON g.sec = b.sec AND g.d = c5.d)"""


@query("d18_risk_panel", RISK + f" SELECT h.sec, h.d, {', '.join(f'round({c}, 5) AS {c}' for c in CARRIED)}, {', '.join(f'round({a} * {b}, 5) AS {n}' for n, (a, b) in INTERACTIONS.items())}, fwd <= -0.1 AS fell, round(1 + 2 * (amount - min(amount) OVER w) / NULLIF(max(amount) OVER w - min(amount) OVER w, 0), 4) AS weight FROM h JOIN l ON h.sec = l.sec AND h.d = l.d WINDOW w AS (PARTITION BY h.d)")
def _(spark, sf):
    """The panel of the risk model: six features carried forward up to five rows, their products, and whether the name then fell."""
    x = forward(spark, sf, risk_features(spark, sf))
    x = wh.training_panel(x, "sec", "d", "fwd", list(CARRIED), INTERACTIONS, "amount")
    r = lambda c, n: F.round(c, n).alias(c)
    return x.select("sec", "d", *(r(c, 5) for c in (*CARRIED, *INTERACTIONS)), (F.col("fwd") <= -0.1).alias("fell"), r("weight", 4))


# ---------------------------------------------------------------- feature sets and vectors


@query(
    "d19_feature_versions",
    "WITH s AS (SELECT DISTINCT year(l_shipdate)::BIGINT AS v, p_brand AS feature FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 48), n AS (SELECT v + 1 AS v, feature FROM s WHERE v < (SELECT max(v) FROM s)), b AS (SELECT min(v) AS v FROM s) SELECT coalesce(s.v, n.v) AS version, coalesce(s.feature, n.feature) AS feature, CASE WHEN n.v IS NULL THEN 'added' WHEN s.v IS NULL THEN 'dropped' ELSE 'both' END AS change FROM s FULL JOIN n ON s.v = n.v AND s.feature = n.feature WHERE coalesce(s.v, n.v) > (SELECT v FROM b)",
)
def _(spark, sf):
    """Sets of brands by year as versions of a registry, each as a change to the one before."""
    s = table(spark, sf, "lineitem").where("l_quantity > 48").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.year("l_shipdate").cast("long").alias("version"), F.col("p_brand").alias("feature")).distinct()
    ends = s.agg(F.min("version"), F.max("version")).first()
    before = s.where(F.col("version") < ends[1]).withColumn("version", F.col("version") + 1)
    x = runs.reconcile(before, s.where(F.col("version") > ends[0]), ["version", "feature"], "dropped", "added")
    return x.select("version", "feature", F.when(F.col("status") == "matched", "both").otherwise(F.col("status")).alias("change"))


@query("d22_nested_vectors", "SELECT l_orderkey, l_linenumber, l_quantity AS v_0, l_discount AS v_1, CASE WHEN l_tax > 0.04 THEN l_tax END AS v_2, l_shipmode AS m_flag, len([l_quantity, l_discount, l_tax]) AS n FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem)")
def _(spark, sf):
    """Vectors and nested objects of a JSON column as columns, by position and by name; what is missing is null."""
    tax = F.when(F.col("l_tax") > 0.04, F.col("l_tax"))
    made = F.to_json(F.struct(F.array("l_quantity", "l_discount", tax).alias("v"), F.struct(F.col("l_returnflag").alias("flag")).alias("m")))
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", made.alias("payload"))
    x = x.withColumn("p", F.from_json("payload", "v array<double>, m struct<flag: string, gone: int>"))
    return x.select("l_orderkey", "l_linenumber", *(F.get("p.v", F.lit(i)).alias(f"v_{i}") for i in range(3)), F.col("p.m.flag").alias("m_flag"), F.size("p.v").cast("long").alias("n"))


@query("pr9_json_patch_typed", """SELECT event_id, json_merge_patch(CASE WHEN event_id % 5 = 0 THEN '{}' ELSE props END, '{"state":{"ok":true},"version":2}')::VARCHAR AS p FROM events""")
def _(spark, sf):
    """Numbers stay numbers; null and malformed values are patched too."""
    props = F.when(F.col("event_id") % 10 == 0, F.lit(None)).when(F.col("event_id") % 5 == 0, "{broken").otherwise(F.col("props"))
    x = table(spark, sf, "events").withColumn("props", props)
    return x.select("event_id", wh.json_patch("props", {"version": 2, "state": {"ok": True}}, ("gone",)).alias("p"))


# ---------------------------------------------------------------- performance


BOOKS = f"WITH {BARS}, w AS (SELECT s_nationkey AS nation, sec, d, amount, round(amount / sum(amount) OVER (PARTITION BY s_nationkey, d), 8) AS w FROM bars JOIN supplier ON s_suppkey = sec)"


def books(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_nationkey").alias("nation"))
    x = bars(spark, sf).select("sec", "d", "amount").join(s, "sec").repartition(tasks(spark, sf), "nation", "d")
    return x.withColumn("w", F.round(F.col("amount") / F.sum("amount").over(Window.partitionBy("nation", "d")), 8)).select("nation", "sec", "d", "amount", "w")


@query(
    "d41_turnover_and_costs",
    BOOKS + """, n AS (SELECT nation, d, lead(d) OVER (PARTITION BY nation ORDER BY d) AS nd FROM (SELECT DISTINCT nation, d FROM w)), e AS (SELECT nation, sec, d AS t, w AS x FROM w UNION ALL SELECT w.nation, sec, nd, -w FROM w JOIN n ON w.nation = n.nation AND w.d = n.d WHERE nd IS NOT NULL),
    m AS (SELECT nation, t AS d, sum(abs(x)) / 2 AS turnover, sum(greatest(-x, 0)) AS sold FROM (SELECT nation, sec, t, sum(x) AS x FROM e GROUP BY ALL) GROUP BY 1, 2)
    SELECT nation, count(*) AS days, round(avg(turnover), 5) AS turnover, round(avg(turnover) * 252, 3) AS annual_turnover, round(sum(turnover * 2) * 0.0001, 5) AS commission, round(sum(sold) * 0.0005, 5) AS tax, round(sum(turnover * 2) * 0.0005, 5) AS slippage FROM m GROUP BY nation""",
)
def _(spark, sf):
    """Turnover of books by day, and what it costs in commission, tax on sales, and slippage, apart."""
    b = books(spark, sf)
    each = panel.turnover(b, "nation", "sec", "d", "w", tasks(spark, sf))
    total = b.groupBy("nation", "d").agg(F.sum("w").alias("held"))
    # sold = turnover less half of what the book has grown by
    grown = total.withColumn("grown", F.col("held") - F.lag("held", 1, 0.0).over(Window.partitionBy("nation").orderBy("d")))
    x = each.join(grown, ["nation", "d"]).withColumn("sold", F.col("turnover") - F.col("grown") / 2)
    costs = [F.round(F.sum(F.col("turnover") * 2) * 0.0001, 5).alias("commission"), F.round(F.sum("sold") * 0.0005, 5).alias("tax"), F.round(F.sum(F.col("turnover") * 2) * 0.0005, 5).alias("slippage")]
    return x.groupBy("nation").agg(F.count("*").alias("days"), F.round(F.avg("turnover"), 5).alias("turnover"), F.round(F.avg("turnover") * 252, 3).alias("annual_turnover"), *costs)


@query(
    "d58_biweekly_overlay",
    NAV + f""", {CAL}, x AS (SELECT sec, d, nav / lag(nav) OVER w - 1 AS r, nav / max(nav) OVER w - 1 AS dd FROM nav WINDOW w AS (PARTITION BY sec ORDER BY d)),
    k AS (SELECT d, row_number() OVER (ORDER BY d) % 2 = 1 AS turn FROM (SELECT max(d) AS d FROM cal GROUP BY isoyear(d), week(d))), s AS (SELECT x.*, CASE WHEN k.turn THEN CASE WHEN dd < -0.25 THEN 0.5 ELSE 1.0 END END AS set_to FROM x LEFT JOIN k ON x.d = k.d),
    e AS (SELECT sec, d, r, coalesce(last_value(set_to IGNORE NULLS) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0)::DOUBLE AS exposure FROM s) SELECT sec, d, exposure, round(exposure * coalesce(r, 0) - abs(exposure - lag(exposure, 1, 1.0) OVER (PARTITION BY sec ORDER BY d)) * 0.004, 5) AS net FROM e""",
)
def _(spark, sf):
    """Exposure that is set on the last open day of every other week, and held from the next day on."""
    turns = cal_.rebalance_dates(calendar(spark, sf), "biweekly").withColumn("turn", F.lit(True))
    x = panel.running_drawdown(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", "nav").join(joins.small(turns), "d", "left")
    set_to = F.when(F.col("turn"), F.when(F.col("drawdown") < -0.25, 0.5).otherwise(1.0))
    held = F.last(set_to, True).over(Window.partitionBy("sec").orderBy("d").rowsBetween(Window.unboundedPreceding, -1))
    return dx.overlay_return(x.withColumn("exposure", F.coalesce(held, F.lit(1.0))), "sec", "d", "ret", "exposure", 40.0).select("sec", "d", "exposure", F.round("net", 5).alias("net"))


# ---------------------------------------------------------------- diagnosis


@query(
    "d56_profile_and_funnel",
    CANDIDATES + """ SELECT d, count(*) AS pool, count(*) FILTER (rk <= 10) AS selected, count(*) FILTER (rk <= 10 AND m.close >= 900) AS affordable, count(*) FILTER (rk <= 10 AND m.close >= 900 AND m.close <= 1300) AS ordered, round(quantile_cont(m.close, 0.1), 4) AS pool_p10, round(quantile_cont(m.close, 0.5), 4) AS pool_p50, round(quantile_cont(m.close, 0.9), 4) AS pool_p90,
    round(quantile_cont(m.close, 0.5) FILTER (rk <= 10), 4) AS selected_p50, min(m.close) FILTER (rk <= 10) AS lowest, max(m.close) FILTER (rk <= 10) AS highest, count(*) FILTER (rk <= 10 AND m.close > (SELECT avg(x.close) + 2 * stddev_samp(x.close) FROM m x)) AS extreme FROM cand JOIN m USING (sec, d) GROUP BY d""",
)
def _(spark, sf):
    """Percentiles of pool and picks, extremes, and how many are left after each filter; a day's pool is a cross-section."""
    c = candidates(spark, sf)
    picked = lambda p=None: F.when((F.col("rk") <= 10) & (p if p is not None else F.lit(True)), F.col("close"))
    high = five_masks(spark, sf).agg((F.avg("close") + 2 * F.stddev_samp("close")).alias("_high"))  # one row
    q = lambda x, p: F.round(F.percentile(x, p), 4)
    fine, cheap = F.col("close") >= 900, F.col("close") <= 1300
    x = c.crossJoin(F.broadcast(high)).groupBy("d")
    return x.agg(F.count("*").alias("pool"), F.count(picked()).alias("selected"), F.count(picked(fine)).alias("affordable"), F.count(picked(fine & cheap)).alias("ordered"), q("close", 0.1).alias("pool_p10"), q("close", 0.5).alias("pool_p50"), q("close", 0.9).alias("pool_p90"), q(picked(), 0.5).alias("selected_p50"), F.min(picked()).alias("lowest"), F.max(picked()).alias("highest"), F.count(picked(F.col("close") > F.col("_high"))).alias("extreme"))


YEARS = ICS + ", y AS (SELECT year(d) AS y, round(avg(ic), 6) AS ic, count(ic)::DOUBLE AS coverage FROM ics WHERE ic IS NOT NULL GROUP BY 1), b AS (SELECT year(d) AS y, d, sum(w * w) AS h, max(w) AS top FROM (SELECT d, round(amount / sum(amount) OVER (PARTITION BY d), 8) AS w FROM bars) GROUP BY 1, 2), c AS (SELECT y, round(avg(h), 6) AS h, round(max(top), 6) AS top FROM b GROUP BY y)"


def years(spark, sf):
    """Mean IC and days by year, beside how concentrated that year's days were."""
    y = ics(spark, sf).where("ic is not null").groupBy(F.year("d").cast("long").alias("y")).agg(F.round(F.avg("ic"), 6).alias("ic"), F.count("ic").cast("double").alias("coverage"))
    b = bars(spark, sf).withColumn("w", F.round(F.col("amount") / F.sum("amount").over(Window.partitionBy("d")), 8)).groupBy("d").agg(F.sum(F.col("w") * F.col("w")).alias("h"), F.max("w").alias("top"))
    return y.join(b.groupBy(F.year("d").cast("long").alias("y")).agg(F.round(F.avg("h"), 6).alias("h"), F.round(F.max("top"), 6).alias("top")), "y")


@query("d46_diagnosis_with_style", YEARS + " SELECT y.y, CASE WHEN coverage < 200 THEN 'too few days' WHEN top > 0.9 THEN 'one name' WHEN h > 0.3 THEN 'concentrated' WHEN ic < -0.3 THEN 'inverted' WHEN abs(ic) < 0.02 THEN 'no signal' ELSE 'no finding' END AS diagnosis FROM y JOIN c ON y.y = c.y")
def _(spark, sf):
    """Coverage before concentration before the signal: the first rule that holds names the year."""
    rules = [("too few days", F.col("coverage") < 200), ("one name", F.col("top") > 0.9), ("concentrated", F.col("h") > 0.3), ("inverted", F.col("ic") < -0.3), ("no signal", F.abs("ic") < 0.02)]
    return years(spark, sf).select("y", dx.first_match(rules, "no finding").alias("diagnosis"))


@query("d82_parity_by_metric", YEARS + ", p AS (SELECT b.y, b.ic AS ic, a.ic AS ic_0, b.coverage AS cov, a.coverage AS cov_0, -c.h AS h, -k.h AS h_0 FROM y b JOIN c ON c.y = b.y LEFT JOIN y a ON a.y = b.y - 1 LEFT JOIN c k ON k.y = a.y), o AS (SELECT y, ic >= ic_0 - 0.02 AS ic_ok, cov >= cov_0 - greatest(5, cov_0 * 0.05) AS coverage_ok, h >= h_0 - greatest(0.002, abs(h_0) * 0.2) AS spread_ok FROM p) SELECT *, CASE WHEN ic_ok IS NULL OR coverage_ok IS NULL OR spread_ok IS NULL THEN 'skipped' WHEN ic_ok AND coverage_ok AND spread_ok THEN 'passed' ELSE 'failed' END AS state FROM o")
def _(spark, sf):
    """Three metrics against the year before, each with its own tolerance, and what they say together."""
    y = years(spark, sf).select("y", "ic", "coverage", (-F.col("h")).alias("spread"))
    names = ("ic", "coverage", "spread")
    base = y.select((F.col("y") + 1).alias("y"), *(F.col(c).alias(f"base_{c}") for c in names))
    pairs = reduce(lambda d, c: d.withColumnRenamed(c, f"new_{c}"), names, y).join(base, "y", "left")
    return dx.parity(pairs, {"ic": (0.02, 0.0), "coverage": (5.0, 0.05), "spread": (0.002, 0.2)}).select("y", *(f"{c}_ok" for c in names), "state")
