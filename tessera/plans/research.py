"""Further queries over the driver tables: masks, splits, ranks, fits, series tests, books, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import rounded, safe_divide
from ..operators import joins, panel, quality, quantiles, research
from ..sources.tables import table
from .market import BARS, CAL, LABELS, NAV, RANKED, bars, calendar, labels, navs, query, scored


@query("prj4_code_classes", "SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN 'first' WHEN ends_with(p_type, 'STEEL') THEN 'steel' ELSE 'other' END AS kind, p_size * 100 AS size_units, coalesce(p_size > 25, false) AS is_large FROM part")
def _(spark, sf):
    kind = F.when(F.col("p_brand").startswith("Brand#1"), "first").when(F.col("p_type").endswith("STEEL"), "steel").otherwise("other")
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind"), (F.col("p_size") * 100).alias("size_units"), F.coalesce(F.col("p_size") > 25, F.lit(False)).alias("is_large"))


@query("prj6_three_valued_flags", f"WITH {BARS}, x AS (SELECT sec, d, volume, close, lag(close) OVER (PARTITION BY sec ORDER BY d) AS prev FROM bars) SELECT sec, d, CASE WHEN prev IS NULL THEN NULL ELSE close >= prev * 1.1 END AS limit_up, CASE WHEN volume < 5 THEN false WHEN prev IS NULL THEN NULL ELSE close < prev * 1.1 END AS can_buy FROM x")
def _(spark, sf):
    x = bars(spark, sf).withColumn("prev", F.lag("close").over(Window.partitionBy("sec").orderBy("d")))
    up = F.when(F.col("prev").isNotNull(), F.col("close") >= F.col("prev") * 1.1)
    return x.select("sec", "d", up.alias("limit_up"), F.when(F.col("volume") < 5, False).otherwise(~up).alias("can_buy"))


@query("prj10_split_tags", "SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'train' WHEN o_orderdate < DATE '2000-01-01' THEN 'valid' WHEN o_orderdate < DATE '2001-01-01' THEN 'test' ELSE 'live' END AS split FROM orders")
def _(spark, sf):
    before = lambda day: F.to_date("o_orderdate") < F.lit(day).cast("date")
    split = F.when(before("1999-01-01"), "train").when(before("2000-01-01"), "valid").when(before("2001-01-01"), "test").otherwise("live")
    return table(spark, sf, "orders").select("o_orderkey", split.alias("split"))


@query("flt2_split_aware_filter", "SELECT o_orderkey FROM orders WHERE (o_orderdate < DATE '1999-01-01' AND o_orderstatus = 'F') OR (o_orderdate >= DATE '1999-01-01' AND o_totalprice > 100000)")
def _(spark, sf):
    train = F.to_date("o_orderdate") < F.lit("1999-01-01").cast("date")
    return table(spark, sf, "orders").where((train & (F.col("o_orderstatus") == "F")) | (~train & (F.col("o_totalprice") > 100000))).select("o_orderkey")


@query("flt4_latest_day_only", "SELECT o_orderkey FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate::DATE) FROM orders)")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    return o.join(F.broadcast(o.agg(F.max("d").alias("d"))), "d", "left_semi").select("o_orderkey")  # one row


@query("flt6_rank_slices", f"WITH {BARS}, r AS (SELECT sec, d, row_number() OVER (PARTITION BY d ORDER BY amount DESC, sec) AS rk, count(*) OVER (PARTITION BY d) AS n FROM bars) SELECT d, sec, CASE WHEN rk <= 0.3 * n THEN 'top' ELSE 'bottom' END AS slice FROM r WHERE rk <= 0.3 * n OR rk > 0.7 * n")
def _(spark, sf):
    x = panel.xs_rank(bars(spark, sf), "d", "amount", "row", "sec", "rk").withColumn("n", F.count("*").over(Window.partitionBy("d")))
    top = F.expr("rk <= 0.3 * n")
    return x.where(top | F.expr("rk > 0.7 * n")).select("d", "sec", F.when(top, "top").otherwise("bottom").alias("slice"))


@query("jn2_star_from_skeleton", "SELECT o_orderkey, c_mktsegment, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    x = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return x.join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_mktsegment", "n_name", "r_name")  # 25 nations


@query("jn4_first_listed_day", f"WITH {BARS}, {CAL}, life AS (SELECT sec, min(d) AS a FROM bars GROUP BY 1) SELECT sec, min(cal.d) AS first_day, min(seq) AS first_seq FROM life JOIN cal ON cal.d >= life.a GROUP BY 1")
def _(spark, sf):
    life = bars(spark, sf).groupBy("sec").agg(F.min("d").alias("d"))
    return life.join(joins.small(calendar(spark, sf).select("d", "seq")), "d").select("sec", F.col("d").alias("first_day"), F.col("seq").alias("first_seq"))


@query("jn15_unpivot", "SELECT s_suppkey, 'balance' AS feature, s_acctbal AS value FROM supplier UNION ALL SELECT s_suppkey, 'nation', s_nationkey::DOUBLE FROM supplier")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return s.unpivot("s_suppkey", ["balance", "nation"], "feature", "value")


@query("jn16_positional_zip", "SELECT s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS pos, s_suppkey, s_name FROM supplier")
def _(spark, sf):
    """Two lists by nation, each numbered by its order, meet at equal places; no list is gathered."""
    place = lambda c: table(spark, sf, "supplier").select("s_nationkey", (F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1).cast("long").alias("pos"), c)
    return place("s_suppkey").join(place("s_name"), ["s_nationkey", "pos"])


@query("jn19_previous_observation", "SELECT o_orderkey, lag(o_totalprice) OVER w AS before, (lag(o_orderdate) OVER w)::DATE AS before_day FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def _(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.to_date(F.lag("o_orderdate").over(w)).alias("before_day"))


@query("jn22_manifest_stitch", f"WITH {BARS} SELECT CASE WHEN d < DATE '1997-01-01' THEN 'run_a' ELSE 'run_b' END AS run, sec, count(*) AS n, max(d) AS last_day FROM bars WHERE d >= DATE '1996-01-01' AND d < DATE '2000-01-01' GROUP BY 1, 2")
def _(spark, sf):
    x = research.stitch(bars(spark, sf), [("run_a", "1996-01-01", "1997-01-01"), ("run_b", "1997-01-01", "2000-01-01")])
    return x.groupBy("run", "sec").agg(F.count("*").alias("n"), F.max("d").alias("last_day"))


@query("ag18_product", "SELECT l_orderkey, round(exp(sum(ln(1 + l_discount))), 6) AS factor FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.exp(F.sum(F.log(1 + F.col("l_discount")))), 6).alias("factor"))


@query("ag20_missing_rates", "SELECT event_type, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), 6) AS no_value, round(avg(CASE WHEN props IS NULL THEN 1.0 ELSE 0.0 END), 6) AS no_props FROM events GROUP BY 1")
def _(spark, sf):
    rate = lambda c: F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0))
    return rounded(table(spark, sf, "events").groupBy("event_type").agg(rate("value").alias("no_value"), rate("props").alias("no_props")), 6)


@query("ag21_group_fingerprints", "SELECT o_custkey, sha256(string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey)) AS fingerprint FROM orders GROUP BY 1")
def _(spark, sf):
    """Lists hold one customer's orders."""
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("s"))))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(rows.alias("r")).select("o_custkey", F.sha2(F.array_join("r.s", ","), 256).alias("fingerprint"))


@query("ag15_two_level", f"WITH {BARS}, m AS (SELECT sec, date_trunc('month', d)::DATE AS m, round(sum(amount), 2) AS amount FROM bars GROUP BY 1, 2) SELECT sec, count(*) AS months, min(amount) AS low, max(amount) AS high FROM m GROUP BY 1")
def _(spark, sf):
    m = bars(spark, sf).groupBy("sec", F.trunc("d", "month").alias("m")).agg(F.round(F.sum("amount"), 2).alias("amount"))
    return m.groupBy("sec").agg(F.count("*").alias("months"), F.min("amount").alias("low"), F.max("amount").alias("high"))


@query("wn5_universe_percentile", f"WITH {BARS}, u AS (SELECT sec, d, round(percent_rank() OVER (PARTITION BY d ORDER BY close), 6) AS pct FROM bars WHERE volume > 20) SELECT b.sec, b.d, u.pct FROM bars b LEFT JOIN u ON b.sec = u.sec AND b.d = u.d")
def _(spark, sf):
    """One window over (day, in universe) gives the ranks that a join of the subset would."""
    inside = F.col("volume") > 20
    w = Window.partitionBy("d", inside).orderBy("close")
    return bars(spark, sf).select("sec", "d", F.when(inside, F.round(F.percent_rank().over(w), 6)).alias("pct"))


@query("wn20_min_n_gate", f"WITH {BARS} SELECT sec, d FROM bars QUALIFY count(*) OVER (PARTITION BY d) >= 5")
def _(spark, sf):
    return bars(spark, sf).withColumn("n", F.count("*").over(Window.partitionBy("d"))).where("n >= 5").select("sec", "d")


@query("wn21_last_n_bound", f"WITH {BARS} SELECT sec, min(d) AS read_from FROM (SELECT sec, d FROM bars QUALIFY row_number() OVER (PARTITION BY sec ORDER BY d DESC) <= 60) GROUP BY 1")
def _(spark, sf):
    w = Window.partitionBy("sec").orderBy(F.desc("d"))
    return bars(spark, sf).select("sec", "d", F.row_number().over(w).alias("k")).where("k <= 60").groupBy("sec").agg(F.min("d").alias("read_from"))


@query("wn23_worst_window", f"WITH {BARS}, r AS (SELECT sec, d, round(sum(amount) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 2) AS s FROM bars QUALIFY row_number() OVER (PARTITION BY sec ORDER BY d) >= 5) SELECT sec, min(s) AS worst, arg_min(d, struct_pack(s, d)) AS last_day FROM r GROUP BY 1")
def _(spark, sf):
    x = panel.rolling(bars(spark, sf), "sec", "d", {"s": ("sum", "amount", 5), "n": ("count", "amount", 5)}).where("n = 5").withColumn("s", F.round("s", 2))
    return x.groupBy("sec").agg(F.min("s").alias("worst"), F.min_by("d", F.struct("s", "d")).alias("last_day"))


@query("sr7_last_dates", f"WITH {BARS} SELECT sec, d, close FROM bars QUALIFY dense_rank() OVER (PARTITION BY sec ORDER BY d DESC) <= 5")
def _(spark, sf):
    w = Window.partitionBy("sec").orderBy(F.desc("d"))
    return bars(spark, sf).withColumn("k", F.dense_rank().over(w)).where("k <= 5").select("sec", "d", "close")


@query("st5_metric_report", "SELECT 'orders' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey)::DOUBLE FROM orders UNION ALL SELECT 'max_price', max(o_totalprice) FROM orders")
def _(spark, sf):
    one = table(spark, sf, "orders").agg(F.count("*").cast("double").alias("orders"), F.count_distinct("o_custkey").cast("double").alias("customers"), F.max("o_totalprice").alias("max_price"))
    return one.unpivot([], ["orders", "customers", "max_price"], "metric", "value")


@query("d20_winsor_zscore", "WITH t AS (SELECT quantile_cont(o_totalprice, 0.01) AS lo, quantile_cont(o_totalprice, 0.99) AS hi FROM orders WHERE o_orderdate < DATE '1999-01-01'), c AS (SELECT o_orderkey, o_orderdate, greatest(least(o_totalprice, hi), lo) AS x FROM orders, t), m AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM c WHERE o_orderdate < DATE '1999-01-01') SELECT o_orderkey, round((x - m) / s, 4) AS o_totalprice FROM c, m")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    fitted = research.WinsorZScore(("o_totalprice",)).fit(o.where(F.to_date("o_orderdate") < F.lit("1999-01-01").cast("date")))
    return fitted.transform(o).select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


@query("d25_score_evaluation", RANKED + ", ev AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) AS r, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS q FROM sc) SELECT d, round(avg(fwd) FILTER (r <= 10), 4) AS top_mean, round(avg(fwd) FILTER (q = 1) - avg(fwd) FILTER (q = 5), 4) AS spread FROM ev GROUP BY d")
def _(spark, sf):
    return rounded(research.evaluate_scores(scored(spark, sf), "d", "score", "fwd", "sec", 10))


DAILY = LABELS + ", s AS (SELECT d, round(avg(fwd), 6) AS v FROM lab GROUP BY d)"


@query("d47_newey_west", DAILY + """, e AS (SELECT d, v, v - avg(v) OVER () AS e FROM s), p AS (SELECT v, e, e * lag(e, 1) OVER w AS p1, e * lag(e, 2) OVER w AS p2 FROM e WINDOW w AS (ORDER BY d))
    SELECT count(*) AS n, round(avg(v), 6) AS mean, round(avg(v) / (sqrt(greatest(sum(e * e) + 2 * (2 / 3.0::DOUBLE) * sum(p1) + 2 * (1 / 3.0::DOUBLE) * sum(p2), 0)) / count(*)), 3) AS t FROM p""")
def _(spark, sf):
    s = labels(spark, sf).groupBy("d").agg(F.round(F.avg("fwd"), 6).alias("v"))
    return research.newey_west(s, "d", "v", 2).select("n", F.round("mean", 6).alias("mean"), F.round("t", 3).alias("t"))


@query("d75_information_ratio", DAILY + " SELECT count(*) AS n, round(avg(v) / stddev_samp(v), 4) AS ir FROM s")
def _(spark, sf):
    s = labels(spark, sf).groupBy("d").agg(F.round(F.avg("fwd"), 6).alias("v"))
    return s.agg(F.count("*").alias("n"), F.round(safe_divide(F.avg("v"), F.stddev_samp("v")), 4).alias("ir"))


@query("d51_transfer_coefficient", f"WITH {BARS}, a AS (SELECT d, sec, 1.0::DOUBLE AS w FROM bars QUALIFY row_number() OVER (PARTITION BY d ORDER BY amount DESC, sec) <= 5), b AS (SELECT d, sec, 1.0::DOUBLE AS w FROM bars QUALIFY row_number() OVER (PARTITION BY d ORDER BY volume DESC, sec) <= 3), x AS (SELECT d, coalesce(a.w, 0) AS x, coalesce(b.w, 0) AS y FROM a FULL JOIN b USING (d, sec)), t AS (SELECT d, count(*) AS n, corr(x, y) AS tc FROM x GROUP BY d) SELECT d, n, CASE WHEN NOT isnan(tc) THEN round(tc, 4) END AS tc FROM t")
def _(spark, sf):
    top = lambda c, n: panel.xs_rank(bars(spark, sf), "d", c, "row", "sec", "k").where(F.col("k") <= n).select("d", "sec", F.lit(1.0).alias("w"))
    x = research.transfer_coefficient(top("amount", 5), top("volume", 3), "d", "sec", "w")
    return x.select("d", "n", F.round("tc", 4).alias("tc"))


@query("d57_factor_ic", RANKED + ", f AS (SELECT 'close' AS factor, close AS x, fwd FROM lab JOIN bars USING (sec, d) UNION ALL SELECT 'amount', amount, fwd FROM lab JOIN bars USING (sec, d) UNION ALL SELECT 'volume', volume, fwd FROM lab JOIN bars USING (sec, d)) SELECT factor, count(*) AS n, round(corr(x, fwd), 4) AS ic, round(regr_slope(fwd, x) * stddev_samp(x), 4) AS standard_slope FROM f GROUP BY 1")
def _(spark, sf):
    names = ["close", "amount", "volume"]
    x = labels(spark, sf).join(bars(spark, sf).select("sec", "d", *names), ["sec", "d"]).unpivot(["fwd"], names, "factor", "x")
    return x.groupBy("factor").agg(F.count("*").alias("n"), F.round(F.corr("x", "fwd"), 4).alias("ic"), F.round(F.regr_slope("fwd", "x") * F.stddev_samp("x"), 4).alias("standard_slope"))


@query("d58_hysteresis_overlay", NAV + ", x AS (SELECT sec, d, CASE WHEN nav < lag(nav) OVER w THEN true WHEN nav > lag(nav) OVER w THEN false END AS turn FROM nav WINDOW w AS (PARTITION BY sec ORDER BY d)) SELECT sec, d, CASE WHEN coalesce(last_value(turn IGNORE NULLS) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 0.5 ELSE 1.0 END::DOUBLE AS exposure FROM x")
def _(spark, sf):
    before = F.lag("nav").over(Window.partitionBy("sec").orderBy("d"))
    x = navs(spark, sf).withColumn("regime", F.when(F.col("nav") < before, "risk_off").when(F.col("nav") > before, "risk_on").otherwise("neutral"))
    return research.hysteresis(x, "sec", "d", "regime", 0.5).select("sec", "d", "exposure")


@query("d62_lot_feasibility", f"WITH {BARS} SELECT sec, d, (ceil(100000 * 0.05 / (close / 100) / 100) * 100)::BIGINT AS min_shares, ceil(100000 * 0.05 / (close / 100) / 100) * 100 * (close / 100) > 10000 AS over_weight FROM bars WHERE close > 0")
def _(spark, sf):
    shares = research.min_buy_shares(F.lit(100000.0), F.lit(0.05), F.col("close") / 100)
    return bars(spark, sf).where("close > 0").select("sec", "d", shares.alias("min_shares"), (shares * (F.col("close") / 100) > 10000).alias("over_weight"))


@query("d45_funnel", f"WITH {BARS} SELECT year(d) AS y, count(*) AS bars, count(*) FILTER (volume > 20) AS liquid, count(*) FILTER (volume > 20 AND close > 900) AS priced, count(DISTINCT sec) AS names FROM bars GROUP BY 1")
def _(spark, sf):
    liquid = F.col("volume") > 20
    return bars(spark, sf).groupBy(F.year("d").cast("long").alias("y")).agg(F.count("*").alias("bars"), F.count_if(liquid).alias("liquid"), F.count_if(liquid & (F.col("close") > 900)).alias("priced"), F.count_distinct("sec").alias("names"))


@query("d69_readiness", "WITH g AS (SELECT n_nationkey, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1) SELECT n_nationkey, CASE WHEN n = 0 AND n_nationkey % 2 = 0 THEN 'EMPTY_OK' WHEN n = 0 THEN 'MISSING' WHEN n >= 100 THEN 'LIMIT_RISK' ELSE 'OK' END AS status FROM g")
def _(spark, sf):
    g = table(spark, sf, "nation").join(table(spark, sf, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_nationkey").agg(F.count("c_custkey").alias("n"))
    status = F.when((F.col("n") == 0) & (F.col("n_nationkey") % 2 == 0), "EMPTY_OK").when(F.col("n") == 0, "MISSING").when(F.col("n") >= 100, "LIMIT_RISK").otherwise("OK")
    return g.select("n_nationkey", status.alias("status"))


@query("d71_score_distribution", "SELECT year(o_orderdate) AS y, count(*) AS n, round(quantile_cont(o_totalprice, 0.01), 2) AS p1, round(quantile_cont(o_totalprice, 0.5), 2) AS p50, round(quantile_cont(o_totalprice, 0.99), 2) AS p99, count(DISTINCT o_totalprice) AS kinds FROM orders GROUP BY 1")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("y"), "o_totalprice")
    counts = o.groupBy("y").agg(F.count("*").alias("n"), F.count_distinct("o_totalprice").alias("kinds"))
    return counts.join(rounded(quantiles.exact_quantiles(o, ["y"], "o_totalprice", {"p1": 0.01, "p50": 0.5, "p99": 0.99}), 2), "y")


@query("d73_label_safe_end", f"WITH {CAL} SELECT h, d FROM (VALUES (1), (5), (20)) t(h) JOIN cal ON cal.seq = (SELECT max(seq) FROM cal) - h")
def _(spark, sf):
    w = Window.orderBy(F.desc("d"))
    return calendar(spark, sf).select("d", (F.row_number().over(w) - 1).alias("h")).where(F.col("h").isin(1, 5, 20)).select("h", "d")


@query("d74_missing_open_days", f"WITH {CAL}, p AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem WHERE l_returnflag = 'R') SELECT d FROM cal WHERE d BETWEEN (SELECT min(d) FROM p) AND (SELECT max(d) FROM p) AND d NOT IN (SELECT d FROM p)")
def _(spark, sf):
    p = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.to_date("l_shipdate").alias("d"))
    return quality.expect_no_gap(p, calendar(spark, sf))


@query("d78_signal_at_or_before", "SELECT o_custkey, coalesce(max(o_orderdate::DATE) FILTER (o_orderdate <= DATE '1998-06-30'), min(o_orderdate::DATE) FILTER (o_orderdate > DATE '1998-06-30')) AS signal FROM orders GROUP BY 1")
def _(spark, sf):
    d, pivot = F.to_date("o_orderdate"), F.lit("1998-06-30").cast("date")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.coalesce(F.max(F.when(d <= pivot, d)), F.min(F.when(d > pivot, d))).alias("signal"))


@query("d84_alert_ids", "SELECT event_id, sha256(event_type || '|' || user_id || '|' || event_id) AS alert_id FROM events WHERE value > 90")
def _(spark, sf):
    key = F.concat_ws("|", "event_type", F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    return table(spark, sf, "events").where("value > 90").select("event_id", F.sha2(key, 256).alias("alert_id"))


@query("qa2_lifecycle_containment", "SELECT o_orderkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 HAVING bool_or(l_shipdate < o_orderdate)")
def _(spark, sf):
    x = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return x.where(F.col("l_shipdate") < F.col("o_orderdate")).select("o_orderkey").distinct()


@query("qa7_unit_ratio", "SELECT l_returnflag, round(median(l_extendedprice / l_quantity), 4) AS ratio FROM lineitem GROUP BY 1")
def _(spark, sf):
    x = table(spark, sf, "lineitem").select("l_returnflag", safe_divide("l_extendedprice", "l_quantity").alias("ratio"))
    return rounded(quantiles.exact_quantiles(x, ["l_returnflag"], "ratio", {"ratio": 0.5}))


@query("qa9_ratio_floor_by_year", "SELECT year(o_orderdate) AS y, count(*) AS n, round(count(*) FILTER (o_orderstatus <> 'P') / count(*), 6) AS ratio FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus <> 'P') / count(*) < 0.7")
def _(spark, sf):
    x = quality.expect_ratio(table(spark, sf, "orders"), [F.year("o_orderdate").cast("long").alias("y")], F.col("o_orderstatus") != "P", 0.7)
    return rounded(x, 6)
