"""Queries over the driver tables: supplier-days stand for bars, orders for announcements, events for run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import log_positive, rounded, safe_divide
from ..operators import calendar as cal_
from ..operators import joins, ledger, panel, quantiles
from ..sources.tables import table
from ..streaming import events as stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


TASK_ROWS = 250_000  # of lineitem behind a task that sorts its rows several times


def tasks(spark: SparkSession, sf: str) -> int:
    """How many tasks to deal lineitem's rows to, so that one's share doesn't grow with the table; counted from footers."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf, "lineitem").count() // TASK_ROWS))


def bars(spark: SparkSession, sf: str, by_sec: bool = False) -> DataFrame:
    """sec, d, volume, amount, close (whole cents, cut), high, low for each supplier and ship date.

    by_sec: lines are dealt by supplier, once, to tasks of bounded share, for what goes on by sec.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    if by_sec:
        lines = lines.repartition(tasks(spark, sf), "l_suppkey")
    grouped = lines.groupBy(F.col("l_suppkey").alias("sec"), F.to_date("l_shipdate").alias("d"))
    return grouped.agg(F.sum("l_quantity").alias("volume"), F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.max(price).alias("high"), F.min(price).alias("low")).withColumn("close", F.expr("cast(round(amount * 100) as bigint) div cast(volume as bigint)") / F.lit(100.0))


BARS = """bars AS (
  SELECT *, (round(amount * 100)::BIGINT // volume::BIGINT) / 100.0::DOUBLE AS close FROM (
    SELECT l_suppkey AS sec, l_shipdate::DATE AS d, sum(l_quantity) AS volume, round(sum(l_extendedprice), 2) AS amount,
      max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low FROM lineitem GROUP BY 1, 2))"""
CAL = "cal AS (SELECT d, row_number() OVER (ORDER BY d) AS seq FROM (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem))"


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return cal_.with_ordinal(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct())


@query("d1_calendar_ordinal", f"WITH {CAL} SELECT d, seq, lag(d) OVER (ORDER BY d) AS prev_d, lead(d) OVER (ORDER BY d) AS next_d FROM cal")
def _(spark, sf):
    return calendar(spark, sf).select("d", "seq", "prev_d", "next_d")


@query("d5_gap_return", f"WITH {BARS} SELECT sec, d, round(close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1, 7) AS ret FROM bars")
def _(spark, sf):
    return rounded(panel.gap_return(bars(spark, sf), "sec", "d", "close").select("sec", "d", "ret"), 7)


@query(
    "jn3_skeleton",
    f"""WITH {BARS}, {CAL}, life AS (SELECT sec, min(d) AS a, max(d) + 1 AS b FROM bars GROUP BY 1)
    SELECT s.sec, count(*) AS days, sum(CASE WHEN b.sec IS NULL THEN 1 ELSE 0 END)::BIGINT AS suspended
    FROM (SELECT life.sec, cal.d FROM life JOIN cal ON cal.d >= life.a AND cal.d < life.b) s LEFT JOIN bars b ON s.sec = b.sec AND s.d = b.d GROUP BY 1""",
)
def _(spark, sf):
    b = bars(spark, sf)
    life = b.groupBy("sec").agg(F.min("d").alias("a"), F.date_add(F.max("d"), 1).alias("b"))
    dense = joins.skeleton(calendar(spark, sf), life, "sec", "a", "b").join(b.select("sec", "d", "close"), ["sec", "d"], "left")
    return dense.groupBy("sec").agg(F.count("*").alias("days"), F.count_if(F.col("close").isNull()).alias("suspended"))


@query(
    "d11_price_features",
    f"""WITH {BARS} SELECT sec, d, round(close / lag(close, 1) OVER w - 1, 6) AS ret_1, round(close / lag(close, 5) OVER w - 1, 6) AS ret_5, round(close / lag(close, 20) OVER w - 1, 6) AS ret_20,
    round(avg(close) OVER r20, 6) AS ma_20, round(stddev_samp(close) OVER r20, 6) AS vol_20, round(close / max(close) OVER r60 - 1, 6) AS dd_60, count(close) OVER r60 AS obs_60,
    round((close - min(close) OVER r20) / NULLIF(max(close) OVER r20 - min(close) OVER r20, 0), 6) AS range_20 FROM bars
    WINDOW w AS (PARTITION BY sec ORDER BY d), r20 AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), r60 AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    x = panel.lags(bars(spark, sf), "sec", "d", "close", (1, 5, 20))
    x = panel.rolling(x, "sec", "d", {"ma_20": ("avg", "close", 20), "vol_20": ("std", "close", 20), "hi_60": ("max", "close", 60), "obs_60": ("count", "close", 60), "hi_20": ("max", "close", 20), "lo_20": ("min", "close", 20)})
    rets = [(safe_divide("close", f"close_lag{k}") - 1).alias(f"ret_{k}") for k in (1, 5, 20)]
    return rounded(x.select("sec", "d", *rets, F.col("ma_20").cast("decimal(18,6)").alias("ma_20"), "vol_20", (safe_divide("close", "hi_60") - 1).alias("dd_60"), "obs_60", safe_divide(F.col("close") - F.col("lo_20"), F.col("hi_20") - F.col("lo_20")).alias("range_20")), 6).withColumn("ma_20", F.col("ma_20").cast("double"))


@query("wn22_shifted_rolling", f"WITH {BARS} SELECT sec, d, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 6) AS ma_before FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)")
def _(spark, sf):
    x = panel.rolling(bars(spark, sf), "sec", "d", {"m": ("avg", "close", 20), "n": ("count", "close", 20)}, shift=1)
    return rounded(x.select("sec", "d", F.when(F.col("n") == 20, F.col("m")).alias("ma_before")), 6)


@query("d12_valuation_features", f"WITH {BARS} SELECT sec, d, round(CASE WHEN amount > 0 THEN ln(amount) END, 4) AS log_amount, round(1 / NULLIF(close, 0), 6) AS inverse, round(amount / NULLIF(avg(amount) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0), 4) AS rel FROM bars")
def _(spark, sf):
    x = panel.rolling(bars(spark, sf), "sec", "d", {"m": ("avg", "amount", 20)})
    return x.select("sec", "d", F.round(log_positive("amount"), 4).alias("log_amount"), F.round(safe_divide(F.lit(1.0), F.col("close")), 6).alias("inverse"), F.round(safe_divide("amount", "m"), 4).alias("rel"))


LABELS = f"""WITH {BARS}, {CAL}, x AS (SELECT b.sec, b.d, e.close AS entry, f.close AS exit FROM bars b JOIN cal c ON b.d = c.d
  LEFT JOIN cal c1 ON c1.seq = c.seq + 1 LEFT JOIN bars e ON e.sec = b.sec AND e.d = c1.d LEFT JOIN cal c5 ON c5.seq = c.seq + 5 LEFT JOIN bars f ON f.sec = b.sec AND f.d = c5.d),
  lab AS (SELECT sec, d, exit / NULLIF(entry, 0) - 1 AS fwd FROM x WHERE entry IS NOT NULL AND exit IS NOT NULL)"""


def forward(spark, sf, x: DataFrame, h: int = 5) -> DataFrame:
    """x (sec, d, close) with fwd, the return from the close of the next open day to that of the h-th, null where either is unknown.

    The close of an open day k places on is found by a window over the days' ordinals.
    """
    x = x.join(joins.small(calendar(spark, sf).select("d", "seq")), "d")
    on = lambda k: F.max("close").over(Window.partitionBy("sec").orderBy("seq").rangeBetween(k, k))
    return x.withColumns({"entry": on(1), "exit": on(h)}).withColumn("fwd", F.when(F.col("entry").isNotNull() & F.col("exit").isNotNull(), safe_divide("exit", "entry") - 1))


def labels(spark, sf, h: int = 5, keep: tuple[str, ...] = ()) -> DataFrame:
    """fwd where it is known, and columns of bars, which are read once."""
    return forward(spark, sf, bars(spark, sf), h).where("entry is not null and exit is not null").select("sec", "d", "fwd", *keep)


@query("d13_forward_labels", LABELS + " SELECT sec, d, round(fwd, 4) AS fwd, round(fwd - avg(fwd) OVER (PARTITION BY d), 4) AS excess, fwd > median(fwd) OVER (PARTITION BY d) AS above FROM lab")
def _(spark, sf):
    w = Window.partitionBy("d")
    x = panel.xs_demean(labels(spark, sf), "d", "fwd", "excess")
    return x.select("sec", "d", F.round("fwd", 4).alias("fwd"), F.round("excess", 4).alias("excess"), (F.col("fwd") > F.percentile("fwd", F.lit(0.5)).over(w)).alias("above"))


RANKED = LABELS + f", sc AS (SELECT lab.sec, lab.d, lab.fwd, bars.close AS score FROM lab JOIN bars ON lab.sec = bars.sec AND lab.d = bars.d)"


def scored(spark, sf, *keep: str) -> DataFrame:
    return labels(spark, sf, keep=("close", *keep)).withColumnRenamed("close", "score")


@query(
    "wn3_cross_section_ranks",
    RANKED + """ SELECT sec, d, row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) AS rk, rank() OVER w AS rk_rank, dense_rank() OVER w AS rk_dense, round(percent_rank() OVER w, 6) AS rk_pct,
    rank() OVER w + (count(*) OVER (PARTITION BY d, score) - 1) / 2.0 AS rk_avg, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS bucket, round(1 - (row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) - 1.0::DOUBLE) / NULLIF(count(*) OVER (PARTITION BY d) - 1, 0), 6) AS rank_pct FROM sc WINDOW w AS (PARTITION BY d ORDER BY score DESC)""",
)
def _(spark, sf):
    x = scored(spark, sf)
    for method, out in (("row", "rk"), ("rank", "rk_rank"), ("dense", "rk_dense"), ("percent", "rk_pct"), ("average", "rk_avg")):
        x = panel.xs_rank(x, "d", "score", method, "sec", out)
    x = panel.xs_bucket(x, "d", "score", 5, "sec", "bucket").withColumn("n", F.count("*").over(Window.partitionBy("d")))
    return x.select("sec", "d", *(F.col(c).cast("long").alias(c) for c in ("rk", "rk_rank", "rk_dense")), F.round("rk_pct", 6).alias("rk_pct"), "rk_avg", F.col("bucket").cast("long").alias("bucket"), F.round(1 - safe_divide(F.col("rk") - 1, F.col("n") - 1), 6).alias("rank_pct"))


@query(
    "d43_rank_ic",
    RANKED + """, r AS (SELECT d, rank() OVER (PARTITION BY d ORDER BY score DESC) + (count(*) OVER (PARTITION BY d, score) - 1) / 2.0::DOUBLE AS s, rank() OVER (PARTITION BY d ORDER BY fwd DESC) + (count(*) OVER (PARTITION BY d, fwd) - 1) / 2.0::DOUBLE AS t FROM sc)
    SELECT d, count(*) AS n, round(corr(s, t), 4) AS ic FROM r GROUP BY d HAVING count(*) >= 5""",
)
def _(spark, sf):
    return rounded(panel.rank_ic(scored(spark, sf), "d", "score", "fwd", "sec"))


@query("d44_bucket_lift", RANKED + ", b AS (SELECT *, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS bucket FROM sc) SELECT bucket, count(*) AS n, round(avg(fwd), 4) AS mean_fwd, round(avg(CASE WHEN fwd > 0 THEN 1.0 ELSE 0.0 END), 4) AS hit FROM b GROUP BY 1")
def _(spark, sf):
    x = panel.xs_bucket(scored(spark, sf), "d", "score", 5, "sec", "bucket")
    return rounded(x.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n"), F.avg("fwd").alias("mean_fwd"), F.avg(F.when(F.col("fwd") > 0, 1.0).otherwise(0.0)).alias("hit")))


@query("d48_neutralize", f"WITH {BARS}, m AS (SELECT *, ln(amount) AS size FROM bars), s AS (SELECT d, regr_slope(close, size) AS b, avg(close) AS my, avg(size) AS mx, count(*) AS n FROM m GROUP BY d HAVING count(*) >= 5) SELECT sec, m.d, round(close - my - b * (size - mx), 3) AS residual FROM m JOIN s ON m.d = s.d")
def _(spark, sf):
    x = bars(spark, sf).withColumn("size", F.log("amount")).withColumn("n", F.count("*").over(Window.partitionBy("d"))).where("n >= 5")
    return panel.neutralize(x, "d", "close", "size", "residual").select("sec", "d", F.round("residual", 3).alias("residual"))


@query("wn16_minmax_weight", f"WITH {BARS} SELECT sec, d, round(1 + 2 * (amount - min(amount) OVER w) / NULLIF(max(amount) OVER w - min(amount) OVER w, 0), 4) AS weight FROM bars WINDOW w AS (PARTITION BY d)")
def _(spark, sf):
    return rounded(panel.xs_minmax_weight(bars(spark, sf), "d", "amount", "weight").select("sec", "d", "weight"))


@query("wn12_bounded_ffill", f"WITH {BARS}, x AS (SELECT sec, d, row_number() OVER (PARTITION BY sec ORDER BY d) AS n, CASE WHEN volume > 40 THEN close END AS v FROM bars), y AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN n END) OVER (PARTITION BY sec ORDER BY d) AS at FROM x) SELECT y.sec, y.d, x.v AS v_ffill FROM y LEFT JOIN x ON x.sec = y.sec AND x.n = y.at AND y.n - y.at <= 5")
def _(spark, sf):
    x = bars(spark, sf).withColumn("v", F.when(F.col("volume") > 40, F.col("close")))
    return panel.bounded_ffill(x, "sec", "d", "v", 5).select("sec", "d", "v_ffill")


NAV = f"""WITH {BARS}, r AS (SELECT sec, d, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars),
  nav AS (SELECT sec, d, round(exp(sum(ln(1 + greatest(least(coalesce(ret, 0), 0.1), -0.1))) OVER (PARTITION BY sec ORDER BY d)), 8) AS nav FROM r)"""


def navs(spark, sf) -> DataFrame:
    """Compounded clipped returns of each supplier."""
    x = panel.gap_return(bars(spark, sf, by_sec=True), "sec", "d", "close").withColumn("ret", F.greatest(F.least(F.coalesce("ret", F.lit(0.0)), F.lit(0.1)), F.lit(-0.1)))
    w = Window.partitionBy("sec").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return x.select("sec", "d", F.round(F.exp(F.sum(F.log(1 + F.col("ret"))).over(w)), 8).alias("nav"))


@query("wn19_cumulative_nav", NAV + " SELECT sec, d, nav FROM nav")
def _(spark, sf):
    return navs(spark, sf)


@query("wn13_running_drawdown", NAV + " SELECT sec, d, round(nav / max(nav) OVER (PARTITION BY sec ORDER BY d) - 1, 5) AS drawdown FROM nav")
def _(spark, sf):
    return panel.running_drawdown(navs(spark, sf), "sec", "d", "nav").select("sec", "d", F.round("drawdown", 5).alias("drawdown"))


@query(
    "d77_max_drawdown",
    NAV + """, p AS (SELECT *, max(nav) OVER (PARTITION BY sec ORDER BY d) AS peak FROM nav), w AS (SELECT *, nav / peak - 1 AS dd, row_number() OVER (PARTITION BY sec ORDER BY nav / peak - 1, d) AS r FROM p)
    SELECT w.sec, round(w.dd, 5) AS drawdown, w.d AS trough, max(nav.d) AS peak_day FROM w JOIN nav ON nav.sec = w.sec AND nav.d <= w.d AND nav.nav = w.peak WHERE r = 1 GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    x = panel.max_drawdown(navs(spark, sf), "sec", "d", "nav")
    return x.select("sec", F.round("drawdown", 5).alias("drawdown"), "trough", "peak_day")


@query(
    "d53_drawdown_episodes",
    NAV + """, p AS (SELECT *, max(nav) OVER (PARTITION BY sec ORDER BY d) AS peak FROM nav), g AS (SELECT *, sum(CASE WHEN nav = peak THEN 1 ELSE 0 END) OVER (PARTITION BY sec ORDER BY d) AS g FROM p)
    SELECT sec, min(d) AS first_day, max(d) AS last_day, count(*) AS days, round(min(nav / peak - 1), 5) AS depth FROM g WHERE nav < peak GROUP BY sec, g.g""",
)
def _(spark, sf):
    x = panel.drawdown_episodes(navs(spark, sf), "sec", "d", "nav")
    return x.select("sec", "first_day", "last_day", "days", F.round("depth", 5).alias("depth"))


@query("d52_performance", NAV + ", x AS (SELECT sec, d, nav, nav / lag(nav) OVER (PARTITION BY sec ORDER BY d) - 1 AS r FROM nav) SELECT sec, count(*) AS days, round(arg_max(nav, d) - 1, 5) AS total, round(stddev_samp(r) * sqrt(252), 4) AS vol, round(avg(r) * 252 / NULLIF(stddev_samp(r) * sqrt(252), 0), 3) AS sharpe FROM x GROUP BY sec")
def _(spark, sf):
    x = panel.gap_return(navs(spark, sf), "sec", "d", "nav").withColumnRenamed("ret", "r")
    vol = F.stddev_samp("r") * F.sqrt(F.lit(252.0))
    return x.groupBy("sec").agg(F.count("*").alias("days"), F.round(F.max_by("nav", "d") - 1, 5).alias("total"), F.round(vol, 4).alias("vol"), F.round(safe_divide(F.avg("r") * 252, vol), 3).alias("sharpe"))


@query("d58_two_state_overlay", NAV + ", x AS (SELECT sec, d, nav / lag(nav) OVER w - 1 AS r, nav < avg(nav) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS off FROM nav WINDOW w AS (PARTITION BY sec ORDER BY d)), e AS (SELECT *, CASE WHEN coalesce(lag(off) OVER (PARTITION BY sec ORDER BY d), false) THEN 0.3 ELSE 1.0 END::DOUBLE AS exposure FROM x) SELECT sec, d, exposure, round(exposure * r, 5) AS ret FROM e")
def _(spark, sf):
    x = panel.rolling(panel.gap_return(navs(spark, sf), "sec", "d", "nav"), "sec", "d", {"m": ("avg", "nav", 20)})
    before = F.coalesce(F.lag(F.col("nav") < F.col("m")).over(Window.partitionBy("sec").orderBy("d")), F.lit(False))
    return x.withColumn("exposure", F.when(before, 0.3).otherwise(1.0)).select("sec", "d", "exposure", F.round(F.col("exposure") * F.col("ret"), 5).alias("ret"))


HIST = """hist AS (SELECT c, a AS valid_from, lead(a, 1, DATE '9999-12-31') OVER (PARTITION BY c ORDER BY a) AS valid_to, status FROM (
  SELECT o_custkey AS c, o_orderdate::DATE AS a, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1, 2))"""


def history(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c"), F.to_date("o_orderdate").alias("valid_from")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))
    return o.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(Window.partitionBy("c").orderBy("valid_from")), F.lit("9999-12-31").cast("date")))


@query("jn5_scd2_interval", f"WITH {HIST} SELECT q.c, q.d, h.status FROM (SELECT c_custkey AS c, DATE '1997-06-30' AS d FROM customer UNION ALL SELECT c_custkey, DATE '1999-12-31' FROM customer) q LEFT JOIN hist h ON h.c = q.c AND q.d >= h.valid_from AND q.d < h.valid_to")
def _(spark, sf):
    q = table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), F.explode(F.array(F.lit("1997-06-30").cast("date"), F.lit("1999-12-31").cast("date"))).alias("d"))
    return joins.interval_join(q, history(spark, sf), "c", "d", "valid_from", "valid_to").select("c", "d", "status")


@query("d3_scd2_history", f"WITH {HIST} SELECT c, valid_from, valid_to, status FROM hist")
def _(spark, sf):
    return history(spark, sf).select("c", "valid_from", "valid_to", "status")


@query(
    "jn6_pit_asof",
    """WITH q AS (SELECT c_custkey AS c, make_date(y, 6, 30) AS d FROM customer, (VALUES (1996), (1998), (2000)) t(y)), r AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate)::DATE AS period, o_orderdate::DATE AS ann, o_orderkey, o_totalprice FROM orders),
    b AS (SELECT q.c, q.d, r.period, r.o_totalprice, row_number() OVER (PARTITION BY q.c, q.d ORDER BY r.period DESC, r.ann DESC, r.o_orderkey DESC) AS k FROM q JOIN r ON q.c = r.c AND r.ann <= q.d AND r.ann >= q.d - 900)
    SELECT q.c, q.d, b.period, b.o_totalprice AS value FROM q LEFT JOIN b ON q.c = b.c AND q.d = b.d AND b.k = 1""",
)
def _(spark, sf):
    years = F.explode(F.array(*(F.make_date(F.lit(y), F.lit(6), F.lit(30)) for y in (1996, 1998, 2000))))
    q = table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), years.alias("d"))
    r = table(spark, sf, "orders").select(F.col("o_custkey").alias("c"), F.trunc("o_orderdate", "month").alias("period"), F.to_date("o_orderdate").alias("ann"), "o_orderkey", F.col("o_totalprice").alias("value"))
    return joins.asof_join(q, r, "c", "d", "ann", [F.desc("period"), F.desc("ann"), F.desc("o_orderkey")], 900, ["c", "d"]).select("c", "d", "period", "value")


@query("jn7_next_open", f"WITH {CAL}, q AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders) SELECT o_orderkey, (SELECT min(cal.d) FROM cal WHERE cal.d >= q.d) AS visible FROM q")
def _(spark, sf):
    q = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return cal_.next_open(q, calendar(spark, sf), "d", "visible").select("o_orderkey", "visible")


@query("jn8_offset_date", f"WITH {CAL} SELECT a.d, b.d AS plus_5 FROM cal a LEFT JOIN cal b ON b.seq = a.seq + 5")
def _(spark, sf):
    c = calendar(spark, sf)
    return cal_.offset_date(c.select("d"), c, "d", 5, "plus_5")


@query("jn10_full_diff", "WITH x AS (SELECT l_suppkey AS sec, round(sum(l_extendedprice), 2) AS v FROM lineitem WHERE l_shipdate < DATE '1998-01-01' AND l_returnflag = 'R' GROUP BY 1), y AS (SELECT l_suppkey AS sec, round(sum(l_extendedprice), 2) AS v FROM lineitem WHERE l_shipdate < DATE '1997-06-01' AND l_returnflag = 'R' GROUP BY 1) SELECT coalesce(x.sec, y.sec) AS sec, x.v AS a, y.v AS b FROM x FULL JOIN y ON x.sec = y.sec WHERE x.v IS NULL OR y.v IS NULL OR abs(x.v - y.v) > 0.5")
def _(spark, sf):
    li = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    side = lambda day: li.where(F.col("l_shipdate") < F.lit(day).cast("date")).groupBy(F.col("l_suppkey").alias("sec")).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    return joins.full_diff(side("1998-01-01"), side("1997-06-01"), ["sec"], "v", 0.5)


@query("jn12_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def _(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders").where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("jn13_semi_join", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def _(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("jn20_banded_time_join", "WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = (SELECT min(event_type) FROM events)) SELECT a.event_id, count(b.event_id) AS near FROM a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_id <> a.event_id AND b.ts >= a.ts - INTERVAL 30 MINUTE AND b.ts <= a.ts + INTERVAL 30 MINUTE GROUP BY 1")
def _(spark, sf):
    """Half-hour slots make the band an equality join on (user, slot); each left row looks into three slots."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    slot = F.floor(F.col("t") / (30 * 60 * 1_000_000)).cast("long")
    kind = e.agg(F.min("event_type").alias("k"))
    a = e.join(F.broadcast(kind), F.col("event_type") == F.col("k"), "left_semi").select("event_id", "user_id", "t", F.explode(F.array(slot - 1, slot, slot + 1)).alias("slot"))
    b = e.select(F.col("event_id").alias("other"), "user_id", F.col("t").alias("u"), slot.alias("slot"))
    hit = (F.col("other") != F.col("event_id")) & (F.abs(F.col("t") - F.col("u")) <= 30 * 60 * 1_000_000)
    return a.join(b, ["user_id", "slot"], "left").groupBy("event_id").agg(F.count_if(hit).alias("near"))


@query("wn1_latest_by", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(spark, sf):
    return joins.latest_by(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("snk2_merge_upsert", "WITH old AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0) SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.merge_upsert(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"], [F.asc("o_orderstatus")])


@query("ag1_conditional_counts", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS high, round(sum(CASE WHEN value > 50 THEN value ELSE 0 END), 2) AS high_sum, bool_or(value > 99) AS any_top, bool_and(value >= 0) AS all_pos, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(spark, sf):
    high = F.col("value") > 50
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(high).alias("high"), F.round(F.sum(F.when(high, F.col("value")).otherwise(0.0)), 2).alias("high_sum"), F.bool_or(F.col("value") > 99).alias("any_top"), F.bool_and(F.col("value") >= 0).alias("all_pos"), F.count_distinct("user_id").alias("users"))


@query("ag4_pivot_regions", "SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) FILTER (r_name = 'ASIA') AS asia, count(*) FILTER (r_name = 'EUROPE') AS europe, count(*) FILTER (r_name = 'AMERICA') AS america FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, sf):
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    x = joined.groupBy(F.trunc("o_orderdate", "month").alias("m")).pivot("r_name", ["ASIA", "EUROPE", "AMERICA"]).count()
    return x.select("m", *(F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("ASIA", "EUROPE", "AMERICA")))


@query("ag5_exact_quantiles", "SELECT o_orderpriority, round(quantile_cont(o_totalprice, 25.0/101), 2) AS q25, round(median(o_totalprice), 2) AS q50, round(quantile_cont(o_totalprice, 0.99), 2) AS q99 FROM orders GROUP BY 1")
def _(spark, sf):
    return rounded(quantiles.exact_quantiles(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", {"q25": 25.0 / 101, "q50": 0.5, "q99": 0.99}), 2)


@query("d9_event_lineage", "SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS period, count(*) AS n, round(sum(o_totalprice), 2) AS total, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities, arg_max(o_orderstatus, o_orderkey) AS status, min(o_orderdate::DATE) AS first_day FROM orders GROUP BY 1, 2")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("period")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ";").alias("priorities"), F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.min(F.to_date("o_orderdate")).alias("first_day"))


@query("ag11_slope_and_corr", "SELECT l_returnflag, round(corr(l_extendedprice, l_quantity), 6) AS ic, round(covar_samp(l_extendedprice, l_quantity) / var_samp(l_quantity), 4) AS slope FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.corr("l_extendedprice", "l_quantity"), 6).alias("ic"), F.round(safe_divide(F.covar_samp("l_extendedprice", "l_quantity"), F.var_samp("l_quantity")), 4).alias("slope"))


@query("ag14_rebalance_dates", f"WITH {CAL}, w AS (SELECT max(d) AS d FROM cal GROUP BY isoyear(d), week(d)) SELECT 'weekly' AS freq, d FROM w UNION ALL SELECT 'biweekly', d FROM (SELECT d, row_number() OVER (ORDER BY d) AS i FROM w) WHERE i % 2 = 1 UNION ALL SELECT 'monthly', max(d) FROM cal GROUP BY date_trunc('month', d)")
def _(spark, sf):
    c = calendar(spark, sf)
    each = [cal_.rebalance_dates(c, f).select(F.lit(f).alias("freq"), "d") for f in ("weekly", "biweekly", "monthly")]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("ag16_concentration", "WITH x AS (SELECT l_suppkey, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1), w AS (SELECT n_name, v / sum(v) OVER (PARTITION BY n_name) AS w FROM x JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) SELECT n_name, round(sum(w * w), 6) AS hhi, round(max(w), 6) AS top, count(*) AS n FROM w GROUP BY 1")
def _(spark, sf):
    x = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    x = x.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    x = x.withColumn("w", F.col("v") / F.sum("v").over(Window.partitionBy("n_name")))
    return x.groupBy("n_name").agg(F.round(F.sum(F.col("w") * F.col("w")), 6).alias("hhi"), F.round(F.max("w"), 6).alias("top"), F.count("*").alias("n"))


@query("ag17_labelled_groups", "SELECT 'all' AS g, count(*) AS n, round(avg(value), 4) AS mean FROM events UNION ALL SELECT 'high', count(*), round(avg(value), 4) FROM events WHERE value > 50 UNION ALL SELECT 'even', count(*), round(avg(value), 4) FROM events WHERE user_id % 2 = 0")
def _(spark, sf):
    """One pass: a row joins every group whose predicate it meets."""
    groups = F.array_compact(F.array(F.lit("all"), F.when(F.col("value") > 50, "high"), F.when(F.col("user_id") % 2 == 0, "even")))
    return rounded(table(spark, sf, "events").select("value", F.explode(groups).alias("g")).groupBy("g").agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


@query("sr4_top_k_per_group", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 5")
def _(spark, sf):
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return table(spark, sf, "customer").withColumn("rk", F.row_number().over(w)).where("rk <= 5").select("c_mktsegment", "c_custkey", "c_acctbal")


@query("st2_set_operations", "SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer) UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)")
def _(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    each = {"union": a.union(b).distinct(), "except": a.subtract(b), "intersect": a.intersect(b)}
    out = [df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n") for op, df in each.items()]
    return out[0].union(out[1]).union(out[2])


@query("flt5_hash_sample", "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 10000 < 500")
def _(spark, sf):
    h = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8), 16, 10).cast("long")
    return table(spark, sf, "orders").where(h % 10000 < 500).select("o_orderkey")


@query("flt7_exclusion_reasons", "SELECT o_orderkey, concat_ws(';', CASE WHEN o_totalprice < 50000 THEN 'small' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'low' END) AS reasons FROM orders")
def _(spark, sf):
    why = F.array_compact(F.array(F.when(F.col("o_totalprice") < 50000, "small"), F.when(F.col("o_orderstatus") == "P", "pending"), F.when(F.col("o_orderpriority").startswith("5"), "low")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(why, ";").alias("reasons"))


MASKS = f"""WITH {BARS}, x AS (SELECT *, row_number() OVER w AS age, avg(amount) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS liq FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d)),
  m AS (SELECT sec, d, close, age > 60 AS pass_age, liq > 30000 AS pass_liquid, close >= 900 AS pass_price FROM x)"""


def masks(spark, sf) -> DataFrame:
    x = panel.rolling(bars(spark, sf), "sec", "d", {"liq": ("avg", "amount", 20)}).withColumn("age", F.row_number().over(Window.partitionBy("sec").orderBy("d")))
    return x.select("sec", "d", "close", (F.col("age") > 60).alias("pass_age"), (F.col("liq") > 30000).alias("pass_liquid"), (F.col("close") >= 900).alias("pass_price"))


@query("d10_universe_masks", MASKS + " SELECT sec, d, pass_age, pass_liquid, pass_price, pass_age AND pass_liquid AND pass_price AS in_universe FROM m")
def _(spark, sf):
    return masks(spark, sf).select("sec", "d", "pass_age", "pass_liquid", "pass_price", (F.col("pass_age") & F.col("pass_liquid") & F.col("pass_price")).alias("in_universe"))


CANDIDATES = MASKS + f""", {CAL}, reb AS (SELECT max(d) AS d FROM cal GROUP BY date_trunc('month', d)), u AS (SELECT m.* FROM m SEMI JOIN reb ON m.d = reb.d WHERE pass_age AND pass_liquid AND pass_price),
  cand AS (SELECT sec, d, row_number() OVER (PARTITION BY d ORDER BY close DESC, sec) AS rk FROM u)"""


def candidates(spark, sf) -> DataFrame:
    dates = cal_.rebalance_dates(calendar(spark, sf), "monthly")
    u = masks(spark, sf).where("pass_age and pass_liquid and pass_price").join(joins.small(dates), "d", "left_semi")
    return panel.xs_rank(u, "d", "close", "row", "sec", "rk")


@query("d32_equal_weight_targets", CANDIDATES + " SELECT d, sec, rk, least(1.0::DOUBLE / least(count(*) OVER (PARTITION BY d), 10), 0.15) AS target FROM cand QUALIFY rk <= 10")
def _(spark, sf):
    n = F.least(F.count("*").over(Window.partitionBy("d")), F.lit(10))
    return candidates(spark, sf).withColumn("target", F.least(F.lit(1.0) / n, F.lit(0.15))).where("rk <= 10").select("d", "sec", F.col("rk").cast("long").alias("rk"), "target")


@query("d33_order_plan", CANDIDATES + """, t AS (SELECT d, sec FROM cand WHERE rk <= 10), days AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT d FROM t)),
  cur AS (SELECT d, sec, 1 AS want FROM t), prev AS (SELECT days.d, t.sec, 1 AS held FROM days JOIN t ON t.d = days.before) SELECT coalesce(cur.d, prev.d) AS d, coalesce(cur.sec, prev.sec) AS sec, CASE WHEN held IS NULL THEN 'buy' WHEN want IS NULL THEN 'sell' ELSE 'hold' END AS side FROM cur FULL JOIN prev ON cur.d = prev.d AND cur.sec = prev.sec""")
def _(spark, sf):
    t = candidates(spark, sf).where("rk <= 10").select("d", "sec")
    days = t.select("d").distinct().withColumn("before", F.lag("d").over(Window.orderBy("d")))
    held = t.withColumnRenamed("d", "before").join(joins.small(days), "before").select("d", "sec", F.lit(True).alias("held"))
    both = t.withColumn("want", F.lit(True)).join(held, ["d", "sec"], "full")
    return both.select("d", "sec", F.when(F.col("held").isNull(), "buy").when(F.col("want").isNull(), "sell").otherwise("hold").alias("side"))


def ledger_rows(spark, sf) -> DataFrame:
    """A portfolio for each nation's suppliers, rebalanced monthly."""
    nations = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_nationkey").cast("long").alias("portfolio"))
    dates = cal_.rebalance_dates(calendar(spark, sf), "monthly").withColumn("reb", F.lit(True))
    rows = bars(spark, sf).join(nations, "sec").join(joins.small(dates), "d", "left").withColumn("rk", F.row_number().over(Window.partitionBy("portfolio", "d").orderBy(F.desc("amount"), "sec")))
    rows = rows.select("portfolio", "d", "sec", (F.col("close") / 100).alias("price"), F.when(F.col("reb") & (F.col("rk") <= 5), 0.2).alias("target"))
    # prices of names that are never aimed at don't matter; a row without a name stands for each other day
    held = rows.where("target is not null").select("portfolio", "sec").distinct()
    days = rows.groupBy("portfolio", "d").agg(F.lit(None).cast("long").alias("sec"), F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("target"))
    return rows.join(held, ["portfolio", "sec"], "left_semi").select("portfolio", "d", "sec", "price", "target").unionByName(days)


@query("d34_ledger")
def _(spark, sf):
    """A fold over days, beyond SQL."""
    return ledger.run_ledger(ledger_rows(spark, sf))


@query("d16_market_state", f"WITH {BARS}, r AS (SELECT sec, d, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars), b AS (SELECT d, count(ret) AS n, count(*) FILTER (ret > 0) AS up, count(*) FILTER (ret <= -0.095) AS down_limit FROM r GROUP BY d) SELECT d, n, up, round(up / NULLIF(n, 0)::DOUBLE, 4) AS breadth, CASE WHEN n = 0 THEN 'unknown' WHEN down_limit / n::DOUBLE > 0.5 THEN 'risk_off' WHEN up / n::DOUBLE > 0.5 THEN 'risk_on' ELSE 'neutral' END AS regime FROM b")
def _(spark, sf):
    r = panel.gap_return(bars(spark, sf), "sec", "d", "close").groupBy("d").agg(F.count("ret").alias("n"), F.count_if(F.col("ret") > 0).alias("up"), F.count_if(F.col("ret") <= -0.095).alias("dl"))
    up, down = safe_divide("up", "n"), safe_divide("dl", "n")
    return r.select("d", "n", "up", F.round(up, 4).alias("breadth"), F.when(F.col("n") == 0, "unknown").when(down > 0.5, "risk_off").when(up > 0.5, "risk_on").otherwise("neutral").alias("regime"))


@query("d60_size_bucket_ic", RANKED + ", b AS (SELECT sc.*, ntile(3) OVER (PARTITION BY sc.d ORDER BY bars.amount DESC, sc.sec) AS bucket FROM sc JOIN bars ON sc.sec = bars.sec AND sc.d = bars.d) SELECT bucket, count(*) AS n, round(corr(score, fwd), 4) AS ic FROM b GROUP BY 1")
def _(spark, sf):
    x = panel.xs_bucket(scored(spark, sf, "amount"), "d", "amount", 3, "sec", "bucket")
    return x.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.corr("score", "fwd"), 4).alias("ic"))


@query("d68_run_health", "SELECT user_id, arg_max(event_type, struct_pack(ts, event_id)) AS last_type, max(ts)::VARCHAR AS last_seen, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.max("ts").cast("string").alias("last_seen"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query("prj_json_payload", "SELECT event_id, (json_extract_string(props, '$.k'))::BIGINT AS k, coalesce((json_extract_string(props, '$.k'))::BIGINT % 2 = 0, false) AS even FROM events")
def _(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf, "events").select("event_id", k.alias("k"), F.coalesce(k % 2 == 0, F.lit(False)).alias("even"))


@query("qa1_key_uniqueness", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("qa3_source_coverage", "SELECT 'orders' AS source, count(*) AS missing FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def _(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    same = F.col("o_orderkey") == F.col("l_orderkey")
    missing = lambda a, b, name: a.join(b, same, "left_anti").agg(F.count("*").alias("missing")).select(F.lit(name).alias("source"), "missing")
    return missing(o, li, "orders").union(missing(li, o, "lineitem"))


@query("qa4_calendar_gaps", f"WITH {BARS}, {CAL}, life AS (SELECT sec, min(d) AS a, max(d) AS b FROM bars GROUP BY 1) SELECT life.sec, count(*) AS gaps FROM life JOIN cal ON cal.d BETWEEN a AND b ANTI JOIN bars ON bars.sec = life.sec AND bars.d = cal.d GROUP BY 1")
def _(spark, sf):
    b = bars(spark, sf).select("sec", "d")
    life = b.groupBy("sec").agg(F.min("d").alias("a"), F.date_add(F.max("d"), 1).alias("b"))
    return joins.skeleton(calendar(spark, sf), life, "sec", "a", "b").join(b, ["sec", "d"], "left_anti").groupBy("sec").agg(F.count("*").alias("gaps"))


@query("qa8_ranges", "SELECT 'discount' AS rule, count(*) AS bad FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.05 UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def _(spark, sf):
    bad = lambda df, rule, p: df.where(p).agg(F.count("*").alias("bad")).select(F.lit(rule).alias("rule"), "bad")
    return bad(table(spark, sf, "lineitem"), "discount", ~F.col("l_discount").between(0, 0.05)).union(bad(table(spark, sf, "orders"), "status", ~F.col("o_orderstatus").isin("O", "F")))


@query("str_windowed_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts)::VARCHAR AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def _(spark, sf):
    return stream.windowed_counts_of_files(spark, sf).select(F.col("start").cast("timestamp_ntz").cast("string").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))
