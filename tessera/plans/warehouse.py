"""Masters, facts, samples, panels and writers over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import log_positive, rounded, safe_divide
from ..operators import calendar as cal_
from ..operators import joins, panel
from ..operators import warehouse as wh
from ..sources.tables import shared_dir, table
from . import market
from .market import BARS, CAL, bars, calendar, query


def day(text: str):
    return F.lit(text).cast("date")


@query(
    "d2_security_master",
    f"""WITH {BARS}, s AS (SELECT s_suppkey AS sec, s_name AS name FROM supplier WHERE s_suppkey % 10 <> 3), life AS (SELECT sec, min(d) AS a, max(d) AS z FROM bars WHERE sec % 7 <> 1 OR d < DATE '2001-06-01' GROUP BY 1), e AS (SELECT max(d) AS e FROM bars)
    SELECT coalesce(s.sec, life.sec) AS sec, coalesce(name, 'derived ' || life.sec) AS name, a AS list_date, CASE WHEN z < e - 30 THEN z + 1 END AS delist_date,
    CASE WHEN z IS NULL THEN 'P' WHEN z < e - 30 THEN 'D' ELSE 'L' END AS status, CASE WHEN name IS NULL THEN 'derived' ELSE 'snapshot' END AS origin FROM s FULL JOIN life ON s.sec = life.sec, e""",
)
def _(spark, sf):
    """Snapshots lack a tenth of the names and come twice; some names stop trading early."""
    b = bars(spark, sf).select("sec", "d")
    seen = b.where((F.col("sec") % 7 != 1) | (F.col("d") < day("2001-06-01")))
    s = table(spark, sf, "supplier").where("s_suppkey % 10 <> 3").select(F.col("s_suppkey").alias("sec"), F.explode(F.array(F.struct(day("2000-01-01").alias("asof"), F.lit("old").alias("name")), F.struct(day("2001-01-01").alias("asof"), F.col("s_name").alias("name")))).alias("x")).select("sec", "x.*")
    end = b.agg(F.max("d").alias("_end"))  # one row
    m = wh.security_master(s, seen.crossJoin(F.broadcast(end)).select("sec", "d"), F.lit(end.first()[0]))
    return m.select("sec", "name", "list_date", "delist_date", "status", "origin")


INDEXES = [("000", "AFRICA"), ("001", "AMERICA"), ("002", "ASIA"), ("003", "EUROPE"), ("004", "MIDDLE EAST"), ("999", "NOWHERE")]


@query(
    "d4_index_map",
    "WITH i(code, r) AS (VALUES " + ", ".join(f"('{c}', '{r}')" for c, r in INDEXES) + """), daily AS (SELECT r_name, min(l_shipdate::DATE) AS a, max(l_shipdate::DATE) AS z, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
    base AS (SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
    SELECT code, i.r AS name, a AS first_day, z AS last_day, concat_ws(';', CASE WHEN daily.n > 0 THEN 'daily' END, CASE WHEN base.n > 0 THEN 'members' END) AS endpoints FROM i LEFT JOIN daily ON i.r = daily.r_name LEFT JOIN base ON i.r = base.r_name""",
)
def _(spark, sf):
    """Inline constants beside what each endpoint has of them; regions are five."""
    place = F.broadcast(table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"))
    of = table(spark, sf, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_name")
    by_name = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("z"))
    daily = by_name.join(of, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("r_name").alias("name")).agg(F.min("a").alias("first_day"), F.max("z").alias("last_day"))
    base = table(spark, sf, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("members"))
    i = spark.createDataFrame(INDEXES, "code string, name string")
    x = i.join(daily, "name", "left").join(base, "name", "left")
    has = F.array_compact(F.array(F.when(F.col("first_day").isNotNull(), "daily"), F.when(F.col("members") > 0, "members")))
    return x.select("code", "name", "first_day", "last_day", F.array_join(has, ";").alias("endpoints"))


@query("d6_valuation_fact", "SELECT o_orderkey, o_orderdate::DATE AS d, o_totalprice AS price_raw, round(o_totalprice / 10000, 6) AS price_10k, CASE WHEN o_totalprice > 0 THEN round(1 / o_totalprice * 1000000, 6) END AS yield_ppm FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01' AND o_totalprice BETWEEN 50000 AND 300000")
def _(spark, sf):
    """A date range and a value range, both pushed to the scan; units changed beside the raw column (D6, FLT1, PRJ1-PRJ3)."""
    o = table(spark, sf, "orders").where((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")) & F.col("o_totalprice").between(50000, 300000))
    x = o.select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("price_raw"), F.round(F.col("o_totalprice") / 10000, 6).alias("price_10k"), "o_orderpriority")
    return x.withColumn("yield_ppm", F.when(F.col("price_raw") > 0, F.round(1 / F.col("price_raw") * 1000000, 6))).drop("o_orderpriority")


@query("prj3_all_columns_but_one", "SELECT * EXCLUDE (o_orderpriority, o_orderstatus) REPLACE (o_orderdate::DATE AS o_orderdate) FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").drop("o_orderpriority", "o_orderstatus").withColumn("o_orderdate", F.to_date("o_orderdate"))


REGION_DAYS = "reg AS (SELECT r_name, l_shipdate::DATE AS d, round(sum(l_extendedprice), 2) AS amount, sum(l_quantity) AS volume FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2), idx AS (SELECT r_name, d, amount, (round(amount * 100)::BIGINT // volume::BIGINT) / 100.0::DOUBLE AS close FROM reg)"


def region_days(spark, sf):
    """amount and close of each region and day, from bars, which are fewer than lines."""
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    of = table(spark, sf, "supplier").join(F.broadcast(place), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("sec"), "r_name")  # 25 nations
    x = bars(spark, sf).join(of, "sec").groupBy("r_name", "d").agg(F.round(F.sum("amount"), 2).alias("amount"), F.sum("volume").alias("volume"))
    return x.withColumn("close", F.expr("cast(round(amount * 100) as bigint) div cast(volume as bigint)") / F.lit(100.0)).drop("volume")


@query("d7_index_eod", f"WITH {REGION_DAYS} SELECT r_name, d, amount, close, lag(close) OVER w AS pre_close, round(close / lag(close) OVER w - 1, 6) AS pct FROM idx WINDOW w AS (PARTITION BY r_name ORDER BY d)")
def _(spark, sf):
    w = Window.partitionBy("r_name").orderBy("d")
    x = region_days(spark, sf).withColumn("pre_close", F.lag("close").over(w))
    return x.withColumn("pct", F.round(safe_divide("close", "pre_close") - 1, 6))


SOURCES = [("income", "1-URGENT"), ("balance", "2-HIGH"), ("cash", "3-MEDIUM"), ("indicator", "5-LOW")]
PIT = "facts AS (SELECT CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{s}'" for s, p in SOURCES) + " END AS source, o_custkey AS c, date_trunc('month', o_orderdate)::DATE AS period, o_orderdate::DATE AS ann, o_orderkey AS key, o_totalprice AS value FROM orders WHERE o_orderpriority IN (" + ", ".join(f"'{p}'" for _, p in SOURCES) + "))"


def facts(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c"), F.trunc("o_orderdate", "month").alias("period"), F.to_date("o_orderdate").alias("ann"), F.col("o_orderkey").alias("key"), "o_totalprice", "o_orderpriority")
    return wh.pit_facts(o, [wh.PitSource(s, F.col("o_orderpriority") == p, F.col("o_totalprice")) for s, p in SOURCES])


@query("d8_pit_latest", f"WITH {PIT} SELECT source, c, period, ann, key, value FROM facts QUALIFY row_number() OVER (PARTITION BY source, c, period ORDER BY ann DESC, key DESC) = 1")
def _(spark, sf):
    """Four sources from one scan, one generic function."""
    return wh.pit_latest(facts(spark, sf)).select("source", "c", "period", "ann", "key", "value")


GRID = "grid AS (SELECT c_custkey AS c, make_date(y, 6, 30) AS d FROM customer, (VALUES (1997), (1999), (2001)) t(y))"


def features_sql(s: str) -> str:
    return f"""{s}_b AS (SELECT g.c, g.d, f.period, f.ann, f.value FROM grid g JOIN facts f ON f.source = '{s}' AND f.c = g.c AND f.ann <= g.d AND f.ann >= g.d - 900 QUALIFY row_number() OVER (PARTITION BY g.c, g.d ORDER BY f.period DESC, f.ann DESC, f.key DESC) = 1),
    {s}_x AS (SELECT b.c, b.d, b.value, b.d - b.ann AS age, p.value AS v FROM {s}_b b LEFT JOIN facts p ON p.source = '{s}' AND p.c = b.c AND p.period = b.period - INTERVAL 12 MONTH AND p.ann <= b.d QUALIFY row_number() OVER (PARTITION BY b.c, b.d ORDER BY p.ann DESC NULLS LAST, p.key DESC NULLS LAST) = 1)"""


@query(
    "d15_pit_features",
    f"WITH {PIT}, {GRID}, " + ", ".join(features_sql(s) for s, _ in SOURCES) + " SELECT g.c, g.d, " + ", ".join(f"{s}_x.value AS {s}_value, {s}_x.age::INTEGER AS {s}_age, round({s}_x.value / NULLIF({s}_x.v, 0) - 1, 6) AS {s}_growth" for s, _ in SOURCES) + " FROM grid g " + " ".join(f"LEFT JOIN {s}_x ON {s}_x.c = g.c AND {s}_x.d = g.d" for s, _ in SOURCES),
)
def _(spark, sf):
    years = F.explode(F.array(*(F.make_date(F.lit(y), F.lit(6), F.lit(30)) for y in (1997, 1999, 2001))))
    grid = table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), years.alias("d"))
    return rounded(wh.pit_features(grid, facts(spark, sf), [s for s, _ in SOURCES]), 6)


FIVE = f"""x AS (SELECT b.*, row_number() OVER w AS age, avg(amount) OVER (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS liq, close / lag(close) OVER w - 1 AS ret, s_nationkey FROM bars b JOIN supplier ON s_suppkey = sec WINDOW w AS (PARTITION BY sec ORDER BY d)),
  m AS (SELECT sec, d, age > 60 AS pass_age, liq > 30000 AS pass_liquid, close >= 900 AS pass_price, ret IS NULL OR ret > -0.095 AS pass_limit, s_nationkey % 9 <> 4 AS pass_board FROM x)"""


def five_masks(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), "s_nationkey")
    x = panel.gap_return(panel.rolling(bars(spark, sf), "sec", "d", {"liq": ("avg", "amount", 20)}), "sec", "d", "close").withColumn("age", F.row_number().over(Window.partitionBy("sec").orderBy("d"))).join(s, "sec")
    return x.select("sec", "d", "close", "amount", "ret", (F.col("age") > 60).alias("pass_age"), (F.col("liq") > 30000).alias("pass_liquid"), (F.col("close") >= 900).alias("pass_price"), (F.col("ret").isNull() | (F.col("ret") > -0.095)).alias("pass_limit"), (F.col("s_nationkey") % 9 != 4).alias("pass_board"))


MASKS = [f"pass_{k}" for k in ("age", "liquid", "price", "limit", "board")]


@query("d10_five_masks", f"WITH {BARS}, {FIVE} SELECT *, pass_age AND pass_liquid AND pass_price AND pass_limit AND pass_board AS in_universe FROM m")
def _(spark, sf):
    """Masks are given out, not filtered by; their conjunction is the universe."""
    return five_masks(spark, sf).select("sec", "d", *MASKS, F.expr(" and ".join(MASKS)).alias("in_universe"))


HORIZONS = (1, 5, 10, 20)


@query(
    "d13_labels_by_horizon",
    f"WITH {BARS}, {CAL}, {FIVE}, u AS (SELECT sec, d FROM m WHERE pass_age AND pass_liquid), l AS (" + " UNION ALL ".join(f"SELECT {h}::BIGINT AS h, b.sec, b.d, f.close / e.close - 1 AS fwd FROM bars b JOIN cal c ON b.d = c.d JOIN cal c1 ON c1.seq = c.seq + 1 JOIN bars e ON e.sec = b.sec AND e.d = c1.d JOIN cal ch ON ch.seq = c.seq + {h} JOIN bars f ON f.sec = b.sec AND f.d = ch.d" for h in HORIZONS) + """),
    y AS (SELECT l.*, u.sec IS NOT NULL AS in_u FROM l LEFT JOIN u ON l.sec = u.sec AND l.d = u.d), z AS (SELECT *, avg(CASE WHEN in_u THEN fwd END) OVER (PARTITION BY h, d) AS mean, CASE WHEN in_u THEN round(percent_rank() OVER (PARTITION BY h, d, in_u ORDER BY fwd), 6) END AS pct FROM y)
    SELECT h, count(*) AS n, count(*) FILTER (in_u) AS in_universe, round(avg(fwd), 6) AS fwd, round(avg(fwd - mean), 6) AS excess, count(*) FILTER (pct >= 0.7) AS top30, count(*) FILTER (pct > 0.5) AS above FROM z GROUP BY h""",
)
def _(spark, sf):
    """Labels of all horizons from one read of bars; the excess is over the universe's mean on every row, ranks are the universe's."""
    b = five_masks(spark, sf).join(joins.small(calendar(spark, sf).select("d", "seq")), "d").withColumn("in_u", F.col("pass_age") & F.col("pass_liquid"))
    on = lambda k: F.max("close").over(Window.partitionBy("sec").orderBy("seq").rangeBetween(k, k))
    x = b.withColumn("entry", on(1)).withColumns({f"e{h}": on(h) for h in HORIZONS})
    x = x.select("sec", "d", "in_u", F.inline(F.array(*(F.struct(F.lit(h).cast("long").alias("h"), (safe_divide(f"e{h}", "entry") - 1).alias("fwd")) for h in HORIZONS)))).where("fwd is not null")
    w = Window.partitionBy("h", "d")
    x = x.withColumn("excess", F.col("fwd") - F.avg(F.when(F.col("in_u"), F.col("fwd"))).over(w)).withColumn("pct", F.when(F.col("in_u"), F.round(F.percent_rank().over(Window.partitionBy("h", "d", "in_u").orderBy("fwd")), 6)))
    return rounded(x.groupBy("h").agg(F.count("*").alias("n"), F.count_if("in_u").alias("in_universe"), F.avg("fwd").alias("fwd"), F.avg("excess").alias("excess"), F.count_if(F.col("pct") >= 0.7).alias("top30"), F.count_if(F.col("pct") > 0.5).alias("above")), 6)


SAMPLE = f"""{FIVE}, f AS (SELECT sec, d, close / lag(close, 5) OVER w - 1 AS ret_5, CASE WHEN amount > 0 THEN ln(amount) END AS log_amount, amount FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d)),
  l AS (SELECT b.sec, b.d, g.close / e.close - 1 AS fwd FROM bars b JOIN cal c ON b.d = c.d JOIN cal c1 ON c1.seq = c.seq + 1 JOIN bars e ON e.sec = b.sec AND e.d = c1.d JOIN cal c5 ON c5.seq = c.seq + 5 JOIN bars g ON g.sec = b.sec AND g.d = c5.d),
  sample AS (SELECT m.sec, m.d, m.pass_age AND m.pass_liquid AS in_universe, CASE WHEN amount > 20000 THEN ret_5 END AS ret_5, log_amount, amount, fwd FROM m LEFT JOIN f ON f.sec = m.sec AND f.d = m.d LEFT JOIN l ON l.sec = m.sec AND l.d = m.d)"""


def sample(spark, sf):
    """Masks, features and labels of each name and day, from bars that are read and dealt to names once."""
    x = panel.lags(five_masks(spark, sf), "sec", "d", "close", (5,))
    x = market.forward(spark, sf, x)
    return x.select("sec", "d", (F.col("pass_age") & F.col("pass_liquid")).alias("in_universe"), F.when(F.col("amount") > 20000, safe_divide("close", "close_lag5") - 1).alias("ret_5"), log_positive("amount").alias("log_amount"), "amount", "fwd")


@query("d14_sample_assembly", f"WITH {BARS}, {CAL}, {SAMPLE} SELECT sec, d, in_universe, round(ret_5, 6) AS ret_5, round(log_amount, 5) AS log_amount, amount, round(fwd, 6) AS fwd FROM sample")
def _(spark, sf):
    x = sample(spark, sf)
    return x.select("sec", "d", "in_universe", F.round("ret_5", 6).alias("ret_5"), F.round("log_amount", 5).alias("log_amount"), "amount", F.round("fwd", 6).alias("fwd"))


@query(
    "d18_training_panel",
    f"""WITH {BARS}, {CAL}, {SAMPLE}, n AS (SELECT *, row_number() OVER w AS i, max(CASE WHEN ret_5 IS NOT NULL THEN 1 END) OVER w AS any_r FROM sample WINDOW w AS (PARTITION BY sec ORDER BY d)), k AS (SELECT *, max(CASE WHEN ret_5 IS NOT NULL THEN i END) OVER (PARTITION BY sec ORDER BY d) AS at FROM n),
    h AS (SELECT k.sec, k.d, k.fwd, k.log_amount, k.amount, o.ret_5 FROM k LEFT JOIN n o ON o.sec = k.sec AND o.i = k.at AND k.i - k.at <= 5)
    SELECT sec, d, round(ret_5, 5) AS ret_5, round(ret_5 * log_amount, 4) AS ret_by_size, round(1 + 2 * (amount - min(amount) OVER w) / NULLIF(max(amount) OVER w - min(amount) OVER w, 0), 4) AS weight FROM h WHERE fwd IS NOT NULL WINDOW w AS (PARTITION BY d)""",
)
def _(spark, sf):
    x = wh.training_panel(sample(spark, sf), "sec", "d", "fwd", ["ret_5"], {"ret_by_size": ("ret_5", "log_amount")}, "amount")
    return x.select("sec", "d", F.round("ret_5", 5).alias("ret_5"), F.round("ret_by_size", 4).alias("ret_by_size"), F.round("weight", 4).alias("weight"))


@query(
    "d16_market_state_versions",
    f"""WITH {BARS}, {REGION_DAYS}, p AS (SELECT d, max(close) FILTER (r_name = 'ASIA') AS asia, max(close) FILTER (r_name = 'EUROPE') AS europe FROM idx GROUP BY d),
    t AS (SELECT *, avg(asia) OVER (ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS asia_20, avg(europe) OVER (ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS europe_60 FROM p),
    r AS (SELECT sec, d, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars), b AS (SELECT d, count(ret) AS n, count(*) FILTER (ret > 0) AS up, count(*) FILTER (ret <= -0.095) AS down FROM r GROUP BY d),
    s AS (SELECT b.*, sum(down) OVER v AS down_5, sum(n) OVER v AS n_5, asia >= round(asia_20, 6) AS asia_up, europe >= round(europe_60, 6) AS europe_up FROM b LEFT JOIN t ON b.d = t.d WINDOW v AS (ORDER BY b.d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    SELECT version, d, round(up / NULLIF(n, 0)::DOUBLE, 4) AS breadth, round(down_5 / NULLIF(n_5, 0)::DOUBLE, 4) AS diffusion, coalesce(asia_up, false)::INTEGER + coalesce(europe_up, false)::INTEGER AS trends,
    CASE WHEN n = 0 THEN 'unknown' WHEN down_5 / n_5::DOUBLE > CASE version WHEN 'v1' THEN 0.45 ELSE 0.4 END AND NOT coalesce(asia_up, false) THEN 'risk_off' WHEN up / n::DOUBLE > 0.5 AND (version = 'v1' OR coalesce(europe_up, false)) THEN 'risk_on' ELSE 'neutral' END AS regime FROM s, (VALUES ('v1'), ('v2')) q(version)""",
)
def _(spark, sf):
    """Trends of pivoted indexes, breadth, and how far falls spread over five days, as regimes under two versions."""
    p = region_days(spark, sf).groupBy("d").pivot("r_name", ["ASIA", "EUROPE"]).agg(F.max("close"))
    rows = lambda n: Window.orderBy("d").rowsBetween(-(n - 1), 0)  # noqa: E731  a row a day
    t = p.select("d", (F.col("ASIA") >= F.round(F.avg("ASIA").over(rows(20)), 6)).alias("asia_up"), (F.col("EUROPE") >= F.round(F.avg("EUROPE").over(rows(60)), 6)).alias("europe_up"))
    b = panel.gap_return(bars(spark, sf), "sec", "d", "close").groupBy("d").agg(F.count("ret").alias("n"), F.count_if(F.col("ret") > 0).alias("up"), F.count_if(F.col("ret") <= -0.095).alias("down"))
    x = b.withColumns({"down_5": F.sum("down").over(rows(5)), "n_5": F.sum("n").over(rows(5))}).join(t, "d", "left").fillna(False, ["asia_up", "europe_up"])
    x = x.withColumn("version", F.explode(F.array(F.lit("v1"), F.lit("v2"))))
    first = F.col("version") == "v1"
    off = (safe_divide("down_5", "n_5") > F.when(first, 0.45).otherwise(0.4)) & ~F.col("asia_up")
    on = (safe_divide("up", "n") > 0.5) & (first | F.col("europe_up"))
    return x.select("version", "d", F.round(safe_divide("up", "n"), 4).alias("breadth"), F.round(safe_divide("down_5", "n_5"), 4).alias("diffusion"), (F.col("asia_up").cast("int") + F.col("europe_up").cast("int")).alias("trends"), F.when(F.col("n") == 0, "unknown").when(off, "risk_off").when(on, "risk_on").otherwise("neutral").alias("regime"))


@query("d11_momentum_and_zscore", f"WITH {BARS}, x AS (SELECT sec, d, close, lag(close, 60) OVER w AS c60, lag(close, 5) OVER w AS c5, avg(close) OVER r AS m, stddev_samp(close) OVER r AS s, max(amount) OVER r AS hi FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d), r AS (PARTITION BY sec ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) SELECT sec, d, round(c5 / c60 - 1, 6) AS mom_60_5, round((close - m) / NULLIF(s, 0), 4) AS z_20, hi AS amount_high FROM x WHERE c60 IS NOT NULL")
def _(spark, sf):
    x = panel.lags(bars(spark, sf), "sec", "d", "close", (5, 60))
    x = panel.rolling(x, "sec", "d", {"m": ("avg", "close", 20), "s": ("std", "close", 20), "hi": ("max", "amount", 20)}).where("close_lag60 is not null")
    return x.select("sec", "d", F.round(safe_divide("close_lag5", "close_lag60") - 1, 6).alias("mom_60_5"), F.round(safe_divide(F.col("close") - F.col("m"), "s"), 4).alias("z_20"), F.col("hi").alias("amount_high"))


@query("prj11_switched_column", f"WITH {BARS}, x AS (SELECT sec, d, lag(close, 1) OVER w AS h_1, lag(close, 5) OVER w AS h_5 FROM bars WINDOW w AS (PARTITION BY sec ORDER BY d)) SELECT p.h, count(CASE p.h WHEN 1 THEN h_1 WHEN 5 THEN h_5 END) AS known FROM x, (VALUES (1), (5), (7)) p(h) GROUP BY 1")
def _(spark, sf):
    """The column that a parameter names; an unknown parameter gives nulls."""
    x = panel.lags(bars(spark, sf), "sec", "d", "close", (1, 5))
    columns = {1: F.col("close_lag1"), 5: F.col("close_lag5")}
    known = x.agg(*(F.count(columns.get(h, F.lit(None))).alias(f"{h}") for h in (1, 5, 7)))
    return known.select(F.inline(F.array(*(F.struct(F.lit(h).alias("h"), F.col(f"{h}").alias("known")) for h in (1, 5, 7)))))


@query("jn17_rank_expansion", f"WITH {BARS}, r AS (SELECT d, sec, row_number() OVER (PARTITION BY d ORDER BY amount DESC, sec) AS rk FROM bars) SELECT cfg.name, count(*) AS picks, count(DISTINCT sec) AS names FROM r JOIN (VALUES ('few', 2), ('some', 5), ('many', 10)) cfg(name, target) ON rk <= cfg.target GROUP BY 1")
def _(spark, sf):
    cfg = spark.createDataFrame([("few", 2), ("some", 5), ("many", 10)], "name string, target int")
    r = panel.xs_rank(bars(spark, sf), "d", "amount", "row", "sec", "rk").where("rk <= 10")
    return r.join(F.broadcast(cfg), F.col("rk") <= F.col("target")).groupBy("name").agg(F.count("*").alias("picks"), F.count_distinct("sec").alias("names"))


@query("jn18_first_day_after", f"WITH {CAL}, q AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders) SELECT o_orderkey, (SELECT min(cal.d) FROM cal WHERE cal.d > q.d) AS after FROM q")
def _(spark, sf):
    q = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return cal_.next_open(q, calendar(spark, sf), "d", "after", inclusive=False).select("o_orderkey", "after")


@query("jn23_one_to_one", "SELECT c_custkey, n, total FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a JOIN (SELECT c_custkey, round(c_acctbal, 2) AS total FROM customer) b ON a.o_custkey = b.c_custkey")
def _(spark, sf):
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return wh.one_to_one(a, table(spark, sf, "customer").select("c_custkey", F.round("c_acctbal", 2).alias("total")), ["c_custkey"])


@query("sr2_recent_runs", "SELECT event_id, ts::VARCHAR AS ts, event_type FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50)")
def _(spark, sf):
    """The 50 latest: a top-k, kept by each task and merged."""
    e = table(spark, sf, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(50)
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_type").withColumn("ts", F.regexp_replace(F.regexp_replace("ts", r"(\.\d*?)0+$", "$1"), r"\.$", ""))


@query("snk6_merge_warnings", "WITH w AS (SELECT n_nationkey AS k, CASE WHEN count(c_custkey) < 3 THEN 'few' END AS warning FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1) SELECT n_nationkey AS k, CASE WHEN warning IS NULL THEN 'ok' ELSE warning END AS status FROM nation LEFT JOIN w ON k = n_nationkey")
def _(spark, sf):
    status = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.lit("ok").alias("status"))
    n = table(spark, sf, "nation").join(table(spark, sf, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy(F.col("n_nationkey").alias("k")).agg(F.count("c_custkey").alias("n"))
    return joins.merge_upsert(status, n.where("n < 3").select("k", F.lit("few").alias("status")), ["k"], ["status"])


def _content(cols: str, table_: str) -> str:
    """SQL of a table's content hash: hashes of its rows as JSON, added in eight parts, whatever their order."""
    parts = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(8))
    return f"SELECT count(*) AS rows, sha256(concat_ws(',', {parts})) AS sha256 FROM (SELECT sha256({cols}) AS h FROM {table_})"


_NATION = "'{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}'"
_ORDERS = "'{\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}'"


@query("snk8_content_hashes", " UNION ALL ".join(f"SELECT '{n}' AS name, * FROM ({_content(c, t)})" for n, c, t in (("nation", _NATION, "nation"), ("orders", _ORDERS, "orders"), ("orders shuffled", _ORDERS, "orders"), ("one order changed", _ORDERS, "(SELECT * REPLACE (CASE WHEN o_orderkey = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders)"))))
def _(spark, sf):
    """The hash of a table's content follows from its rows alone: shuffled they give it again, one changed value another."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == 1, "X").otherwise(F.col("o_orderstatus")))
    out = wh.manifest(table(spark, sf, "nation"), "nation")
    for name, df in (("orders", o), ("orders shuffled", o.repartition(7, "o_custkey")), ("one order changed", changed)):
        out = out.unionByName(wh.manifest(df, name))
    return out.select("name", "rows", "sha256")


@query("snk8_manifest", "SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'nation', count(*) FROM nation")
def _(spark, sf):
    return wh.manifest(table(spark, sf, "orders"), "orders").unionByName(wh.manifest(table(spark, sf, "nation"), "nation")).select("name", "rows")


@query("snk10_lossy_casts", "SELECT 'o_custkey' AS \"column\", 0::BIGINT AS lossy UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice <> floor(o_totalprice)) FROM orders")
def _(spark, sf):
    return wh.lossy_casts(table(spark, sf, "orders"), {"o_orderkey": "long", "o_custkey": "double", "o_totalprice": "long"})


@query(
    "qa10_schema_check",
    """WITH have AS (SELECT column_name AS c, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' ELSE column_type END AS t FROM (DESCRIBE nation)), want(c, t) AS (VALUES ('n_nationkey', 'bigint'), ('n_name', 'string'), ('gone', 'string'))
    SELECT coalesce(have.c, want.c) AS "column", want.t AS expected, have.t AS actual, CASE WHEN have.c IS NULL THEN 'missing' WHEN want.c IS NULL THEN 'extra' WHEN have.t = want.t THEN 'ok' ELSE 'cast' END AS state FROM have FULL JOIN want ON have.c = want.c""",
)
def _(spark, sf):
    return wh.schema_diff(table(spark, sf, "nation"), {"n_nationkey": "long", "n_name": "string", "gone": "string"})


TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@query("qa15_source_readability", " UNION ALL ".join(f"SELECT '{t}' AS source, count(*) > 0 AS readable FROM {t}" for t in TABLES))
def _(spark, sf):
    each = [table(spark, sf, t).limit(1).agg(F.count("*").alias("n")).select(F.lit(t).alias("source"), (F.col("n") > 0).alias("readable")) for t in TABLES]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out


@query("src6_lineage", "SELECT o_orderkey, 'orders' AS _source, 'run-1' AS _run_id, TIMESTAMP '2024-01-02 03:04:05' AS _ingested_at, '{\"limit\":5000,\"offset\":0}' AS _params FROM orders")
def _(spark, sf):
    return wh.lineage(table(spark, sf, "orders").select("o_orderkey"), "orders", "run-1", "2024-01-02 03:04:05", {"offset": 0, "limit": 5000})


@query("pr9_json_patch", "SELECT event_id, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN NULL ELSE '2' END AS version, json_extract_string(props, '$.k') AS kept FROM events")
def _(spark, sf):
    x = table(spark, sf, "events").withColumn("p", wh.json_patch("props", {"version": "2"}, ("gone",)))
    k = F.get_json_object("p", "$.k")
    return x.select("event_id", F.when(k.isNotNull(), F.get_json_object("p", "$.version")).alias("version"), k.alias("kept"))


@query("pr6_view", "SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1")
def _(spark, sf):
    """A view is a name for a plan."""
    name = f"high_events_{uuid.uuid4().hex}"
    table(spark, sf, "events").where("value > 50").createOrReplaceTempView(name)
    return spark.sql(f"SELECT event_type, count(*) AS n FROM {name} GROUP BY event_type")


@query("fn_strings_and_patterns", "SELECT p_partkey, lower(trim(concat('  ', p_name, ' '))) AS name, replace(p_brand, 'Brand#', 'B') AS brand, length(p_name) AS size, substr(p_type, 1, 3) AS head, p_name LIKE '%ring%' AS ring, regexp_matches(p_type, '^(ECONOMY|SMALL)') AS plain, regexp_extract(p_brand, '#([0-9]+)', 1) AS number, regexp_replace(p_name, '[aeiou]', '', 'g') AS bare FROM part")
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.lower(F.trim(F.concat(F.lit("  "), "p_name", F.lit(" ")))).alias("name"), F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("brand"), F.length("p_name").cast("long").alias("size"), F.substring("p_type", 1, 3).alias("head"), F.col("p_name").like("%ring%").alias("ring"), F.col("p_type").rlike("^(ECONOMY|SMALL)").alias("plain"), F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("number"), F.regexp_replace("p_name", "[aeiou]", "").alias("bare"))


@query("fn_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS text, try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d')::DATE AS parsed, (o_orderdate::DATE + 45) AS later, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS days, date_trunc('quarter', o_orderdate)::DATE AS quarter, isoyear(o_orderdate) AS iso_year, weekofyear(o_orderdate) AS iso_week, (o_orderdate - INTERVAL 90 MINUTE)::VARCHAR AS before FROM orders")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    text = F.date_format("o_orderdate", "yyyyMMdd")
    before = F.date_format(F.col("o_orderdate") - F.expr("INTERVAL 90 MINUTES"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", text.alias("text"), F.to_date(text, "yyyyMMdd").alias("parsed"), F.date_add(d, 45).alias("later"), F.datediff(d, day("1995-01-01")).cast("long").alias("days"), F.trunc(d, "quarter").alias("quarter"), F.extract(F.lit("YEAROFWEEK"), d).cast("long").alias("iso_year"), F.weekofyear(d).cast("long").alias("iso_week"), before.alias("before"))


@query("fn_arrays_and_json", "SELECT o_orderkey, array_to_string(list_sort(list_distinct([o_orderstatus, o_orderpriority, o_orderstatus])), '|') AS kinds, list_max([o_orderkey % 7, o_custkey % 7]) AS most, ([o_orderkey % 7, o_custkey % 7])[2] AS second, '{\"key\":' || o_orderkey || ',\"status\":\"' || o_orderstatus || '\"}' AS written FROM orders")
def _(spark, sf):
    pair = F.array(F.col("o_orderkey") % 7, F.col("o_custkey") % 7)
    kinds = F.array_sort(F.array_distinct(F.array("o_orderstatus", "o_orderpriority", "o_orderstatus")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(kinds, "|").alias("kinds"), F.array_max(pair).alias("most"), F.element_at(pair, 2).alias("second"), F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))).alias("written"))


@query("str_missing_followers", "SELECT a.event_id FROM events a WHERE a.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 2 DAY)")
def _(spark, sf):
    """Views that no purchase of the user follows within two days: the next purchase by one window over the user's events."""
    e = table(spark, sf, "events").where(F.col("event_type").isin("view", "purchase")).select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    ahead = Window.partitionBy("user_id").orderBy("t").rangeBetween(1, 2 * 86_400_000_000)
    return e.withColumn("n", F.count(F.when(F.col("event_type") == "purchase", 1)).over(ahead)).where("event_type = 'view' and n = 0").select("event_id")
