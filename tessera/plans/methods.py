"""Rolling folds, least squares by group, one-to-one matching and digest trees over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, matching, panel, regress
from ..operators import diagnosis as dx
from ..sources.tables import table
from .market import BARS, bars, query
from .warehouse import REGION_DAYS, region_days

STEPS = "list_reduce(list_transform(list(close) OVER (PARTITION BY r_name ORDER BY d ROWS BETWEEN 755 PRECEDING AND CURRENT ROW), lambda v: {'peak': v, 'worst': 0.0::DOUBLE}), lambda s, v: {'peak': greatest(s.peak, v.peak), 'worst': least(s.worst, v.peak / greatest(s.peak, v.peak) - 1)})"


@query("wn24_rolling_drawdown_756", f"WITH {REGION_DAYS} SELECT r_name, d, CASE WHEN row_number() OVER (PARTITION BY r_name ORDER BY d) >= 756 THEN round({STEPS}.worst, 6) END AS drawdown FROM idx")
def _(spark, sf):
    """The deepest drawdown inside the last three years of each index."""
    x = dx.rolling_drawdown(region_days(spark, sf), "r_name", "d", "close", 756, "drawdown")
    return x.select("r_name", "d", F.round("drawdown", 6).alias("drawdown"))


def sized(spark, sf):
    """Bars with the log of their amount and the nation of their supplier."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_nationkey").alias("nation"))
    return bars(spark, sf).withColumns({"size": F.log("amount"), "span": F.col("high") / F.col("low") - 1}).join(s, "sec")


SIZED = f"{BARS}, m AS (SELECT sec, d, s_nationkey AS nation, close, ln(amount) AS size, high / low - 1 AS span FROM bars JOIN supplier ON s_suppkey = sec)"


@query(
    "d48_neutralize_industry",
    f"""WITH {SIZED}, w AS (SELECT *, close - avg(close) OVER g AS y, size - avg(size) OVER g AS x, count(*) OVER (PARTITION BY d) AS n FROM m WINDOW g AS (PARTITION BY d, nation)),
    b AS (SELECT d, sum(x * y) / NULLIF(sum(x * x), 0) AS b FROM w WHERE n >= 10 GROUP BY d HAVING sum(x * x) > 1e-12) SELECT sec, w.d, round(y - b * x, 4) AS residual FROM w JOIN b ON w.d = b.d""",
)
def _(spark, sf):
    """What size and nation leave of a price, day by day; days on which size doesn't vary within nations are left out."""
    x = sized(spark, sf)
    fits = regress.grouped_ols(x, "d", "close", ["size"], "nation").where("rank = 1").select("d")
    return regress.residuals(x.join(fits, "d", "left_semi"), "d", "close", ["size"], "residual", "nation", least=10).select("sec", "d", F.round("residual", 4).alias("residual"))


@query(
    "d57_standardised_coefficients",
    f"""WITH {SIZED}, z AS (SELECT d, close, (size - avg(size) OVER w) / NULLIF(stddev_pop(size) OVER w, 0) AS x, (span - avg(span) OVER w) / NULLIF(stddev_pop(span) OVER w, 0) AS z FROM m WINDOW w AS (PARTITION BY d)),
    s AS (SELECT d, count(*) AS n, covar_pop(x, close) AS xy, covar_pop(z, close) AS zy, covar_pop(x, z) AS xz FROM z WHERE x IS NOT NULL AND z IS NOT NULL GROUP BY d)
    SELECT d, n, round((xy - xz * zy) / (1 - xz * xz), 3) AS size, round((zy - xz * xy) / (1 - xz * xz), 3) AS span FROM s WHERE n >= 5 AND 1 - xz * xz > 1e-6""",
)
def _(spark, sf):
    """Coefficients of two standardised factors taken together, day by day."""
    fits = regress.grouped_ols(regress.standardised(sized(spark, sf), "d", ["size", "span"]), "d", "close", ["size", "span"])
    got = lambda i, name: F.round(F.get("coefficients", F.lit(i)), 3).alias(name)
    return fits.where("n >= 5 and rank = 2").select("d", "n", got(0, "size"), got(1, "span"))


@query(
    "d67_interval_matching",
    f"""WITH {BARS}, j AS (SELECT sec, row_number() OVER (PARTITION BY sec ORDER BY d) AS id, d, size FROM (SELECT sec, d, round(close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1, 6) AS size FROM bars) WHERE abs(size) > 0.3),
    a AS (SELECT sec, row_number() OVER (PARTITION BY sec ORDER BY d) AS id, d, size FROM (SELECT l_suppkey AS sec, l_shipdate::DATE AS d, round(max(l_tax) * 10 - 0.4, 6) AS size FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1, 2)),
    c AS (SELECT a.sec, a.id AS x, j.id AS y, abs(a.d - j.d) AS far, abs(a.size - j.size) AS off FROM a JOIN j ON a.sec = j.sec AND abs(a.d - j.d) <= 5 AND abs(a.size - j.size) <= greatest(0.1, 0.2 * abs(a.size))),
    p AS (SELECT sec, list_reduce(list_prepend({{'x': []::BIGINT[], 'y': []::BIGINT[]}}, list({{'x': [x], 'y': [y]}} ORDER BY far, off, x, y)), lambda s, v: CASE WHEN list_has_any(s.x, v.x) OR list_has_any(s.y, v.y) THEN s ELSE {{'x': s.x || v.x, 'y': s.y || v.y}} END) AS s FROM c GROUP BY sec),
    u AS (SELECT sec, unnest(s.x) AS x, unnest(s.y) AS y FROM p)
    SELECT coalesce(aj.sec, j.sec) AS sec, aj.d AS action_day, j.d AS jump_day, CASE WHEN j.sec IS NULL THEN 'action without jump' WHEN aj.sec IS NULL THEN 'jump without action' ELSE 'matched' END AS status FROM (SELECT a.*, u.y FROM a LEFT JOIN u ON a.sec = u.sec AND a.id = u.x) aj FULL JOIN j ON aj.sec = j.sec AND aj.y = j.id""",
)
def _(spark, sf):
    """Actions and jumps of prices, one to one: at most five days apart, sizes within a tenth or a fifth of the action's."""
    jumps = panel.gap_return(bars(spark, sf), "sec", "d", "close").select("sec", "d", F.round("ret", 6).alias("size")).where("abs(size) > 0.3")
    actions = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").groupBy(F.col("l_suppkey").alias("sec"), F.to_date("l_shipdate").alias("d")).agg(F.round(F.max("l_tax") * 10 - 0.4, 6).alias("size"))
    jumps, actions = (x.withColumn("id", F.unix_date("d").cast("long")) for x in (jumps, actions))
    pairs = matching.match(actions, jumps, "sec", 5, F.greatest(F.lit(0.1), 0.2 * F.abs("a_size")))
    a = actions.select("sec", F.col("id").alias("a_id"), F.col("d").alias("action_day")).join(pairs.select("sec", "a_id", "b_id"), ["sec", "a_id"], "left")
    b = jumps.select("sec", F.col("id").alias("b_id"), F.col("d").alias("jump_day"))
    status = F.when(F.col("jump_day").isNull(), "action without jump").when(F.col("action_day").isNull(), "jump without action").otherwise("matched")
    return a.join(b, ["sec", "b_id"], "full").select("sec", "action_day", "jump_day", status.alias("status"))


@query("qa12_digest_trees", "WITH b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 1009 <> 0) SELECT o.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only in a' ELSE 'differs' END AS why FROM orders o LEFT JOIN b ON o.o_orderkey = b.o_orderkey WHERE b.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM b.o_orderstatus")
def _(spark, sf):
    """Two runs that differ in a few rows, compared by ranges of keys."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    other = o.where("o_orderkey % 1009 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 997 != 0, F.col("o_orderstatus")))
    return compare.compare(o, other, ["o_orderkey"])
