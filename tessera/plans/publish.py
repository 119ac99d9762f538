"""Windows of several tables replaced as one version, over the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..operators import quality
from ..sources.tables import shared_dir, table
from ..sources.versions import Refresh, Store
from .market import query
from .warehouse import REGION_DAYS, day, region_days

FROM, TO = "1998-03-10", "1998-05-20"
INSIDE = f"d BETWEEN DATE '{FROM}' AND DATE '{TO}'"


def store(spark, name: str) -> Store:
    return Store(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("v"), (F.col("o_custkey") % 9).alias("target")).withColumn("m", F.date_format("d", "yyyy-MM"))


# inside the window a fifth of the rows goes, and all of April; what is left counts twice
FRESH = "o_orderkey % 5 <> 0 AND m <> '1998-04'"
ORDERS = "o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_totalprice AS v, o_custkey % 9 AS target, strftime(o_orderdate, '%Y-%m') AS m FROM orders)"
AFTER = f"after AS (SELECT o_orderkey, d, CASE WHEN {INSIDE} THEN v * 2 ELSE v END AS v, target, m FROM o WHERE NOT ({INSIDE}) OR ({FRESH}))"


@query("snk4_window_refresh", f"WITH {ORDERS}, {AFTER} SELECT o_orderkey, d, v, m FROM after WHERE d BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
def _(spark, sf):
    """A year's table by month, of which a window is deleted and written anew; a month that is left without rows goes."""
    s, o = store(spark, "year"), orders(spark, sf)
    s.create({"year": (o.where(F.col("d").between(day("1998-01-01"), day("1998-12-31"))), "m")})
    s.refresh([Refresh("year", o.where(FRESH).withColumn("v", F.col("v") * 2), "d", FROM, TO, "m")])
    return s.read("year").select("o_orderkey", "d", "v", "m")


YEAR = "year(d) = 1998"
NINE = "o_orderkey % 5 <> 0 AND target <> 0"  # the first target has nothing for the year


@query("pr7_nine_targets", f"WITH {ORDERS} SELECT target, year(d)::INTEGER AS y, count(*) AS n, sum(round(CASE WHEN {YEAR} THEN v * 2 ELSE v END * 100)::BIGINT)::BIGINT AS cents FROM o WHERE NOT ({YEAR}) OR ({NINE}) GROUP BY 1, 2")
def _(spark, sf):
    """Nine tables, each with a window of its own rows replaced; readers see all nine before or all nine after."""
    s, o = store(spark, "nine"), orders(spark, sf).withColumn("y", F.year("d")).drop("m")
    part = lambda df, k: df.where(F.col("target") == k)
    s.create({f"target_{k}": (part(o, k), "y") for k in range(9)})
    fresh = o.where(NINE).withColumn("v", F.col("v") * 2)
    v = s.refresh([Refresh(f"target_{k}", part(fresh, k), "d", "1998-01-01", "1998-12-31", "y") for k in range(9)])
    all_nine = reduce(lambda a, b: a.unionByName(b), (s.read(f"target_{k}", v) for k in range(9)))
    return all_nine.groupBy("target", "y").agg(F.count("*").alias("n"), F.sum(F.round(F.col("v") * 100).cast("long")).alias("cents"))


@query("d88_index_window", f"WITH {REGION_DAYS}, x AS (SELECT r_name, d, round(close, 4) AS close FROM idx) SELECT r_name, d, CASE WHEN d BETWEEN DATE '2000-03-10' AND DATE '2000-05-20' THEN close + 1 ELSE close END AS close FROM x WHERE year(d) = 2000")
def _(spark, sf):
    """The index's window, checked before it is published: keys are unique, none is null, and there are rows at all."""
    s = store(spark, "index")
    x = region_days(spark, sf).where(F.year("d") == 2000).select("r_name", "d", F.round("close", 4).alias("close"), F.date_format("d", "yyyy-MM").alias("m"))
    s.create({"index": (x, "m")}, {"by": "first load"})
    new = x.where(F.col("d").between(day("2000-03-10"), day("2000-05-20"))).withColumn("close", F.col("close") + 1)
    quality.assert_empty(quality.expect_unique(new, ["r_name", "d"]), "one row an index and day")
    quality.assert_empty(new.where("r_name is null or d is null or close is null"), "no nulls")
    s.refresh([Refresh("index", new, "d", "2000-03-10", "2000-05-20", "m")], note={"from": "2000-03-10", "to": "2000-05-20"})
    return s.read("index").select("r_name", "d", "close")


@query(
    "qa24_refreshed_window",
    f"""WITH {ORDERS}, {AFTER}, n AS (SELECT o_orderkey, d, v * 2 AS v, target, m FROM o WHERE {INSIDE} AND {FRESH})
    SELECT 'duplicate keys' AS rule, count(*) - count(DISTINCT o_orderkey) AS bad FROM after UNION ALL SELECT 'source rows not written', count(*) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM after WHERE {INSIDE})
    UNION ALL SELECT 'rows left that the source has not', count(*) FROM (SELECT * FROM after WHERE {INSIDE} EXCEPT ALL SELECT * FROM n) UNION ALL SELECT 'rows outside changed', count(*) FROM (SELECT * FROM o WHERE NOT ({INSIDE}) EXCEPT ALL SELECT * FROM after WHERE NOT ({INSIDE}))
    UNION ALL SELECT 'rows deleted', (SELECT count(*) FROM o) - (SELECT count(*) FROM after) UNION ALL SELECT 'months without rows', (SELECT count(DISTINCT m) FROM o) - (SELECT count(DISTINCT m) FROM after)""",
)
def _(spark, sf):
    """What a refresh has done, by comparing the versions before and after; April is emptied."""
    s = store(spark, "refreshed")
    before = s.create({"orders": (orders(spark, sf), "m")})
    o = s.read("orders", before)
    new = o.where(FRESH).where(INSIDE).withColumn("v", F.col("v") * 2)
    now = s.read("orders", s.refresh([Refresh("orders", new, "d", FROM, TO, "m")]))
    count = lambda df, name, agg=None: df.agg((F.count("*") if agg is None else agg).alias("bad")).select(F.lit(name).alias("rule"), "bad")
    keys = now.groupBy("o_orderkey").agg((F.count("*") - 1).alias("more"))
    sizes = lambda agg: o.agg(agg.alias("a")).crossJoin(now.agg(agg.alias("b"))).select((F.col("a") - F.col("b")).alias("n"))  # noqa: E731  two rows
    rules = [
        count(keys, "duplicate keys", F.sum("more")),
        count(new.exceptAll(now.where(INSIDE)), "source rows not written"),
        count(now.where(INSIDE).exceptAll(new), "rows left that the source has not"),
        count(o.where(f"not ({INSIDE})").exceptAll(now.where(f"not ({INSIDE})")), "rows outside changed"),
        sizes(F.count("*")).select(F.lit("rows deleted").alias("rule"), F.col("n").alias("bad")),
        sizes(F.count_distinct("m")).select(F.lit("months without rows").alias("rule"), F.col("n").alias("bad")),
    ]
    return reduce(lambda a, b: a.unionByName(b), rules)
