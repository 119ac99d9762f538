"""Streams over the driver tables, each with the rows of a batch query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.tables import shared_dir, table
from ..sources.versions import Store
from ..streaming import events as ev
from ..streaming.restate import Restated
from .market import BARS, CAL, QUERIES, SQL, bars, calendar, query


@query(
    "str_late_restated",
    f"WITH {BARS}, {CAL} SELECT sec, d, n_5, avg_5, top_5 FROM (SELECT sec, bars.d, count(*) OVER w AS n_5, round(avg(close) OVER w, 6) AS avg_5, max(close) OVER w AS top_5 FROM bars JOIN cal ON bars.d = cal.d WINDOW w AS (PARTITION BY sec ORDER BY seq RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))",
)
def _(spark, sf):
    """Bars arrive in three parts, most of the later ones late; each part restates the five open days that look back on it."""
    at = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    b = bars(spark, sf).select("sec", "d", "close")
    kept = Restated(Store(spark, f"{at}/store"), calendar(spark, sf), "sec", "close", 5, {"n_5": F.count, "avg_5": F.avg, "top_5": F.max}, F.year)
    kept.create(b)
    stream = spark.readStream.schema(b.schema).parquet(f"{at}/in/*")
    b.withColumn("part", F.pmod(F.xxhash64("sec", "d"), F.lit(3))).write.partitionBy("part").parquet(f"{at}/all")
    for k in range(3):
        spark.read.schema(b.schema).parquet(f"{at}/all/part={k}").write.parquet(f"{at}/in/{k}")
        kept.run(stream, f"{at}/checkpoint")
    return kept.store.read("features").select("sec", "d", "n_5", F.round("avg_5", 6).alias("avg_5"), "top_5")


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


def by_time(e, parts: int):
    """The events in consecutive parts of equal time."""
    a, b = e.agg(F.min("ts"), F.max("ts")).first()
    k = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(a))) * parts / (F.unix_micros(F.lit(b)) - F.unix_micros(F.lit(a)) + 1)).cast("int")
    return [e.where(k == i) for i in range(parts)]


def flush(e, days: int):
    """An event of each type, of no user (ids of -1), far after the last: it moves the watermark past all others."""
    far = e.agg((F.max("ts") + F.expr(f"interval {days} days")).alias("ts"))
    return far.select(F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"), F.explode(F.array(F.lit("view"), F.lit("purchase"))).alias("event_type"))


@query("str_missing_followers_stream", SQL["str_missing_followers"])
def _(spark, sf):
    """Views that no purchase of the user follows within two days, as they become known, from five runs."""
    e = events(spark, sf)
    feed = ev.Feed(e, "followers")
    s = feed.stream()
    out = ev.without_follower(s.where("event_type = 'view'"), s.where("event_type = 'purchase'"), "user_id", "2 days", "1 day")
    for part in (*by_time(e, 3), flush(e, 30), flush(e, 60)):  # what one batch makes final, the next gives out
        feed.put(part)
        feed.run(out)
    return feed.read().where("event_id >= 0")  # not before: Catalyst would push it below the watermark


@query("str_daily_state_stream", SQL["str_daily_state"])
def _(spark, sf):
    """Days as they end: history is the state to begin from, the rest comes in two runs, the second from the first's checkpoint."""
    e = events(spark, sf)
    cut = F.date_trunc("day", F.lit(by_time(e, 3)[1].agg(F.min("ts")).first()[0]))
    old, new = e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)
    feed = ev.Feed(e, "daily")
    history = old.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count_distinct(F.to_date("ts")).alias("days"))
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ev.ROCKS)
    try:
        for part in (*by_time(new, 2), flush(e, 30)):
            feed.put(part)
            feed.run(ev.daily_state(feed.stream(), history))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    streamed = feed.read().where("user_id >= 0").select("user_id", F.date_from_unix_date(F.col("day").cast("int")).alias("d"), "last_type", "errors_so_far", "warm")
    early = QUERIES["str_daily_state"](spark, sf).where(F.col("d") < F.to_date(cut))
    return early.unionByName(streamed)
