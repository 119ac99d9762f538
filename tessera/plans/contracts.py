"""Scans, writes, parameters, introspection, registries, and per-user state over the driver tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr, safe_divide
from ..operators import calendar as cal_
from ..operators import joins, panel, quality, runs
from ..operators import warehouse as wh
from ..sources.tables import read_source, shared_dir, staged_write, table, to_contract
from .market import BARS, CAL, NAV, bars, calendar, navs, query
from .warehouse import FIVE, HORIZONS, day, five_masks


def folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("src1_partitioned_scan", "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) IN (1997, 1998) AND o_totalprice > 200000")
def _(spark, sf):
    """Written by year; the scan of two years reads their folders only, and the range reaches the files."""
    at = folder(spark, "orders-by-year")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    o.write.partitionBy("y").parquet(at)
    return read_source(spark, at, o.schema, "y IN (1997, 1998)").where("o_totalprice > 200000").select("o_orderkey", "o_totalprice", F.col("y").cast("long").alias("y"))


@query("src7_contract_cast", "SELECT o_orderkey::INTEGER AS o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority, TRY_CAST(round(o_totalprice, 1) AS DECIMAL(12, 1))::DOUBLE AS o_totalprice, NULL::VARCHAR AS note FROM orders")
def _(spark, sf):
    """What can't be cast, and what is missing, is null."""
    o = table(spark, sf, "orders").withColumn("o_totalprice", F.round("o_totalprice", 1))
    x = to_contract(o, {"o_orderkey": "int", "o_orderpriority": "int", "o_totalprice": "decimal(12,1)", "note": "string"})
    return x.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("snk1_staged_write", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    at = folder(spark, "finished")
    df = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    staged_write(df, at, f"{at}-stage", rows=df.count())
    return spark.read.parquet(at)


@query("snk3_table_by_month", "SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
def _(spark, sf):
    """A table made from a query, partitioned by month, sorted by customer within, and read back."""
    at = folder(spark, "orders-by-month")
    o = table(spark, sf, "orders").withColumn("m", F.date_format("o_orderdate", "yyyy-MM"))
    o.repartition("m").sortWithinPartitions("m", "o_custkey").write.partitionBy("m").parquet(at)
    return spark.read.schema(o.schema).parquet(at).groupBy("m").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


STATES = "SELECT o_orderdate::DATE AS d, 'v1' AS version, count(*) AS n FROM orders WHERE o_orderdate < DATE '1999-01-01' GROUP BY 1"


@query("snk5_merge_by_date_and_version", f"WITH a AS ({STATES}), b AS (SELECT o_orderdate::DATE AS d, v.version, count(*) * 10 AS n FROM orders, (VALUES ('v1'), ('v2')) v(version) WHERE o_orderdate >= DATE '1998-12-01' AND o_orderdate < DATE '1999-02-01' GROUP BY 1, 2) SELECT * FROM b UNION ALL SELECT a.* FROM a ANTI JOIN b ON a.d = b.d AND a.version = b.version")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    old = o.where(F.col("d") < day("1999-01-01")).groupBy("d", F.lit("v1").alias("version")).agg(F.count("*").alias("n"))
    new = o.where((F.col("d") >= day("1998-12-01")) & (F.col("d") < day("1999-02-01"))).withColumn("version", F.explode(F.array(F.lit("v1"), F.lit("v2")))).groupBy("d", "version").agg((F.count("*") * 10).alias("n"))
    return joins.merge_upsert(old, new, ["d", "version"], ["n"])


@query("d17_refresh_window", f"WITH {CAL}, i AS (SELECT min(seq) AS a, min(d) AS write_from, max(d) AS write_to FROM cal WHERE d BETWEEN DATE '1998-03-10' AND DATE '1998-05-20') SELECT write_from, write_to, (SELECT d FROM cal WHERE seq = greatest(a - 60, 1)) AS read_from, (SELECT d FROM cal WHERE seq = greatest(a - 20, 1)) AS label_from FROM i")
def _(spark, sf):
    w = cal_.plan_refresh_window(calendar(spark, sf), day("1998-03-10"), day("1998-05-20"))
    return spark.createDataFrame([(w.write_from, w.write_to, w.read_from, w.label_from)], "write_from date, write_to date, read_from date, label_from date")


@query("pr1_typed_parameters", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 250000.5 AND o_orderdate >= DATE '1997-06-01' GROUP BY 1")
def _(spark, sf):
    """Named, typed parameters of a SQL text, with defaults."""
    name = f"orders_{uuid.uuid4().hex}"
    table(spark, sf, "orders").createOrReplaceTempView(name)
    given = {"least": 250000.5} | {"since": dt.date(1997, 6, 1)}
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {name} WHERE o_totalprice > :least AND to_date(o_orderdate) >= :since GROUP BY o_orderstatus", args=given)


@query("pr4_assertion_then_stages", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 5")
def _(spark, sf):
    """A gate that raises, then a stage written and used by the next."""
    o = table(spark, sf, "orders")
    quality.assert_empty(quality.expect_unique(o, ["o_orderkey"]), "order keys are unique")
    at = folder(spark, "per-customer")
    o.groupBy("o_custkey").agg(F.count("*").alias("n")).write.parquet(at)
    return spark.read.parquet(at).where("n > 5")


NOTES = {"n_name": "name of the nation", "n_nationkey": "key of the nation", "n_regionkey": ""}


@query("pr10_descriptions", "SELECT column_name AS \"column\", CASE column_name " + " ".join(f"WHEN '{c}' THEN '{d}'" for c, d in NOTES.items()) + " END AS description FROM (DESCRIBE nation)")
def _(spark, sf):
    """Descriptions are metadata of the schema, kept by Parquet."""
    n = table(spark, sf, "nation")
    at = folder(spark, "nation")
    n.select(*(F.col(c).alias(c, metadata={"comment": NOTES[c]} if NOTES[c] else {}) for c in n.columns)).write.parquet(at)
    fields = spark.read.parquet(at).schema.fields
    return spark.createDataFrame([(f.name, f.metadata.get("comment", "")) for f in fields], "column string, description string")


@query("src9_introspection", " UNION ALL ".join(f"SELECT '{t}' AS source, count(*)::INTEGER AS columns FROM (DESCRIBE {t})" for t in ("events", "nation", "orders")))
def _(spark, sf):
    return spark.createDataFrame([(t, len(table(spark, sf, t).schema.fields)) for t in ("events", "nation", "orders")], "source string, columns int")


SETS = {"base": ["close", "range", "ret_1", "ret_5"], "risk": ["close", "dd_60", "ret_5", "vol_20"]}


@query("d19_feature_sets", "SELECT * FROM (VALUES ('close', 'both'), ('dd_60', 'added'), ('range', 'dropped'), ('ret_1', 'dropped'), ('ret_5', 'both'), ('vol_20', 'added')) t(feature, change)")
def _(spark, sf):
    """A registry and how one set differs from the base."""
    base, risk = (spark.createDataFrame([(f,) for f in SETS[k]], "feature string") for k in ("base", "risk"))
    return runs.reconcile(base, risk, ["feature"], "dropped", "added").select("feature", F.when(F.col("status") == "matched", "both").otherwise(F.col("status")).alias("change"))


@query("d22_vector_expansion", "SELECT event_id, (json_extract_string(props, '$.k'))::DOUBLE AS k, NULL::DOUBLE AS other FROM events")
def _(spark, sf):
    """A JSON object of numbers as columns, by a list of names; missing ones are null."""
    names = ["k", "other"]
    x = table(spark, sf, "events").withColumn("v", F.from_json("props", ", ".join(f"{c} double" for c in names)))
    return x.select("event_id", *(F.col(f"v.{c}").alias(c) for c in names))


@query("d45_horizons", f"WITH {BARS}, {CAL}, l AS (" + " UNION ALL ".join(f"SELECT {h}::BIGINT AS h, b.sec, b.d, b.close AS score, f.close / e.close - 1 AS fwd FROM bars b JOIN cal c ON b.d = c.d JOIN cal c1 ON c1.seq = c.seq + 1 JOIN bars e ON e.sec = b.sec AND e.d = c1.d JOIN cal ch ON ch.seq = c.seq + {h} JOIN bars f ON f.sec = b.sec AND f.d = ch.d" for h in HORIZONS if h > 1) + ") SELECT h, count(*) AS n, count(DISTINCT sec) AS names, round(corr(score, fwd), 4) AS ic FROM l GROUP BY h")
def _(spark, sf):
    """One score against labels of several horizons, from one read."""
    b = bars(spark, sf).join(joins.small(calendar(spark, sf).select("d", "seq")), "d")
    on = lambda k: F.max("close").over(Window.partitionBy("sec").orderBy("seq").rangeBetween(k, k))
    hs = [h for h in HORIZONS if h > 1]
    x = b.withColumn("entry", on(1)).withColumns({f"e{h}": on(h) for h in hs})
    x = x.select("sec", F.col("close").alias("score"), F.inline(F.array(*(F.struct(F.lit(h).cast("long").alias("h"), (safe_divide(f"e{h}", "entry") - 1).alias("fwd")) for h in hs)))).where("fwd is not null")
    return x.groupBy("h").agg(F.count("*").alias("n"), F.count_distinct("sec").alias("names"), F.round(safe_corr("score", "fwd"), 4).alias("ic"))


@query(
    "d63_three_benchmarks",
    f"WITH {BARS}, {FIVE}, r AS (SELECT b.sec, b.d, b.close / lag(b.close) OVER w - 1 AS ret, lag(pass_age AND pass_liquid) OVER w AS pool, lag(pass_limit) OVER w AS can FROM bars b JOIN m ON m.sec = b.sec AND m.d = b.d WINDOW w AS (PARTITION BY b.sec ORDER BY b.d)), c AS (SELECT *, CASE WHEN ret IS NOT NULL THEN greatest(least(ret, 0.1), -0.1) END AS x FROM r), v AS (SELECT d, round(avg(x), 8) AS signal, round(coalesce(avg(x) FILTER (can), 0), 8) AS executable FROM c WHERE pool GROUP BY d) SELECT d, round(sum(ln(1 + signal)) OVER w, 6) AS signal, round(sum(ln(1 + executable)) OVER w, 6) AS executable, round(sum(ln(1 + executable - 0.0002)) OVER w, 6) AS costed FROM v WINDOW w AS (ORDER BY d)",
)
def _(spark, sf):
    """Log NAVs of the pool as signalled, as tradable, and after costs; the last window holds a row a day."""
    w = Window.partitionBy("sec").orderBy("d")
    x = five_masks(spark, sf).withColumns({"pool": F.lag(F.col("pass_age") & F.col("pass_liquid")).over(w), "can": F.lag("pass_limit").over(w), "x": F.greatest(F.least("ret", F.lit(0.1)), F.lit(-0.1))})
    x = x.withColumn("x", F.when(F.col("ret").isNotNull(), F.col("x")))
    v = x.where("pool").groupBy("d").agg(F.round(F.avg("x"), 8).alias("signal"), F.round(F.coalesce(F.avg(F.when(F.col("can"), F.col("x"))), F.lit(0.0)), 8).alias("executable"))
    total = lambda c: F.round(F.sum(F.log(1 + c)).over(Window.orderBy("d")), 6)
    return v.select("d", total(F.col("signal")).alias("signal"), total(F.col("executable")).alias("executable"), total(F.col("executable") - 0.0002).alias("costed"))


CONTRACTS = {"v1": {"total": 0.0}, "v3": {"total": 0.0, "mdd": -0.9}}
HASHES = {k: hashlib.sha256(json.dumps(v, sort_keys=True).encode()).hexdigest()[:12] for k, v in CONTRACTS.items()}


@query(
    "d64_versions",
    NAV + f", s AS (SELECT sec, round(arg_max(nav, d) - 1, 5) AS total, round(min(nav / pk) - 1, 5) AS mdd, count(*) FILTER (d >= DATE '2001-01-01') AS held_out FROM (SELECT *, max(nav) OVER (PARTITION BY sec ORDER BY d) AS pk FROM nav) GROUP BY sec) SELECT version, h AS contract, sec, CASE WHEN held_out = 0 THEN 'incomplete' WHEN total > 0 AND (version = 'v1' OR mdd > -0.9) THEN 'accepted' ELSE 'rejected' END AS status FROM s, (VALUES ('v1', '{HASHES['v1']}'), ('v3', '{HASHES['v3']}')) c(version, h)",
)
def _(spark, sf):
    """Two versions of a contract, each with the hash of its terms; without days held out nothing is decided."""
    s = panel.running_drawdown(navs(spark, sf), "sec", "d", "nav").groupBy("sec").agg(F.round(F.max_by("nav", "d") - 1, 5).alias("total"), F.round(F.min("drawdown"), 5).alias("mdd"), F.count_if(F.col("d") >= day("2001-01-01")).alias("held_out"))
    s = s.withColumn("held_out", F.when(F.col("held_out") > 0, F.col("held_out")))
    each = [runs.decide(s, [("holdout", "held_out", F.lit(True)), *((m, m, F.col(m) > least) for m, least in terms.items())]).select(F.lit(v).alias("version"), F.lit(HASHES[v]).alias("contract"), "sec", "status") for v, terms in CONTRACTS.items()]
    return each[0].unionByName(each[1])


@query("str_asymmetric_window", "SELECT a.event_id, count(b.event_id) AS around FROM events a LEFT JOIN events b ON b.user_id = a.user_id AND b.ts >= a.ts - INTERVAL 10 HOUR AND b.ts <= a.ts + INTERVAL 30 HOUR GROUP BY 1")
def _(spark, sf):
    """Events of the user from ten hours before to thirty after, by one window over event time."""
    hour = 3_600_000_000
    e = table(spark, sf, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return e.select("event_id", F.count("*").over(Window.partitionBy("user_id").orderBy("t").rangeBetween(-10 * hour, 30 * hour)).alias("around"))


@query("str_daily_state", "WITH x AS (SELECT user_id, ts::DATE AS d, arg_max(event_type, struct_pack(ts, event_id)) AS last_type, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2) SELECT user_id, d, last_type, (sum(errors) OVER w)::BIGINT AS errors_so_far, row_number() OVER w > 3 AS warm FROM x WINDOW w AS (PARTITION BY user_id ORDER BY d)")
def _(spark, sf):
    """State at the end of each day: the last event, errors so far, and whether three days came before."""
    x = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count_if(F.col("event_type") == "error").alias("errors"))
    w = Window.partitionBy("user_id").orderBy("d")
    return x.select("user_id", "d", "last_type", F.sum("errors").over(w).alias("errors_so_far"), (F.row_number().over(w) > 3).alias("warm"))


@query("qa6_three_look_ahead_checks", f"WITH {BARS}, {CAL}, w AS (SELECT sec, d, lag(d) OVER (PARTITION BY sec ORDER BY d) AS before FROM bars) SELECT 'feature after its day' AS rule, count(*) FILTER (before >= d) AS bad FROM w UNION ALL SELECT 'next open not after', count(*) FILTER (n <= d) FROM (SELECT d, lead(d) OVER (ORDER BY d) AS n FROM cal) UNION ALL SELECT 'report visible before announced', count(*) FILTER (seen < d) FROM (SELECT o_orderdate::DATE AS d, (SELECT min(cal.d) FROM cal WHERE cal.d >= o_orderdate::DATE) AS seen FROM orders)")
def _(spark, sf):
    w = bars(spark, sf).select("d", F.lag("d").over(Window.partitionBy("sec").orderBy("d")).alias("before")).agg(F.count_if(F.col("before") >= F.col("d")).alias("bad"))
    c = calendar(spark, sf).agg(F.count_if(F.col("next_d") <= F.col("d")).alias("bad"))
    q = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    v = cal_.next_open(q, calendar(spark, sf), "d", "seen").agg(F.count_if(F.col("seen") < F.col("d")).alias("bad"))
    named = [x.select(F.lit(r).alias("rule"), "bad") for r, x in (("feature after its day", w), ("next open not after", c), ("report visible before announced", v))]
    return named[0].unionByName(named[1]).unionByName(named[2])
