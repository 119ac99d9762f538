"""Session variables, guarded runs, zipped arrays and other forms of the reference's SQL, each by itself."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr
from ..operators import panel
from ..sources.tables import shared_dir, table
from ..sources.versions import Refresh, Store
from .market import BARS, CAL, RANKED, bars, calendar, query, scored

# ---------------------------------------------------------------- parameters and runs


@query("pr1_session_variables", "WITH p AS (SELECT max(o_orderdate)::DATE - 400 AS since, avg(o_totalprice) * 1.5 AS least FROM orders) SELECT o_orderstatus, count(*) AS n FROM orders, p WHERE o_orderdate::DATE >= since AND o_totalprice > least GROUP BY 1")
def _(spark, sf):
    """Typed variables of a session with defaults, set anew from scalar subqueries, and used by name."""
    view, since, least = (f"{n}_{uuid.uuid4().hex}" for n in ("orders", "since", "least"))
    table(spark, sf, "orders").createOrReplaceTempView(view)
    spark.sql(f"DECLARE VARIABLE {since} DATE DEFAULT date_sub(current_date(), 400)")
    spark.sql(f"DECLARE VARIABLE {least} DOUBLE DEFAULT 0.0")
    spark.sql(f"SET VAR {since} = (SELECT date_sub(to_date(max(o_orderdate)), 400) FROM {view})")
    spark.sql(f"SET VAR {least} = (SELECT avg(o_totalprice) * 1.5 FROM {view})")
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {view} WHERE to_date(o_orderdate) >= {since} AND o_totalprice > {least} GROUP BY o_orderstatus")


class AlreadyRun(RuntimeError):
    """A run of this id has been committed."""


def run_once(store: Store, run_id: str, change: Refresh, force: bool = False) -> None:
    """Commits a change under a run's id; refused if there has been one of that id, unless it is forced."""
    if not force and any(store.version(n).note.get("run") == run_id for n in store.numbers()):
        raise AlreadyRun(run_id)
    store.refresh([change], note={"run": run_id})


@query("pr3_guarded_runs", "SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n, sum(CASE WHEN year(o_orderdate) = 1997 THEN round(o_totalprice * 100)::BIGINT * 3 ELSE round(o_totalprice * 100)::BIGINT END)::BIGINT AS cents FROM orders GROUP BY 1")
def _(spark, sf):
    """A run that is repeated is refused, and changes the table only when forced."""
    s = Store(spark, f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}")
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"), F.year("o_orderdate").alias("y"))
    s.create({"orders": (o, "y")})
    times = lambda k: Refresh("orders", o.withColumn("v", F.col("v") * k), "d", "1997-01-01", "1997-12-31", "y")
    run_once(s, "run-1", times(2))
    try:
        run_once(s, "run-1", times(5))
    except AlreadyRun:
        run_once(s, "run-1", times(3), force=True)
    return s.read("orders").groupBy("y").agg(F.count("*").alias("n"), F.sum("v").alias("cents"))


# ---------------------------------------------------------------- arrays, enums, masks, orders


@query("jn16_zip_of_arrays", "WITH a AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS ks, list(o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS ps FROM orders GROUP BY 1) SELECT o_custkey, i - 1 AS pos, ks[i] AS o_orderkey, ps[i] AS o_orderpriority FROM a, range(1, len(ks) + 1) r(i) WHERE i <= 5")
def _(spark, sf):
    """Two arrays of a customer, in orders of their own, unnested with their offsets and joined by them."""
    o = table(spark, sf, "orders")
    ordered = lambda *by: F.array_sort(F.collect_list(F.struct(*by)))
    a = o.groupBy("o_custkey").agg(ordered("o_orderdate", "o_orderkey").alias("ks"), ordered((-F.col("o_totalprice")).alias("p"), "o_orderkey", "o_orderpriority").alias("ps"))
    ks = a.select("o_custkey", F.posexplode("ks.o_orderkey").alias("pos", "o_orderkey"))
    ps = a.select("o_custkey", F.posexplode("ps.o_orderpriority").alias("pos", "o_orderpriority"))
    return ks.join(ps, ["o_custkey", "pos"]).where("pos < 5").select("o_custkey", F.col("pos").cast("long").alias("pos"), "o_orderkey", "o_orderpriority")


@query("flt3_in_array_parameter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')")
def _(spark, sf):
    """Arrays given as parameters; a filter over each that reaches the scan."""
    wanted, unwanted = ["1-URGENT", "5-LOW"], ["P"]
    return table(spark, sf, "orders").where(F.col("o_orderpriority").isin(wanted) & ~F.col("o_orderstatus").isin(unwanted)).select("o_orderkey", "o_orderpriority")


@query("prj5_enum_mapping", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS state, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN left(o_orderpriority, 1) END = '1', false) AS urgent FROM orders")
def _(spark, sf):
    """Codes by a map, what isn't in it as unknown; a flag that is false where its source is null."""
    names = F.create_map(*(F.lit(x) for x in ("F", "finished", "O", "open")))
    flag = F.when(F.col("o_orderkey") % 4 > 0, F.substring("o_orderpriority", 1, 1))
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(F.get(F.map_values(F.map_filter(names, lambda k, _: k == F.col("o_orderstatus"))), F.lit(0)), F.lit("unknown")).alias("state"), F.coalesce(flag == "1", F.lit(False)).alias("urgent"))


@query("prj7_nested_tradability", f"WITH {BARS}, {CAL}, e AS (SELECT s.sec, cal.d FROM (SELECT sec, min(d) AS a, max(d) AS z FROM bars GROUP BY 1) s JOIN cal ON cal.d BETWEEN s.a AND s.z), r AS (SELECT sec, d, volume, close / lag(close) OVER (PARTITION BY sec ORDER BY d) - 1 AS ret FROM bars) SELECT e.sec, e.d, CASE WHEN r.sec IS NULL THEN false WHEN ret IS NULL THEN NULL ELSE ret < 0.095 AND volume > 5 END AS can_buy FROM e LEFT JOIN r ON e.sec = r.sec AND e.d = r.d")
def _(spark, sf):
    """Suspended names can't be bought, those without a return are unknown, the others follow the rule."""
    b = panel.gap_return(bars(spark, sf), "sec", "d", "close")
    life = b.groupBy("sec").agg(F.min("d").alias("a"), F.max("d").alias("z"))
    each = life.select("sec", F.explode(F.sequence("a", "z")).alias("d")).join(calendar(spark, sf).select("d"), "d", "left_semi")
    x = each.join(b.select("sec", "d", "volume", "ret", F.lit(True).alias("traded")), ["sec", "d"], "left")
    return x.select("sec", "d", F.when(F.col("traded").isNull(), F.lit(False)).when(F.col("ret").isNotNull(), (F.col("ret") < 0.095) & (F.col("volume") > 5)).alias("can_buy"))


@query("wn14_running_conditional_count", f"WITH {CAL} SELECT day::DATE AS day, count(cal.d) OVER (ORDER BY day) AS open_days, CASE WHEN cal.d IS NOT NULL THEN count(cal.d) OVER (ORDER BY day) END AS seq FROM (SELECT unnest(generate_series((SELECT min(d) FROM cal), (SELECT max(d) FROM cal), INTERVAL 1 DAY)) AS day) t LEFT JOIN cal ON cal.d = t.day::DATE")
def _(spark, sf):
    """Days of the calendar, open or not, with the number of open ones so far; a row a day."""
    cal = calendar(spark, sf).select("d", F.lit(1).alias("is_open"))
    days = cal.agg(F.min("d").alias("a"), F.max("d").alias("z")).select(F.explode(F.sequence("a", "z")).alias("day"))
    so_far = F.count("is_open").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return days.join(cal, F.col("day") == F.col("d"), "left").withColumn("open_days", so_far).select("day", "open_days", F.when(F.col("is_open") == 1, F.col("open_days")).alias("seq"))


@query("sr1_order_by_several_keys", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS place FROM customer")
def _(spark, sf):
    """Each nation's customers in an order of three keys, of mixed directions, as a place."""
    w = Window.partitionBy("c_nationkey").orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey")
    return table(spark, sf, "customer").select("c_custkey", F.row_number().over(w).cast("long").alias("place"))


@query("sr3_latest_record_of_each", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, sf):
    """The latest record by time, then id: one maximum of a struct, merged from every task."""
    e = table(spark, sf, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("x"))
    return e.select("user_id", "x.event_id", "x.event_type")


@query("d29_prediction_rows", RANKED + " SELECT 'model-1' AS model, sec, d, round(score, 4) AS score, row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) AS rk, CASE WHEN count(*) OVER (PARTITION BY d) > 1 THEN round(1 - (row_number() OVER (PARTITION BY d ORDER BY score DESC, sec) - 1) / (count(*) OVER (PARTITION BY d) - 1)::DOUBLE, 6) ELSE 1.0 END AS rank_pct FROM sc")
def _(spark, sf):
    """Scores as rows of predictions: place within the day, and its share, which is 1 for a name alone."""
    n = F.count("*").over(Window.partitionBy("d"))
    x = panel.xs_rank(scored(spark, sf), "d", "score", "row", "sec", "rk").withColumn("n", n)
    share = F.when(F.col("n") > 1, F.round(1 - (F.col("rk") - 1) / (F.col("n") - 1), 6)).otherwise(1.0)
    return x.select(F.lit("model-1").alias("model"), "sec", "d", F.round("score", 4).alias("score"), F.col("rk").cast("long").alias("rk"), share.alias("rank_pct"))


@query("d45_pool_coverage", RANKED + f", days AS (SELECT bars.d, count(*) AS traded FROM bars GROUP BY 1), s AS (SELECT d, count(*) AS scored, count(fwd) AS labelled FROM sc GROUP BY 1) SELECT year(days.d)::INTEGER AS y, count(*) AS days, count(s.d) AS scored_days, round(sum(coalesce(scored, 0)) / sum(traded)::DOUBLE, 5) AS coverage, round(sum(coalesce(labelled, 0)) / sum(traded)::DOUBLE, 5) AS labelled FROM days LEFT JOIN s ON s.d = days.d GROUP BY 1")
def _(spark, sf):
    """How much of what trades has a score, and a label, by year."""
    traded = bars(spark, sf).groupBy("d").agg(F.count("*").alias("traded"))
    s = scored(spark, sf).groupBy("d").agg(F.count("*").alias("scored"), F.count("fwd").alias("labelled"))
    share = lambda c: F.round(F.sum(F.coalesce(c, F.lit(0))) / F.sum("traded"), 5)
    return traded.join(s, "d", "left").groupBy(F.year("d").alias("y")).agg(F.count("*").alias("days"), F.count("scored").alias("scored_days"), share("scored").alias("coverage"), share("labelled").alias("labelled"))


# ---------------------------------------------------------------- experiments


@query(
    "d80_experiments_with_registry",
    f"""WITH {BARS}, runs AS (SELECT DISTINCT s_nationkey AS run FROM bars JOIN supplier ON s_suppkey = sec), b AS (SELECT s_nationkey AS run, year(d) AS y, sum(amount) AS amount, count(*) AS n FROM bars JOIN supplier ON s_suppkey = sec WHERE s_nationkey % 5 <> 2 GROUP BY 1, 2), m AS (SELECT run, count(*) AS years, sum(n)::BIGINT AS n, round(max(amount) / min(amount), 4) AS spread FROM b GROUP BY 1)
    SELECT run, years, n, spread, coalesce(n_name, 'unregistered') AS name, CASE WHEN m.n IS NULL THEN 'no summary' WHEN n_name IS NULL THEN 'no registry' ELSE 'complete' END AS state, CASE WHEN spread IS NOT NULL THEN rank() OVER (ORDER BY spread NULLS LAST, run) END AS place FROM runs LEFT JOIN m USING (run) LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 7 <> 3) g ON g.n_nationkey = run""",
)
def _(spark, sf):
    """Runs of a manifest beside their summary and their entry in a registry, where there are any; a row a run."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_nationkey").alias("run"))
    b = bars(spark, sf).join(s, "sec")
    years = b.where("run % 5 <> 2").groupBy("run", F.year("d").alias("y")).agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    summary = years.groupBy("run").agg(F.count("*").alias("years"), F.sum("n").alias("n"), F.round(F.max("amount") / F.min("amount"), 4).alias("spread"))
    registry = table(spark, sf, "nation").where("n_nationkey % 7 <> 3").select(F.col("n_nationkey").alias("run"), "n_name")
    x = b.select("run").distinct().join(summary, "run", "left").join(registry, "run", "left")
    state = F.when(F.col("n").isNull(), "no summary").when(F.col("n_name").isNull(), "no registry").otherwise("complete")
    place = F.when(F.col("spread").isNotNull(), F.rank().over(Window.orderBy(F.asc_nulls_last("spread"), "run")).cast("long"))
    return x.select("run", "years", "n", "spread", F.coalesce("n_name", F.lit("unregistered")).alias("name"), state.alias("state"), place.alias("place"))


@query(
    "qa25_reversed_scores",
    RANKED + """, r AS (SELECT d, sec, fwd, score, rank() OVER (PARTITION BY d ORDER BY score) AS up, rank() OVER (PARTITION BY d ORDER BY -score) AS down, rank() OVER (PARTITION BY d ORDER BY fwd) AS f, ntile(5) OVER (PARTITION BY d ORDER BY score DESC, sec) AS q, ntile(5) OVER (PARTITION BY d ORDER BY -score DESC, sec DESC) AS p, count(*) OVER (PARTITION BY d) AS n FROM sc),
    i AS (SELECT d, corr(up, f) AS ic, corr(down, f) AS rev, count(*) FILTER (n % 5 = 0 AND q <> 6 - p) AS moved FROM r GROUP BY d HAVING count(*) >= 5) SELECT count(*) AS days, count(*) FILTER (abs(ic + rev) > 0.2) AS unlike, sum(moved)::BIGINT AS moved FROM i""",
)
def _(spark, sf):
    """A reversed score has the opposite rank correlation (up to ties), and its fifths are those of the score from the other end."""
    w = lambda *by: Window.partitionBy("d").orderBy(*by)
    x = scored(spark, sf).withColumn("other", -F.col("score")).withColumns({
        "up": F.rank().over(w("score")), "down": F.rank().over(w("other")), "f": F.rank().over(w("fwd")),
        "q": F.ntile(5).over(w(F.desc("score"), "sec")), "p": F.ntile(5).over(w(F.desc("other"), F.desc("sec"))), "n": F.count("*").over(Window.partitionBy("d")),
    })
    moved = F.count_if((F.col("n") % 5 == 0) & (F.col("q") != 6 - F.col("p")))
    i = x.groupBy("d").agg(F.count("*").alias("k"), safe_corr("up", "f").alias("ic"), safe_corr("down", "f").alias("rev"), moved.alias("moved")).where("k >= 5")
    return i.agg(F.count("*").alias("days"), F.count_if(F.abs(F.col("ic") + F.col("rev")) > 0.2).alias("unlike"), F.sum("moved").alias("moved"))
