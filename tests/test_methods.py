"""Versioned tables, late rows, state over restarts, as-of in one pass, folds, least squares, matching and digest trees."""

import datetime as dt
import itertools
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import compare, diagnosis, matching, regress
from tessera.operators import warehouse as wh
from tessera.sources.tables import shared_dir
from tessera.sources.versions import Conflict, Refresh, Store, Upsert
from tessera.streaming.restate import Restated

D = dt.date


def store(spark):
    return Store(spark, f"{shared_dir(spark)}/test-{uuid.uuid4().hex}")


def days_of_2024(spark):
    return spark.sql("select id k, date_add(date'2024-01-01', cast(id as int)) d, id * 2 v, date_format(date_add(date'2024-01-01', cast(id as int)), 'yyyy-MM') m from range(150)")


# ---------------------------------------------------------------- versions


def test_a_month_left_without_rows_goes(spark):
    s, x = store(spark), days_of_2024(spark)
    s.create({"t": (x, "m")})
    s.refresh([Refresh("t", x.where("m <> '2024-04'").withColumn("v", -F.col("v")), "d", "2024-03-10", "2024-05-05", "m")])
    got = {r.k: r.v for r in s.read("t").collect()}
    d = lambda k: D(2024, 1, 1) + dt.timedelta(k)
    assert got == {k: -2 * k if D(2024, 3, 10) <= d(k) <= D(2024, 5, 5) else 2 * k for k in range(150) if not D(2024, 4, 1) <= d(k) <= D(2024, 4, 30)}
    assert "m=2024-04" not in s.version().tables["t"]["parts"] and s.read("t", s.version(1)).count() == 150


def test_nine_tables_change_together_or_not_at_all(spark):
    s, x = store(spark), days_of_2024(spark)
    s.create({f"t{i}": (x, "m") for i in range(9)})
    new = x.withColumn("v", F.lit(0).cast("long"))
    broken = new.withColumn("v", F.when(F.col("k") == 45, F.raise_error(F.lit("lost in the middle")).cast("long")).otherwise(F.col("v")))
    changes = [Refresh(f"t{i}", broken if i == 5 else new, "d", "2024-02-01", "2024-02-29", "m") for i in range(9)]
    with pytest.raises(Exception, match="lost in the middle"):
        s.refresh(changes)
    assert s.version().number == 1 and all(s.read(f"t{i}").where("v = 0").count() == 1 for i in (0, 4, 5, 8))
    assert len(s.unreferenced()) >= 5
    assert s.refresh([Refresh(f"t{i}", new, "d", "2024-02-01", "2024-02-29", "m") for i in range(9)]).number == 2
    assert all(s.read(f"t{i}").where("v = 0").count() == 30 for i in range(9))


def test_a_second_writer_on_one_base_is_refused(spark):
    s, x = store(spark), days_of_2024(spark)
    base = s.create({"t": (x, "m")})
    s.refresh([Refresh("t", x.where("k = 40"), "d", "2024-02-01", "2024-02-29", "m")], base)
    with pytest.raises(Conflict):
        s.refresh([Refresh("t", x, "d", "2024-02-01", "2024-02-29", "m")], base)
    assert s.read("t").count() == 150 - 29 + 1
    assert s.vacuum() > 0 and s.unreferenced() == [] and s.read("t").count() == 122
    with pytest.raises(Exception):
        s.read("t", base).count()  # its folders are gone


def test_null_partitions_upserts_and_empty_tables(spark):
    s = store(spark)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, d date, v int, p string")
    s.create({"t": (rows((1, D(2024, 1, 1), 1, None), (2, None, 2, None), (3, D(2024, 1, 2), 3, "a/b=c")), "p"), "none": (rows(), "p")})
    s.refresh([Refresh("t", rows((9, D(2024, 1, 1), 9, None)), "d", D(2024, 1, 1), D(2024, 1, 2), "p")])
    assert sorted(map(tuple, s.read("t").collect())) == [(2, None, 2, None), (9, D(2024, 1, 1), 9, None)]
    s.refresh([Upsert("t", rows((2, None, 7, "x"), (5, None, 5, None)), ("k",), "p"), Upsert("none", rows((1, None, 1, None)), ("k",), "p")])
    # a row of another partition isn't looked for: keys stay within theirs
    assert sorted(map(tuple, s.read("t").select("k", "v").collect())) == [(2, 7), (5, 5), (9, 9)]
    assert s.read("none").count() == 1
    s.refresh([])
    assert s.version().number == 4


# ---------------------------------------------------------------- late rows


def test_replayed_and_failed_batches_count_once(spark):
    cal = spark.sql("select date_add(date'2024-01-01', cast(id as int)) d, id seq from range(40)")
    s = store(spark)
    kept = Restated(s, cal, "k", "v", 3, {"n": F.count, "total": F.sum}, F.month)
    x = spark.createDataFrame([(k, D(2024, 1, 1) + dt.timedelta(i), i + k) for k in (1, 2) for i in range(0, 40, 1 + k)], "k int, d date, v int")
    kept.create(x)
    parts = [x.where((F.col("v") * 7) % 3 == i) for i in range(3)]
    kept.restate(parts[0], 0)
    kept.restate(parts[0].withColumn("v", F.lit(99)), 0)  # replayed: passed over
    with pytest.raises(Exception, match="boom"):
        kept.restate(parts[1].withColumn("v", F.raise_error(F.lit("boom")).cast("int")), 1)
    kept.restate(parts[1], 1)
    kept.restate(parts[2], 2)
    kept.restate(parts[2].limit(0), 3)
    got = {(r.k, r.d): (r.n, r.total) for r in s.read("features").collect()}
    rows = {(r.k, r.d): r.v for r in x.collect()}
    want = {(k, d): [rows[k, e] for e in (d - dt.timedelta(2), d - dt.timedelta(1), d) if (k, e) in rows] for k, d in rows}
    assert got == {i: (len(v), sum(v)) for i, v in want.items()} and s.version().note == {"batch": 3}


# ---------------------------------------------------------------- as-of


def test_as_of_in_one_pass_equals_one_by_one(spark):
    rng = np.random.default_rng(1)
    day = lambda i: D(2020, 1, 1) + dt.timedelta(int(i))
    facts = [(["a", "b"][int(rng.integers(2))], None if rng.random() < 0.05 else int(rng.integers(4)), None if rng.random() < 0.05 else D(2018 + int(rng.integers(3)), int(rng.integers(1, 4)), 28), None if rng.random() < 0.05 else day(rng.integers(500)), int(i), float(rng.integers(0, 5))) for i in range(300)]
    grid = [(c, day(d)) for c in (None, 0, 1, 2, 3, 7) for d in range(0, 520, 13)] + [(1, None)]
    out = wh.pit_features(spark.createDataFrame(grid, "c int, d date"), spark.createDataFrame(facts, "source string, c int, period date, ann date, key long, value double"), ["a", "b"], 200)
    got = {(r.c, r.d): tuple(r)[2:] for r in out.collect()}
    low = D(1, 1, 1)

    def one(c, d, s):
        seen = [f for f in facts if f[0] == s and f[1] is not None and f[1] == c and f[3] and d and f[3] <= d]
        best = max((f for f in seen if (d - f[3]).days <= 200), key=lambda f: (f[2] or low, f[3], f[4]), default=None)
        if best is None:
            return None, None, None
        before = max((f for f in seen if best[2] and f[2] == best[2].replace(year=best[2].year - 1)), key=lambda f: (f[3], f[4]), default=None)
        return best[5], (d - best[3]).days, best[5] / before[5] - 1 if before and before[5] else None

    assert got == {(c, d): one(c, d, "a") + one(c, d, "b") for c, d in grid}


def test_as_of_reads_its_inputs_once(spark):
    at = f"{shared_dir(spark)}/asof-{uuid.uuid4().hex}"
    spark.sql("select id c, date'2020-01-01' d from range(9)").write.parquet(f"{at}/g")
    spark.sql("select 'a' source, id c, date'2019-12-01' period, date'2019-12-31' ann, id key, 1.0d value from range(9)").write.parquet(f"{at}/f")
    plan = wh.pit_features(spark.read.parquet(f"{at}/g"), spark.read.parquet(f"{at}/f"), ["a", "b", "c", "e"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1


# ---------------------------------------------------------------- folds


@pytest.mark.parametrize("rows", [1, 2, 5, 40])
def test_rolling_drawdown_equals_every_window(spark, rows):
    rng = np.random.default_rng(rows)
    nav = {k: [None if rng.random() < 0.03 else float(x) for x in np.exp(np.cumsum(rng.normal(0, 0.1, n)))] for k, n in (("a", 33), ("b", 1), ("c", 80))}
    df = spark.createDataFrame([(k, i, v, 1) for k, vs in nav.items() for i, v in enumerate(vs)], "k string, i int, v double, rows int")
    got = {(r.k, r.i): r.dd for r in diagnosis.rolling_drawdown(df, "k", "i", "v", rows, "dd").collect()}
    for k, vs in nav.items():
        for i in range(len(vs)):
            w = vs[max(i - rows + 1, 0) : i + 1]
            want = None if len(w) < rows or None in w else min(b / a - 1 for x, a in enumerate(w) for b in w[x:])
            assert (got[k, i] is None and want is None) or abs(got[k, i] - want) < 1e-12


# ---------------------------------------------------------------- least squares


def test_residuals_are_orthogonal_to_all_regressors_and_dummies(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(6)), "uvw"[int(rng.integers(3))], *map(float, rng.normal(0, 1, 3))) for _ in range(400)] + [(9, "u", None, 1.0, 2.0), (9, "u", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d int, g string, y double, a double, b double").withColumn("c", F.col("a") * 2 - F.col("b"))  # c depends on a and b
    out = regress.residuals(df, "d", "y", ["a", "b", "c"], "e", "g").toPandas()
    fits = {r.d: r for r in regress.grouped_ols(df, "d", "y", ["a", "b", "c"], "g").collect()}
    assert fits[9].rank == 0 and fits[9].n == 1 and list(fits[9].coefficients) == [0, 0, 0]
    for d, x in out[out.d < 9].groupby("d"):
        full = np.column_stack([x[["a", "b", "c"]], *((x.g == g) * 1.0 for g in "uvw")])
        assert np.abs(full.T @ x.e).max() < 1e-9 and fits[d].rank == 2
        assert np.abs(x.y - full @ np.linalg.lstsq(full, x.y, rcond=None)[0] - x.e).max() < 1e-9


# ---------------------------------------------------------------- matching


def test_matching_takes_the_nearest_pair_first(spark):
    day = lambda i: D(2024, 1, 1) + dt.timedelta(int(i))
    rng = np.random.default_rng(8)
    a = [(int(k), i, day(rng.integers(60)), float(rng.integers(5)) / 10) for i, k in enumerate(rng.integers(0, 3, 60))]
    b = [(int(k), i, day(rng.integers(60)), float(rng.integers(5)) / 10) for i, k in enumerate(rng.integers(0, 3, 60))]
    a += [(7, 100, day(10), 0.5)]  # two jumps near one action, one of them nearer
    b += [(7, 100, day(12), 0.5), (7, 101, day(9), 0.45)]
    table = lambda x: spark.createDataFrame(x, "k int, id int, d date, size double")
    got = {tuple(r) for r in matching.match(table(a), table(b), "k", 4, F.greatest(F.lit(0.1), F.col("a_size") * 0.2)).select("k", "a_id", "b_id").collect()}
    pairs = sorted((abs((x[2] - y[2]).days), abs(x[3] - y[3]), x[1], y[1], x[0]) for x, y in itertools.product(a, b) if x[0] == y[0] and abs((x[2] - y[2]).days) <= 4 and abs(x[3] - y[3]) <= max(0.1, x[3] * 0.2))
    want, used_a, used_b = set(), set(), set()
    for _, _, i, j, k in pairs:
        if (k, i) not in used_a and (k, j) not in used_b:
            want.add((k, i, j))
            used_a.add((k, i))
            used_b.add((k, j))
    assert got == want and (7, 100, 101) in got
    assert matching.match(table(a).limit(0), table(b), "k", 4, F.lit(0.1)).count() == 0


# ---------------------------------------------------------------- digest trees


def test_trees_find_what_differs_and_read_little_else(spark):
    a = spark.sql("select id k, cast(id % 7 as string) v, if(id % 5 = 0, null, id) w from range(20000)")
    b = a.where("k <> 77").withColumn("v", F.when(F.col("k") == 500, None).otherwise(F.col("v"))).unionByName(spark.sql("select 20001L k, 'x' v, 1L w"))
    assert {tuple(r) for r in compare.compare(a, b, ["k"]).collect()} == {(77, "only in a"), (500, "differs"), (20001, "only in b")}
    ranges = compare.differing(compare.digests(a, ["k"]), compare.digests(b, ["k"]))
    near = a.withColumn("leaf", compare.leaf(["k"], 12)).join(ranges, "leaf", "left_semi").count()
    assert ranges.count() == 3 and near < 40
    assert compare.compare(a, a.repartition(7, "v"), ["k"]).count() == 0
    assert compare.compare(a.limit(0), a.limit(0), ["k"]).count() == 0


# ---------------------------------------------------------------- saved stages, plans, files


def test_a_saved_stage_gives_what_the_fit_gave(spark):
    from pyspark.ml import Pipeline, PipelineModel

    from tessera.operators.research import WinsorZScore
    from tessera.operators.stages import Winsor

    rng = np.random.default_rng(2)
    rows = [(float(x), None if i % 9 == 0 else float(y), None, 5.0) for i, (x, y) in enumerate(rng.normal(0, 3, (200, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    at = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    for z in (True, False):
        Pipeline(stages=[Winsor(inputCols=["a", "b", "k"], lower=0.1, upper=0.9, zscore=z)]).fit(df).save(f"{at}-{z}")
        got = PipelineModel.load(f"{at}-{z}").transform(df).toPandas()
        want = WinsorZScore(("a", "b", "k"), 0.1, 0.9, z).fit(df).transform(df).toPandas()
        for c in "abk":
            assert np.allclose(np.sort(got[c]), np.sort(want[c]), equal_nan=True)
    alone = Winsor(inputCols=["a"])
    alone.save(f"{at}-alone")
    assert Winsor.load(f"{at}-alone").getInputCols() == ["a"] and Winsor.load(f"{at}-alone").uid == alone.uid


def test_unpruned_and_forbidden_scans_are_refused_before_they_run(spark):
    from tessera.sources import scans

    at = f"{shared_dir(spark)}/years-{uuid.uuid4().hex}"
    spark.sql("select id k, id * 2 v, id % 5 y, id w from range(50)").write.partitionBy("y").parquet(at)
    df = spark.read.parquet(at)
    for bad in (df, df.where("v = 3"), df.where("y is not null"), spark.range(3).withColumnRenamed("id", "k").join(df.select("k"), "k"), df.where("y = 1").unionByName(df)):
        with pytest.raises(scans.ForbiddenScan):
            scans.guarded(bad)
    assert scans.guarded(df.where("y in (1, 2) and v > 3")).count() == 19
    (s,) = scans.scans(df.where("y = 1 and v > 3").select("v"))
    assert s.columns == ("v",) and s.partitioned_by == ("y",) and any("v" in f for f in s.data_filters)
    with pytest.raises(scans.ForbiddenScan, match="must not"):
        scans.guarded(df.where("y = 1"), forbidden=s.paths)
    with pytest.raises(scans.ForbiddenScan, match="columns"):
        scans.guarded(df.where("y = 1"), columns_at_most=2)


def test_only_files_that_differ_are_repaired(spark):
    import hashlib
    import pathlib

    from tessera.sources import repair

    at = pathlib.Path(shared_dir(spark).removeprefix("file:")) / f"mixed-{uuid.uuid4().hex}"
    for name, query in {"long": "select id k, id v from range(100)", "double": "select id k, cast(id * 3 as double) v, 'x' extra from range(40)", "lossy": "select id k, id + 0.5d v from range(5)", "short": "select id k from range(7)", "none": "select id k from range(7) where id > 9"}.items():
        spark.sql(query).coalesce(1).write.parquet(f"file:{at}/{name}")
    files = {p.parent.name: p for p in at.rglob("*.parquet")}
    sums = lambda: {n: hashlib.sha256(p.read_bytes()).hexdigest() for n, p in files.items()}
    before = sums()
    out = {r.path.rsplit("/", 2)[1]: (r.rows, r.state) for r in repair.repair_files(spark, f"file:{at}", {"k": "long", "v": "long"}, f"file:{at}-backup").collect()}
    assert out == {"long": (100, "ok"), "double": (40, "repaired"), "lossy": (5, "lossy"), "short": (7, "repaired"), "none": (0, "empty")}
    after = sums()
    assert {n for n in before if before[n] != after[n]} == {"double", "short"}
    backed = {hashlib.sha256(p.read_bytes()).hexdigest() for p in pathlib.Path(f"{at}-backup").glob("*.parquet")}
    assert backed == {before["double"], before["short"]}
    assert [tuple(r) for r in spark.read.parquet(f"file:{files['double']}").collect()] == [(i, 3 * i, "x") for i in range(40)]
    assert [tuple(r) for r in spark.read.parquet(f"file:{files['short']}").collect()] == [(i, None) for i in range(7)]
    again = repair.repair_files(spark, f"file:{at}", {"k": "long", "v": "long"}, f"file:{at}-backup")
    assert again.where("state = 'ok'").count() == 3 and sums() == after


def test_staged_partitions_replace_only_their_own(spark, tmp_path):
    from tessera.sources import tables

    df = spark.sql("select id k, id % 3 a, id % 2 b from range(30)")
    at, stage = f"file:{tmp_path}/t", f"file:{tmp_path}/stage"
    tables.staged_write(df, at, stage, ("a", "b"), rows=30)
    tables.staged_write(df.where("a = 1 and b = 0").limit(2), at, stage, ("a", "b"), rows=2)
    got = spark.read.parquet(at)
    assert got.count() == 27 and got.where("a = 1 and b = 0").count() == 2 and not (tmp_path / "stage").exists() and not (tmp_path / "stage-before").exists()
    with pytest.raises(ValueError):
        tables.staged_write(df, at, stage, ("a", "b"), rows=31)
    assert spark.read.parquet(at).count() == 27
    tables.staged_write(df.limit(4), f"file:{tmp_path}/u", stage)
    tables.staged_write(df.limit(3), f"file:{tmp_path}/u", stage)
    assert spark.read.parquet(f"file:{tmp_path}/u").count() == 3


# ---------------------------------------------------------------- models


def test_fitted_weights_are_where_the_penalised_loss_is_flat(spark):
    from tessera.operators import runs

    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (400, 3)) * [1, 2, 0.5]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.0] + 0.3)))).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = runs.fit_logistic(df, ["a", "b", "c"], "y", reg=0.05)
    fitted = model.stages[-1] if hasattr(model, "stages") else model
    w, b0 = np.array(fitted.coefficients), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b0)))
    std = x.std(0, ddof=1)
    # the penalty is on weights of standardised columns
    assert np.abs(((p - y) @ x) / 400 / std + 0.05 * w * std).max() < 1e-4 and abs((p - y).mean()) < 1e-4


def test_a_planted_feature_is_the_most_important(spark):
    from tessera.operators import runs

    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (600, 4))
    df = spark.createDataFrame([(*map(float, r), float(r[2] > 0.2)) for r in x], "a double, b double, c double, d double, y double")
    rows = runs.importances(spark, runs.fit_trees(df, list("abcd"), "y"), list("abcd")).collect()
    best = max(rows, key=lambda r: r["importance"])
    assert best[0] == "c" and best["importance"] > 0.8


def test_a_fit_makes_its_rows_once_and_keeps_none(spark):
    from tessera.operators import runs

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for x in batches:
            made.add(len(x))
            yield x

    df = spark.range(400).selectExpr("id % 7 * 1.0D as a", "id % 5 * 1.0D as b", "double(id % 3 = 0) as y").mapInPandas(counted, "a double, b double, y double")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    for fit in (runs.fit_logistic, runs.fit_trees):
        made.value = 0
        fit(df, ["a", "b"], "y")
        assert made.value == 400 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_a_users_open_days_are_one_value_with_one_timer():
    from types import SimpleNamespace

    from tessera.streaming.events import DAY, DailyState

    held, timers, calls = [], [], []
    state = SimpleNamespace(get=lambda: calls.append("get") or (held[-1] if held else None), update=lambda v: calls.append("update") or held.append(v))
    p = DailyState()
    p.init(SimpleNamespace(getValueState=lambda name, schema: state, registerTimer=timers.append))
    row = lambda day, us, i, kind: SimpleNamespace(day=day, us=us, event_id=i, event_type=kind)
    rows = [row(d, d * 100 + k, d * 3 + k, "error" if k == 1 else "view") for d in range(30, 0, -1) for k in range(3)]
    assert list(p.handleInputRows((7,), iter(rows), None)) == []
    assert calls == ["get", "update"] and timers == [2 * DAY]  # of the first day alone
    at = lambda day: SimpleNamespace(getCurrentWatermarkInMs=lambda: day * DAY)
    out = list(p.handleExpiredTimer((7,), at(21), None))
    assert [tuple(r) for r in out] == [(7, d, "view", d, d > 3) for d in range(1, 21)]
    assert timers == [2 * DAY, 22 * DAY] and len(calls) == 4
    assert list(p.handleInputRows((7,), iter([row(25, 2502, 99, "late"), row(25, 1, 1, "error")]), None)) == []  # an equal time: the larger id
    out = list(p.handleExpiredTimer((7,), at(31), None))
    assert [r.day for r in out] == list(range(21, 31)) and out[4].last_type == "late" and out[-1].errors_so_far == 31
