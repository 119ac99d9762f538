"""Masters, point-in-time facts, wide samples, panels, and writers of windows, manifests and repaired schemas."""

from __future__ import annotations

import json
import uuid
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import safe_divide
from ..sources.tables import staged_write
from .joins import latest_by
from .panel import bounded_ffill_all, xs_minmax_weight


def security_master(snapshots: DataFrame, seen: DataFrame, last_open, grace_days: int = 30) -> DataFrame:
    """sec, name, list_date, delist_date, status (L, D, P) and origin, from snapshots (sec, name, asof) and sightings (sec, d).

    The latest snapshot of a name counts.  A name is listed from its first sighting; one not seen in the last
    grace_days up to last_open is delisted the day after its last; one never seen is pending (P).  Names that are seen
    but in no snapshot are derived.
    """
    latest = latest_by(snapshots, ["sec"], [F.desc("asof"), F.desc("name")]).select("sec", "name")
    life = seen.groupBy("sec").agg(F.min("d").alias("list_date"), F.max("d").alias("_z"))
    x = latest.join(life, "sec", "full")
    gone = F.col("_z") < F.date_sub(F.lit(last_open) if not isinstance(last_open, Column) else last_open, grace_days)
    return x.select(
        "sec",
        F.coalesce("name", F.concat(F.lit("derived "), F.col("sec").cast("string"))).alias("name"),
        "list_date",
        F.when(gone, F.date_add("_z", 1)).alias("delist_date"),
        F.when(F.col("_z").isNull(), "P").when(gone, "D").otherwise("L").alias("status"),
        F.when(F.col("name").isNull(), "derived").otherwise("snapshot").alias("origin"),
    )


@dataclass(frozen=True)
class PitSource:
    """A versioned report: which rows, its value, and how it is named."""

    name: str
    rows: Column
    value: Column


def pit_facts(reports: DataFrame, sources: list[PitSource]) -> DataFrame:
    """source, c, period, ann, key, value: the reports of all sources in one pass; a row may serve several."""
    each = F.array_compact(F.array(*(F.when(s.rows, F.struct(F.lit(s.name).alias("source"), s.value.cast("double").alias("value"))) for s in sources)))
    return reports.select("c", "period", "ann", "key", F.inline(each))


def pit_latest(facts: DataFrame) -> DataFrame:
    """The last announced version of each source, entity and period."""
    return latest_by(facts, ["source", "c", "period"], [F.desc("ann"), F.desc("key")])


class Visible:
    """What is known of one source at a day: the queue of reports that may still be the best, and the last value of each period.

    Reports come by the day of their announcement.  One that a later, higher-ranked one has overtaken can't be the best
    again, so the queue falls in rank from its front, and days too long ago leave at the front.
    """

    def __init__(self):
        self.queue: deque = deque()
        self.last: dict = {}

    def add(self, day: int, rank: tuple, period, prior, value) -> None:
        while self.queue and self.queue[-1][1] <= rank:
            self.queue.pop()
        self.queue.append((day, rank, prior, value))
        self.last[period] = value

    def at(self, day: int, lookback: int) -> tuple:
        """Value, age and the value of the period a year before, or nulls."""
        while self.queue and self.queue[0][0] < day - lookback:
            self.queue.popleft()
        if not self.queue:
            return None, None, None
        since, _, prior, value = self.queue[0]
        return value, day - since, self.last.get(prior) if prior is not None else None


def as_known(batches, sources: list[str], lookback: int):
    """Rows of the grid, with what each source shows, of rows sorted by entity and day, reports before grid rows."""
    now, held, began = None, {}, False
    for batch in batches:
        for lo in range(0, batch.num_rows, 8192):
            cut = batch.slice(lo, 8192)
            kept, found = [], {s: ([], [], []) for s in sources}
            for i, (c, day, source, period, prior, key, value) in enumerate(zip(*(cut.column(n).to_pylist() for n in ("c", "_day", "source", "_period", "_prior", "key", "value")), strict=True)):
                if not began or c != now:
                    now, began, held = c, True, {s: Visible() for s in sources}
                if source is not None:
                    held[source].add(day, (period is not None, period or 0, day, key is not None, key or 0), period, prior, value)
                    continue
                kept.append(i)
                for s in sources:
                    for column, x in zip(found[s], held[s].at(day, lookback) if c is not None and day is not None else (None,) * 3, strict=True):
                        column.append(x)
            out = [cut.column("c").take(pa.array(kept, pa.int32())), cut.column("d").take(pa.array(kept, pa.int32()))]
            for s in sources:
                out += [pa.array(found[s][0], pa.float64()), pa.array(found[s][1], pa.int32()), pa.array(found[s][2], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, ["c", "d", *(f"{s}_{k}" for s in sources for k in ("value", "age", "before"))])


def pit_features(grid: DataFrame, facts: DataFrame, sources: list[str], lookback_days: int = 900) -> DataFrame:
    """grid (c, d) with, for each source, the value of the latest period visible at d, its age in days, and its growth
    over the same period a year before as known then; the latest period wins over a later restatement of an older one.

    Grid and facts are read once and merged by one sort of each entity's rows by day, whatever the number of sources; a
    task holds one entity's open reports and its last value of each period.
    """
    g = grid.select("c", "d", F.unix_date("d").alias("_day"), *(F.lit(None).cast(t).alias(n) for n, t in (("source", "string"), ("_period", "int"), ("_prior", "int"), ("key", "long"), ("value", "double"))))
    f = facts.where(F.col("source").isin(*sources) & F.col("c").isNotNull() & F.col("ann").isNotNull())
    f = f.select("c", F.lit(None).cast(grid.schema["d"].dataType).alias("d"), F.unix_date("ann").alias("_day"), "source", F.unix_date("period").alias("_period"), F.unix_date(F.add_months("period", -12)).alias("_prior"), F.col("key").cast("long").alias("key"), F.col("value").cast("double").alias("value"))
    rows = g.unionByName(f).repartition("c").sortWithinPartitions("c", "_day", F.asc_nulls_last("source"), F.asc_nulls_first("key"))
    kind = lambda n: grid.schema[n].dataType.simpleString()
    schema = f"c {kind('c')}, d {kind('d')}, " + ", ".join(f"{s}_value double, {s}_age int, {s}_before double" for s in sources)
    known = rows.mapInArrow(lambda batches: as_known(batches, sources, lookback_days), schema)
    each = [x for s in sources for x in (F.col(f"{s}_value"), F.col(f"{s}_age"), (safe_divide(f"{s}_value", f"{s}_before") - 1).alias(f"{s}_growth"))]
    return known.select("c", "d", *each)


def training_panel(sample: DataFrame, key: str, date: str, label: str, features: list[str], interactions: dict[str, tuple[str, str]], weight_by: str, max_age: int = 5) -> DataFrame:
    """Labelled rows with features carried forward at most max_age rows, products of two of them, and a weight from 1 to 3
    by the place of weight_by in the day's range.
    """
    x = bounded_ffill_all(sample, key, date, features, max_age)
    x = x.withColumns({out: F.col(a) * F.col(b) for out, (a, b) in interactions.items()})
    return xs_minmax_weight(x.where(F.col(label).isNotNull()), date, weight_by, "weight")


def manifest(df: DataFrame, name: str) -> DataFrame:
    """name, rows, columns (as JSON) and sha256 of the table's content, whatever its order; hashes are added, not gathered."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")) for i in range(8)]
    return df.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(",", *(F.coalesce(p, F.lit(0)).cast("string") for p in parts)), 256).alias("sha256")).select(F.lit(name).alias("name"), "rows", F.lit(json.dumps({f.name: f.dataType.simpleString() for f in df.schema})).alias("columns"), "sha256")


def schema_diff(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """column, expected, actual, state (ok, cast, missing, extra): a row a column."""
    have = dict(df.dtypes)
    norm = lambda t: T._parse_datatype_string(t).simpleString()
    rows = [(c, norm(contract[c]) if c in contract else None, have.get(c), "missing" if c not in have else "extra" if c not in contract else "ok" if have[c] == norm(contract[c]) else "cast") for c in sorted(contract.keys() | have.keys())]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, state string")


def lossy_casts(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """column, lossy: how many values of each column to be cast don't come back the same."""
    casts = [c for c, t in df.dtypes if c in contract and t != T._parse_datatype_string(contract[c]).simpleString()]
    back = [F.count_if(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(c).try_cast(contract[c]).try_cast(dict(df.dtypes)[c]))).alias(c) for c in casts]
    return df.agg(*back).unpivot([], [f"`{c}`" for c in casts], "column", "lossy") if casts else df.sparkSession.createDataFrame([], "column string, lossy long")


def repair_schema(spark: SparkSession, path: str, contract: dict[str, str], out: str) -> None:
    """The table at path, cast to contract, staged, checked and published at out; raises if a cast loses values."""
    df = spark.read.parquet(path)
    bad = lossy_casts(df, contract).where("lossy > 0").collect()  # a row a column
    if bad:
        raise ValueError(f"casts lose values: {[tuple(r) for r in bad]}")
    fixed = df.select(*((F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in contract.items()))
    staged_write(fixed, out, f"{out}-stage-{uuid.uuid4().hex}", rows=df.count())


def lineage(df: DataFrame, source: str, run_id: str, ingested_at: str, params: dict) -> DataFrame:
    return df.withColumns({"_source": F.lit(source), "_run_id": F.lit(run_id), "_ingested_at": F.lit(ingested_at).cast("timestamp_ntz"), "_params": F.lit(json.dumps(params, sort_keys=True, separators=(",", ":")))})


def one_to_one(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """a joined to b; raises unless keys are unique in both."""
    for side in (a, b):
        if side.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"{keys} aren't unique")
    return a.join(b, keys, how)


def json_patch(col: str, changes: dict, remove: tuple[str, ...] = ()) -> Column:
    """A JSON object with fields set (to strings, numbers, lists, objects, null) and removed; other fields keep their types.

    What is null, malformed or no object counts as an empty one, so that a patch is never lost.
    """
    nothing = F.expr("cast(map() as map<string, variant>)")
    fields = F.coalesce(F.try_variant_get(F.try_parse_json(col), "$", "map<string,variant>"), nothing)
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*changes, *remove))
    new = F.create_map(*(x for k, v in changes.items() for x in (F.lit(k), F.parse_json(F.lit(json.dumps(v)))))) if changes else nothing
    return F.to_json(F.to_variant_object(F.map_concat(kept, new)))


def canonical_dividends(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each of keys from event rows (cash, bonus, conversion, record, announced, id): amounts are added as
    decimals, unknown ones counting nothing; the last record day stands; announcements are listed, each once, in order.
    """
    amount = lambda c: F.sum(F.coalesce(F.col(c).try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))).alias(c)
    lead = F.min_by("id", F.struct("announced", "id")).alias("first_id")
    return events.groupBy(*keys).agg(amount("cash"), amount("bonus"), amount("conversion"), F.count("*").alias("events"), F.max("record").alias("record"), F.array_join(F.sort_array(F.collect_set(F.col("announced").cast("string"))), ";").alias("announced"), lead)
