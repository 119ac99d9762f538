"""Late rows restated: a stream whose every batch rewrites the trailing open days that its rows reach.

Each batch's rows go to the table of rows, and features of the keys that they concern are computed again from the first
late day to the last day that still looks back on it.  Both tables and the batch's number are one version of a store,
so a batch that is replayed after a failure is either in both already, and passed over, or in neither.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import small
from ..sources.versions import Store, Upsert


@dataclass(frozen=True)
class Restated:
    """Rows (key, d, value) arriving in any order, and features over the last `days` open days of each key."""

    store: Store
    calendar: DataFrame  # d, seq: the open days
    key: str
    value: str
    days: int
    features: dict[str, Callable[[str], Column]]  # name: aggregate of the value over the window
    partition: Callable[[str], Column]  # of a date column

    def create(self, like: DataFrame) -> None:
        """Empty tables for rows such as these."""
        rows = like.limit(0).select(self.key, "d", self.value)
        self.store.create({"rows": (rows.withColumn("part", self.partition("d")), "part"), "features": (self._featured(rows).withColumn("part", self.partition("d")), "part")}, {"batch": -1})

    def _featured(self, rows: DataFrame) -> DataFrame:
        x = rows.join(small(self.calendar.select("d", "seq")), "d")
        w = Window.partitionBy(self.key).orderBy("seq").rangeBetween(1 - self.days, 0)
        return x.withColumns({n: f(self.value).over(w) for n, f in self.features.items()}).select(self.key, "d", *self.features)

    def restate(self, batch: DataFrame, number: int) -> None:
        """Takes one batch in; for foreachBatch."""
        base = self.store.version()
        if number <= base.note["batch"]:
            return
        new = batch.select(self.key, "d", self.value).withColumn("part", self.partition("d")).persist()
        kept = [new]
        cal = small(self.calendar.select("d", "seq"))
        reach = new.join(cal, "d").groupBy(self.key).agg(F.min("seq").alias("_lo"), F.max("seq").alias("_hi"))
        ends = reach.agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).first()
        changes = [Upsert("rows", new, (self.key, "d"), "part")]
        if ends.lo is not None:
            # days that the batch's first row looks back on, to those that look back on its last: bounds of the scan
            seq = F.col("seq")
            a, b = self.calendar.agg(F.min(F.when(seq >= ends.lo - self.days + 1, F.col("d"))), F.max(F.when(seq <= ends.hi + self.days - 1, F.col("d")))).first()
            old = self.store.read("rows", base).where(F.col("part").between(self.partition(F.lit(a)), self.partition(F.lit(b))) & F.col("d").between(F.lit(a), F.lit(b)))
            rows = old.join(new.select(self.key, "d"), [self.key, "d"], "left_anti").unionByName(new).select(self.key, "d", self.value)
            placed = lambda df: df.join(cal, "d").join(reach, self.key)
            near = placed(rows).where(seq.between(F.col("_lo") - self.days + 1, F.col("_hi") + self.days - 1)).select(self.key, "d", self.value)
            again = placed(self._featured(near)).where(seq.between(F.col("_lo"), F.col("_hi") + self.days - 1))
            # kept, as an upsert reads its rows for their partitions, for what they replace, and to write them
            kept.append(again.select(self.key, "d", *self.features).withColumn("part", self.partition("d")).persist())
            changes.append(Upsert("features", kept[-1], (self.key, "d"), "part"))
        self.store.refresh(changes, base, {"batch": number})
        for df in kept:
            df.unpersist()

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """All that has arrived, from where the checkpoint left off."""
        sink = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(self.restate)
        sink.trigger(availableNow=True).start().awaitTermination()
