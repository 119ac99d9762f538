"""Event streams: windowed counts, events whose follower is missing, and state by user and day.

Each has a batch query with the same rows.  Counts and missing followers are final once the watermark has passed; days
are given out by timers of event time, and may begin from a state that history has left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.tables import shared_dir, table

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def windowed_counts(events: DataFrame, minutes: int = 60, late: str = "2 days") -> DataFrame:
    """Events and sum of value for each type and tumbling window of event time."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def windowed_counts_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run to its end over the events files; each trigger's result is a folder of its own, the last one counts."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    at = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    counts = windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    last: list[int] = []

    def put(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{at}/counts/{number}")
        last.append(number)

    counts.writeStream.outputMode("complete").option("checkpointLocation", f"{at}/state").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/counts/{last[-1]}")


class Feed:
    """Folders of events that a stream reads one after another, each taken in by a run that starts from the checkpoint."""

    def __init__(self, events: DataFrame, name: str):
        self.spark, self.at, self.n = events.sparkSession, f"{shared_dir(events.sparkSession)}/{name}-{uuid.uuid4().hex}", 0
        self.schema = events.schema

    def put(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.at}/in/{self.n:06d}")
        self.n += 1

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.at}/in/*")

    def run(self, result: DataFrame, name: str = "out") -> None:
        """Appends what is final to the files of `name`, exactly once, and stops."""
        sink = result.writeStream.outputMode("append").format("parquet").option("path", f"{self.at}/{name}").option("checkpointLocation", f"{self.at}/checkpoint-{name}")
        sink.trigger(availableNow=True).start().awaitTermination()

    def read(self, name: str = "out") -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/{name}")


# ---------------------------------------------------------------- missing followers


def without_follower(first: DataFrame, then: DataFrame, key: str, within: str, late: str) -> DataFrame:
    """event_id of rows of `first` that no row of `then` of the same key follows within a time, as streams.

    A left outer join of two streams bounded in time: a row is given out when the watermark of both has passed its bound.
    """
    a = first.select("event_id", F.col(key).alias("_a"), F.col("ts").alias("_from")).withWatermark("_from", late)
    b = then.select(F.col("event_id").alias("_id"), F.col(key).alias("_b"), F.col("ts").alias("_at")).withWatermark("_at", late)
    bound = F.expr(f"_a = _b and _at > _from and _at <= _from + interval {within}")
    return a.join(b, bound, "leftOuter").where("_id is null").select("event_id")


# ---------------------------------------------------------------- state by user and day


DAY = 86_400_000  # milliseconds


class DailyState(StatefulProcessor):
    """A row for each user and day with events, when the day is over: last type, errors so far, whether `warm` days came before.

    A day is kept open until the watermark has passed its end, so that late events count in it; days are given out in
    order, because what a day shows depends on those before.  A user's state is one value, which a batch reads and
    writes once however many days are open, and only the first open day has a timer: it gives out all that are over.
    """

    def __init__(self, warm: int = 3):
        self.warm = warm

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "errors long, days long, open array<struct<day: long, us: long, event_id: long, event_type: string, errors: long>>")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState["errors"], initialState["days"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        errors, n, held = self.state.get() or (0, 0, [])
        open_ = {h[0]: tuple(h[1:]) for h in held}
        first = min(open_, default=None)
        for r in rows:
            us, event_id, kind, bad = open_.get(r.day) or (r.us, r.event_id, r.event_type, 0)
            if (r.us, r.event_id) > (us, event_id):
                us, event_id, kind = r.us, r.event_id, r.event_type
            open_[r.day] = us, event_id, kind, bad + (r.event_type == "error")
        if open_ and (first is None or min(open_) < first):
            self.handle.registerTimer((min(open_) + 1) * DAY)
        self.state.update((errors, n, [(day, *open_[day]) for day in sorted(open_)]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        errors, n, held = self.state.get() or (0, 0, [])
        upto, out = timerValues.getCurrentWatermarkInMs(), []
        over = [h for h in held if (h[0] + 1) * DAY <= upto]
        for day, _, _, kind, bad in over:
            errors += bad
            out.append(Row(user_id=key[0], day=day, last_type=kind, errors_so_far=errors, warm=n >= self.warm))
            n += 1
        left = held[len(over) :]
        self.state.update((errors, n, [tuple(h) for h in left]))
        if over and left:
            self.handle.registerTimer((left[0][0] + 1) * DAY)
        return iter(out)

    def close(self) -> None:
        pass


def day_number(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)).cast("long")


def daily_state(events: DataFrame, history: DataFrame | None = None, late: str = "1 day", warm: int = 3) -> DataFrame:
    """user_id, day (since 1970), last_type, errors_so_far, warm of a stream of events; history (user_id, errors, days) is the state to begin from."""
    x = events.select("user_id", "event_id", "event_type", "ts", F.unix_micros("ts").alias("us"), day_number(F.col("ts")).alias("day")).withWatermark("ts", late)
    begin = history.groupBy("user_id") if history is not None else None
    return x.groupBy("user_id").transformWithState(DailyState(warm), "user_id long, day long, last_type string, errors_so_far long, warm boolean", "append", "eventTime", begin)
