"""Structured Streaming twins of the incremental steps: arrival of files, bins, flood duration, alert status."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.alerts import alert_code, alert_status
from freshet.functions.dates import run_ts_from_path
from freshet.functions.numeric import clean
from freshet.operators.temporal import flood_duration, last_durations
from freshet.session import DEFAULTS, stored
from freshet.sources.sinks import reprocess

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Files per micro-batch: bounds what a micro-batch holds of one watershed.
MAX_FILES = 1000
LATENESS = "2 days"


def stream_summaries(
    spark: SparkSession, path: str, product: str, max_files: int = MAX_FILES, once_within: str | None = None
) -> DataFrame:
    """Stream of newly arrived summary CSV files; the checkpoint of the query remembers which were read.

    With ``once_within``, such as ``2 days``, a watershed's row of a run counts once, also when its file is delivered again
    under another name: the first one that arrives stays. The state keeps keys, and those only for that long.
    """
    reader = spark.readStream.schema(S.SUMMARIES[product]).option("header", True).option("maxFilesPerTrigger", max_files)
    raw = reader.csv(path).withColumn("run_ts", run_ts_from_path(F.col("_metadata.file_path")))
    if once_within is not None:
        raw = raw.withWatermark("run_ts", once_within).dropDuplicatesWithinWatermark(["run_ts", "pfaf_id"])
    if product in ("dfo", "viirs"):
        raw = raw.withColumn("run_date", F.to_date("run_ts")).drop("run_ts")
    return clean(raw.drop("row_index"))


def stream_bins(
    stream: DataFrame, width: str = "3 hours", time: str = "ts", keys: tuple[str, ...] = ("pfaf_id",),
    value: str = "value", lateness: str = LATENESS, unique: tuple[str, ...] = (),
) -> DataFrame:
    """Tumbling bins per watershed, emitted once no later data can reach them. Rows with the same ``unique`` columns that come
    within the lateness of each other count once."""
    marked = stream.withWatermark(time, lateness)
    return (
        (marked.dropDuplicatesWithinWatermark(list(unique)) if unique else marked)
        .groupBy(F.window(time, width), *keys)
        .agg(F.sum(value).alias("total"), F.count("*").alias("n"))
        .select(F.col("window.start").alias("run_ts"), *keys, "total", "n")
    )


def stream_flood_duration(
    summaries: DataFrame, area: str = "gfms_totalarea_km", lateness: str = LATENESS, step_hours: int = 3,
    threshold: float = 100.0, max_gap_hours: float = 3, carry: DataFrame | None = None,
) -> DataFrame:
    """Flood duration over a stream of summary rows; the batch twin is ``flood_duration``.

    State per watershed: the last step (time, duration) and the steps the watermark has not passed yet. Steps are
    applied in time order once the watermark has passed them, so their order of arrival does not matter. A summary
    file holds a watershed once, so a watershed keeps at most the steps of the lateness and of one micro-batch's files.
    History belongs to the batch twin: its last durations come in as ``carry`` (pfaf_id, last_ts, duration).
    """
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

    # Keyed state with timers needs the state store that keeps its data off the heap.
    summaries.sparkSession.conf.set(STATE_STORE, DEFAULTS[STATE_STORE])

    class Duration(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "us long, duration int")
            self.waiting = handle.getListState("waiting", "us long, area double")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            row = initialState.iloc[0]
            self.last.update((int(row["us"]), int(row["duration"])))

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            for chunk in rows:
                us = chunk["run_ts"].astype("datetime64[us]").astype("int64").tolist()
                self.waiting.appendList(list(zip(us, chunk["area"].astype("float64").tolist(), strict=True)))
            yield from self.advance(key, timerValues.getCurrentWatermarkInMs() * 1000)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
            yield from self.advance(key, timerValues.getCurrentWatermarkInMs() * 1000)

        def advance(self, key, watermark: int) -> Iterator:
            import pandas as pd

            steps = sorted((u, a) for u, a in self.waiting.get())
            ready = [s for s in steps if s[0] <= watermark]
            if len(ready) < len(steps):
                # Woken again as soon as the watermark passes the next step.
                self.handle.registerTimer(steps[len(ready)][0] // 1000)
            if not ready:
                return
            if len(ready) < len(steps):
                self.waiting.put(steps[len(ready) :])
            else:
                self.waiting.clear()
            at, hours = self.last.get() or (None, 0)
            out = []
            for u, a in ready:
                if at is not None and u <= at:
                    continue  # delivered again
                linked = at is not None and u - at <= max_gap_hours * 3_600_000_000
                hours = (step_hours + (hours if linked else 0)) if a > threshold else 0
                at = u
                out.append((u, a, hours))
            self.last.update((at, hours))
            done = pd.DataFrame(out, columns=["us", "area", "duration"])
            yield pd.DataFrame(
                {
                    "pfaf_id": key[0],
                    "run_ts": done["us"].astype("datetime64[us]"),
                    "area": done["area"],
                    "duration": done["duration"].astype("int32"),
                }
            )

        def close(self) -> None:
            pass

    steps = summaries.select("run_ts", F.col("pfaf_id").cast("long").alias("pfaf_id"), F.col(area).alias("area"))
    out = (
        steps.withWatermark("run_ts", lateness)
        .groupBy("pfaf_id")
        .transformWithStateInPandas(
            statefulProcessor=Duration(),
            outputStructType="pfaf_id long, run_ts timestamp, area double, duration int",
            outputMode="Append",
            timeMode="EventTime",
            initialState=None if carry is None else carry.select(
                F.col("pfaf_id").cast("long").alias("pfaf_id"),
                F.unix_micros("last_ts").alias("us"),
                F.col("duration").cast("int").alias("duration"),
            ).groupBy("pfaf_id"),
        )
    )
    return out.select("run_ts", "pfaf_id", F.col("area").alias(area), F.col("duration").alias("gfms_duration"))


_CARRY = "pfaf_id long, last_ts timestamp, duration int"


def advance_durations(
    batch: DataFrame, number: int, path: str, state: str, area: str = "gfms_totalarea_km", lateness_hours: float = 48,
    carry: DataFrame | None = None, **options,
) -> None:
    """One micro-batch of summary rows: its durations to ``path``, partition ``batch = number``, by the batch twin's algorithm.

    ``state`` has two slots, used in turn: each holds a batch's last duration of every watershed and the steps that wait for
    the newest time seen to be ``lateness_hours`` past them. A batch reads the slot of the one before and replaces its own and
    its partition, so a repeated batch changes nothing, whatever it had written. ``carry`` (pfaf_id, last_ts,
    duration) is where the first batch goes on from. Steps not after a watershed's last one were delivered again or
    too late and are skipped, rows without time or watershed as well.
    """
    spark = batch.sparkSession
    before, after = f"{state}/{(number + 1) % 2}", f"{state}/{number % 2}"
    steps = batch.select("run_ts", F.col("pfaf_id").cast("long").alias("pfaf_id"), F.col(area).cast("double").alias(area))
    steps = steps.where(F.col("run_ts").isNotNull() & F.col("pfaf_id").isNotNull())
    last = spark.createDataFrame([], _CARRY) if carry is None else carry.selectExpr("CAST(pfaf_id AS long) pfaf_id", "last_ts", "CAST(duration AS int) duration")
    if number:
        last = spark.read.schema(_CARRY).parquet(f"{before}/carry")
        steps = steps.unionByName(spark.read.schema(steps.schema).parquet(f"{before}/waiting"))
    # Read by what follows three times; the batch's own source may not be there as long.
    steps = steps.join(last.select("pfaf_id", "last_ts"), "pfaf_id", "left").where(F.col("last_ts").isNull() | (F.col("run_ts") > F.col("last_ts")))
    steps = stored(steps.drop("last_ts"), "steps")
    newest, applied = (df.agg(F.max(F.unix_micros(c))).first()[0] for df, c in ((steps, "run_ts"), (last, "last_ts")))
    if newest is None:
        newest = applied or 0
    horizon = F.timestamp_micros(F.lit(max(newest - round(lateness_hours * 3_600_000_000), applied or 0)))
    done = stored(flood_duration(steps.where(F.col("run_ts") <= horizon), area, carry=last, **options), "durations")
    out = done.withColumn("batch", F.lit(number).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    both = last.unionByName(last_durations(done)).groupBy("pfaf_id").agg(F.max("last_ts").alias("last_ts"), F.max_by("duration", "last_ts").alias("duration"))
    both.write.mode("overwrite").parquet(f"{after}/carry")
    steps.where(F.col("run_ts") > horizon).write.mode("overwrite").parquet(f"{after}/waiting")


def durations_available(
    summaries: DataFrame, path: str, state: str, checkpoint: str, lateness_hours: float = 48, carry: DataFrame | None = None, **options,
) -> None:
    """Flood durations of what there is of a stream, batch by batch as in ``advance_durations``: no row goes through Python, and
    no watershed's steps meet in one task. ``path``, ``state`` and ``checkpoint`` belong together."""
    query = (
        summaries.writeStream.foreachBatch(
            lambda batch, number: advance_durations(batch, number, path, state, lateness_hours=lateness_hours, carry=carry, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_alert_status(alerts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Alert rows with the status against exactly one day before, as an outer self join of the stream.

    The earlier side is shifted by a day, so that the join is an equality on run and watershed and the watermark
    bounds its state. New rows come out once the watermark shows that no earlier row will follow. The batch twin is
    ``day_over_day(require_previous_run=False)``; ``published_runs`` applies its rule on whole runs.
    """
    rows = alerts.select("run_ts", "pfaf_id", "alert")
    current = rows.withWatermark("run_ts", lateness)
    previous = rows.select(
        (F.col("run_ts") + F.expr("INTERVAL 1 DAY")).alias("previous_ts"),
        F.col("pfaf_id").alias("previous_id"),
        F.col("alert").alias("previous_alert"),
    ).withWatermark("previous_ts", lateness)
    match = (F.col("pfaf_id") == F.col("previous_id")) & (F.col("run_ts") == F.col("previous_ts"))
    status = alert_status(alert_code(F.col("alert")), alert_code(F.col("previous_alert")))
    return current.join(previous, match, "left_outer").select(
        "run_ts", "pfaf_id", "alert", "previous_alert", status.alias("status")
    )


def published_runs(statuses: DataFrame) -> DataFrame:
    """Keep the runs that have a run exactly one day before (batch, on the stream's output table)."""
    earlier = statuses.select((F.col("run_ts") + F.expr("INTERVAL 1 DAY")).alias("run_ts")).distinct()
    return statuses.join(earlier, "run_ts", "left_semi")


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process what is there, append it to ``path`` and stop; the next call goes on from the checkpoint."""
    query = (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def publish_available(
    alerts: DataFrame, alerts_path: str, published_path: str, centroids: DataFrame, checkpoint: str, apply_north_filter: bool = False
) -> None:
    """Published alerts of a stream of whole runs, new or corrected: each micro-batch replaces its runs in the alert table and
    publishes them and the runs a day later again.

    What is compared with is looked up in the table, so nothing is kept in memory or state however late a run comes. A
    repeated batch writes the same rows again.
    """
    from freshet.plans.pipelines import publish_stale

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            reprocess(batch, alerts_path, ["run_ts"])
            table = batch.sparkSession.read.schema(batch.schema).parquet(alerts_path)
            publish_stale(table, alerts_path, published_path, centroids, apply_north_filter)

    query = alerts.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upsert_available(stream: DataFrame, path: str, keys: list[str], checkpoint: str) -> None:
    """Process what is there and replace the partitions each micro-batch touches; a repeated batch changes nothing.

    For complete partitions, such as the corrected files of a date.
    """
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: reprocess(batch, path, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
