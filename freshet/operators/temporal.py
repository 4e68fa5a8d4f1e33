"""Operators along the time axis: flood duration, as-of and previous-day joins, run inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.alerts import alert_code, alert_status
from freshet.functions.dates import is_ready
from freshet.functions.numeric import nan_to_null
from freshet.session import stored

HOUR = 3600


def _unix(c: str | Column) -> Column:
    return F.unix_micros(c if isinstance(c, Column) else F.col(c)) / F.lit(1_000_000)


def flood_duration(
    summary: DataFrame,
    area: str = "gfms_totalarea_km",
    out: str = "gfms_duration",
    step_hours: int = 3,
    threshold: float = 100.0,
    max_gap_hours: float = 3,
    carry: DataFrame | None = None,
    block_days: int = 64,
) -> DataFrame:
    """Hours of uninterrupted flooding up to each step.

    A step above ``threshold`` adds ``step_hours`` to the previous step's duration; any other step, and any gap longer
    than ``max_gap_hours``, starts over. ``carry`` (pfaf_id, last_ts, duration) continues from an earlier batch.

    The series of a watershed is cut into blocks of ``block_days``. Streaks are counted inside the blocks, the blocks'
    closing streaks are chained per watershed (one row per block), and the streak that enters a block is added to its
    leading rows. No task ever holds more than one block of a watershed, however long its series is.

    A step that was delivered more than once counts once, with its largest area.
    """
    step = F.lit(float(step_hours))
    gap = F.lit(float(max_gap_hours) * HOUR)
    wet = F.coalesce(nan_to_null(F.col(area).cast("double")) > F.lit(threshold), F.lit(False))
    rows = summary.withColumn("_wet", wet).withColumn(
        "_block", F.floor(_unix("run_ts") / F.lit(block_days * 86400))
    )
    # One exchange serves the choice among repeated steps, the streaks and the blocks.
    again = Window.partitionBy("pfaf_id", "_block", "run_ts").orderBy(F.col(area).desc_nulls_last())
    rows = rows.repartition("pfaf_id", "_block").withColumn("_nth", F.row_number().over(again)).where("_nth = 1").drop("_nth")
    inside = Window.partitionBy("pfaf_id", "_block").orderBy("run_ts")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    late = _unix("run_ts") - _unix(F.lag("run_ts").over(inside)) > gap
    own = F.when(F.col("_wet"), step).otherwise(F.lit(0.0))
    rows = (
        rows.withColumn("_break", ~F.col("_wet") | F.coalesce(late, F.lit(False)))
        .withColumn("_sum", F.sum(own).over(upto))
        .withColumn("_base", F.max(F.when(F.col("_break"), F.col("_sum") - own)).over(upto))
        .withColumn("_hours", F.when(F.col("_wet"), F.col("_sum") - F.coalesce("_base", F.lit(0.0))).otherwise(0.0))
    )
    blocks = rows.groupBy("pfaf_id", "_block").agg(
        F.min("run_ts").alias("_first"),
        F.max("run_ts").alias("_last"),
        F.max_by("_hours", "run_ts").alias("_closing"),
        (F.count("_base") == 0).alias("_through"),
    )
    if carry is not None:
        blocks = blocks.unionByName(
            carry.select(
                F.col("pfaf_id").cast(summary.schema["pfaf_id"].dataType).alias("pfaf_id"),
                F.lit(None).cast("long").alias("_block"),
                F.col("last_ts").alias("_first"),
                F.col("last_ts").alias("_last"),
                F.col("duration").cast("double").alias("_closing"),
                F.lit(False).alias("_through"),
            )
        )
    chain = Window.partitionBy("pfaf_id").orderBy(F.col("_block").asc_nulls_first())
    upto_block = chain.rowsBetween(Window.unboundedPreceding, 0)
    since = _unix("_first") - _unix(F.lag("_last").over(chain))
    blocks = (
        blocks.withColumn("_linked", F.coalesce((since > 0) & (since <= gap), F.lit(False)))
        .withColumn("_sum", F.sum("_closing").over(upto_block))
        .withColumn(
            "_base",
            F.max(F.when(~(F.col("_through") & F.col("_linked")), F.col("_sum") - F.col("_closing"))).over(upto_block),
        )
        .withColumn("_entering", F.when(F.col("_linked"), F.lag(F.col("_sum") - F.col("_base")).over(chain)))
        .where(F.col("_block").isNotNull())
        .select("pfaf_id", "_block", "_entering")
    )
    leading = F.col("_wet") & F.col("_base").isNull()
    entering = F.when(leading, F.coalesce("_entering", F.lit(0.0))).otherwise(F.lit(0.0))
    return (
        rows.join(blocks, ["pfaf_id", "_block"], "left")
        .withColumn(out, (F.col("_hours") + entering).cast("int"))
        .select(*dict.fromkeys([*summary.columns, out]))
    )


def last_durations(durations: DataFrame, out: str = "gfms_duration") -> DataFrame:
    """Carry table for the next batch: newest step of every watershed."""
    return durations.groupBy("pfaf_id").agg(
        F.max("run_ts").alias("last_ts"), F.max_by(out, "run_ts").alias("duration")
    )


def asof_latest(
    runs: DataFrame, dates: DataFrame, out: str = "latest_date", lookback_days: int = 9,
    same_day_hours: tuple[int, ...] = (18,),
) -> DataFrame:
    """Newest date within ``lookback_days`` before each run; the run's own day counts only at ``same_day_hours``.

    The bounded lookback turns the range condition into an equality: each date is listed under the ten days it may
    serve, so no inequality join and no window over all dates is needed.
    """
    served = (
        dates.select(F.col("run_date").alias(out))
        .distinct()
        .withColumn("_age", F.explode(F.sequence(F.lit(0), F.lit(lookback_days))))
        .withColumn("_day", F.date_add(out, F.col("_age")))
    )
    early = F.col("_age") > 0
    if same_day_hours:
        early = early | F.hour("run_ts").isin(*same_day_hours)
    distinct_runs = runs.select("run_ts").distinct().withColumn("_day", F.to_date("run_ts"))
    return distinct_runs.join(served, "_day", "left").groupBy("run_ts").agg(F.max(F.when(early, F.col(out))).alias(out))


def _exact_or_latest(
    runs: DataFrame, sources: DataFrame, key: Column, name: str, out: str, keep, look_ahead: bool
) -> DataFrame:
    """The source at ``key``, else the newest one before it, or the newest of all with ``look_ahead``.

    Works on inventories: one row per run and per source time, however large the products are.
    """
    known = sources.select(F.col(name).alias(out)).where(F.col(out).isNotNull()).distinct()
    wanted = runs.select("run_ts").distinct().withColumn("_want", key)
    if look_ahead:
        latest = sources.select(F.max(name)).scalar()
        joined = wanted.join(known, F.col("_want") == F.col(out), "left")
        fallback = F.when(keep(latest), latest) if keep else latest
        return joined.select("run_ts", F.coalesce(F.col(out), fallback).alias(out))
    times = known.select(F.col(out).alias("_want"), F.col(out), F.lit(None).cast("timestamp").alias("run_ts"))
    upto = Window.orderBy("_want", F.col("run_ts").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = times.unionByName(wanted, allowMissingColumns=True).withColumn(out, F.last(out, ignorenulls=True).over(upto))
    found = found.where(F.col("run_ts").isNotNull())
    value = F.when(keep(F.col(out)), F.col(out)) if keep else F.col(out)
    return found.select("run_ts", value.alias(out))


def latest_within(
    runs: DataFrame, sources: DataFrame, hours: int = 6, out: str = "source_ts", look_ahead: bool = False
) -> DataFrame:
    """The source of the same time, else the newest earlier source when it is within ``hours`` of the run, else NULL.

    ``look_ahead`` takes the newest source of all instead, also one after the run: right for a run computed now, but it
    changes the past whenever a source arrives.
    """

    def near(latest: Column) -> Column:
        return F.abs(((_unix("run_ts") - _unix(latest)) / F.lit(HOUR)).cast("int")) <= hours

    return _exact_or_latest(runs, sources, F.col("run_ts"), "run_ts", out, near, look_ahead)


def latest_or(runs: DataFrame, dates: DataFrame, out: str = "source_date", look_ahead: bool = False) -> DataFrame:
    """The source of the run's date, else the newest date before it; ``look_ahead`` as in ``latest_within``."""
    return _exact_or_latest(runs, dates, F.to_date("run_ts"), "run_date", out, None, look_ahead)


def latest_n(df: DataFrame, by: str = "run_ts", n: int = 7) -> DataFrame:
    """The ``n`` newest items: a top-n per partition, merged."""
    return df.orderBy(F.col(by).desc()).limit(n)


def latest_n_per(df: DataFrame, keys: list[str], by: str = "run_ts", n: int = 7) -> DataFrame:
    """The ``n`` newest items per key; the rank filter is applied before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(by).desc()))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def pending_dates(available: DataFrame, processed: DataFrame, key: str = "run_date") -> DataFrame:
    """Dates that are there but not processed yet."""
    return available.select(key).distinct().join(processed.select(key), key, "left_anti")


def run_dates(*inventories: DataFrame, key: str = "run_ts") -> DataFrame:
    """Distinct times of several inventories, ascending."""
    return reduce(DataFrame.union, [i.select(key) for i in inventories]).distinct().orderBy(key)


def ready_runs(runs: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """Runs old enough for their data to be complete."""
    return runs.where(is_ready(F.col("run_ts"), now, hours))


def day_over_day(
    alerts: DataFrame, require_previous_run: bool = True, earlier: DataFrame | None = None, places: DataFrame | None = None
) -> DataFrame:
    """Alert rows with the alert of exactly one day before and the status.

    A run without any row one day before is left out as a whole, unless ``require_previous_run`` is False. ``earlier`` has the
    rows of the days before, by default they are among ``alerts``, which are then used three times and so stored once.
    ``places`` (pfaf_id and more) gives each alert a row per place of its watershed, and none without a place. It meets the
    alerts' keys and the alerts of the day before first, so that the wide alerts are shuffled for one join only.
    """
    if earlier is None:
        alerts = earlier = stored(alerts, "alerts")
    day = F.expr("INTERVAL 1 DAY")
    previous = earlier.select("pfaf_id", (F.col("run_ts") + day).alias("run_ts"), F.col("alert").alias("previous_alert"))
    if require_previous_run:
        # The times are one row per run; broadcast or pushed to the scan, they never make the alerts travel.
        alerts = among(alerts, "run_ts", stored(previous.select("run_ts").distinct(), "days"))
    if places is None:
        joined = alerts.join(previous, ["run_ts", "pfaf_id"], "left")
    else:
        beside = alerts.select("run_ts", "pfaf_id").distinct().join(previous, ["run_ts", "pfaf_id"], "left").join(places, "pfaf_id")
        joined = alerts.join(beside, ["run_ts", "pfaf_id"])
    return joined.withColumn("status", alert_status(alert_code(F.col("alert")), alert_code(F.col("previous_alert"))))


def among(df: DataFrame, key: str, times: DataFrame, source: str | None = None, most: int = 1000) -> DataFrame:
    """Rows of ``df`` whose ``key``, a time or a date, is among ``times``: a list of literals when they are few, which goes down
    to a partitioned scan and below aggregates by the key; a semi join otherwise. ``times`` should be stored."""
    source = source or key
    wanted = times.select(F.col(source).alias(key)).where(F.col(key).isNotNull()).distinct()
    if isinstance(times.schema[source].dataType, T.DateType):
        number, literal = F.unix_date(key), F.date_from_unix_date
    else:
        number, literal = F.unix_micros(key), F.timestamp_micros
    few = wanted.select(number.alias("t")).limit(most + 1).collect()
    if len(few) > most:
        return df.join(wanted, key, "left_semi")
    return df.where(F.col(key).isin([literal(F.lit(r.t)) for r in few]) if few else F.lit(False))


def at_times(df: DataFrame, times: DataFrame, key: str = "run_ts", most: int = 1000) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``times``, so that the scan of a table that is partitioned by ``key`` opens those
    partitions only."""
    return among(df, key, times, most=most)
