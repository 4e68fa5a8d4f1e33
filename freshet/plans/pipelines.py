"""The products' dataflows. Each takes all runs at once; ``run_ts`` is a column, never a loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators import fusion as U
from freshet.operators import scores as C
from freshet.operators.spatial import clip_rain, points_in_watersheds, rasterize_points
from freshet.operators.stations import PROBABILITIES, normalize_probability, station_output, station_scores, station_union
from freshet.operators.temporal import (
    among, asof_latest, at_times, day_over_day, flood_duration, latest_or, latest_within, pending_dates, ready_runs,
)
from freshet.operators.zonal import complete_dates, dfo_summary, gfms_summary, hwrf_summary, viirs_summary
from freshet.params import DFO_TILES
from freshet.schemas import DEPTH, Grid
from freshet.session import stored
from freshet.sources import commits
from freshet.sources.sinks import existing_keys, write_partitions

KEYS = U.KEYS


# --- inputs of a run -------------------------------------------------------------------------------------------------


def align_runs(runs: DataFrame, station_dates: DataFrame, storm_runs: DataFrame, storm_hours: int = 6) -> DataFrame:
    """(run_ts, station_date, storm_ts): the station date of the run's day, else the latest; the storm run of the same
    time, else the latest when near enough."""
    stations = latest_or(runs, station_dates, "station_date")
    storms = latest_within(runs, storm_runs, storm_hours, "storm_ts")
    return stations.join(storms, "run_ts")


def on_runs(df: DataFrame, mapping: DataFrame, source: str, key: str) -> DataFrame:
    """Give source rows the runs that use them: ``mapping`` has run_ts and ``source``, ``df`` has ``key``.

    The mapping has one row per run, so its size is the calendar's. It should be stored: the planner then knows its size
    and broadcasts it when small.
    """
    used = mapping.where(F.col(source).isNotNull()).select(
        F.col("run_ts").alias("_run"), F.col(source).alias("_used")
    )
    # Times that no run uses are left out below the aggregates that made the rows.
    joined = among(df, key, mapping, source).join(used, F.col(key) == F.col("_used"))
    return joined.drop("_used", key, "run_ts").withColumnRenamed("_run", "run_ts")


def observation_runs(alert_runs: DataFrame, dfo_dates: DataFrame, viirs_dates: DataFrame) -> DataFrame:
    """(run_ts, dfo_date, viirs_date) of the runs for which both observations exist in their lookback."""
    both = asof_latest(alert_runs, dfo_dates, "dfo_date").join(
        asof_latest(alert_runs, viirs_dates, "viirs_date"), "run_ts"
    )
    return both.where(F.col("dfo_date").isNotNull() & F.col("viirs_date").isNotNull())


# --- alert stages as columns of one merged row -----------------------------------------------------------------------
#
# A merged row holds one struct per source. The stages add a few scores to it and pass the structs on; they are opened
# in the last projection. Rows so stay narrow through the stages, and the generated code small enough to be compiled.

_STATION_COLUMNS = ["point_no", "alert_level", "days_until_peak", "glofas_2yr", "glofas_5yr", "glofas_20yr",
                    *C.GLOFAS_PARTS]
_GFMS_COLUMNS = ["gfms_totalarea_km", "gfms_perc_area", "gfms_meandepth", "gfms_maxdepth", "gfms_duration",
                 *C.GFMS_PARTS]
_RISKS = ["scaled_riverine_risk", "scaled_coastal_risk", "severity", "alert"]
_SCORES = ["glofas_score", "gfms_score", "forecast_score", "hazard_score", "flag"]


def _merged(glofas: DataFrame, gfms: DataFrame, exposed: DataFrame, more: dict[str, DataFrame]) -> DataFrame:
    """One row per run and watershed with all scored sources, the exposure and the combined forecast score.

    A watershed with exposure but without a forecast has the score zero, one with neither has none. Watersheds with
    exposure only end with hazard zero in every stage, so a left join yields the full outer join's result.
    """
    # By the watershed, so that the exposure meets the merged rows where they are.
    wide = U.merge_sources({"glofas": glofas, "gfms": gfms, **more}, by=("pfaf_id",))
    packed = exposed.select("pfaf_id", F.struct(*U.EXPOSURE).alias("exposure"))
    wide = U.fuse_exposure(wide, packed).selectExpr("*", "exposure.rfr_score", "exposure.cfr_score")
    points, depth, total = U.combine_forecast(F.col("glofas.glofas_score"), F.col("gfms.gfms_score"))
    in_model = F.expr("glofas IS NOT NULL OR gfms IS NOT NULL OR exposure IS NOT NULL")
    return wide.withColumns(
        {
            "glofas_score": F.when(in_model, points),
            "gfms_score": F.when(in_model, depth),
            "forecast_score": F.when(in_model, total),
        }
    )


def _storm_stage(wide: DataFrame) -> DataFrame:
    hazard, flag = U.raise_hazard(
        F.col("forecast_score"), F.col("hwrf.hwrf_total"), F.lit(None).cast("int"), 1, fill=False
    )
    present = F.expr("glofas IS NOT NULL OR gfms IS NOT NULL OR hwrf IS NOT NULL")
    return wide.withColumns({"hazard_score": hazard, "flag": flag, "_present": present})


def _observation_stage(wide: DataFrame, source: str, code: int, earlier: list[str]) -> DataFrame:
    """Next stage on the same row.

    What the earlier stage would have dropped comes back only through the new source, without the earlier columns.
    The earlier stage's alert is not needed: its low classes lose the flag, but so they do at the end, unless the
    new source raised the hazard and set a flag of its own.
    """
    wide = wide.withColumn("_kept", F.col("_present") & U.has_hazard(F.col("hazard_score")) & U.is_exposed())
    masked = {*earlier, *_SCORES}
    wide = wide.selectExpr(
        *[f"CASE WHEN _kept THEN {c} END AS {c}" if c in masked else c for c in wide.columns if c != "_present"],
        f"_kept OR {source} IS NOT NULL AS _present",
    )
    total = F.col(f"{source}.{source}_total")
    hazard, flag = U.raise_hazard(F.col("hazard_score"), total, F.col("flag"), code, fill=True)
    return wide.withColumns({"hazard_score": hazard, "flag": flag}).drop("_kept")


def _opened(df: DataFrame, *more: str) -> DataFrame:
    """The flat result: exposure, forecast columns, then ``more``."""
    stations = [f"glofas.{c}" for c in _STATION_COLUMNS]
    depth = [f"gfms.{c}" for c in _GFMS_COLUMNS]
    return df.selectExpr(*KEYS, "exposure.*", *stations, "glofas_score", *depth, "gfms_score", *more)


_STORM = ["forecast_score", "hwrf.*"]
_TAIL = ["hazard_score", *_RISKS]


def _seen(dfo: DataFrame) -> DataFrame:
    return C.score_dfo(dfo, U.MIN_TOTAL)


def _composites(viirs: DataFrame) -> DataFrame:
    return C.score_viirs(viirs, U.MIN_TOTAL)


def forecast_alerts(stations: DataFrame, gfms: DataFrame, exposed: DataFrame, digits: int | None = None) -> DataFrame:
    """Alerts from stations and flood depth; both inputs carry the ``run_ts`` they serve."""
    wide = _merged(station_scores(stations), C.score_gfms(gfms), exposed, {})
    return _opened(U.finish(wide.withColumn("hazard_score", F.col("forecast_score")), digits), *_TAIL)


def _hwrf_stage(glofas, gfms, hwrf, exposed, digits) -> DataFrame:
    wide = _storm_stage(_merged(glofas, gfms, exposed, {"hwrf": hwrf}))
    return _opened(U.finish(wide, digits), *_STORM, *_TAIL, "flag")


def _dfo_stage(glofas, gfms, hwrf, dfo, exposed, digits) -> DataFrame:
    wide = _storm_stage(_merged(glofas, gfms, exposed, {"hwrf": hwrf, "dfo": dfo}))
    wide = _observation_stage(wide, "dfo", 2, ["glofas", "gfms", "hwrf"])
    return _opened(U.finish(wide.where("_present"), digits), *_STORM, "dfo.*", *_TAIL, "flag")


def _viirs_stage(glofas, gfms, hwrf, dfo, viirs, exposed, digits) -> DataFrame:
    wide = _storm_stage(_merged(glofas, gfms, exposed, {"hwrf": hwrf, "dfo": dfo, "viirs": viirs}))
    wide = _observation_stage(wide, "dfo", 2, ["glofas", "gfms", "hwrf"])
    wide = _observation_stage(wide, "viirs", 3, ["glofas", "gfms", "hwrf", "dfo"])
    return _opened(U.finish(wide.where("_present"), digits), *_STORM, "dfo.*", "viirs.*", *_TAIL, "flag")


def hwrf_alerts(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, exposed: DataFrame, digits: int | None = None
) -> DataFrame:
    """Forecast alerts raised by storm rain (flag 1)."""
    return _hwrf_stage(station_scores(stations), C.score_gfms(gfms), C.score_hwrf(hwrf), exposed, digits)


def dfo_alerts(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, dfo: DataFrame, exposed: DataFrame,
    digits: int | None = None,
) -> DataFrame:
    """Storm alerts raised by observed water (flag 2); ``dfo`` carries the ``run_ts`` it serves."""
    return _dfo_stage(
        station_scores(stations), C.score_gfms(gfms), C.score_hwrf(hwrf), _seen(dfo), exposed, digits
    )


def viirs_alerts(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, dfo: DataFrame, viirs: DataFrame, exposed: DataFrame,
    digits: int | None = None,
) -> DataFrame:
    """Observed-water alerts raised by the flood composites (flag 3)."""
    return _viirs_stage(
        station_scores(stations), C.score_gfms(gfms), C.score_hwrf(hwrf), _seen(dfo), _composites(viirs), exposed, digits
    )


# --- alerts of all runs, inputs chosen by the rules of each product --------------------------------------------------
#
# Inputs carry their own times: stations, depth and storm rain ``run_ts``, observations ``run_date``. Sources are
# scored, filtered and averaged before they are given to the runs that use them.

OBSERVED_HOUR = 18


def _dated_scores(stations: DataFrame) -> DataFrame:
    dated = stations.withColumn("_date", F.to_date("run_ts")).drop("run_ts")
    return station_scores(dated, ("_date", "pfaf_id"))


def _inventory(df: DataFrame, time: str) -> DataFrame:
    """The times a source has, stored: the joins that choose a run's inputs read them several times."""
    return stored(df.select(time).distinct(), "inventory")


def _station_dates(stations: DataFrame) -> DataFrame:
    return _inventory(stations.select(F.to_date("run_ts").alias("run_date")), "run_date")


def _same_run(df: DataFrame, plan: DataFrame) -> DataFrame:
    return among(df, "run_ts", plan)


def _storm_inputs(stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, plan: DataFrame) -> list[DataFrame]:
    return [
        on_runs(_dated_scores(stations), plan, "station_date", "_date"),
        _same_run(C.score_gfms(gfms), plan),
        on_runs(C.score_hwrf(hwrf).withColumn("_at", F.col("run_ts")), plan, "storm_ts", "_at"),
    ]


def daily_forecast(stations: DataFrame, gfms: DataFrame, exposed: DataFrame, digits: int | None = None) -> DataFrame:
    """Forecast alerts of every day: depth at 00 h with the day's stations, else the latest ones."""
    midnight = gfms.where((F.hour("run_ts") == 0) & (F.minute("run_ts") == 0))
    plan = stored(latest_or(_inventory(midnight, "run_ts"), _station_dates(stations), "station_date"), "runs")
    glofas = on_runs(_dated_scores(stations), plan, "station_date", "_date")
    wide = _merged(glofas, C.score_gfms(midnight), exposed, {})
    return _opened(U.finish(wide.withColumn("hazard_score", F.col("forecast_score")), digits), *_TAIL)


def storm_alerts(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, exposed: DataFrame, runs: DataFrame, digits: int | None = None
) -> DataFrame:
    """Storm alerts of all ``runs``: depth of the same hour, the day's stations (else the latest), rain of the same hour
    (else the latest within 6 hours, else none)."""
    plan = align_runs(_inventory(runs, "run_ts"), _station_dates(stations), _inventory(hwrf, "run_ts"))
    plan = stored(plan, "runs")
    return _hwrf_stage(*_storm_inputs(stations, gfms, hwrf, plan), exposed, digits)


def daily_observed(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, dfo: DataFrame, exposed: DataFrame, runs: DataFrame,
    viirs: DataFrame | None = None, digits: int | None = None,
) -> DataFrame:
    """Observed-water alerts of every day: the 18 h run of ``runs`` with the same day's observation, and with ``viirs``
    also the same day's composites. Days without the observations are left out."""
    evening = _inventory(runs.where(F.hour("run_ts") == OBSERVED_HOUR), "run_ts")
    evening = evening.withColumn("run_date", F.to_date("run_ts"))
    for observed in (dfo, viirs):
        if observed is not None:
            evening = evening.join(_inventory(observed, "run_date"), "run_date", "left_semi")
    plan = align_runs(evening, _station_dates(stations), _inventory(hwrf, "run_ts"))
    plan = stored(plan.withColumn("day", F.to_date("run_ts")), "runs")
    inputs = _storm_inputs(stations, gfms, hwrf, plan)
    seen = on_runs(_seen(dfo), plan, "day", "run_date")
    if viirs is None:
        return _dfo_stage(*inputs, seen, exposed, digits)
    return _viirs_stage(*inputs, seen, on_runs(_composites(viirs), plan, "day", "run_date"), exposed, digits)


def combined_alerts(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, dfo: DataFrame, viirs: DataFrame, exposed: DataFrame,
    runs: DataFrame, digits: int | None = None,
) -> DataFrame:
    """All sources for all ``runs``: the inputs of ``storm_alerts`` and the newest observations of the last days, with
    their dates. Runs without both observations are left out."""
    observed = observation_runs(
        _inventory(runs, "run_ts"), _inventory(dfo, "run_date"), _inventory(viirs, "run_date")
    )
    plan = align_runs(observed, _station_dates(stations), _inventory(hwrf, "run_ts")).join(observed, "run_ts")
    plan = stored(plan, "runs")
    out = _viirs_stage(
        *_storm_inputs(stations, gfms, hwrf, plan),
        on_runs(_seen(dfo), plan, "dfo_date", "run_date"),
        on_runs(_composites(viirs), plan, "viirs_date", "run_date"),
        exposed,
        digits,
    )
    return out.join(plan.select("run_ts", "dfo_date", "viirs_date"), "run_ts")


NORTH_LATITUDE = 50


def final_alert(
    alerts: DataFrame, centroids: DataFrame, apply_north_filter: bool = False, earlier: DataFrame | None = None
) -> DataFrame:
    """Published alert: administrative centroids (several per watershed) with the alert and its status.

    ``apply_north_filter`` drops northern rows that neither a forecast nor observed water supports; by default they
    stay, as they do in the published product. ``earlier`` are the alerts of the days before, when ``alerts`` lacks them.
    """
    drop = ["admin0", "admin1", "iso", "resilience_index", "normalized_lack_of_resilience", "previous_alert"]
    alerts = alerts.drop(*[c for c in alerts.columns if "fid" in c.lower()])
    centroids = centroids.drop(*[c for c in centroids.columns if "fid" in c.lower()])
    named = [c for c in centroids.columns if c != "pfaf_id"]
    out = day_over_day(alerts, earlier=earlier, places=centroids.select("pfaf_id", F.struct(*named).alias("_place"))).drop(*drop)
    out = out.select("pfaf_id", *[c for c in out.columns if c not in ("pfaf_id", "_place")], "_place.*")
    if apply_north_filter:
        blank = F.col("dfo_total").isNull() & F.col("forecast_score").isNull()
        out = out.where(~(blank & F.coalesce(F.col("centroid_y") > NORTH_LATITUDE, F.lit(False))))
    return out


def due_runs(runs: DataFrame, now: Column, alerts_path: str, changed: DataFrame | None = None) -> DataFrame:
    """(run_ts): of ``runs`` those old enough that are not in the alert table yet, or whose inputs have ``changed``."""
    due = ready_runs(runs.select("run_ts").distinct(), now)
    done = existing_keys(due, alerts_path, ["run_ts"])
    pending = due if done is None else pending_dates(due, done, "run_ts")
    if changed is not None:
        pending = pending.union(due.join(changed.select("run_ts"), "run_ts", "left_semi")).distinct()
    return pending


def stale_runs(alerts_path: str, published_path: str, runs: DataFrame) -> DataFrame:
    """(run_ts, _inputs): committed runs with a committed run the day before, whose published rows are missing or come from
    an older version of either. Only commit records are read; ``runs`` gives the type of the time."""
    spark, key = runs.sparkSession, [runs.schema["run_ts"]]
    made = commits.committed(spark, alerts_path, key)
    if made is None:
        return runs.select("run_ts", F.lit(None).cast("map<string,bigint>").alias(commits.INPUTS)).where("false")
    made = made.select("run_ts", F.col(commits.VERSION).alias("_now"))
    before = made.select((F.col("run_ts") + F.expr("INTERVAL 1 DAY")).alias("run_ts"), F.col("_now").alias("_before"))
    wanted = made.join(before, "run_ts")
    have = commits.committed(spark, published_path, key)
    if have is not None:
        have = have.select("run_ts", F.col(f"{commits.INPUTS}.alerts").alias("_had"), F.col(f"{commits.INPUTS}.previous").alias("_had_before"))
        wanted = wanted.join(have, "run_ts", "left").where(
            ~(F.col("_now").eqNullSafe(F.col("_had")) & F.col("_before").eqNullSafe(F.col("_had_before"))))
    inputs = F.create_map(F.lit("alerts"), F.col("_now"), F.lit("previous"), F.col("_before"))
    return wanted.select("run_ts", inputs.alias(commits.INPUTS))


def publish_stale(
    alerts: DataFrame, alerts_path: str, published_path: str, centroids: DataFrame, apply_north_filter: bool = False
) -> DataFrame:
    """Publish what is stale, and return those runs. Of the alert table ``alerts`` only the partitions of these runs and of
    the runs a day earlier are read, and only these runs are replaced in the published table.

    A run that was computed again makes itself and the run a day later stale; a run that comes late makes the next day's run
    publishable. A call that was cut off is made up for by the next one.
    """
    stale = stored(stale_runs(alerts_path, published_path, alerts.select("run_ts")), "stale")
    if stale.isEmpty():
        return stale
    earlier = at_times(alerts, stale.select((F.col("run_ts") - F.expr("INTERVAL 1 DAY")).alias("run_ts")))
    final = final_alert(at_times(alerts, stale), centroids, apply_north_filter, earlier.select("run_ts", "pfaf_id", "alert"))
    write_partitions(final, published_path, ["run_ts"], overwrite=True, written=stale)
    return stale


def publish_runs(
    stations: DataFrame, gfms: DataFrame, hwrf: DataFrame, dfo: DataFrame, viirs: DataFrame, exposed: DataFrame,
    centroids: DataFrame, runs: DataFrame, now: Column, alerts_path: str, published_path: str,
    apply_north_filter: bool = False, digits: int | None = None, changed: DataFrame | None = None,
) -> DataFrame:
    """Everything that is due: of ``runs`` those old enough and not yet in the alert table, and the ``changed`` ones again, get
    their combined alerts in it by run; then published alerts of the runs that these touch. Returns the published runs.

    Neither the sources' nor the alerts' history is read again, and a second call changes nothing. A changed run
    that no longer has rows keeps its old ones.
    """
    spark = runs.sparkSession
    pending = stored(due_runs(runs, now, alerts_path, changed), "pending")
    alerts = combined_alerts(stations, gfms, hwrf, dfo, viirs, exposed, pending, digits)
    if not pending.isEmpty():
        write_partitions(alerts, alerts_path, ["run_ts"], overwrite=True)
    table = spark.read.schema(alerts.schema).parquet(alerts_path)
    return publish_stale(table, alerts_path, published_path, centroids, apply_north_filter)


# --- products to summaries -------------------------------------------------------------------------------------------


def located_stations(fixed: DataFrame, dynamic: DataFrame, watersheds: DataFrame) -> DataFrame:
    """Both station sets, located in their watersheds and with probabilities in percent.

    The located stations are stored, since the rescaling looks at them twice.
    """
    located = points_in_watersheds(station_union(fixed, dynamic), watersheds)
    return normalize_probability(stored(located, "located"))


def forecast_stations(fixed: DataFrame, dynamic: DataFrame, watersheds: DataFrame) -> DataFrame:
    """Located stations as the alerts take them: with their run times and the whole-number probabilities that are published,
    so that 37.6 % counts as 37 and 100.4 % is valid."""
    located = located_stations(fixed, dynamic, watersheds)
    return located.withColumns({c: F.col(c).cast("int").cast("double") for c in PROBABILITIES})


def glofas_stations(fixed: DataFrame, dynamic: DataFrame, watersheds: DataFrame) -> DataFrame:
    """Station ingestion up to the published projection."""
    return station_output(located_stations(fixed, dynamic, watersheds))


def gfms_pipeline(
    raw_pixels: DataFrame, watersheds: DataFrame, grid: Grid = DEPTH, carry: DataFrame | None = None,
    runs: DataFrame | None = None, factor: int = 2, spans: DataFrame | None = None, by_rows: bool = False,
) -> DataFrame:
    """Raw depth cells, or grid rows, -> watershed summary on the ``factor`` times finer ``grid`` -> flood duration.

    The finer cells are never made: the summary weighs each raw cell with the fine cells it stands for. The summary is
    stored, since the duration reads it twice.
    """
    summary = gfms_summary(raw_pixels, watersheds, grid, runs, spans=spans, factor=factor, by_rows=by_rows)
    return flood_duration(stored(summary, "summary"), carry=carry)


def hwrf_pipeline(
    rain: DataFrame, watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None
) -> DataFrame:
    """Storm rain readings (run_ts, source, lon, lat, z, box) -> clipped -> one mosaic of cells -> watershed summary.

    Rasterising each storm and laying the storms over each other is one aggregate: the last reading of the last source.
    """
    order = F.struct("source", "lat", "lon", "z")
    cells = rasterize_points(clip_rain(rain).withColumn("ordinal", order), grid, keys=("run_ts",))
    return hwrf_summary(cells, watersheds, grid, spans)


def dfo_pipeline(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, today: Column, min_tiles: int = DFO_TILES,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Water class cells of the dates that are complete -> watershed summary."""
    dates = stored(complete_dates(pixels, min_tiles, today).select("run_date"), "dates")
    return dfo_summary(pixels.join(dates, "run_date", "left_semi"), watersheds, grid, spans=spans)


def viirs_pipeline(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None
) -> DataFrame:
    """Flood composite cells -> watershed summary."""
    return viirs_summary(pixels, watersheds, grid, spans)
