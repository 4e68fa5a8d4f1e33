"""The registered queries: every operator on inputs derived from the test tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet import params as P_
from freshet.checks import fixtures as X
from freshet.functions import alerts as A
from freshet.functions import dates as D
from freshet.functions.geo import RAIN_DEG2RAD, pixel_area, pixel_center
from freshet.operators import fusion as U
from freshet.operators import monitor as M
from freshet.operators import scores as C
from freshet.operators import spatial as G
from freshet.operators import stations as S
from freshet.operators import temporal as W
from freshet.operators import zonal as Z
from freshet.plans import pipelines as P
from freshet.schemas import Grid
from freshet.session import prepare, work_folder
from freshet.sources import readers as R
from freshet.sources import sinks as K
from freshet.sources.grids import read_grid_rows
from freshet.streaming import streams as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 9


def rounded(df: DataFrame) -> DataFrame:
    """Floating point columns to 6 digits, so that the order of a sum does not show; also folds -0.0 into 0.0.

    Engines round decimal ties differently; the small shift keeps them off the ties.
    """
    return df.selectExpr(
        *[
            f"round({f.name} + 3e-10D, 6) + 0D AS {f.name}" if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def cells_named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"row": "row_no", "col": "col_no"})


# --- scores and stations ---------------------------------------------------------------------------------------------


@query
def score_gfms(spark, sf):
    return C.score_gfms(X.gfms_summary(spark, sf))


@query
def score_hwrf(spark, sf):
    return C.score_hwrf(X.hwrf_summary(spark, sf))


@query
def score_dfo(spark, sf):
    return C.score_dfo(X.dfo_summary(spark, sf), U.MIN_TOTAL)


@query
def score_viirs(spark, sf):
    return C.score_viirs(X.viirs_summary(spark, sf), U.MIN_TOTAL)


def _weight_table(spark, product: str, row: dict[str, float]) -> dict:
    """Weights of a product from a table with this row, written to a file and read back."""
    folder = work_folder(spark, "weights")
    _write_text(spark.createDataFrame([list(row.values())], list(row)).coalesce(1), folder)
    return P_.table_weights(product, R.read_parameters(spark, folder))


def _half(name: str, p, minimum: str = "Minpt", maximum: str = "Maxpt") -> dict[str, float]:
    """Half the weight, twice the points."""
    return {f"{name}_wt": p.wt / 2.0, f"{name}_{minimum}": p.mn * 2.0, f"{name}_{maximum}": p.mx * 2.0}


@query
def score_gfms_weights(spark, sf):
    """Scores with a weight table read from a file: half the weights, twice the points."""
    row = {}
    for part, p in zip(("area", "percarea", "meandepth", "maxdepth", "duration"), P_.GFMS.values(), strict=True):
        row |= _half(f"GFMS_{part}", p, *(("Min_pt", "max_pt") if part == "area" else ()))
    return C.score_gfms(X.gfms_summary(spark, sf), _weight_table(spark, "gfms", row))


@query
def score_hwrf_weights(spark, sf):
    row = _half("HWRF_area", P_.HWRF["area"], "Min_pt", "max_pt") | _half("HWRF_percarea", P_.HWRF["perc"])
    for part in ("meanrain", "maxrain"):
        p = P_.HWRF[part]
        row |= {f"HWRF_{part}_minwt": p.lo / 2.0, f"HWRF_{part}_increment": p.inc / 2.0, f"HWRF_{part}_Minpt": p.mn * 2.0, f"HWRF_{part}_Maxpt": p.mx * 2.0}
    return C.score_hwrf(X.hwrf_summary(spark, sf), _weight_table(spark, "hwrf", row))


def _daily_weights(product: str, weights: dict, days: dict[str, float]) -> dict[str, float]:
    return _half(f"{product}_area", weights["area"], "Min_pt", "max_pt") | _half(f"{product}_percarea", weights["perc"]) | days


@query
def score_dfo_weights(spark, sf):
    row = _daily_weights("DFO", P_.DFO, {"One_Day_Multiplier": 2.0, "Two_Day_Multiplier": 3.0, "Three_Day_Multiplier": 4.0})
    return C.score_dfo(X.dfo_summary(spark, sf), U.MIN_TOTAL, _weight_table(spark, "dfo", row))


@query
def score_viirs_weights(spark, sf):
    row = _daily_weights("VIIRS", P_.VIIRS, {"One_Day_Multiplier": 2.0, "Five_Day_Multiplier": 3.0})
    return C.score_viirs(X.viirs_summary(spark, sf), U.MIN_TOTAL, _weight_table(spark, "viirs", row))


@query
def score_glofas(spark, sf):
    return C.score_glofas(S.validate_stations(X.stations(spark, sf))[0])


@query
def stations_ok(spark, sf):
    return S.validate_stations(X.stations(spark, sf))[0]


@query
def stations_rejected(spark, sf):
    return S.validate_stations(X.stations(spark, sf))[1]


@query
def station_average(spark, sf):
    return S.station_scores(X.stations(spark, sf))


@query
def station_union(spark, sf):
    """The dynamic files of the second run have another width than the fixed ones; that run keeps its fixed stations."""
    fixed, dynamic = X.raw_stations(spark, sf)
    odd = F.when(F.col("run_ts") == X.ts("2024-01-02 00:00:00"), F.lit(18)).otherwise(F.lit(19))
    return S.station_union(fixed.withColumn("width", F.lit(19)), dynamic.withColumn("width", odd))


@query
def probability_rescale(spark, sf):
    return S.normalize_probability(S.station_union(*X.raw_stations(spark, sf)))


@query
def station_output(spark, sf):
    every = S.normalize_probability(S.station_union(*X.raw_stations(spark, sf)))
    return S.station_output(every.withColumn("pfaf_id", F.col("point_no")))


@query
def glofas_stations(spark, sf):
    return P.glofas_stations(*X.raw_stations(spark, sf), X.watersheds(spark, sf))


@query
def stations_to_alerts(spark, sf):
    """Raw stations of two days and the flood depth of the second midnight, up to the alerts."""
    stations = P.forecast_stations(*X.raw_stations(spark, sf), X.watersheds(spark, sf))
    depth = X.gfms_summary(spark, sf).withColumn("run_ts", X.ts("2024-01-02 00:00:00"))
    return P.daily_forecast(stations, depth, X.exposure(spark, sf), DIGITS)


# --- fusion and alerts -----------------------------------------------------------------------------------------------


def _inputs(spark, sf, *names: str) -> list[DataFrame]:
    made = {
        "stations": X.stations, "gfms": X.gfms_summary, "hwrf": X.hwrf_summary, "exposure": X.exposure,
        "dfo": lambda a, b: X.at_run(X.dfo_summary(a, b)), "viirs": lambda a, b: X.at_run(X.viirs_summary(a, b)),
    }
    return [made[n](spark, sf) for n in names]


@query
def forecast_alerts(spark, sf):
    return P.forecast_alerts(*_inputs(spark, sf, "stations", "gfms", "exposure"), DIGITS)


@query
def hwrf_alerts(spark, sf):
    return P.hwrf_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "exposure"), DIGITS)


@query
def dfo_alerts(spark, sf):
    return P.dfo_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "dfo", "exposure"), DIGITS)


@query
def viirs_alerts(spark, sf):
    return P.viirs_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "dfo", "viirs", "exposure"), DIGITS)


@query
def daily_forecast(spark, sf):
    return P.daily_forecast(X.station_runs(spark, sf), X.gfms_runs(spark, sf), X.exposure(spark, sf), DIGITS)


@query
def storm_alerts(spark, sf):
    return P.storm_alerts(
        X.station_runs(spark, sf), X.gfms_runs(spark, sf), X.hwrf_runs(spark, sf), X.exposure(spark, sf),
        X.run_slots(spark, sf), DIGITS,
    )


def _observed(spark, sf, viirs: DataFrame | None) -> DataFrame:
    return P.daily_observed(
        X.station_runs(spark, sf), X.gfms_runs(spark, sf), X.hwrf_runs(spark, sf), X.dfo_dates(spark, sf),
        X.exposure(spark, sf), X.run_slots(spark, sf), viirs, DIGITS,
    )


@query
def daily_dfo(spark, sf):
    return _observed(spark, sf, None)


@query
def daily_viirs(spark, sf):
    return _observed(spark, sf, X.viirs_today(spark, sf))


@query
def combined_alerts(spark, sf):
    return P.combined_alerts(
        X.station_runs(spark, sf), X.gfms_runs(spark, sf), X.hwrf_runs(spark, sf), X.dfo_dates(spark, sf),
        X.viirs_dates(spark, sf), X.exposure(spark, sf), X.run_slots(spark, sf), DIGITS,
    )


def _two_days(spark, sf) -> DataFrame:
    depth = X.gfms_runs(spark, sf)
    return depth.union(depth.withColumn("run_ts", F.col("run_ts") + F.expr("INTERVAL 1 DAY")))


def _two_days_times(spark, sf) -> DataFrame:
    """The times of ``_two_days``, from the readings' times alone."""
    times = X.run_slots(spark, sf)
    return times.union(times.select(F.col("run_ts") + F.expr("INTERVAL 1 DAY")))


def _publish(spark, sf, depth: DataFrame, now: str, folder: str, north: bool = False, changed: DataFrame | None = None) -> None:
    P.publish_runs(
        X.station_runs(spark, sf), depth, X.hwrf_runs(spark, sf), X.dfo_dates(spark, sf), X.viirs_dates(spark, sf),
        X.exposure(spark, sf), X.centroids(spark, sf), _two_days_times(spark, sf), X.ts(now), folder + "/alerts", folder + "/out",
        north, DIGITS, changed,
    )


def _published(spark, sf, north: bool) -> DataFrame:
    """Two days of runs, published in two goes; the second finds the first day's runs there."""
    depth, folder = _two_days(spark, sf), work_folder(spark, "published")
    _publish(spark, sf, depth, "2024-01-11 02:00:00", folder, north)
    _publish(spark, sf, depth, "2024-01-13 00:00:00", folder, north)
    return spark.read.parquet(folder + "/out")


@query
def published_alerts(spark, sf):
    return _published(spark, sf, False)


@query
def published_alerts_north(spark, sf):
    return _published(spark, sf, True)


@query
def republished_alerts(spark, sf):
    """After both days were published a run of the first one is corrected; the run a day later follows."""
    depth, folder = _two_days(spark, sf), work_folder(spark, "published")
    _publish(spark, sf, depth, "2024-01-13 00:00:00", folder)
    run = X.ts("2024-01-10 06:00:00")
    parts = {c: F.when(F.col("run_ts") == run, F.col(c) * 9.0).otherwise(F.col(c)) for c in ("gfms_totalarea_km", "gfms_perc_area")}
    changed = _two_days_times(spark, sf).where(F.col("run_ts") == run)
    _publish(spark, sf, depth.withColumns(parts), "2024-01-13 00:00:00", folder, changed=changed)
    return spark.read.parquet(folder + "/out")


@query
def exposure(spark, sf):
    return X.exposure(spark, sf)


def _forecast(spark, sf) -> DataFrame:
    glofas = S.station_scores(X.stations(spark, sf)).select(*U.KEYS, "glofas_score")
    return U.fuse_forecast(glofas, C.score_gfms(X.gfms_summary(spark, sf)).select(*U.KEYS, "gfms_score"))


@query
def fuse_forecast(spark, sf):
    return _forecast(spark, sf).drop("run_ts")


@query
def combine_forecast(spark, sf):
    glofas, gfms, total = U.combine_forecast(F.col("glofas_score"), F.col("gfms_score"))
    return _forecast(spark, sf).select(
        "pfaf_id", glofas.alias("glofas_score"), gfms.alias("gfms_score"), total.alias("forecast_score")
    )


@query
def fuse_exposure_full(spark, sf):
    scores = C.score_gfms(X.gfms_summary(spark, sf)).select("pfaf_id", "gfms_score")
    return U.fuse_exposure(scores, X.exposure(spark, sf), "full_outer")


@query
def fuse_exposure_right(spark, sf):
    scores = C.score_viirs(X.viirs_summary(spark, sf), U.MIN_TOTAL).select("pfaf_id", "viirs_total")
    return U.fuse_exposure(scores, X.exposure(spark, sf), "right")


def _step(stage: DataFrame, scores: DataFrame, total: str, flag: int, fill: bool = True) -> DataFrame:
    base = stage.select(*[c for c in (*U.KEYS, "hazard_score", "flag") if c in stage.columns])
    return U.fuse(base, scores.select(*U.KEYS, total), total, flag, fill)


@query
def fuse_hwrf(spark, sf):
    stage = P.forecast_alerts(*_inputs(spark, sf, "stations", "gfms", "exposure"), DIGITS)
    return _step(stage, C.score_hwrf(X.hwrf_summary(spark, sf)), "hwrf_total", 1, fill=False)


@query
def fuse_dfo(spark, sf):
    stage = P.hwrf_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "exposure"), DIGITS)
    return _step(stage, C.score_dfo(*_inputs(spark, sf, "dfo"), U.MIN_TOTAL), "dfo_total", 2)


@query
def fuse_viirs(spark, sf):
    stage = P.dfo_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "dfo", "exposure"), DIGITS)
    return _step(stage, C.score_viirs(*_inputs(spark, sf, "viirs"), U.MIN_TOTAL), "viirs_total", 3)


@query
def drop_no_hazard(spark, sf):
    scored = C.score_gfms(X.gfms_summary(spark, sf)).select(*U.KEYS, "gfms_score")
    return U.drop_no_hazard(scored, "gfms_score")


@query
def drop_unexposed(spark, sf):
    return U.drop_unexposed(X.attributes(spark, sf).select("pfaf_id", "rfr_score", "cfr_score"), unique=False)


@query
def severity(spark, sf):
    scores = C.score_gfms(X.gfms_summary(spark, sf)).select("pfaf_id", F.col("gfms_score").alias("hazard_score"))
    joined = U.fuse_exposure(scores, X.exposure(spark, sf))
    return U.classify(joined, DIGITS).select(
        "pfaf_id", "hazard_score", "scaled_riverine_risk", "scaled_coastal_risk", "severity", "alert"
    )


@query
def alerts_clean(spark, sf):
    alerts = P.dfo_alerts(*_inputs(spark, sf, "stations", "gfms", "hwrf", "dfo", "exposure"), DIGITS)
    return U.clean_alerts(alerts, X.exposure(spark, sf), with_flag=True)


@query
def merge_duplicates(spark, sf):
    """The depth summary twice, the second time with other values, beside the storm summary."""
    depth = X.gfms_summary(spark, sf).select(*U.KEYS, "gfms_totalarea_km")
    again = depth.withColumn("gfms_totalarea_km", F.col("gfms_totalarea_km") - 1.0)
    storm = X.hwrf_summary(spark, sf).select(*U.KEYS, "rain_totalarea_km")
    merged = U.merge_sources({"depth": again.union(depth), "storm": storm})
    return merged.select(*U.KEYS, "depth.gfms_totalarea_km", "storm.rain_totalarea_km")


@query
def alert_codes(spark, sf):
    code = A.alert_code(F.col("alert"))
    return X.alert_series(spark, sf).select(
        "run_ts", "pfaf_id", "alert", code.alias("code"), A.alert_label(code).alias("label")
    )


@query
def alert_status(spark, sf):
    return W.day_over_day(X.alert_series(spark, sf)).drop("severity", "flag")


@query
def final_alert(spark, sf):
    return P.final_alert(X.alert_series(spark, sf), X.centroids(spark, sf))


# --- time -------------------------------------------------------------------------------------------------------------


@query
def flood_duration(spark, sf):
    return W.flood_duration(X.gfms_series(spark, sf), block_days=4)


@query
def flood_duration_carry(spark, sf):
    """The second half of the series, continued from the first half's last durations."""
    series, cut = X.gfms_series(spark, sf), X.ts("2024-01-15 00:00:00")
    first = W.flood_duration(series.where(F.col("run_ts") < cut))
    return W.flood_duration(series.where(F.col("run_ts") >= cut), carry=W.last_durations(first), block_days=4)


@query
def flood_duration_redelivered(spark, sf):
    """Every step twice, the second time with a smaller area."""
    series = X.gfms_series(spark, sf)
    again = series.withColumn("gfms_totalarea_km", F.col("gfms_totalarea_km") / 2.0)
    return W.flood_duration(series.union(again), block_days=4)


@query
def flood_duration_gaps(spark, sf):
    return W.flood_duration(X.gfms_series(spark, sf).where(F.col("gfms_totalarea_km") > 0), block_days=2)


@query
def asof_latest(spark, sf):
    runs = X.runs(spark, sf)
    out = W.asof_latest(runs, X.click_dates(spark, sf), "dfo_date")
    out = out.join(W.asof_latest(runs, X.view_dates(spark, sf), "viirs_date"), "run_ts")
    return out.join(W.asof_latest(runs, X.sparse_dates(spark, sf), "rare_date"), "run_ts")


@query
def observation_runs(spark, sf):
    return P.observation_runs(X.runs(spark, sf), X.sparse_dates(spark, sf), X.view_dates(spark, sf))


@query
def latest_within(spark, sf):
    return W.latest_within(X.runs(spark, sf), X.storm_inventory(spark, sf))


@query
def latest_or(spark, sf):
    return W.latest_or(X.runs(spark, sf), X.click_dates(spark, sf))


@query
def latest_n(spark, sf):
    return W.latest_n(X.runs(spark, sf))


@query
def latest_n_per(spark, sf):
    return W.latest_n_per(X.alert_series(spark, sf).drop("severity", "flag"), ["pfaf_id"], n=5)


@query
def pending_dates(spark, sf):
    return W.pending_dates(X.click_dates(spark, sf), X.view_dates(spark, sf))


@query
def run_dates(spark, sf):
    midnight = F.col("run_date").cast("timestamp").alias("run_ts")
    return W.run_dates(
        X.storm_inventory(spark, sf), X.view_dates(spark, sf).select(midnight), X.click_dates(spark, sf).select(midnight)
    )


@query
def ready_runs(spark, sf):
    return W.ready_runs(X.runs(spark, sf), X.ts("2024-01-30 20:30:00"))


@query
def date_scalars(spark, sf):
    t, now = F.col("ts"), X.ts(X.NOW)
    stamp = F.concat(F.lit("/data/flood_"), F.date_format("ts", "yyyyMMddHH"), F.lit(".csv"))
    text = F.concat(F.lit("DFO_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv"))
    return X.table(spark, sf, "events").select(
        "event_id",
        D.days_from(t, now).alias("days_from_now"),
        D.hour_diff(t, now).alias("hours_to_now"),
        D.floor_hours(t, 6).alias("slot"),
        D.processing_slot(t).alias("due_slot"),
        D.doy_date(F.year(t), F.dayofyear(t)).alias("doy_day"),
        D.days_before(F.to_date(t), 3).alias("three_days_before"),
        D.iso_time(t).alias("iso"),
        D.date_from_text(text).alias("text_day"),
        D.run_ts_from_path(stamp).alias("path_ts"),
        D.is_ready(t, now).alias("ready"),
    )


# --- rasters, polygons, points ---------------------------------------------------------------------------------------


@query
def watershed_spans(spark, sf):
    spans = G.watershed_spans(X.watersheds(spark, sf), X.GRID)
    cells = F.sum(F.col("c1") - F.col("c0") + F.lit(1))
    return cells_named(spans).groupBy("pfaf_id", "row_no").agg(cells.alias("cells"))


@query
def pixel_geometry(spark, sf):
    lon, lat = pixel_center(F.col("row"), F.col("col"), X.GRID)
    return cells_named(X.pixels(spark, sf).select("run_ts", "row", "col", lon.alias("lon"), lat.alias("lat"))).select(
        "*", pixel_area(F.col("lat"), X.GRID).alias("km2"), pixel_area(F.col("lat"), X.GRID, RAIN_DEG2RAD).alias("rain_km2")
    )


@query
def zonal_gfms(spark, sf):
    return Z.gfms_summary(X.pixels(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def zonal_gfms_rows(spark, sf):
    """From running sums along the rows of the pixel table."""
    return Z.gfms_summary(X.pixels(spark, sf), X.watersheds(spark, sf), X.GRID, by_rows=True)


@query
def zonal_gfms_grids(spark, sf):
    """From raw grids of the same cells, which never become a pixel table."""
    rows = read_grid_rows(spark, X.float_grids(spark, sf), X.GRID)
    return Z.gfms_summary(rows, X.watersheds(spark, sf), X.GRID)


@query
def float_grid(spark, sf):
    """Raw grids of the pixels, read back in bands."""
    return cells_named(R.read_float_grid(spark, X.float_grids(spark, sf) + "/*.bin", X.GRID, min_bytes=0))


@query
def zonal_hwrf_rows(spark, sf):
    return Z.hwrf_summary(X.pixels(spark, sf), X.watersheds(spark, sf), X.GRID, by_rows=True)


@query
def zonal_hwrf(spark, sf):
    return Z.hwrf_summary(X.pixels(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def zonal_dfo(spark, sf):
    return Z.dfo_layers(X.dfo_pixels(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def merge_dfo_layers(spark, sf):
    return U.merge_dfo_layers(Z.dfo_layers(X.dfo_pixels(spark, sf), X.watersheds(spark, sf), X.GRID, keep_empty=False))


@query
def zonal_viirs(spark, sf):
    return Z.viirs_products(X.viirs_pixels(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def merge_viirs(spark, sf):
    return U.merge_viirs(Z.viirs_products(X.viirs_pixels(spark, sf), X.watersheds(spark, sf), X.GRID))


@query
def viirs_pipeline(spark, sf):
    return P.viirs_pipeline(X.viirs_pixels(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def complete_dates(spark, sf):
    return Z.complete_dates(X.dfo_pixels(spark, sf), 73, X.day("2024-01-02"))


@query
def dfo_pipeline(spark, sf):
    return P.dfo_pipeline(X.dfo_pixels(spark, sf), X.watersheds(spark, sf), X.GRID, X.day("2024-01-02"), 73)


@query
def gfms_pipeline(spark, sf):
    fine = Grid("check_fine", -180.0, 90.0, 0.5, 0.5, 360, 720, X.GRID.nodata)
    return P.gfms_pipeline(X.pixels(spark, sf), X.watersheds(spark, sf), fine)


@query
def gfms_pipeline_rows(spark, sf):
    fine = Grid("check_fine", -180.0, 90.0, 0.5, 0.5, 360, 720, X.GRID.nodata)
    return P.gfms_pipeline(X.pixels(spark, sf), X.watersheds(spark, sf), fine, by_rows=True)


@query
def upsample(spark, sf):
    return cells_named(G.upsample_nearest(X.pixels(spark, sf)))


@query
def clip_rain(spark, sf):
    return G.clip_rain(X.rain(spark, sf)).select("source", "ordinal", "lon", "lat", "z")


@query
def rasterize(spark, sf):
    rain = G.clip_rain(X.rain(spark, sf))
    return cells_named(G.rasterize_points(rain, X.GRID, keys=("run_ts", "source")))


@query
def mosaic(spark, sf):
    cells = G.rasterize_points(G.clip_rain(X.rain(spark, sf)), X.GRID, keys=("run_ts", "source"))
    return cells_named(G.mosaic(cells, "source"))


@query
def hwrf_pipeline(spark, sf):
    return P.hwrf_pipeline(X.rain(spark, sf), X.watersheds(spark, sf), X.GRID)


@query
def points_in_watersheds(spark, sf):
    return G.points_in_watersheds(X.points(spark, sf), X.watersheds(spark, sf), cell=5.0)


@query
def to_geojson_lines(spark, sf):
    located = G.points_in_watersheds(X.points(spark, sf), X.watersheds(spark, sf), cell=5.0)
    return K.to_geojson_lines(located.select("point_no", "pfaf_id", "lon", "lat"))


# --- monitoring -------------------------------------------------------------------------------------------------------


@query
def freshness(spark, sf):
    return M.freshness(X.product_runs(spark, sf), X.ts(X.NOW), X.EVENT_LIMITS)


@query
def freshness_absent(spark, sf):
    """A product that never came is late."""
    limits = [*X.EVENT_LIMITS, ("data", "refund", -1, True)]
    return M.freshness(X.product_runs(spark, sf), X.ts(X.NOW), limits)


@query
def freshness_overall(spark, sf):
    return M.overall_freshness(M.freshness(X.product_runs(spark, sf), X.ts(X.NOW), X.EVENT_LIMITS))


@query
def uptime_summary(spark, sf):
    return M.uptime_summary(X.site_checks(spark, sf), ("name",))


@query
def uptime_latest(spark, sf):
    return M.uptime_summary(M.latest_checks(X.site_checks(spark, sf)))


# --- files: written to the work folder and read back -----------------------------------------------------------------


def _write_text(df: DataFrame, folder: str, header: bool = True) -> str:
    df.write.option("header", header).csv(folder)
    return folder


def _summary_files(spark, sf) -> str:
    """The depth summary as CSV files whose folder and names carry the run time."""
    summary = X.gfms_summary(spark, sf).select(R.S.GFMS_SUMMARY.fieldNames())
    return _write_text(summary, work_folder(spark, "summary") + "/depth_2024010118")


@query
def read_summary(spark, sf):
    return R.read_summary(spark, _summary_files(spark, sf), "gfms")


@query
def read_stations(spark, sf):
    """Fixed and dynamic files of two runs, those of the second run one column slimmer."""
    read = []
    for kind, stations in zip(("fixed", "dynamic"), X.raw_stations(spark, sf), strict=True):
        folder = work_folder(spark, "stations")
        for day, width in (("2024-01-01", 19), ("2024-01-02", 18)):
            layout = R.S.STATION_LAYOUTS[kind, width].fieldNames()
            cols = [F.col(n) if n in stations.columns else F.lit("x, y").alias(n) for n in layout]
            mine = stations.where(F.to_date("run_ts") == X.day(day)).select(*cols)
            _write_text(mine, f"{folder}/points_{day.replace('-', '')}00", header=False)
        read.append(R.read_stations(spark, f"{folder}/*", kind).withColumn("kind", F.lit(kind)))
    keep = ["run_ts", "kind", "width", "point_no", "station", "basin", "country", "upstream_area", "lon", "lat", "glofas_2yr",
            "glofas_5yr", "glofas_20yr", "alert_level", "days_until_peak"]
    return read[0].select(*keep).union(read[1].select(*keep))


@query
def read_rain_text(spark, sf):
    """Readings of all storms as text lines, one box line per file."""
    rain = X.rain(spark, sf)
    folder = work_folder(spark, "rain")
    head = F.lit("-180.0 180.0 -90.0 90.0 0.1 1800 3600")
    line = F.concat_ws(" ", F.col("lat").cast("string"), F.col("lon").cast("string"), F.col("z").cast("string"))
    body = rain.select(F.col("source"), line.alias("value"))
    heads = rain.select("source").distinct().withColumn("value", head)
    # One file per storm, in a folder named by storm and run: its few readings and its box line.
    stamped = F.concat("source", F.lit("_2024010106"))
    body.union(heads).withColumn("source", stamped).repartition(4, "source").write.partitionBy("source").text(folder)
    return R.read_rain_text(spark, folder + "/*").select("run_ts", "lon", "lat", "z")


@query
def read_pixels(spark, sf):
    folder = work_folder(spark, "pixels")
    K.write_partitions(X.dfo_pixels(spark, sf), folder, ["run_date", "layer"])
    return cells_named(R.read_pixels(spark, folder, layers=["d1", "d2"], start="2024-01-02", time="run_date"))


@query
def read_watersheds(spark, sf):
    folder = work_folder(spark, "watersheds")
    K.write_product(X.watersheds(spark, sf), folder)
    sheds = R.read_watersheds(spark, folder)
    edges = G.polygon_edges(sheds).groupBy("pfaf_id").agg(F.count("*").alias("edges"))
    return sheds.select("pfaf_id", "area_km2").join(edges, "pfaf_id")


@query
def read_dimensions(spark, sf):
    folder = work_folder(spark, "dimensions")
    _write_text(X.attributes(spark, sf), folder + "/attributes")
    res = X.resilience(spark, sf)
    names = [F.col(n) if n in res.columns else F.lit(None).cast("string").alias(n) for n in R.S.RESILIENCE.fieldNames()]
    _write_text(res.select(*names), folder + "/resilience")
    cent = X.centroids(spark, sf).drop("FID_union").withColumnRenamed("centroid_y", "CentroidY")
    K.write_product(cent, folder + "/centroids", "csv", "windows-1252")
    attrs, res, cent = R.read_dimensions(spark, *[f"{folder}/{n}" for n in ("attributes", "resilience", "centroids")])
    return U.exposure(attrs, res).join(cent, "pfaf_id")


@query
def write_product_csv(spark, sf):
    folder = work_folder(spark, "product") + "/depth_2024010118"
    K.write_product(X.gfms_summary(spark, sf).select(R.S.GFMS_SUMMARY.fieldNames()), folder, "csv", "windows-1252")
    return R.read_summary(spark, folder, "gfms")


@query
def write_rejected(spark, sf):
    folder = work_folder(spark, "rejected")
    K.write_rejected(S.validate_stations(X.stations(spark, sf))[1], folder)
    read = spark.read.option("header", True).csv(folder)
    return read.groupBy("error").agg(F.count("*").alias("n"))


def _alert_table(spark, sf) -> tuple[DataFrame, str]:
    return X.alert_series(spark, sf).select(*U.KEYS, "hazard_score", "alert"), work_folder(spark, "alerts")


@query
def write_partitions(spark, sf):
    """Written in two overlapping goes; the partitions there already stay as they are."""
    alerts, folder = _alert_table(spark, sf)
    K.write_partitions(alerts.where(F.col("run_ts") < X.ts("2024-01-20 00:00:00")), folder, ["run_ts"])
    K.write_partitions(alerts, folder, ["run_ts"])
    return spark.read.parquet(folder)


@query
def reprocess(spark, sf):
    """Runs from a date on are corrected and replace what was written."""
    alerts, folder = _alert_table(spark, sf)
    K.write_partitions(alerts, folder, ["run_ts"])
    late = alerts.where(F.col("run_ts") >= X.ts("2024-01-20 00:00:00"))
    K.reprocess(late.withColumn("hazard_score", -F.col("hazard_score")), folder, ["run_ts"])
    return spark.read.parquet(folder)


# --- streams: run until what is there is processed -------------------------------------------------------------------


def _streamed(spark, source: DataFrame, twin: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Write ``source``, stream it through ``twin`` into a table and read that."""
    folder = work_folder(spark, name)
    source.write.parquet(folder + "/in")
    stream = spark.readStream.schema(source.schema).parquet(folder + "/in")
    ST.run_available(twin(stream), folder + "/out", folder + "/state")
    return spark.read.parquet(folder + "/out")


@query
def stream_summaries(spark, sf):
    folder, out = _summary_files(spark, sf), work_folder(spark, "stream_summaries")
    ST.run_available(ST.stream_summaries(spark, folder, "gfms"), out + "/out", out + "/state")
    return spark.read.parquet(out + "/out")


@query
def stream_summaries_daily(spark, sf):
    """Files of a daily product; they have a date instead of a run time."""
    names = ["row_index", *X.VIIRS_COLUMNS]
    summary = X.viirs_summary(spark, sf).withColumn("row_index", F.lit(0))
    fields = [n for n in R.S.SUMMARIES["viirs"].fieldNames()]
    folder, out = work_folder(spark, "daily") + "/VIIRS_Flood_20240101", work_folder(spark, "stream_daily")
    _write_text(summary.select(*[n for n in fields if n in names]), folder)
    ST.run_available(ST.stream_summaries(spark, folder, "viirs"), out + "/out", out + "/state")
    return spark.read.parquet(out + "/out")


@query
def stream_upsert(spark, sf):
    """A stream of runs that replaces their partitions, delivered again with corrected values."""
    alerts, folder = _alert_table(spark, sf)
    for turn in (1, 2):
        part = alerts if turn == 1 else alerts.where(F.col("run_ts") >= X.ts("2024-01-20 00:00:00"))
        source = work_folder(spark, "corrected")
        part.withColumn("hazard_score", F.col("hazard_score") * turn).write.parquet(source)
        stream = spark.readStream.schema(alerts.schema).parquet(source)
        ST.upsert_available(stream, folder, ["run_ts"], source + "_state")
    return spark.read.parquet(folder)


@query
def stream_bins(spark, sf):
    events = X.table(spark, sf, "events").select("ts", (F.col("user_id") % 10).alias("pfaf_id"), "value")
    # A row a day later lets the watermark pass the last bin.
    end = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(
        "ts", F.lit(-1).cast("long").alias("pfaf_id"), F.lit(0.0).alias("value")
    )
    out = _streamed(spark, events.union(end), lambda s: ST.stream_bins(s, lateness="0 seconds"), "stream_bins")
    return out.where(F.col("pfaf_id") >= 0)


@query
def stream_flood_duration(spark, sf):
    return _streamed(
        spark, X.gfms_series(spark, sf), lambda s: ST.stream_flood_duration(s, lateness="0 seconds"), "stream_duration"
    )


@query
def stream_flood_duration_batches(spark, sf):
    """The series in four files, one per micro-batch, by the batch algorithm with a carry."""
    series, folder = X.gfms_series(spark, sf), work_folder(spark, "durations")
    parts = series.withColumn("part", F.ntile(4).over(Window.orderBy("run_ts")))
    for n in range(1, 5):
        # The last batch lets everything pass.
        parts.where(F.col("part") == n).drop("part").coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = spark.readStream.schema(series.schema).parquet(folder + "/in")
        ST.durations_available(stream, folder + "/out", folder + "/carry", folder + "/state", lateness_hours=72 if n < 4 else 0)
    return spark.read.parquet(folder + "/out").drop("batch")


@query
def stream_alert_status(spark, sf):
    alerts = X.alert_series(spark, sf).select(*U.KEYS, "alert")
    # A row a week later lets the watermark pass the last run.
    end = alerts.agg((F.max("run_ts") + F.expr("INTERVAL 7 DAYS")).alias("run_ts")).select(
        "run_ts", F.lit(-1).cast("long").alias("pfaf_id"), F.lit(None).cast("string").alias("alert")
    )
    out = _streamed(spark, alerts.union(end), lambda s: ST.stream_alert_status(s, "0 seconds"), "stream_status")
    return ST.published_runs(out.where(F.col("pfaf_id") >= 0))
