"""Forecast stations: validation, rescaling, union, averaging and the published projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.dates import iso_time
from freshet.functions.numeric import clean
from freshet.operators.scores import GLOFAS_PARTS, score_glofas
from freshet.session import stored

PROBABILITIES = ["glofas_2yr", "glofas_5yr", "glofas_20yr"]

# Messages of the validation rules, first match wins.
_RULES = [
    ("alert level outside 0 to 3", lambda: (F.col("alert_level") > 3) | (F.col("alert_level") < 0)),
    ("2-year probability above 100", lambda: F.col("glofas_2yr") > 100),
    ("5-year probability above 100", lambda: F.col("glofas_5yr") > 100),
    ("20-year probability above 100", lambda: F.col("glofas_20yr") > 100),
    ("peak later than 30 days", lambda: F.col("days_until_peak") > 30),
]


def validation_error() -> Column:
    """Message of the first broken rule, NULL for a valid station."""
    error = F.lit(None).cast("string")
    for message, broken in reversed(_RULES):
        error = F.when(broken(), F.lit(message)).otherwise(error)
    return error


def validate_stations(stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with an ``error`` column); both read the input with the rule pushed into their filter."""
    checked = clean(stations).withColumn("error", validation_error())
    return checked.where(F.col("error").isNull()).drop("error"), checked.where(F.col("error").isNotNull())


def normalize_probability(stations: DataFrame, scope: str = "run_ts") -> DataFrame:
    """Scale the probabilities of a run to 0..100 when its highest 2-year value is at most 1.

    The run maxima are aggregated with a map-side combine, stored and joined back, so that a run with most of the
    stations is not gathered in one task the way a window over the run would.
    """
    stations = clean(stations)
    top = stations.groupBy(scope).agg(F.max("glofas_2yr").alias("_top")).where(F.col("_top") <= 1.0)
    unit = top.select(F.col(scope).alias("_scope"), F.lit(100.0).alias("_factor"))
    joined = stations.join(stored(unit, "unit"), F.col(scope).eqNullSafe(F.col("_scope")), "left")
    factor = F.coalesce("_factor", F.lit(1.0))
    return joined.withColumns({c: F.col(c) * factor for c in PROBABILITIES}).drop("_scope", "_factor")


def station_union(fixed: DataFrame, dynamic: DataFrame) -> DataFrame:
    """All stations by column name; the dynamic set of a run is ignored if its files have another ``width`` than the fixed
    ones of that run. Sets without the column must have equally many columns, else the dynamic set is ignored.
    """
    if "width" not in fixed.columns or "width" not in dynamic.columns:
        return fixed.unionByName(dynamic) if len(fixed.columns) == len(dynamic.columns) else fixed
    mine = fixed.groupBy("run_ts").agg(F.max("width").alias("_mine"))
    both = dynamic.groupBy("run_ts").agg(F.max("width").alias("_other")).join(mine, "run_ts")
    odd = stored(both.where("_mine <> _other").select("run_ts"), "odd_runs")
    return fixed.unionByName(dynamic.join(odd, "run_ts", "left_anti")).drop("width")


def station_output(stations: DataFrame, forecast_ts: str = "run_ts") -> DataFrame:
    """Published 15 columns: whole-number probabilities, their label and the forecast date."""
    whole = {c: F.col(c).cast("int") for c in PROBABILITIES}
    df = stations.withColumns(whole)
    return df.select(
        "point_no",
        "station",
        "basin",
        "country",
        F.round("lat", 3).alias("lat"),
        F.round("lon", 3).alias("lon"),
        F.round("upstream_area", 3).alias("upstream_area"),
        iso_time(F.col(forecast_ts)).alias("forecast_date"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in PROBABILITIES]).alias("max_eps"),
        *PROBABILITIES,
        "alert_level",
        "days_until_peak",
        "pfaf_id",
    )


STATION_VALUES = ["point_no", "alert_level", "days_until_peak", *PROBABILITIES, *GLOFAS_PARTS]


def average_stations(scored: DataFrame, keys: tuple[str, ...] = ("run_ts", "pfaf_id")) -> DataFrame:
    """Mean score per watershed, the other columns from the station with the highest number.

    Both are aggregates with a map-side combine, so a watershed with very many stations costs no more than another;
    one aggregate per column keeps it a hash aggregate.
    """
    values = [c for c in STATION_VALUES if c in scored.columns]
    return scored.groupBy(*keys).agg(
        *[F.expr(f"max_by({c}, point_no) AS {c}") for c in values], F.avg("glofas_score").alias("glofas_score")
    )


def station_scores(stations: DataFrame, keys: tuple[str, ...] = ("run_ts", "pfaf_id")) -> DataFrame:
    """Raw stations to one averaged score row per watershed and run."""
    accepted, _ = validate_stations(stations)
    return average_stations(score_glofas(accepted), keys)
