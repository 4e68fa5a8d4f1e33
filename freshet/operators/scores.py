"""Product scores: one narrow projection per product, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import params as P
from freshet.functions.numeric import alert_score, capped_score, clean, eps_score, peak_score, step_score

GFMS_PARTS = ["gfms_area_score", "gfms_perc_area_score", "gfms_meandepth_score", "gfms_maxdepth_score",
              "gfms_duration_score"]
GLOFAS_PARTS = ["alert_score", "peak_score", "two_score", "five_score", "twenty_score"]
HWRF_PARTS = ["hwrf_area_score", "hwrf_percarea_score", "meanrain_score", "maxrain_score"]
DFO_PARTS = [f"dfo_{m}_{d}_score" for d in P.DFO_DAYS for m in ("area", "perc_area")]
VIIRS_PARTS = [f"viirs_{m}_{d}_score" for d in P.VIIRS_DAYS for m in ("area", "perc_area")]


def _total(names: list[str]):
    total = F.col(names[0])
    for n in names[1:]:
        total = total + F.col(n)
    return total


def score_gfms(summary: DataFrame, weights: dict | None = None) -> DataFrame:
    """Depth summary -> five part scores and ``gfms_score``; ``weights`` as from ``params.table_weights``."""
    weights = weights or P.GFMS
    sources = ["gfms_totalarea_km", "gfms_perc_area", "gfms_meandepth", "gfms_maxdepth", "gfms_duration"]
    parts = {
        name: capped_score(F.col(c).cast("double"), p)
        for name, c, p in zip(GFMS_PARTS, sources, weights.values(), strict=True)
    }
    return clean(summary).withColumns(parts).withColumn("gfms_score", _total(GFMS_PARTS))


def score_glofas(stations: DataFrame) -> DataFrame:
    """Valid forecast stations -> alert, peak and three probability scores and ``glofas_score``."""
    probabilities = ["glofas_2yr", "glofas_5yr", "glofas_20yr"]
    signals = [F.col(c) for c in [*probabilities, "alert_level"]]
    df = clean(stations)
    parts = {
        "alert_score": alert_score(F.col("alert_level")),
        "peak_score": peak_score(F.col("days_until_peak"), *signals),
    }
    parts.update({n: eps_score(F.col(c)) for n, c in zip(GLOFAS_PARTS[2:], probabilities, strict=True)})
    return df.withColumns(parts).withColumn("glofas_score", _total(GLOFAS_PARTS))


def score_hwrf(summary: DataFrame, weights: dict | None = None) -> DataFrame:
    """Storm rain summary -> four part scores and ``hwrf_total``."""
    weights = weights or P.HWRF
    return (
        clean(summary)
        .withColumns(
            {
                "hwrf_area_score": capped_score(F.col("rain_totalarea_km"), weights["area"]),
                "hwrf_percarea_score": capped_score(F.col("perc_area"), weights["perc"]),
                "meanrain_score": step_score(F.col("meanrain"), weights["meanrain"]),
                "maxrain_score": step_score(F.col("maxrain"), weights["maxrain"]),
            }
        )
        .withColumn("hwrf_total", _total(HWRF_PARTS) * F.lit(P.HWRF_FACTOR))
    )


def score_dfo(summary: DataFrame, min_total: float | None = None, weights: dict | None = None) -> DataFrame:
    """Observed water summary -> six part scores and ``dfo_total``; the one-day layer scored is the cloud-shadow one.

    ``min_total`` keeps only rows above it.
    """
    weights, parts = weights or P.DFO | {"days": P.DFO_DAYS}, {}
    for (day, mult), layer in zip(weights["days"].items(), ("d1cs", "d2", "d3"), strict=True):
        parts[f"dfo_area_{day}_score"] = capped_score(F.col(f"{layer}_area"), weights["area"], mult)
        parts[f"dfo_perc_area_{day}_score"] = capped_score(F.col(f"{layer}_perc"), weights["perc"], mult)
    df = clean(summary).withColumns(parts).withColumn("dfo_total", _total(DFO_PARTS))
    return df if min_total is None else df.where(F.col("dfo_total") > F.lit(min_total))


def score_viirs(summary: DataFrame, min_total: float | None = None, weights: dict | None = None) -> DataFrame:
    """Flood composite summary -> four part scores and ``viirs_total``."""
    weights, parts = weights or P.VIIRS | {"days": P.VIIRS_DAYS}, {}
    for (day, mult), layer in zip(weights["days"].items(), ("oneday", "fiveday"), strict=True):
        parts[f"viirs_area_{day}_score"] = capped_score(F.col(f"{layer}_flood_area_km"), weights["area"], mult)
        parts[f"viirs_perc_area_{day}_score"] = capped_score(F.col(f"{layer}_perc_area"), weights["perc"], mult)
    df = clean(summary).withColumns(parts).withColumn("viirs_total", _total(VIIRS_PARTS))
    return df if min_total is None else df.where(F.col("viirs_total") > F.lit(min_total))
