"""Explicit schemas of all inputs and the raster grid description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# Summary files, columns in file order (the time is in the file name).
GFMS_SUMMARY = _struct(
    "pfaf_id long, gfms_totalarea_km double, gfms_perc_area double, gfms_meandepth double, gfms_maxdepth double,"
    "gfms_duration int"
)
HWRF_SUMMARY = _struct("pfaf_id long, rain_totalarea_km double, perc_area double, meanrain double, maxrain double")
DFO_SUMMARY = _struct(
    "row_index long, pfaf_id long, d1_area double, d1_perc double, d1cs_area double, d1cs_perc double,"
    "d2_area double, d2_perc double, d3_area double, d3_perc double"
)
VIIRS_SUMMARY = _struct(
    "pfaf_id long, oneday_flood_area_km double, oneday_perc_area double, fiveday_flood_area_km double,"
    "fiveday_perc_area double"
)
SUMMARIES = {"gfms": GFMS_SUMMARY, "hwrf": HWRF_SUMMARY, "dfo": DFO_SUMMARY, "viirs": VIIRS_SUMMARY}

# Station files, 18 or 19 columns without a header.
_STATION_HEAD = "point_no long, id string,"
_STATION_PLACE = "country string, continent string, country_code string,"
_STATION_TAIL = (
    "lon double, lat double, empty string, unknown_2 string, days_until_peak int, glofas_2yr double,"
    "glofas_5yr double, glofas_20yr double, alert_level int"
)
_FIXED = _STATION_HEAD + "basin string, location string, station string," + _STATION_PLACE
_DYNAMIC = _STATION_HEAD + "station string, basin string, location string," + _STATION_PLACE
STATION_LAYOUTS = {
    ("fixed", 19): _struct(_FIXED + "upstream_area double, unknown_1 string," + _STATION_TAIL),
    ("fixed", 18): _struct(_FIXED + "upstream_area double," + _STATION_TAIL),
    ("dynamic", 19): _struct(_DYNAMIC + "unknown_1 string, upstream_area double," + _STATION_TAIL),
    ("dynamic", 18): _struct(_DYNAMIC + "upstream_area double," + _STATION_TAIL),
}

RESILIENCE = _struct(
    "country_name string, iso string, normalized_lack_of_resilience double, resilience_index double,"
    "resilience_rank int, vulnerability_index double, vulnerability_rank int, coping_capacity_index double,"
    "coping_capacity_rank int"
)
ATTRIBUTES = _struct(
    "pfaf_id long, area_km2 double, iso string, admin0 string, admin1 string, rfr_score double, cfr_score double"
)

_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
WATERSHEDS = T.StructType(
    [
        T.StructField("pfaf_id", T.LongType()),
        T.StructField("area_km2", T.DoubleType()),
        T.StructField("rings", T.ArrayType(T.ArrayType(_POINT))),
    ]
)
PIXELS = _struct("product string, run_ts timestamp, row int, col int, value double")
ALERTS = _struct("run_ts timestamp, pfaf_id long, hazard_score double, severity double, alert string, flag int")


@dataclass(frozen=True)
class Grid:
    """North-up raster: (x0, y0) is the upper left corner, px and py the positive cell sizes in degrees."""

    grid_id: str
    x0: float
    y0: float
    px: float
    py: float
    nrows: int
    ncols: int
    nodata: float = -9999.0


DEPTH_RAW = Grid("depth_raw", -127.25, 50.0, 0.125, 0.125, 800, 2458)
DEPTH = Grid("depth", -127.25, 50.0, 0.0625, 0.0625, 1600, 4916)
# A raw depth file below this size was cut off in transfer.
DEPTH_MIN_BYTES = 7_000_000
RAIN_NODATA = -999.0
