"""Every input of the operators, derived from the test tables (``sf_dir``) as plain DataFrames.

Metrics that come from floating point sums are rounded to 9 digits here and in the SQL twin, so that a threshold does
not depend on the order of a sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.alerts import alert_class
from freshet.operators.fusion import exposure as join_exposure
from freshet.schemas import Grid
from freshet.session import work_folder

RUN_TS = "2024-01-01 18:00:00"
RUN_DATE = "2024-01-01"
NOW = "2024-01-31 06:00:00"
GRID = Grid("check", -180.0, 90.0, 1.0, 1.0, 180, 360, -9999.0)
EVENT_LIMITS = [
    ("data", "click", -1, True),
    ("data", "view", -2, True),
    ("data", "error", -3, False),
    ("data", "purchase", -1, False),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Event times come without a zone; everything here is UTC.
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


def ts(text: str = RUN_TS) -> Column:
    return F.lit(text).cast("timestamp")


def day(text: str = RUN_DATE) -> Column:
    return F.lit(text).cast("date")


def r9(c: Column) -> Column:
    return F.round(c, 9)


def hours(c: Column) -> Column:
    return F.make_dt_interval(hours=c)


def attributes(spark, sf) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("pfaf_id"),
        (F.lit(500.0) + F.abs("c_acctbal")).alias("area_km2"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("iso"),
        F.col("n_name").alias("admin0"),
        F.col("c_mktsegment").alias("admin1"),
        (F.col("c_custkey") % 26 / F.lit(5.0)).alias("rfr_score"),
        (F.col("c_custkey") % 11 / F.lit(2.0)).alias("cfr_score"),
    )


def resilience(spark, sf) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").where(key != 7).select(
        F.concat(F.lit("N"), key.cast("string")).alias("iso"),
        F.when(key % 8 == 0, F.lit(-9999.0)).otherwise(key / F.lit(25.0)).alias("resilience_index"),
        (F.lit(1.0) - key / F.lit(50.0)).alias("normalized_lack_of_resilience"),
    )


def exposure(spark, sf) -> DataFrame:
    return join_exposure(attributes(spark, sf), resilience(spark, sf))


def stations(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        ts().alias("run_ts"),
        k.alias("point_no"),
        F.col("o_custkey").alias("pfaf_id"),
        (k * 7 % 103).cast("double").alias("glofas_2yr"),
        (k * 5 % 104).cast("double").alias("glofas_5yr"),
        (k * 11 % 105).cast("double").alias("glofas_20yr"),
        F.when(k % 41 == 0, F.lit(4)).otherwise((k % 4).cast("int")).alias("alert_level"),
        (k % 33 + 1).cast("int").alias("days_until_peak"),
    )


# Each source shifts the part keys by another number, so that every outer join has rows of one side only.
SHIFT = {"gfms": 40, "hwrf": 70, "dfo": 20, "viirs": 90}


def _gfms(lines: DataFrame, *keys: str) -> DataFrame:
    qty = F.sum("l_quantity")
    return lines.groupBy(*keys, (F.col("l_partkey") + SHIFT["gfms"]).alias("pfaf_id")).agg(
        r9(qty * 7.0).alias("gfms_totalarea_km"),
        r9(qty / 60.0).alias("gfms_perc_area"),
        r9(F.avg("l_discount") * 200.0).alias("gfms_meandepth"),
        r9(F.max("l_discount") * 1000.0).alias("gfms_maxdepth"),
        F.count("*").cast("int").alias("gfms_duration"),
    )


def _hwrf(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys, (F.col("l_partkey") + SHIFT["hwrf"]).alias("pfaf_id")).agg(
        r9(F.sum("l_quantity") * 13.0).alias("rain_totalarea_km"),
        r9(F.avg("l_quantity") * 1.5).alias("perc_area"),
        r9((F.avg("l_tax") * 100.0 - 2.0) * 3.0).alias("meanrain"),
        r9((F.avg("l_extendedprice") - 20000.0) / 3000.0).alias("maxrain"),
    )


def gfms_summary(spark, sf) -> DataFrame:
    return _gfms(table(spark, sf, "lineitem")).withColumn("run_ts", ts())


def hwrf_summary(spark, sf) -> DataFrame:
    return _hwrf(table(spark, sf, "lineitem")).withColumn("run_ts", ts())


def _dfo(parts: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    return parts.withColumns(
        {
            "pfaf_id": F.col("p_partkey") + SHIFT["dfo"],
            "d1_area": size, "d1_perc": size / 50.0,
            "d1cs_area": size * 30.0, "d1cs_perc": size / 4.0,
            "d2_area": size * 20.0, "d2_perc": size / 5.0,
            "d3_area": size * 10.0, "d3_perc": size / 10.0,
        }
    )


DFO_COLUMNS = ["pfaf_id", "d1_area", "d1_perc", "d1cs_area", "d1cs_perc", "d2_area", "d2_perc", "d3_area", "d3_perc"]


def _viirs(parts: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    return parts.withColumns(
        {
            "pfaf_id": F.col("p_partkey") + SHIFT["viirs"],
            "oneday_flood_area_km": size * 25.0, "oneday_perc_area": size / 6.0,
            "fiveday_flood_area_km": size * 40.0, "fiveday_perc_area": size / 3.0,
        }
    )


VIIRS_COLUMNS = ["pfaf_id", "oneday_flood_area_km", "oneday_perc_area", "fiveday_flood_area_km", "fiveday_perc_area"]


def dfo_summary(spark, sf) -> DataFrame:
    return _dfo(table(spark, sf, "part")).select(day().alias("run_date"), *DFO_COLUMNS)


def viirs_summary(spark, sf) -> DataFrame:
    return _viirs(table(spark, sf, "part")).select(day().alias("run_date"), *VIIRS_COLUMNS)


def at_run(df: DataFrame) -> DataFrame:
    """A daily product as input of the single fixture run."""
    return df.drop("run_date").withColumn("run_ts", ts())


# --- several runs on 2024-01-10 at 00, 06, 12 and 18 h ---------------------------------------------------------------


def _slots(spark, sf, n: int = 4) -> DataFrame:
    at = ts("2024-01-10 00:00:00") + hours((F.col("l_linenumber") % n * 6).cast("int"))
    return table(spark, sf, "lineitem").withColumn("run_ts", at)


def gfms_runs(spark, sf) -> DataFrame:
    return _gfms(_slots(spark, sf), "run_ts")


def hwrf_runs(spark, sf) -> DataFrame:
    """No storm run at 18 h: that hour falls back on 12 h."""
    return _hwrf(_slots(spark, sf, 3), "run_ts")


def station_runs(spark, sf) -> DataFrame:
    """Forecasts of 2024-01-09 and 2024-01-10, at midnight."""
    at = F.when(F.col("point_no") % 3 == 0, ts("2024-01-09 00:00:00")).otherwise(ts("2024-01-10 00:00:00"))
    return stations(spark, sf).withColumn("run_ts", at)


def dfo_dates(spark, sf) -> DataFrame:
    """Observations of 2024-01-08 and, usable at 18 h only, of 2024-01-10."""
    at = F.when(F.col("p_partkey") % 2 == 0, day("2024-01-10")).otherwise(day("2024-01-08"))
    return _dfo(table(spark, sf, "part")).select(at.alias("run_date"), *DFO_COLUMNS)


def viirs_dates(spark, sf) -> DataFrame:
    at = F.when(F.col("p_partkey") % 2 == 1, day("2024-01-09")).otherwise(day("2023-12-20"))
    return _viirs(table(spark, sf, "part")).select(at.alias("run_date"), *VIIRS_COLUMNS)


def viirs_today(spark, sf) -> DataFrame:
    return _viirs(table(spark, sf, "part")).select(day("2024-01-10").alias("run_date"), *VIIRS_COLUMNS)


def run_slots(spark, sf) -> DataFrame:
    return gfms_runs(spark, sf).select("run_ts").distinct()


# --- time series ------------------------------------------------------------------------------------------------------


def bins(spark, sf, width: int) -> DataFrame:
    start = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / F.lit(width * 3600)) * F.lit(width * 3600))
    return table(spark, sf, "events").withColumn("run_ts", start)


def gfms_series(spark, sf) -> DataFrame:
    """3-hour series of ten watersheds, gaps filled with zero."""
    sums = bins(spark, sf, 3).groupBy((F.col("user_id") % 10).alias("pfaf_id"), "run_ts").agg(
        F.round(F.sum("value"), 6).alias("gfms_totalarea_km")
    )
    span = bins(spark, sf, 3).agg(F.min("run_ts").alias("a"), F.max("run_ts").alias("b"))
    steps = span.select(F.explode(F.expr("sequence(a, b, INTERVAL 3 HOURS)")).alias("run_ts"))
    grid = steps.withColumn("pfaf_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))))
    return grid.join(sums, ["pfaf_id", "run_ts"], "left").fillna(0.0, ["gfms_totalarea_km"])


def alert_series(spark, sf) -> DataFrame:
    hazard = F.least(F.lit(100.0), r9(F.sum("value") / 4.0))
    return (
        bins(spark, sf, 6)
        .groupBy(F.col("user_id").alias("pfaf_id"), "run_ts")
        .agg(hazard.alias("hazard_score"))
        .withColumn("severity", F.lit(None).cast("double"))
        .withColumn("alert", alert_class(F.col("severity"), F.col("hazard_score"), 9))
        .withColumn("flag", F.lit(None).cast("int"))
    )


def runs(spark, sf) -> DataFrame:
    return bins(spark, sf, 6).select("run_ts").distinct()


def click_dates(spark, sf) -> DataFrame:
    d = F.to_date("ts")
    kept = table(spark, sf, "events").where((F.col("event_type") == "click") & (F.dayofmonth("ts") % 3 != 0))
    return kept.select(d.alias("run_date")).distinct()


def view_dates(spark, sf) -> DataFrame:
    kept = table(spark, sf, "events").where((F.col("event_type") == "view") & (F.dayofmonth("ts") % 4 != 0))
    return kept.select(F.to_date("ts").alias("run_date")).distinct()


def sparse_dates(spark, sf) -> DataFrame:
    """Two dates only, so that some runs find none in their lookback."""
    kept = table(spark, sf, "events").where(F.dayofmonth("ts").isin(3, 20))
    return kept.select(F.to_date("ts").alias("run_date")).distinct()


def storm_inventory(spark, sf) -> DataFrame:
    """Storm runs with every third slot missing and none in the last two slots."""
    last = ts("2024-01-30 06:00:00")
    kept = (F.unix_seconds("run_ts") / F.lit(21600)).cast("long") % 3 != 0
    return runs(spark, sf).where(kept & (F.col("run_ts") < last))


def product_runs(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.lit("data").alias("kind"), F.col("event_type").alias("product"), F.to_date("ts").alias("run_date")
    )


def site_checks(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat(F.lit("site"), (F.col("user_id") % 5).cast("string")).alias("name"),
        F.when(F.col("event_type") == "error", "DOWN").otherwise("UP").alias("status"),
        "ts",
    )


# --- rasters, polygons, points ---------------------------------------------------------------------------------------


def cells(spark, sf) -> DataFrame:
    """All readings with their cell; several may share one."""
    return table(spark, sf, "lineitem").select(
        (ts("2024-01-01 00:00:00") + hours((F.col("l_suppkey") % 4 * 3).cast("int"))).alias("run_ts"),
        (F.col("l_orderkey") % 180).cast("int").alias("row"),
        ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 360).cast("int").alias("col"),
        F.when(F.col("l_linenumber") == 7, F.lit(-9999.0)).otherwise(F.col("l_quantity")).alias("value"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("ordinal"),
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
    )


def pixels(spark, sf) -> DataFrame:
    return cells(spark, sf).groupBy("run_ts", "row", "col").agg(F.max_by("value", "ordinal").alias("value"))


def float_grids(spark, sf) -> str:
    """A folder with a raw grid of float32 per run of ``pixels``, no-data where there is none."""
    folder = work_folder(spark, "grids")
    rows, cols, nodata = GRID.nrows, GRID.ncols, GRID.nodata

    def write(key, pdf):
        import numpy as np
        import pandas as pd
        import pyarrow.fs as pafs

        data = np.full((rows, cols), nodata, "<f4")
        data[pdf["row"], pdf["col"]] = pdf["value"]
        fs, inner = pafs.FileSystem.from_uri(folder)
        fs.create_dir(inner)
        with fs.open_output_stream(f"{inner}/depth_{key[0]:%Y%m%d%H}.bin") as f:
            f.write(data.tobytes())
        return pd.DataFrame({"n": [len(pdf)]})

    pixels(spark, sf).groupBy(F.date_format("run_ts", "yyyyMMddHH").alias("stamp"), "run_ts").applyInPandas(
        lambda key, pdf: write(key[1:], pdf), "n long").collect()
    return folder


def dfo_pixels(spark, sf) -> DataFrame:
    """Class 3 is water; tiles are blocks of 30 x 30 cells."""
    c = cells(spark, sf)
    layer = F.element_at(F.array(*[F.lit(x) for x in ("d1", "d1cs", "d2", "d3")]), (F.col("l_suppkey") % 4 + 1).cast("int"))
    return (
        c.withColumn("run_date", F.date_add(day(), (F.col("l_linenumber") % 2).cast("int")))
        .withColumn("layer", layer)
        .groupBy("run_date", "layer", "row", "col")
        .agg(F.max_by((F.col("l_quantity") % 4).cast("double"), "ordinal").alias("value"))
        .withColumn("tile", (F.floor(F.col("row") / 30) * 12 + F.floor(F.col("col") / 30)).cast("int"))
    )


def viirs_pixels(spark, sf) -> DataFrame:
    return (
        cells(spark, sf)
        .withColumn("run_date", F.date_add(day(), (F.col("l_linenumber") % 2).cast("int")))
        .withColumn("product", F.when(F.col("l_suppkey") % 2 == 0, "1day").otherwise("5day"))
        .groupBy("run_date", "product", "row", "col")
        .agg(F.max_by(F.col("l_quantity") * 4.0, "ordinal").alias("value"))
    )


def watersheds(spark, sf) -> DataFrame:
    """A triangle per nation, every fourth one with a square hole."""
    k = F.col("n_nationkey")
    x = F.lit(-170.0) + k % 5 * F.lit(65.0) + F.lit(0.3)
    y = F.lit(-70.0) + F.floor(k / 5) * F.lit(28.0) + F.lit(0.2)

    def point(dx: float, dy: float) -> Column:
        return F.struct((x + F.lit(dx)).alias("x"), (y + F.lit(dy)).alias("y"))

    triangle = F.array(point(0.0, 0.0), point(25.0, 3.0), point(9.0, 22.0))
    hole = F.array(point(9.0, 6.0), point(13.0, 6.0), point(13.0, 10.0), point(9.0, 10.0))
    return table(spark, sf, "nation").select(
        k.cast("long").alias("pfaf_id"),
        (F.lit(1000.0) + k * F.lit(137.0)).alias("area_km2"),
        F.when(k % 4 == 0, F.array(triangle, hole)).otherwise(F.array(triangle)).alias("rings"),
    )


def points(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("point_no"),
        (F.lit(-180.0) + F.col("o_orderkey") * 37 % 3600 / F.lit(10.0)).alias("lon"),
        (F.lit(-90.0) + F.col("o_custkey") * 13 % 1800 / F.lit(10.0)).alias("lat"),
    )


def raw_stations(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(fixed, dynamic) stations with place and probabilities; odd keys hold probabilities in 0..1."""
    k = F.col("o_orderkey")
    scale = F.when(k % 2 == 1, F.lit(0.01)).otherwise(F.lit(1.0))
    every = table(spark, sf, "orders").select(
        F.when(k % 2 == 1, ts("2024-01-02 00:00:00")).otherwise(ts("2024-01-01 00:00:00")).alias("run_ts"),
        k.alias("point_no"),
        F.concat(F.lit("S"), k.cast("string")).alias("station"),
        F.col("o_orderpriority").alias("basin"),
        F.col("o_orderstatus").alias("country"),
        F.col("o_totalprice").alias("upstream_area"),
        (F.lit(-180.0) + k * 37 % 3600 / F.lit(10.0)).alias("lon"),
        (F.lit(-90.0) + F.col("o_custkey") * 13 % 1800 / F.lit(10.0)).alias("lat"),
        (k % 33 + 1).cast("int").alias("days_until_peak"),
        (k * 7 % 101 * scale).alias("glofas_2yr"),
        (k * 5 % 101 * scale).alias("glofas_5yr"),
        (k * 11 % 101 * scale).alias("glofas_20yr"),
        (k % 4).cast("int").alias("alert_level"),
    )
    return every.where(F.col("point_no") % 3 != 0), every.where(F.col("point_no") % 3 == 0)


def rain(spark, sf) -> DataFrame:
    """Rain readings of four storms in their boxes; some lie outside or have no rain."""
    storm = F.col("o_orderkey") % 4
    return table(spark, sf, "orders").select(
        ts("2024-01-01 06:00:00").alias("run_ts"),
        F.concat(F.lit("storm"), storm.cast("string")).alias("source"),
        F.col("o_orderkey").alias("ordinal"),
        (F.lit(-180.0) + F.col("o_orderkey") * 37 % 3600 / F.lit(10.0)).alias("lon"),
        (F.lit(-90.0) + F.col("o_custkey") * 13 % 1800 / F.lit(10.0)).alias("lat"),
        ((F.col("o_orderkey") * 3 + F.col("o_custkey")) % 200 / F.lit(10.0) - F.lit(1.0)).alias("z"),
        (F.lit(-180.0) + storm * F.lit(60.0)).alias("xlc"),
        (F.lit(-20.0) + storm * F.lit(60.0)).alias("xrc"),
        F.lit(-80.0).alias("ybc"),
        F.lit(80.0).alias("ytc"),
    )


def centroids(spark, sf) -> DataFrame:
    """One or two administrative centroids per watershed."""
    k = F.col("c_custkey")
    return (
        table(spark, sf, "customer")
        .withColumn("_part", F.explode(F.when(k % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            k.alias("pfaf_id"),
            F.col("c_name").alias("admin_name"),
            F.col("_part").alias("part"),
            (k * 7 % 180 - F.lit(90.0)).alias("centroid_y"),
            k.alias("FID_union"),
        )
    )
