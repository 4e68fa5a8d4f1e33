"""Readers with explicit schemas; every one splits its files over the executors."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet import schemas as S
from freshet.functions.dates import run_ts_from_path
from freshet.functions.numeric import clean
from freshet.session import stored
from freshet.sources.grids import read_grid_rows

LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def read_summary(spark: SparkSession, path: str | list[str], product: str) -> DataFrame:
    """Summary CSV files of one product, with the run time taken from the file name.

    The schema is applied by position, so that header spellings do not matter. Daily products get ``run_date``.
    """
    raw = (
        spark.read.schema(S.SUMMARIES[product])
        .option("header", True)
        .csv(path)
        .withColumn("run_ts", run_ts_from_path(F.col("_metadata.file_path")))
    )
    if product in ("dfo", "viirs"):
        raw = raw.withColumn("run_date", F.to_date("run_ts")).drop("run_ts")
    return clean(raw.drop("row_index"))


def read_parameters(spark: SparkSession, path: str) -> dict[str, float]:
    """The single row of a parameter CSV (a leading byte order mark is stripped by the reader)."""
    row = spark.read.option("header", True).csv(path).first()
    return {name.strip().lower(): float(value) for name, value in row.asDict().items()}


def read_stations(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Headerless station CSV, ``kind`` fixed or dynamic; each file has 18 or 19 columns by its own first line.

    All files are read at once as text columns, and the names are given by file. Lines with more fields than their file's
    first line are left out, short lines are filled up with NULL; fields are counted outside quotes. ``width`` has the
    file's number of columns. The widths, one row per file, are stored so that their size is known to the join.
    """
    names = [f"c{i}" for i in range(20)]
    raw = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_line")])
    # A pruned line would be taken for complete.
    reader = spark.read.schema(raw).option("columnPruning", False).option("columnNameOfCorruptRecord", "_line")
    def count(line: str):
        return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))

    # Places of lines grow within a file, which may be read in several blocks.
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), place.alias("_at"), count("value").alias("_fields"))
    widths = stored(lines.groupBy("_file").agg(F.min_by("_fields", "_at").alias("width")), "widths")
    # A line of other than twenty fields comes with its text.
    fields = F.coalesce(count("_line"), F.lit(20))
    rows = reader.csv(path).select(*names, fields.alias("_fields"), F.col("_metadata.file_path").alias("_file"))
    rows = rows.join(widths, "_file").where(F.col("_fields") <= F.col("width"))
    wide, slim = S.STATION_LAYOUTS[kind, 19], S.STATION_LAYOUTS[kind, 18].fieldNames()

    def value(i: int, field: T.StructField):
        other = F.col(f"c{slim.index(field.name)}") if field.name in slim else F.lit(None).cast("string")
        known = F.when(F.col("width") == 19, F.col(f"c{i}")).when(F.col("width") == 18, other)
        bad = F.raise_error(F.concat(F.lit("not a station file: "), F.col("_file"))).cast("string")
        return known.otherwise(bad).try_cast(field.dataType).alias(field.name)

    named = rows.select(*[value(i, f) for i, f in enumerate(wide.fields)], "width", run_ts_from_path(F.col("_file")).alias("run_ts"))
    return clean(named)


def read_float_grid(
    spark: SparkSession, path: str, grid: S.Grid = S.DEPTH_RAW, min_bytes: int = S.DEPTH_MIN_BYTES,
    keep_nodata: bool = False,
) -> DataFrame:
    """Raw little-endian float32 grids as pixel rows (run_ts, row, col, value), a band of rows per task.

    Files cut off in transfer are skipped by their length before they are read. Conditions on ``row`` reach the source.
    """
    rows = read_grid_rows(spark, path, grid, min_bytes)
    cells = rows.select("run_ts", "row", F.posexplode("values").alias("col", "value"))
    if not keep_nodata:
        cells = cells.where(F.isnan("value") | (F.col("value") != F.lit(grid.nodata).cast("float")))
    return cells.select("run_ts", "row", "col", F.col("value").cast("double").alias("value"))


def read_rain_text(spark: SparkSession, path: str) -> DataFrame:
    """Storm rain text grids: rows (source, run_ts, lon, lat, z) with their file's box (xlc, xrc, ybc, ytc, res).

    The first line of a file has seven numbers, the others ``lat lon z``; a missing amount becomes the no-data value.
    The boxes, one row per file, are stored so that their size is known to the join.
    """
    tokens = F.split(F.trim(F.col("value")), r"\s+")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), tokens.alias("t"))

    def num(i: int):
        return F.try_element_at("t", F.lit(i)).try_cast("double")

    names = ["xlc", "xrc", "ybc", "ytc", "res", "nrows", "ncol"]
    heads = lines.where(F.size("t") == 7).select(
        "source", *[num(i).alias(n) for i, n in enumerate(names, start=1)]
    )
    z = F.coalesce(F.when(~F.isnan(num(3)), num(3)), F.lit(S.RAIN_NODATA))
    readings = lines.where(F.size("t").isin(2, 3)).select(
        "source",
        run_ts_from_path(F.col("source")).alias("run_ts"),
        num(2).alias("lon"),
        num(1).alias("lat"),
        z.alias("z"),
    )
    return readings.join(stored(heads, "boxes"), "source")


def read_pixels(
    spark: SparkSession, path: str, product: str | None = None, layers: list[str] | None = None,
    start: str | None = None, end: str | None = None, time: str = "run_ts",
) -> DataFrame:
    """Pixel table in parquet; product, layers and time bounds prune partitions or are pushed into the scan."""
    df = spark.read.parquet(path)
    if product is not None:
        df = df.where(F.col("product") == product)
    if layers is not None:
        df = df.where(F.col("layer").isin(*layers))
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast(df.schema[time].dataType))
    if end is not None:
        df = df.where(F.col(time) < F.lit(end).cast(df.schema[time].dataType))
    return df


def read_watersheds(spark: SparkSession, path: str) -> DataFrame:
    """Watershed polygons (pfaf_id, area_km2, rings) from parquet; polygons over the date line come split."""
    return spark.read.schema(S.WATERSHEDS).parquet(path)


def _snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip().strip("﻿")).replace(" ", "_").lower()


def read_csv_windows1252(spark: SparkSession, path: str) -> DataFrame:
    """CSV in Windows-1252; Spark wants its wider list of charsets switched on for it."""
    spark.conf.set(LEGACY_CHARSETS, "true")
    return spark.read.option("header", True).option("encoding", "windows-1252").csv(path)


def read_dimensions(
    spark: SparkSession, attributes: str, resilience: str, centroids: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(attributes, resilience, admin centroids). The first two have fixed columns; a centroid file keeps all of its own."""
    attrs = spark.read.schema(S.ATTRIBUTES).option("header", True).csv(attributes)
    res = spark.read.schema(S.RESILIENCE).option("header", True).csv(resilience)
    cent = read_csv_windows1252(spark, centroids)
    cent = cent.select(*[F.col(f"`{c}`").alias(_snake(c)) for c in cent.columns])
    cent = cent.withColumns({"pfaf_id": F.col("pfaf_id").cast("long"), "centroid_y": F.col("centroid_y").cast("double")})
    return clean(attrs), clean(res), cent
