"""Zonal statistics: pixels joined to watershed spans and aggregated per run and watershed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet import params as P
from freshet.functions.geo import RAIN_DEG2RAD, center_y, pixel_area
from freshet.functions.numeric import percent_area
from freshet.operators.fusion import merge_dfo_layers, merge_viirs
from freshet.operators.rowsums import dense_rows, pixel_rows, row_stats, row_sums
from freshet.operators.spatial import row_spans, watershed_spans, zonal_join
from freshet.schemas import Grid
from freshet.session import stored

SCAFFOLD_SLOTS = 256


def dense_scaffold(watersheds: DataFrame, runs: DataFrame, slots: int = SCAFFOLD_SLOTS) -> DataFrame:
    """Every run with every watershed, for products that report dry watersheds as zero rows.

    That table is what the product publishes, so its size is given. Watersheds are spread over ``slots`` by hash and
    each run is listed once per slot; the equality join on the slot then spreads the work evenly.
    """
    slotted = watersheds.withColumn("_slot", F.pmod(F.xxhash64("pfaf_id"), F.lit(slots)).cast("int"))
    listed = runs.distinct().withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return slotted.join(listed, "_slot").drop("_slot")


def grid_spans(watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None) -> DataFrame:
    """``spans`` as handed in, else computed and stored; written once per grid they serve every later call."""
    return stored(watershed_spans(watersheds, grid), "spans") if spans is None else spans


def zonal_stats(
    pixels: DataFrame, spans: DataFrame, grid: Grid, keys: tuple[str, ...] = ("run_ts",),
    deg2rad: float = math.pi / 180.0, factor: int = 1,
) -> DataFrame:
    """Area, mean and maximum of the cells with data, per run and watershed; zero is data, ``grid.nodata`` is not.

    Partial aggregates run before the shuffle, so a watershed with most of the pixels is no hot spot. The cell area
    depends on the row only and is computed per span, not per pixel. ``grid`` is the grid of the spans, which may be
    ``factor`` times finer than the pixels'.
    """
    sized = spans.withColumn("_km2", pixel_area(center_y(F.col("row"), grid), grid, deg2rad))
    data = pixels.where((F.col("value") != F.lit(grid.nodata)) & ~F.isnan("value"))
    cells = F.col("cells")
    return (
        zonal_join(data.select(*keys, "row", "col", "value"), sized, factor)
        .groupBy(*keys, "pfaf_id")
        .agg(
            F.sum(F.col("_km2") * cells).alias("area"),
            (F.sum(F.col("value") * cells) / F.sum(cells)).alias("mean"),
            F.max("value").alias("max"),
        )
    )


def depth_stats(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None, deg2rad: float = math.pi / 180.0,
    factor: int = 1, by_rows: bool = False,
) -> DataFrame:
    """``zonal_stats`` of a pixel table, or, with ``by_rows``, the same from running sums along grid rows: for polygons that
    overlap much or are wide. Grid rows (run_ts, row, values) need no pixel table and always go by rows."""
    dense = "values" in pixels.columns
    if not (by_rows or dense):
        return zonal_stats(pixels, grid_spans(watersheds, grid, spans), grid, deg2rad=deg2rad, factor=factor)
    spans = stored(row_spans(watersheds, grid), "spans") if spans is None else spans
    sums = row_sums(dense_rows(pixels) if dense else pixel_rows(pixels), grid.nodata)
    return row_stats(sums, spans, grid, deg2rad=deg2rad, factor=factor)


def zonal_count(
    pixels: DataFrame, spans: DataFrame, predicate: Column, cell_km2: float, keys: tuple[str, ...]
) -> DataFrame:
    """Area of the cells that meet ``predicate``; the predicate is applied before the join, where it can reach the scan."""
    hits = zonal_join(pixels.where(predicate).select(*keys, "row", "col"), spans)
    return hits.groupBy(*keys, "pfaf_id").agg((F.count("*") * F.lit(cell_km2)).alias("area"))


def _sizes(watersheds: DataFrame) -> DataFrame:
    return watersheds.select("pfaf_id", "area_km2")


def gfms_summary(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, runs: DataFrame | None = None, keep_empty: bool = True,
    seed_hours: int = 3, threshold: float = 100.0, spans: DataFrame | None = None, factor: int = 1, by_rows: bool = False,
) -> DataFrame:
    """Flood depth per watershed and run, with the seed of the flood duration.

    ``spans`` may be handed in when they were written once for the grid. ``runs`` lists the runs to report, by default
    those that have pixels. With ``factor`` the pixels count as upsampled to ``grid``. ``by_rows`` as in ``depth_stats``.
    """
    stats = depth_stats(pixels, watersheds, grid, spans, factor=factor, by_rows=by_rows)
    if keep_empty:
        runs = pixels.select("run_ts") if runs is None else runs.select("run_ts")
        stats = dense_scaffold(_sizes(watersheds), runs).join(stats, ["run_ts", "pfaf_id"], "left")
    else:
        stats = stats.join(_sizes(watersheds), "pfaf_id")

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    area = or_zero(F.col("area"))
    return stats.select(
        "run_ts",
        "pfaf_id",
        area.alias("gfms_totalarea_km"),
        or_zero(percent_area(F.col("area"), F.col("area_km2"))).alias("gfms_perc_area"),
        or_zero(F.col("mean")).alias("gfms_meandepth"),
        or_zero(F.col("max")).alias("gfms_maxdepth"),
        F.when(area > threshold, F.lit(seed_hours)).otherwise(F.lit(0)).alias("gfms_duration"),
    )


def hwrf_summary(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None, by_rows: bool = False
) -> DataFrame:
    """Storm rain per watershed and run; only watersheds that got rain data. ``by_rows`` as in ``depth_stats``."""
    stats = depth_stats(pixels, watersheds, grid, spans, deg2rad=RAIN_DEG2RAD, by_rows=by_rows).join(_sizes(watersheds), "pfaf_id")
    return stats.select(
        "run_ts",
        "pfaf_id",
        F.col("area").alias("rain_totalarea_km"),
        percent_area(F.col("area"), F.col("area_km2")).alias("perc_area"),
        F.col("mean").alias("meanrain"),
        F.col("max").alias("maxrain"),
    )


def _with_zero_rows(
    areas: DataFrame, watersheds: DataFrame, runs: DataFrame, keys: list[str], keep_empty: bool
) -> DataFrame:
    if keep_empty:
        dense = dense_scaffold(_sizes(watersheds), runs).join(areas, [*keys, "pfaf_id"], "left")
        dense = dense.withColumn("area", F.coalesce("area", F.lit(0.0)))
    else:
        dense = areas.join(_sizes(watersheds), "pfaf_id")
    return dense.withColumn("perc", percent_area(F.col("area"), F.col("area_km2"))).drop("area_km2")


def dfo_layers(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, keep_empty: bool = True, spans: DataFrame | None = None
) -> DataFrame:
    """Water class area per (run_date, layer, watershed), rounded to 3 decimals."""
    spans = grid_spans(watersheds, grid, spans)
    keys = ["run_date", "layer"]
    water = F.col("value") == F.lit(P.DFO_FLOOD_CLASS)
    areas = zonal_count(pixels, spans, water, P.DFO_CELL_KM2, tuple(keys))
    out = _with_zero_rows(areas, watersheds, pixels.select(*keys), keys, keep_empty)
    return out.withColumns({c: F.round(c, 3) for c in ("area", "perc")})


def dfo_summary(pixels: DataFrame, watersheds: DataFrame, grid: Grid, **options) -> DataFrame:
    """Observed water, the four layers side by side."""
    return merge_dfo_layers(dfo_layers(pixels, watersheds, grid, **options))


def viirs_products(
    pixels: DataFrame, watersheds: DataFrame, grid: Grid, keep_empty: bool = True, spans: DataFrame | None = None
) -> DataFrame:
    """Flood class area per (run_date, product, watershed)."""
    spans = grid_spans(watersheds, grid, spans)
    keys = ["run_date", "product"]
    flood = (F.col("value") > P.VIIRS_CLASS_ABOVE) & (F.col("value") < P.VIIRS_CLASS_BELOW)
    areas = zonal_count(pixels, spans, flood, P.VIIRS_CELL_KM2, tuple(keys))
    return _with_zero_rows(areas, watersheds, pixels.select(*keys), keys, keep_empty)


def viirs_summary(pixels: DataFrame, watersheds: DataFrame, grid: Grid, spans: DataFrame | None = None) -> DataFrame:
    """Flood composites, one-day and five-day side by side. Zero rows would be dropped again, so none are made."""
    return merge_viirs(viirs_products(pixels, watersheds, grid, keep_empty=False, spans=spans))


def complete_dates(tiles: DataFrame, min_tiles: int, today: Column) -> DataFrame:
    """Dates that may be processed: past dates as they are, the current one only with all its tiles.

    Distinct tiles are counted in two steps, (date, tile) first, so that one date's pixels are not gathered in a task.
    """
    counted = tiles.select("run_date", "tile").distinct().groupBy("run_date").agg(F.count("tile").alias("tiles"))
    return counted.where((F.col("run_date") < today) | (F.col("tiles") >= min_tiles))
