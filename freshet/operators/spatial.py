"""Raster and polygon operators: scanline spans, pixel and point joins, resampling, rasterising, mosaics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.geo import cell_of, center_x, center_y
from freshet.schemas import Grid
from freshet.session import small_side, stored

# Cells of one row are joined in buckets of this many columns, so that neither a wide polygon nor a busy row is one key.
BUCKET = 256
# Spans up to this number are broadcast, some hundred megabytes on an executor; the depth and rain grids have fewer.
SPAN_ROWS = 2_000_000
# Edges of all cover rows together, some forty bytes each.
COVER_EDGES = 1_000_000
# Edges of a cover cell that is not cut further, and how often cells are halved at most.
MOST_EDGES, MAX_LEVEL = 64, 12


def _closed_edges(ring: Column) -> Column:
    """Array of edge structs (x1, y1, x2, y2) of a ring, the closing edge included."""
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    closed = F.when((first["x"] == last["x"]) & (first["y"] == last["y"]), ring).otherwise(
        F.concat(ring, F.array(first))
    )
    n = F.size(closed) - F.lit(1)
    pairs = F.arrays_zip(F.slice(closed, F.lit(1), n).alias("a"), F.slice(closed, F.lit(2), n).alias("b"))
    return F.transform(
        pairs,
        lambda p: F.struct(
            p["a"]["x"].alias("x1"), p["a"]["y"].alias("y1"), p["b"]["x"].alias("x2"), p["b"]["y"].alias("y2")
        ),
    )


def _with_edges(watersheds: DataFrame) -> DataFrame:
    rings = F.filter("rings", lambda r: F.size(r) >= 3)
    edges = F.flatten(F.transform(rings, _closed_edges))
    return watersheds.where(F.col("rings").isNotNull()).select("pfaf_id", edges.alias("edges"))


def polygon_edges(watersheds: DataFrame) -> DataFrame:
    """One row per polygon edge, all rings alike: holes and parts follow from even-odd parity."""
    return _with_edges(watersheds).select("pfaf_id", F.inline("edges"))


def row_spans(watersheds: DataFrame, grid: Grid) -> DataFrame:
    """Polygons as scanline spans (pfaf_id, row, c0, c1) of a grid.

    A cell belongs to a polygon when its centre does, with half-open edges: [bottom, top) and [left, right). Each edge
    is listed under the rows it crosses, the crossings of a row are sorted and paired.
    """
    edges = polygon_edges(watersheds).where(F.col("y1") != F.col("y2"))
    # Same direction for an edge shared by two polygons, so both get the same crossing to the last bit.
    up = F.col("y1") < F.col("y2")
    edges = edges.select(
        "pfaf_id",
        *[F.when(up, F.col(a)).otherwise(F.col(b)).alias(n)
          for n, a, b in (("xa", "x1", "x2"), ("ya", "y1", "y2"), ("xb", "x2", "x1"), ("yb", "y2", "y1"))],
    )
    top = F.floor((F.lit(grid.y0) - F.col("yb")) / F.lit(grid.py)).cast("int") - F.lit(1)
    bottom = F.ceil((F.lit(grid.y0) - F.col("ya")) / F.lit(grid.py)).cast("int") + F.lit(1)
    edges = edges.withColumns(
        {"_r0": F.greatest(top, F.lit(0)), "_r1": F.least(bottom, F.lit(grid.nrows - 1))}
    ).where(F.col("_r0") <= F.col("_r1"))
    crossings = (
        edges.withColumn("row", F.explode(F.sequence("_r0", "_r1")))
        .withColumn("_y", center_y(F.col("row"), grid))
        .where((F.col("ya") <= F.col("_y")) & (F.col("_y") < F.col("yb")))
        .select(
            "pfaf_id",
            "row",
            (F.col("xa") + (F.col("_y") - F.col("ya")) * (F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya")))
            .alias("_x"),
        )
    )
    order = Window.partitionBy("pfaf_id", "row").orderBy("_x")
    paired = crossings.select(
        "pfaf_id",
        "row",
        F.col("_x").alias("_from"),
        F.lead("_x").over(order).alias("_to"),
        F.row_number().over(order).alias("_n"),
    ).where((F.col("_n") % 2 == 1) & F.col("_to").isNotNull())
    return paired.select(
        "pfaf_id",
        "row",
        F.greatest(_first_col(F.col("_from"), grid), F.lit(0)).alias("c0"),
        F.least(_first_col(F.col("_to"), grid) - F.lit(1), F.lit(grid.ncols - 1)).alias("c1"),
    ).where(F.col("c0") <= F.col("c1"))


def split_spans(spans: DataFrame, width: int, name: str = "bucket") -> DataFrame:
    """Spans cut at multiples of ``width`` columns, with the number of their piece of the row as ``name``."""
    low, high = (F.floor(F.col(c) / F.lit(width)).cast("int") for c in ("c0", "c1"))
    cut = spans.withColumn(name, F.explode(F.sequence(low, high)))
    first = F.col(name) * F.lit(width)
    return cut.withColumns({"c0": F.greatest("c0", first), "c1": F.least("c1", first + F.lit(width - 1))})


def watershed_spans(watersheds: DataFrame, grid: Grid) -> DataFrame:
    """Scanline spans in buckets of columns (pfaf_id, row, bucket, c0, c1); computed once per grid."""
    return split_spans(row_spans(watersheds, grid), BUCKET).select("pfaf_id", "row", "bucket", "c0", "c1")


def _first_col(x: Column, grid: Grid) -> Column:
    """First column whose centre is at or right of x; the guess is checked against the centres themselves."""
    guess = F.ceil((x - F.lit(grid.x0)) / F.lit(grid.px) - F.lit(0.5)).cast("int")
    one = F.lit(1)
    return (
        F.when(center_x(guess - one, grid) >= x, guess - one)
        .when(center_x(guess, grid) >= x, guess)
        .otherwise(guess + one)
    )


def zonal_join(pixels: DataFrame, spans: DataFrame, factor: int = 1) -> DataFrame:
    """Every pixel with every watershed that holds its centre, as an equality join on (row, bucket).

    Spans grow with the polygons and the grid, not with the runs. They are broadcast when counted to be few; otherwise
    both sides are shuffled and adaptive execution splits skewed keys.

    With ``factor`` the spans are those of a grid that many times finer, as if the pixels had been upsampled to it.
    A pixel then meets each fine row of a watershed once, with the number of its fine cells in the span as ``cells``.
    """
    if BUCKET % factor:
        raise ValueError(f"factor must divide {BUCKET}")
    f, one = F.lit(factor), F.lit(1)
    left, right = F.col("col") * f, F.col("col") * f + F.lit(factor - 1)
    p = pixels.withColumn("bucket", F.floor(F.col("col") / F.lit(BUCKET // factor)).cast("int"))
    s = small_side(spans, SPAN_ROWS).withColumn("row", F.floor(F.col("row") / f).cast("int"))
    met = p.join(s, ["row", "bucket"]).where((right >= F.col("c0")) & (left <= F.col("c1")))
    cells = F.least("c1", right) - F.greatest("c0", left) + one
    return met.withColumn("cells", cells).drop("bucket", "c0", "c1")


def _low(e: Column, axis: str) -> Column:
    return F.least(e[f"{axis}1"], e[f"{axis}2"])


def _high(e: Column, axis: str) -> Column:
    return F.greatest(e[f"{axis}1"], e[f"{axis}2"])


def _crossings(edges: str, x: Column, y: Column) -> Column:
    """How many edges a ray to the right of a point crosses."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] <= y) != (e["y2"] <= y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        return F.when(straddles & (x < at), F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(edges, F.lit(0), lambda acc, e: acc + crosses(e))


def _touching(cover: DataFrame, size: float) -> DataFrame:
    """Cells of ``size`` (_cx, _cy, edges) that edges may reach, with their number as ``_near``, or else that lie inside.

    Without an edge that reaches a cell all its points are on the same side, so one of them tells."""
    s, slack = F.lit(size), F.lit(size * 1e-9)
    x0, y0 = F.col("_cx") * s, F.col("_cy") * s

    def near(e: Column) -> Column:
        return ((_high(e, "x") >= x0 - slack) & (_low(e, "x") <= x0 + s + slack)
                & (_high(e, "y") >= y0 - slack) & (_low(e, "y") <= y0 + s + slack))

    judged = cover.withColumn("_near", F.size(F.filter("edges", near)))
    return judged.where((F.col("_near") > 0) | (_crossings("edges", x0 + s / 2, y0 + s / 2) % 2 == 1))


def polygon_cover(watersheds: DataFrame, cell: float = 1.0, most_edges: int = MOST_EDGES, max_level: int = MAX_LEVEL) -> list[tuple[int, DataFrame]]:
    """(level, stored cells (pfaf_id, _cx, _cy, edges)): each polygon as squares of ``cell / 2 ** level`` degrees.

    A cell that edges may reach has the edges that matter in it, those of its latitude band that are not left of it. It is cut
    into four while more than ``most_edges`` reach it; what lies to the right in its band shrinks with the band. A cell inside
    has none, cells outside are left out.
    """
    def cells(axis: str) -> Column:
        lo = F.array_min(F.transform("edges", lambda e: _low(e, axis)))
        hi = F.array_max(F.transform("edges", lambda e: _high(e, axis)))
        return F.explode(F.sequence(*[F.floor(c / F.lit(cell)).cast("int") for c in (lo, hi)]))

    def in_band(size: float):
        return lambda e: (_high(e, "y") >= F.col("_cy") * F.lit(size)) & (_low(e, "y") <= (F.col("_cy") + 1) * F.lit(size))

    def not_left(size: float):
        return lambda e: _high(e, "x") >= F.col("_cx") * F.lit(size)

    cover = _with_edges(watersheds).where(F.size("edges") > 0).withColumn("_cy", cells("y")).withColumn("edges", F.filter("edges", in_band(cell)))
    cover = cover.where(F.size("edges") > 0).withColumn("_cx", cells("x")).withColumn("edges", F.filter("edges", not_left(cell)))
    out = []
    for level in range(max_level + 1):
        cover = stored(_touching(cover, cell / 2**level), "cover")
        split = (F.col("_near") > most_edges) & F.lit(level < max_level)
        edges = F.when(F.col("_near") > 0, F.col("edges")).otherwise(F.slice("edges", 1, 0))
        out.append((level, cover.where(~split).select("pfaf_id", "_cx", "_cy", edges.alias("edges"))))
        cover = cover.where(split).drop("_near")
        if cover.isEmpty():
            break
        size = cell / 2 ** (level + 1)
        for axis, keep in (("_cy", in_band(size)), ("_cx", not_left(size))):
            halves = F.explode(F.array(F.col(axis) * 2, F.col(axis) * 2 + 1))
            cover = cover.withColumn(axis, halves).withColumn("edges", F.filter("edges", keep)).where(F.size("edges") > 0)
    return out


def points_in_watersheds(points: DataFrame, watersheds: DataFrame, cell: float = 1.0, most_edges: int = MOST_EDGES) -> DataFrame:
    """Inner join of points (lon, lat) with the polygons that hold them strictly inside.

    Polygons are squares of ``polygon_cover``. A point meets the candidates of its square, of each size there is, and counts the
    crossings to its right with the few edges of that square; in squares inside a polygon there is nothing to count.
    """
    x, y = F.col("lon"), F.col("lat")
    cover = polygon_cover(watersheds, cell, most_edges)

    def touches(e: Column) -> Column:
        on_line = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        return on_line & x.between(_low(e, "x"), _high(e, "x")) & y.between(_low(e, "y"), _high(e, "y"))

    def cell_at(c: Column, level: int) -> Column:
        return F.floor(c / F.lit(cell / 2**level)).cast("int")

    side = reduce(DataFrame.unionByName, [df.withColumn("_level", F.lit(level)) for level, df in cover])
    at = F.array(*[F.struct(F.lit(level).alias("_level"), cell_at(x, level).alias("_cx"), cell_at(y, level).alias("_cy")) for level, _ in cover])
    located = points.select("*", F.inline(at))
    return (
        located.join(small_side(side, COVER_EDGES, F.size("edges") + 1), ["_level", "_cx", "_cy"])
        .where((F.size("edges") == 0) | ((_crossings("edges", x, y) % 2 == 1) & ~F.exists("edges", touches)))
        .drop("_level", "_cx", "_cy", "edges")
    )


def upsample_nearest(pixels: DataFrame, factor: int = 2) -> DataFrame:
    """Every cell as factor x factor cells of the finer grid; a projection with a fixed fan-out."""
    offsets = F.array(
        *[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(factor) for c in range(factor)]
    )
    f = F.lit(factor)
    return (
        pixels.withColumn("_o", F.explode(offsets))
        .withColumns({"row": F.col("row") * f + F.col("_o.r"), "col": F.col("col") * f + F.col("_o.c")})
        .drop("_o")
    )


def clip_rain(rain: DataFrame) -> DataFrame:
    """Rain readings inside their file's box with a positive amount."""
    return rain.where(
        F.col("lon").between(F.col("xlc"), F.col("xrc"))
        & F.col("lat").between(F.col("ybc"), F.col("ytc"))
        & (F.col("z") > 0)
    )


def rasterize_points(
    points: DataFrame, grid: Grid, value: str = "z", order: str = "ordinal", keys: tuple[str, ...] = ()
) -> DataFrame:
    """Points burnt into grid cells; the highest ``order`` wins a shared cell. Points off the grid are dropped."""
    row, col = cell_of(F.col("lon"), F.col("lat"), grid)
    on_grid = F.col("row").between(0, grid.nrows - 1) & F.col("col").between(0, grid.ncols - 1)
    return (
        points.withColumns({"row": row, "col": col})
        .where(on_grid)
        .groupBy(*keys, "row", "col")
        .agg(F.max_by(value, order).alias("value"))
    )


def mosaic(
    pixels: DataFrame, order: str = "ordinal", keys: tuple[str, ...] = ("run_ts",), nodata: float | None = None
) -> DataFrame:
    """Overlapping rasters as one: in every cell the last source that has data there."""
    if nodata is not None:
        pixels = pixels.where(F.col("value") != F.lit(nodata))
    return pixels.groupBy(*keys, "row", "col").agg(F.max_by("value", order).alias("value"))
