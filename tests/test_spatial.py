"""Spans, pixel and point joins against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import spatial as G
from freshet.operators import zonal as Z
from freshet.schemas import WATERSHEDS, Grid

GRID = Grid("t", 0.0, 20.0, 0.5, 0.25, 80, 700)


def random_polygons(seed, n):
    """Star-shaped polygons, some with a hole or a second part; some reach over the grid's border."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        cx, cy = rnd.uniform(-5, 300), rnd.uniform(-3, 23)
        rings = [star(rnd, cx, cy, rnd.uniform(2, 60), 9)]
        if i % 3 == 0:
            rings.append(star(rnd, cx, cy, 0.9, 5))
        if i % 4 == 0:
            rings.append(star(rnd, cx + 100, cy, 5, 6))
        out.append((i, 100.0, [[(x, y) for x, y in r] for r in rings]))
    return out


def star(rnd, cx, cy, r, k):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(k))
    return [(cx + rnd.uniform(0.4, 1) * r * math.cos(a), cy + 0.2 * rnd.uniform(0.4, 1) * r * math.sin(a)) for a in angles]


def edges(rings):
    for r in rings:
        for a, b in zip(r, r[1:] + r[:1], strict=True):
            if a != b:
                yield a, b


def inside(rings, x, y):
    odd = False
    for (x1, y1), (x2, y2) in edges(rings):
        if y1 > y2:
            (x1, y1), (x2, y2) = (x2, y2), (x1, y1)
        if y1 <= y < y2 and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def frame(spark, polygons):
    return spark.createDataFrame(polygons, WATERSHEDS)


def cells_of(spans):
    return {(r.pfaf_id, r.row, c) for r in spans.collect() for c in range(r.c0, r.c1 + 1)}


def brute_cells(polygons, grid):
    out = set()
    for pfaf, _, rings in polygons:
        for r in range(grid.nrows):
            y = grid.y0 - (r + 0.5) * grid.py
            for c in range(grid.ncols):
                if inside(rings, grid.x0 + (c + 0.5) * grid.px, y):
                    out.add((pfaf, r, c))
    return out


def test_spans_equal_ray_casting(spark):
    polygons = random_polygons(7, 8)
    spans = G.watershed_spans(frame(spark, polygons), GRID)
    got = cells_of(spans)
    assert got == brute_cells(polygons, GRID) and len(got) > 1000
    assert all(r.c0 // G.BUCKET == r.c1 // G.BUCKET == r.bucket for r in spans.collect())


def test_span_edges_are_half_open(spark):
    """Centres on the left and bottom edge belong to the square, those on the right and top edge do not."""
    grid = Grid("u", 0.0, 10.0, 1.0, 1.0, 10, 10)
    square = [(1, 1.0, [[(2.5, 2.5), (5.5, 2.5), (5.5, 5.5), (2.5, 5.5), (2.5, 2.5)]])]
    got = cells_of(G.watershed_spans(frame(spark, square), grid))
    assert got == {(1, r, c) for r in (5, 6, 7) for c in (2, 3, 4)}


def test_null_and_degenerate_geometry(spark):
    rows = [(1, 1.0, None), (2, 1.0, []), (3, 1.0, [[(1.0, 1.0), (2.0, 2.0)]])]
    sheds = frame(spark, rows)
    assert G.watershed_spans(sheds, GRID).count() == 0
    points = spark.createDataFrame([(1.5, 1.5)], "lon double, lat double")
    assert G.points_in_watersheds(points, sheds).count() == 0


@pytest.mark.parametrize("cell", [1.0, 7.0])
def test_points_equal_ray_casting(spark, cell):
    polygons = random_polygons(11, 10)
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-10, 400), rnd.uniform(-5, 25)) for i in range(3000)]
    points = spark.createDataFrame(pts, "n long, lon double, lat double")
    got = {(r.n, r.pfaf_id) for r in G.points_in_watersheds(points, frame(spark, polygons), cell).collect()}
    want = {(n, p) for n, x, y in pts for p, _, rings in polygons if inside(rings, x, y)}
    assert got == want and len({p for _, p in got}) == 10


def test_points_on_the_border_are_outside(spark):
    square = frame(spark, [(1, 1.0, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]),
                           (2, 1.0, [[(0.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])])
    pts = [(0.0, 2.0), (4.0, 2.0), (2.0, 0.0), (2.0, 4.0), (0.0, 0.0), (2.0, 2.0), (1.0, 2.0)]
    points = spark.createDataFrame(pts, "lon double, lat double")
    got = sorted((r.lon, r.lat, r.pfaf_id) for r in G.points_in_watersheds(points, square).collect())
    assert got == [(1.0, 2.0, 1), (1.0, 2.0, 2), (2.0, 2.0, 1)]


def pixel_rows(grid, runs=2, every=3):
    rnd = random.Random(5)
    return [(k, r, c, rnd.choice([-9999.0, 0.0, 1.5, 7.0]))
            for k in range(runs) for r in range(grid.nrows) for c in range(0, grid.ncols, every)]


def test_zonal_stats_both_join_paths(spark, monkeypatch):
    polygons = random_polygons(13, 5)
    rows = pixel_rows(GRID)
    sheds = frame(spark, [*polygons, (99, 5.0, [[(900.0, 1.0), (901.0, 1.0), (901.0, 2.0)]])])
    pixels = spark.createDataFrame(rows, "k int, row int, col int, value double").withColumn(
        "run_ts", F.timestamp_seconds(F.col("k") * 10800)
    )
    want = {}
    for k, r, c, v in rows:
        x, y = GRID.x0 + (c + 0.5) * GRID.px, GRID.y0 - (r + 0.5) * GRID.py
        for p, _, rings in polygons:
            if v != -9999.0 and inside(rings, x, y):
                area = 111.111 * 111.111 * math.cos(math.radians(y)) * GRID.px * GRID.py
                want.setdefault((k, p), []).append((area, v))

    def check():
        got = Z.gfms_summary(pixels, sheds, GRID).withColumn("k", F.unix_seconds("run_ts") / 10800).collect()
        assert len(got) == 2 * 6
        for r in got:
            cells = want.get((int(r.k), r.pfaf_id), [])
            assert r.gfms_totalarea_km == pytest.approx(sum(a for a, _ in cells))
            assert r.gfms_meandepth == pytest.approx(sum(v for _, v in cells) / len(cells) if cells else 0.0)
            assert r.gfms_maxdepth == (max(v for _, v in cells) if cells else 0.0)
            assert r.gfms_duration == (3 if r.gfms_totalarea_km > 100 else 0)

    check()
    monkeypatch.setattr(G, "small_side", lambda df, *a, **k: df.hint("merge"))
    check()


def test_weighted_cells_equal_upsampling(spark):
    polygons = random_polygons(17, 6)
    coarse = Grid("c", 0.0, 20.0, 1.0, 0.5, 40, 350)
    pixels = spark.createDataFrame(pixel_rows(coarse, 1, 1), "k int, row int, col int, value double").withColumn(
        "run_ts", F.timestamp_seconds(F.col("k"))
    )
    sheds = frame(spark, polygons)
    spans = G.watershed_spans(sheds, GRID)
    fine = Z.zonal_stats(G.upsample_nearest(pixels, 2), spans, GRID)
    weighted = Z.zonal_stats(pixels, spans, GRID, factor=2)
    a = {r.pfaf_id: (r.area, r.mean, r.max) for r in fine.collect()}
    b = {r.pfaf_id: (r.area, r.mean, r.max) for r in weighted.collect()}
    assert a.keys() == b.keys() and len(a) == 6
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_classes_are_strict(spark):
    sheds = frame(spark, [(1, 2.0, [[(0.0, 0.0), (50.0, 0.0), (50.0, 20.0), (0.0, 20.0)]])])
    rows = [(0, c, v) for c, v in enumerate([140.0, 141.0, 200.0, 201.0])]
    px = spark.createDataFrame(rows, "row int, col int, value double").withColumns(
        {"run_date": F.lit("2024-01-01").cast("date"), "product": F.lit("1day")}
    )
    r = Z.viirs_summary(px, sheds, GRID).first()
    assert r.oneday_flood_area_km == 2 * 0.140625 and r.fiveday_flood_area_km == 0.0
    assert r.oneday_perc_area == pytest.approx(2 * 0.140625 / 2.0 * 100)


def test_mosaic_and_rasterize(spark):
    grid = Grid("r", 0.0, 2.0, 1.0, 1.0, 2, 2)
    pts = [(0.5, 1.5, 1.0, 1), (0.9, 1.1, 2.0, 2), (1.5, 0.5, 3.0, 1), (5.0, 0.5, 9.0, 1)]
    cells = G.rasterize_points(spark.createDataFrame(pts, "lon double, lat double, z double, ordinal int"), grid)
    assert sorted(tuple(r) for r in cells.collect()) == [(0, 0, 2.0), (1, 1, 3.0)]
    px = [(0, 0, 0, 1.0, "a"), (0, 0, 0, 2.0, "b"), (0, 0, 1, 3.0, "a"), (0, 0, 1, -9.0, "b")]
    m = G.mosaic(spark.createDataFrame(px, "run_ts int, row int, col int, value double, ordinal string"), nodata=-9.0)
    assert sorted(tuple(r) for r in m.collect()) == [(0, 0, 0, 2.0), (0, 0, 1, 3.0)]


def test_complete_dates(spark):
    rows = [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-02", 1), ("2024-01-03", 1), ("2024-01-03", 2)]
    tiles = spark.createDataFrame(rows, "d string, tile int").select(F.col("d").cast("date").alias("run_date"), "tile")
    got = Z.complete_dates(tiles, 2, F.lit("2024-01-02").cast("date")).collect()
    assert sorted((str(r.run_date), r.tiles) for r in got) == [("2024-01-01", 1), ("2024-01-03", 2)]


# --- adaptive cover ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("cell,most", [(16.0, 1), (8.0, 3)])
def test_cells_that_are_cut_give_what_brute_force_gives(spark, cell, most):
    polygons = random_polygons(11, 8)
    rnd = random.Random(12)
    at = [(i, rnd.uniform(-10, 310), rnd.uniform(-5, 25)) for i in range(1500)]
    # Points on corners and sides of cells, and on the polygons' own corners.
    at += [(2000 + i, float(rnd.randrange(0, 300)), float(rnd.randrange(0, 20))) for i in range(300)]
    at += [(3000 + i, x, y) for i, (x, y) in enumerate(p for _, _, rings in polygons for r in rings for p in r)]
    points = spark.createDataFrame(at, "n long, lon double, lat double")
    got = {(r.n, r.pfaf_id) for r in G.points_in_watersheds(points, frame(spark, polygons), cell, most).collect() if r.n < 3000}
    assert got == {(n, p) for n, x, y in at if n < 3000 for p, _, rings in polygons if inside(rings, x, y)}


def test_a_polygon_with_very_many_edges(spark):
    """Cells keep a small part of the edges, most of the area needs none, and points inside pass without a crossing test."""
    n = 40_000
    ring = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        (F.lit(5.0) + F.lit(4.0) * F.cos(i * (2 * math.pi / n))).alias("x"), (F.lit(5.0) + F.lit(4.0) * F.sin(i * (2 * math.pi / n))).alias("y")))
    round_ = spark.range(1).select(F.lit(1).cast("long").alias("pfaf_id"), F.lit(1.0).alias("area_km2"), F.array(ring).alias("rings"))
    cover = G.polygon_cover(round_, 1.0)
    assert len(cover) > 3 and max(df.agg(F.max(F.size("edges"))).first()[0] or 0 for _, df in cover) < n / 10
    area = sum(df.where(F.size("edges") == 0).count() / 4**level for level, df in cover)
    assert math.pi * 16 * 0.97 < area < math.pi * 16
    rnd = random.Random(3)
    at = [(rnd.uniform(0, 10), rnd.uniform(0, 10)) for _ in range(2000)]
    points = spark.createDataFrame(at, "lon double, lat double")
    assert G.points_in_watersheds(points, round_).count() == sum((x - 5) ** 2 + (y - 5) ** 2 < 16 for x, y in at)


def test_cover_of_no_polygons(spark):
    points = spark.createDataFrame([(1.0, 1.0), (None, 1.0)], "lon double, lat double")
    assert G.points_in_watersheds(points, frame(spark, [])).count() == 0
    assert G.points_in_watersheds(points, frame(spark, [(1, 1.0, None), (2, 1.0, [])])).count() == 0
