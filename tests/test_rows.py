"""Raw grids as a data source, and zonal statistics from running sums along grid rows."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators import rowsums as R
from freshet.operators import zonal as Z
from freshet.operators.spatial import row_spans, watershed_spans
from freshet.schemas import WATERSHEDS, Grid
from freshet.sources import grids
from freshet.sources.readers import read_float_grid

GRID = Grid("g", 0.0, 40.0, 1.0, 1.0, 40, 300, -9.0)


def rectangles(spark, n, seed):
    """Overlapping polygons, some one cell wide, some as wide as the grid."""
    rng, out = random.Random(seed), []
    for i in range(n):
        x, y = rng.uniform(0, 250), rng.uniform(0, 30)
        w, h = rng.choice([0.9, 7, 64, 300]), rng.uniform(0.5, 12)
        ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        out.append((i, 100.0, [[{"x": a, "y": b} for a, b in ring]]))
    return spark.createDataFrame(out, WATERSHEDS)


def pixels(spark, seed, share, extra=()):
    rng = random.Random(seed)
    rows = [(dt.datetime(2024, 1, 1, h), r, c, float(rng.choice([-9, -3, 0, 1, 5, 250, float("nan")])))
            for h in (0, 3) for r in range(40) for c in range(300) if rng.random() < share]
    return spark.createDataFrame([*rows, *extra], "run_ts timestamp, row int, col int, value double").repartition(4)


def plain(df):
    return sorted((r.run_ts, r.pfaf_id, f"{r.area:.10g}", f"{r['mean']:.10g}", r["max"]) for r in df.collect())


@pytest.mark.parametrize("share", [1.0, 0.3, 0.01])
def test_rows_give_what_cells_give(spark, share):
    sheds = rectangles(spark, 40, 1)
    # A cell that is there twice counts twice, rows of NULL not at all.
    extra = [(dt.datetime(2024, 1, 1), 20, 20, 7.0)] * 2 + [(None, None, None, None), (dt.datetime(2024, 1, 1), 20, 21, None)]
    px = pixels(spark, 2, share, extra)
    want = Z.zonal_stats(px, watershed_spans(sheds, GRID), GRID)
    assert plain(R.row_stats(R.row_sums(R.pixel_rows(px), GRID.nodata), row_spans(sheds, GRID), GRID)) == plain(want)


@pytest.mark.parametrize("factor", [2, 4])
def test_rows_of_a_finer_grid(spark, factor):
    fine = Grid("f", 0.0, 40.0, 1.0 / factor, 1.0 / factor, 40 * factor, 300 * factor, -9.0)
    sheds, px = rectangles(spark, 30, 3), pixels(spark, 4, 0.6)
    want = Z.zonal_stats(px, watershed_spans(sheds, fine), fine, factor=factor)
    got = R.row_stats(R.row_sums(R.pixel_rows(px), -9.0), row_spans(sheds, fine), fine, factor=factor)
    assert plain(got) == plain(want)
    # Spans in buckets are spans, too.
    assert plain(R.row_stats(R.row_sums(R.pixel_rows(px), -9.0), watershed_spans(sheds, fine), fine, factor=factor)) == plain(want)


def test_rows_wider_than_a_block(spark):
    wide = Grid("w", 0.0, 2.0, 1.0, 1.0, 2, 10_000, -9.0)
    ring = [[{"x": a, "y": b} for a, b in ((3.0, 0.0), (9_700.0, 0.0), (9_700.0, 2.0), (3.0, 2.0))]]
    sheds = spark.createDataFrame([(1, 1.0, ring)], WATERSHEDS)
    px = spark.range(20_000).selectExpr("timestamp'2024-01-01' AS run_ts", "int(id div 10000) AS row", "int(id % 10000) AS col", "double(id % 7777) AS value")
    want = Z.zonal_stats(px, watershed_spans(sheds, wide), wide)
    assert plain(R.row_stats(R.row_sums(R.pixel_rows(px), -9.0), row_spans(sheds, wide), wide)) == plain(want)
    rows = px.groupBy("run_ts", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))), lambda s: s["value"]).alias("values"))
    assert plain(R.row_stats(R.row_sums(R.dense_rows(rows), -9.0), row_spans(sheds, wide), wide)) == plain(want)


def test_lookups_do_not_grow_with_the_span(spark):
    """One row a span goes into the sums, whatever its width; cells are met by no join."""
    sheds = rectangles(spark, 20, 5)
    sums = R.row_sums(R.pixel_rows(pixels(spark, 6, 1.0)), -9.0)
    spans = row_spans(sheds, GRID)
    assert sums.join(spans, "row").count() == 2 * spans.count()
    plan = R.row_stats(sums, spans, GRID)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_rows(spark):
    none = R.row_sums(R.pixel_rows(pixels(spark, 1, 0.0)), -9.0)
    assert R.row_stats(none, row_spans(rectangles(spark, 3, 1), GRID), GRID).count() == 0
    empty = spark.createDataFrame([(dt.datetime(2024, 1, 1), 0, []), (dt.datetime(2024, 1, 1), 1, None)], "run_ts timestamp, row int, values array<float>")
    assert R.row_stats(R.row_sums(R.dense_rows(empty), -9.0), row_spans(rectangles(spark, 3, 1), GRID), GRID).count() == 0


# --- raw grids ------------------------------------------------------------------------------------------------------


def write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    data.astype("<f4").tofile(f"{folder}/{name}")


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    grid, folder = Grid("g", 0.0, 0.0, 1.0, 1.0, 200, 11), f"{tmp_path}/g"
    data = np.arange(2200).reshape(200, 11)
    write(folder, "depth_2024010106.bin", data)
    rows = grids.read_grid_rows(spark, folder, grid, band=16)
    assert rows.rdd.getNumPartitions() == 13
    assert {r["row"]: r["values"] for r in rows.collect()} == {i: data[i].tolist() for i in range(200)}


@pytest.mark.parametrize("condition,first,last,tasks", [
    ("row >= 50 AND row < 70", 50, 69, 2), ("row = 33", 33, 33, 1), ("row > 190", 191, 199, 1), ("row <= 3", 0, 3, 1), ("row > 300", 0, -1, 1)])
def test_row_conditions_reach_the_source(spark, tmp_path, condition, first, last, tasks):
    grid, folder = Grid("g", 0.0, 0.0, 1.0, 1.0, 200, 3), f"{tmp_path}/g"
    write(folder, "depth_2024010106.bin", np.zeros((200, 3)))
    rows = grids.read_grid_rows(spark, folder, grid, band=16).where(condition)
    assert sorted(r["row"] for r in rows.select("row").collect()) == list(range(first, last + 1))
    assert rows.rdd.getNumPartitions() == tasks


def test_conditions_on_cells_reach_the_source(spark, tmp_path):
    grid, folder = Grid("g", 0.0, 0.0, 1.0, 1.0, 64, 3), f"{tmp_path}/g"
    write(folder, "depth_2024010106.bin", np.full((64, 3), 2.0))
    cells = read_float_grid(spark, f"{folder}/depth_*.bin", grid, 0).where("row = 5 AND value > 1")
    assert cells.count() == 3 and cells.rdd.getNumPartitions() == 1


def test_files_cut_off_other_names_and_nothing_there(spark, tmp_path):
    grid, folder = Grid("g", 0.0, 0.0, 1.0, 1.0, 20, 3), f"{tmp_path}/g"
    write(folder, "depth_2024010106.bin", np.ones((20, 3)))
    write(folder, "depth_2024010109.bin", np.ones((19, 3)))
    write(folder, "depth.bin", np.ones((20, 3)))
    write(folder, "_depth_2024010112.bin", np.ones((20, 3)))
    rows = grids.read_grid_rows(spark, folder, grid)
    assert {r.run_ts for r in rows.select("run_ts").distinct().collect()} == {dt.datetime(2024, 1, 1, 6), None}
    assert grids.read_grid_rows(spark, f"{folder}/other*.bin", grid).count() == 0
    assert grids.read_grid_rows(spark, f"{folder}/depth_2024010106.bin", grid).count() == 20
    with pytest.raises(Exception, match="missing"):
        grids.read_grid_rows(spark, f"{tmp_path}/missing", grid).count()


def test_run_times_are_those_of_the_column_expression(spark):
    from freshet.functions.dates import run_ts_from_path

    paths = ["/a/f_2024010106.bin", "/a/f_20240101.bin", "/a/2024010103.x", "/a/f.bin", "/a/f_20241301.bin", "/a_2024010106/f.bin", "/a/f_20240101061.bin",
             "/a/f_2024010106/part-0001"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    want = [r.t for r in df.select(run_ts_from_path(F.col("p")).alias("t")).collect()]
    assert [t and t.replace(tzinfo=None) for t in map(grids.run_time, paths)] == want
