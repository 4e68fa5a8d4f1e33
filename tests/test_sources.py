"""Readers and writers on files made here."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators.spatial import clip_rain
from freshet.schemas import Grid
from freshet.sources import readers as R
from freshet.sources import sinks as K


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def test_summaries_take_their_time_from_the_name(spark, tmp_path):
    put(f"{tmp_path}/g/Flood_2024010203.csv", "pfaf_id,A,B,C,D,E\n11,1.5,2,3,4,6\n\n12,,0,0,0,0\n")
    put(f"{tmp_path}/g/Flood_2024010206.csv", "pfaf_id,A,B,C,D,E\n11,NaN,2,3,4,6\n")
    rows = sorted((tuple(r) for r in R.read_summary(spark, f"{tmp_path}/g", "gfms").collect()), key=lambda r: r[0])
    assert [r[0] for r in rows] == [11, 11, 12]
    assert {(r[0], r[1], r[-1].hour) for r in rows} == {(11, 1.5, 3), (11, None, 6), (12, None, 3)}
    put(f"{tmp_path}/d/DFO_20240103.csv", ",pfaf_id,a,b,c,d,e,f,g,h\n0,7,1,2,3,4,5,6,7,8\n")
    r = R.read_summary(spark, f"{tmp_path}/d", "dfo").first()
    assert (r.pfaf_id, r.d1_area, r.d1cs_area, r.d3_perc, r.run_date) == (7, 1.0, 3.0, 8.0, dt.date(2024, 1, 3))
    assert "row_index" not in r.asDict()


def test_parameters_with_byte_order_mark(spark, tmp_path):
    path = put(f"{tmp_path}/w.csv", "﻿Area_wt,One_Day\n100,1.5\n")
    assert R.read_parameters(spark, path) == {"area_wt": 100.0, "one_day": 1.5}


LINE19 = "1,a,bas,loc,sta,co,con,cc,5.5,u,10.5,20.5,,x,3,1,2,3,2"
LINE18 = "1,a,sta,bas,loc,co,con,cc,5.5,10.5,20.5,,x,3,1,2,3,2"


def test_stations_skip_long_and_pad_short_lines(spark, tmp_path):
    short = ",".join(LINE19.replace("1,a", "3,a", 1).split(",")[:17])
    path = put(f"{tmp_path}/p_2024010100.txt", "\n".join([LINE19, "2" + LINE19[1:] + ",extra", "4" + LINE19[1:] + ",", short]) + "\n")
    rows = {r.point_no: r for r in R.read_stations(spark, path, "fixed").collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].station, rows[1].upstream_area, rows[1].lon, rows[1].alert_level) == ("sta", 5.5, 10.5, 2)
    assert rows[3].glofas_5yr == 2.0 and rows[3].glofas_20yr is None and rows[3].alert_level is None
    assert rows[1].run_ts == dt.datetime(2024, 1, 1)
    dyn = R.read_stations(spark, put(f"{tmp_path}/d_2024010100.txt", LINE18 + "\n"), "dynamic").first()
    assert (dyn.station, dyn.basin, dyn.location, dyn.upstream_area, dyn.lat) == ("sta", "bas", "loc", 5.5, 20.5)


def test_stations_have_the_layout_of_their_own_file(spark, tmp_path):
    put(f"{tmp_path}/p_2024010100.txt", LINE19 + "\n")
    put(f"{tmp_path}/p_2024010200.txt", LINE18.replace("a,sta", '"a, b",sta') + "\n" + LINE18 + ",more\n")
    rows = {r.run_ts.day: r for r in R.read_stations(spark, str(tmp_path), "dynamic").collect()}
    assert {d: (r.width, r.lon, r.lat, r.alert_level) for d, r in rows.items()} == {1: (19, 10.5, 20.5, 2), 2: (18, 10.5, 20.5, 2)}
    assert rows[2].id == "a, b"
    put(f"{tmp_path}/p_2024010300.txt", "1,2,3\n")
    with pytest.raises(Exception, match="not a station file"):
        R.read_stations(spark, str(tmp_path), "dynamic").collect()


def test_float_grid(spark, tmp_path):
    grid = Grid("f", 0.0, 0.0, 1.0, 1.0, 130, 7)
    data = np.arange(130 * 7, dtype="<f4").reshape(130, 7)
    data[3, :] = -9999
    os.makedirs(f"{tmp_path}/g")
    data.tofile(f"{tmp_path}/g/flood_2024010118.bin")
    data[:100].tofile(f"{tmp_path}/g/flood_2024010121.bin")
    df = R.read_float_grid(spark, f"{tmp_path}/g", grid, min_bytes=0)
    rows = df.collect()
    assert len(rows) == 129 * 7 and {r.run_ts for r in rows} == {dt.datetime(2024, 1, 1, 18)}
    assert all(r.value == r.row * 7 + r.col for r in rows)
    assert R.read_float_grid(spark, f"{tmp_path}/g", grid, 0, keep_nodata=True).count() == 130 * 7
    assert R.read_float_grid(spark, f"{tmp_path}/g", grid, min_bytes=10_000).count() == 0


def test_rain_text(spark, tmp_path):
    head = "  -10.0  10.0 -5.0 5.0  0.1  100 200\n"
    put(f"{tmp_path}/r/a_2024010106.ascii", head + "  1.0  2.0  3.5\n 1.0 20.0 3.5\n 2.0 2.0\n 2.0 3.0 nan\n 2.0 4.0 0.0\n")
    put(f"{tmp_path}/r/b_2024010106.ascii", head.replace("10.0", "30.0") + " 1.0 20.0 3.5\n")
    df = R.read_rain_text(spark, f"{tmp_path}/r")
    assert df.count() == 6
    assert sorted(r.z for r in df.collect()) == [-999.0, -999.0, 0.0, 3.5, 3.5, 3.5]
    got = sorted((os.path.basename(r.source)[0], r.lat, r.lon) for r in clip_rain(df).collect())
    assert got == [("a", 1.0, 2.0), ("b", 1.0, 20.0)]


def test_dimensions(spark, tmp_path):
    a = put(f"{tmp_path}/a.csv", "pfaf_id,area_km2,ISO,Admin0,Admin1,rfr_score,cfr_score\n1,5,AA,x,y,1,2\n")
    r = put(f"{tmp_path}/r.csv", "Country_Name,ISO, N ,R,a,b,c,d,e\nLand,AA,0.9,-9999,1,1,1,1,1\n")
    c = put(f"{tmp_path}/c.csv", "pfaf_id,Name,CentroidY,FID\n1,Côte d’Or,51.5,9\n", "windows-1252")
    attrs, res, cent = R.read_dimensions(spark, a, r, c)
    assert attrs.first().iso == "AA" and res.first().normalized_lack_of_resilience == 0.9
    assert cent.first().asDict() == {"pfaf_id": 1, "name": "Côte d’Or", "centroid_y": 51.5, "fid": "9"}


def test_windows_1252_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Côte d’Ivoire €", 1)], "name string, v int")
    K.write_product(df, f"{tmp_path}/o", "csv", "windows-1252")
    assert R.read_csv_windows1252(spark, f"{tmp_path}/o").first().name == "Côte d’Ivoire €"


def test_rejected_only_when_there_are_some(spark, tmp_path):
    df = spark.createDataFrame([(1, "e")], "k int, error string")
    assert not K.write_rejected(df.where("k > 1"), f"{tmp_path}/none") and not os.path.exists(f"{tmp_path}/none")
    assert K.write_rejected(df, f"{tmp_path}/some") and spark.read.csv(f"{tmp_path}/some", header=True).count() == 1


def test_partitions_skip_and_replace(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    K.write_partitions(df, path, ["k"])
    K.write_partitions(df.union(spark.createDataFrame([(3, "c")], df.schema)).withColumn("v", F.upper("v")), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [(1, "a"), (2, "b"), (3, "C")]
    K.reprocess(spark.createDataFrame([(2, "z")], df.schema), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [(1, "a"), (2, "z"), (3, "C")]


def test_pixels_prune_partitions(spark, tmp_path):
    path = f"{tmp_path}/p"
    df = spark.range(100).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("run_date"),
        F.concat(F.lit("l"), (F.col("id") % 2).cast("string")).alias("layer"),
        F.col("id").cast("int").alias("row"),
    )
    K.write_partitions(df, path, ["run_date", "layer"])
    got = R.read_pixels(spark, path, layers=["l1"], start="2024-01-02", end="2024-01-04", time="run_date")
    assert {(str(r.run_date), r.layer) for r in got.collect()} == {("2024-01-02", "l1")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "run_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_geojson(spark, tmp_path):
    df = spark.createDataFrame([(7, 1.5, -2.0, None)], "k int, lon double, lat double, n string")
    K.write_geojson_lines(df, f"{tmp_path}/g")
    assert spark.read.text(f"{tmp_path}/g").first().value == (
        '{"type":"Feature","geometry":{"type":"Point","coordinates":[1.5,-2.0]},"properties":{"k":7}}')


def test_work_folder_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from freshet import session

    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {"master": "spark://far:1"})

    with pytest.raises(ValueError):
        session.work_folder(Far, "x")
    assert session.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_small_side_falls_back_to_a_shuffled_join(spark):
    from freshet.session import small_side

    left, right = spark.range(100), spark.range(50)
    for limit, join in ((50, "BroadcastHashJoin"), (49, "SortMergeJoin")):
        df = left.join(small_side(right, limit), "id")
        assert df.count() == 50 and join in df._jdf.queryExecution().executedPlan().toString()
