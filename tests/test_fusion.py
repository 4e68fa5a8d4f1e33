"""Stations, fusion and the alert stages on hand-made rows."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import fusion as U
from freshet.operators import scores as C
from freshet.operators import stations as S
from freshet.plans import pipelines as P

TS = dt.datetime(2024, 1, 1, 18)
STATION = "run_ts timestamp, point_no long, pfaf_id long, glofas_2yr double, glofas_5yr double, glofas_20yr double, " \
          "alert_level int, days_until_peak int"
GFMS = "run_ts timestamp, pfaf_id long, gfms_totalarea_km double, gfms_perc_area double, gfms_meandepth double, " \
       "gfms_maxdepth double, gfms_duration int"
HWRF = "run_ts timestamp, pfaf_id long, rain_totalarea_km double, perc_area double, meanrain double, maxrain double"
DFO = "run_ts timestamp, pfaf_id long, d1_area double, d1_perc double, d1cs_area double, d1cs_perc double, d2_area double, " \
      "d2_perc double, d3_area double, d3_perc double"
VIIRS = "run_ts timestamp, pfaf_id long, oneday_flood_area_km double, oneday_perc_area double, " \
        "fiveday_flood_area_km double, fiveday_perc_area double"


def exposed(spark, rows):
    attrs = spark.createDataFrame(
        [(p, 100.0, "AA", "a", "b", r, c) for p, r, c in rows],
        "pfaf_id long, area_km2 double, iso string, admin0 string, admin1 string, rfr_score double, cfr_score double",
    )
    res = spark.createDataFrame([("AA", 0.5, 0.4)], "iso string, resilience_index double, normalized_lack_of_resilience double")
    return U.exposure(attrs, res)


def test_validation_first_match_wins(spark):
    rows = [(TS, 1, 1, 120.0, 0.0, 0.0, 4, 1), (TS, 2, 1, 101.0, 101.0, 0.0, 3, 31), (TS, 3, 1, 0.0, 0.0, 101.0, 0, 1),
            (TS, 4, 1, 0.0, 0.0, 0.0, 0, 31), (TS, 5, 1, 100.0, 100.0, 100.0, 3, 30), (TS, 6, 1, 0.0, 101.0, 0.0, -1, 1)]
    ok, bad = S.validate_stations(spark.createDataFrame(rows, STATION))
    assert [r.point_no for r in ok.collect()] == [5]
    got = {r.point_no: r.error.split(" ")[0] for r in bad.collect()}
    assert got == {1: "alert", 2: "2-year", 3: "20-year", 4: "peak", 6: "alert"}


def test_average_takes_the_other_columns_from_the_last_station(spark):
    rows = [(TS, 7, 1, 10.0, 0.0, 0.0, 1, 1), (TS, 9, 1, 30.0, 0.0, 0.0, 2, 10), (TS, 8, 1, 50.0, 0.0, 0.0, 3, 5)]
    r = S.station_scores(spark.createDataFrame(rows, STATION)).first()
    assert (r.point_no, r.glofas_2yr, r.alert_level) == (9, 30.0, 2)
    assert r.glofas_score == pytest.approx(((3 + 10 + 1) + (7 + 1 + 3) + (10 + 6 + 5)) / 3)


def test_rescaling_is_per_run(spark):
    other = TS + dt.timedelta(days=1)
    rows = [(TS, 1, 1, 1.0, 0.5, 0.2, 0, 1), (TS, 2, 1, 0.3, 0.0, 0.0, 0, 1), (other, 3, 1, 1.0, 2.0, 0.2, 0, 1),
            (other, 4, 1, 55.0, 0.0, 0.0, 0, 1)]
    got = {r.point_no: r.glofas_2yr for r in S.normalize_probability(spark.createDataFrame(rows, STATION)).collect()}
    assert got == {1: 100.0, 2: 30.0, 3: 1.0, 4: 55.0}


def test_union_ignores_a_set_of_another_width(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert S.station_union(a, b).count() == 1
    assert S.station_union(a, a.select("y", "x")).collect()[1] == (1, 2)


def test_doubling(spark):
    rows = [(1, 10.0, None), (2, None, 5.0), (3, 4.0, 6.0), (4, None, None), (5, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    x, y, total = U.combine_forecast(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.orderBy("k").select(x, y, total).collect()] == [
        (20.0, 0.0, 20.0), (0.0, 10.0, 10.0), (4.0, 6.0, 10.0), (0.0, 0.0, 0.0), (0.0, 10.0, 10.0)]
    _, _, plain = U.combine_forecast(F.col("a"), F.col("b"), 1.0)
    assert [r[0] for r in df.orderBy("k").select(plain).collect()] == [10.0, 5.0, 10.0, 0.0, 5.0]


def test_drop_unexposed_takes_the_whole_watershed(spark):
    rows = [(1, 0.0, 0.0), (1, 1.0, 1.0), (2, None, 0.0), (3, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "pfaf_id long, rfr_score double, cfr_score double")
    assert sorted(r.pfaf_id for r in U.drop_unexposed(df).collect()) == [1, 2, 3]
    assert sorted(r.pfaf_id for r in U.drop_unexposed(df, unique=False).collect()) == [2, 3]


def test_merge_sources_is_a_full_outer_join(spark):
    rnd = random.Random(1)
    sides = {n: {(r, p): rnd.random() for r in range(3) for p in range(40) if rnd.random() < 0.5} for n in "abc"}
    frames = {
        n: spark.createDataFrame([(*k, v) for k, v in s.items()], f"run_ts int, pfaf_id int, v_{n} double")
        for n, s in sides.items()
    }
    merged = U.merge_sources(frames).selectExpr("run_ts", "pfaf_id", "a.v_a", "b.v_b", "c.v_c", "a IS NULL AS no_a")
    got = {(r.run_ts, r.pfaf_id): (r.v_a, r.v_b, r.v_c, r.no_a) for r in merged.collect()}
    keys = set().union(*sides.values())
    assert got == {k: (*[sides[n].get(k) for n in "abc"], k not in sides["a"]) for k in keys}


def test_the_largest_of_repeated_rows_counts(spark):
    a = spark.createDataFrame([(1, 1, 5.0), (1, 1, 7.0), (1, 1, 7.0), (1, 2, None)], "run_ts int, pfaf_id int, v double")
    b = spark.createDataFrame([(1, 1, 2.0)], "run_ts int, pfaf_id int, w double")
    got = U.merge_sources({"a": a, "b": b}).selectExpr("pfaf_id", "a.v", "b.w", "a IS NULL AS no_a").collect()
    assert sorted((r.pfaf_id, r.v, r.w, r.no_a) for r in got) == [(1, 7.0, 2.0, False), (2, None, None, False)]


def test_merge_dfo_layers_and_viirs(spark):
    rows = [("2024-01-01", 1, n, 1.0, 2.0) for n in ("d1", "d1cs", "d2", "d3")] + [("2024-01-01", 2, "d1", 1.0, 2.0)]
    layers = spark.createDataFrame(rows, "run_date string, pfaf_id long, layer string, area double, perc double")
    assert [r.pfaf_id for r in U.merge_dfo_layers(layers).collect()] == [1]
    rows = [("2024-01-01", 1, "1day", 3.0, 1.0), ("2024-01-01", 2, "5day", 4.0, 1.0), ("2024-01-01", 3, "1day", 0.0, 0.0)]
    products = spark.createDataFrame(rows, "run_date string, pfaf_id long, product string, area double, perc double")
    got = {r.pfaf_id: (r.oneday_flood_area_km, r.fiveday_flood_area_km) for r in U.merge_viirs(products).collect()}
    assert got == {1: (3.0, 0.0), 2: (0.0, 4.0)}


def test_score_dfo_uses_the_cloud_shadow_layer_for_one_day(spark):
    df = spark.createDataFrame([(TS, 1, 5000.0, 50.0, 200.0, 3.0, 0.0, 0.0, 1100.0, 0.0)], DFO)
    r = C.score_dfo(df).first()
    assert (r.dfo_area_1day_score, r.dfo_perc_area_1day_score, r.dfo_area_3day_score) == (2.0, 3.0, 25.0)
    assert r.dfo_total == 30.0
    assert C.score_dfo(df.withColumns({c: F.lit(0.0) for c in df.columns[2:]}), 0.1).count() == 0


def sources(spark, gfms=(), hwrf=(), dfo=(), viirs=(), stations=()):
    return (
        spark.createDataFrame([(TS, *r) for r in stations], STATION),
        spark.createDataFrame([(TS, *r) for r in gfms], GFMS),
        spark.createDataFrame([(TS, *r) for r in hwrf], HWRF),
        spark.createDataFrame([(TS, *r) for r in dfo], DFO),
        spark.createDataFrame([(TS, *r) for r in viirs], VIIRS),
    )


def wet(area):
    """A depth row whose score is 2 x area / 1000 (alone, it counts double)."""
    return (area, 0.0, 0.0, 0.0, 0)


def test_stages_raise_hazard_and_flag(spark):
    st, g, h, d, v = sources(
        spark,
        gfms=[(1, *wet(5000.0)), (2, *wet(5000.0)), (4, *wet(0.0))],
        # 100 points: all four at the cap.
        hwrf=[(1, 1e6, 100.0, 99.0, 99.0), (3, 1e6, 100.0, 99.0, 99.0), (6, 1e6, 100.0, 99.0, 99.0)],
        dfo=[(2, 0.0, 0.0, 1e6, 1e3, 1e6, 1e3, 1e6, 1e3), (4, 0.0, 0.0, 200.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
        viirs=[(2, 1e6, 1e3, 1e6, 1e3), (4, 1e6, 1e3, 1e6, 1e3), (5, 1e6, 1e3, 1e6, 1e3)],
    )
    ex = exposed(spark, [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 0.0), (4, 1.0, 1.0), (5, 0.0, 0.0), (7, 1.0, 1.0)])

    def rows(df):
        return {r.pfaf_id: r for r in df.collect()}

    p3 = rows(P.forecast_alerts(st, g, ex))
    assert {k: r.hazard_score for k, r in p3.items()} == {1: 10.0, 2: 10.0}
    p4 = rows(P.hwrf_alerts(st, g, h, ex))
    # 3 has exposure but no forecast: score zero, so the storm raises it. 6 has neither: no flag.
    assert {k: (r.hazard_score, r.flag, r.forecast_score) for k, r in p4.items()} == {
        1: (100.0, 1, 10.0), 2: (10.0, None, 10.0), 3: (100.0, 1, 0.0), 6: (100.0, None, None)}
    assert p4[6].severity is None and p4[6].alert == "Warning"
    p5 = rows(P.dfo_alerts(st, g, h, d, ex))
    assert {k: (r.hazard_score, r.flag) for k, r in p5.items()} == {
        1: (100.0, 1), 2: (100.0, 2), 3: (100.0, 1), 6: (100.0, None), 4: (2.0, None)}
    # The dry forecast row of 4 was dropped before; it comes back without its forecast columns. Low class: no flag.
    assert p5[4].gfms_totalarea_km is None and p5[4].forecast_score is None and p5[4].alert == "Information"
    p6 = rows(P.viirs_alerts(st, g, h, d, v, ex))
    assert {k: (r.hazard_score, r.flag) for k, r in p6.items()} == {
        1: (100.0, 1), 2: (100.0, 2), 3: (100.0, 1), 6: (100.0, None), 4: (100.0, 3)}
    assert p6[4].dfo_total == 2.0


def test_stepwise_fusion_equals_the_single_pass(spark):
    rnd = random.Random(4)

    def some(n, k, top):
        return [(p, *[rnd.uniform(0, t) for t in top]) for p in range(n) if rnd.random() < k]

    gf = [(p, *v[:4], int(v[4])) for p, *v in some(60, 0.6, [12000, 60, 120, 120, 300])]
    st, g, h, d, v = sources(
        spark, gf, some(60, 0.4, [12000, 60, 8, 16]), some(60, 0.4, [1000, 10] + [1200, 12] * 3),
        some(60, 0.4, [1200, 12] * 2),
        [(p, p % 50, *x[:3], rnd.randrange(4), rnd.randrange(1, 30)) for p, *x in some(80, 0.8, [90, 90, 90])],
    )
    ex = exposed(spark, [(p, rnd.choice([0.0, 1.0, 5.0]), rnd.choice([0.0, 2.0])) for p in range(0, 60, 2)])
    stage = P.hwrf_alerts(st, g, h, ex)
    for scores, total, code in ((C.score_dfo(d, U.MIN_TOTAL), "dfo_total", 2), (C.score_viirs(v, U.MIN_TOTAL), "viirs_total", 3)):
        fused = U.fuse(stage, scores.select(*U.KEYS, total), total, code)
        stage = U.finish(U.fuse_exposure(fused, ex))
    a = {r.pfaf_id: (r.hazard_score, r.flag, r.alert, r.dfo_total, r.forecast_score) for r in stage.collect()}
    single = P.viirs_alerts(st, g, h, d, v, ex).collect()
    b = {r.pfaf_id: (r.hazard_score, r.flag, r.alert, r.dfo_total, r.forecast_score) for r in single}
    assert a == b and len(b) > 30
    assert {f for _, f, *_ in b.values()} == {None, 1, 2, 3}
    assert all(0 <= h <= 100 for h, *_ in b.values())


def test_hazard_grows_with_every_source(spark):
    base = {"gfms": [(1, *wet(3000.0))], "hwrf": [(1, 2000.0, 5.0, 1.0, 1.0)], "dfo": [(1, 0.0, 0.0, 300.0, 2.0, 0.0, 0.0, 0.0, 0.0)],
            "viirs": [(1, 500.0, 1.0, 0.0, 0.0)]}
    ex, seen = exposed(spark, [(1, 1.0, 1.0)]), {}
    for n in range(4):
        for names in itertools.combinations(("hwrf", "dfo", "viirs"), n):
            st, g, h, d, v = sources(spark, base["gfms"], **{k: base[k] for k in names})
            seen[frozenset(names)] = P.viirs_alerts(st, g, h, d, v, ex).first().hazard_score
    assert all(seen[a] <= seen[b] for a in seen for b in seen if a < b)


def test_final_alert(spark):
    day = dt.timedelta(days=1)
    rows = [(TS, 1, "Watch", 1.0, 2.0), (TS + day, 1, "Warning", 1.0, 2.0), (TS + day, 2, "Watch", None, None)]
    alerts = spark.createDataFrame(rows, "run_ts timestamp, pfaf_id long, alert string, dfo_total double, forecast_score double")
    cent = spark.createDataFrame([(1, 10.0, 1), (1, 11.0, 2), (2, 60.0, 3), (4, 1.0, 4)], "pfaf_id long, centroid_y double, FID_1 int")
    out = P.final_alert(alerts, cent)
    assert "FID_1" not in out.columns and "previous_alert" not in out.columns
    assert sorted((r.pfaf_id, r.centroid_y, r.status) for r in out.collect()) == [
        (1, 10.0, "Upgraded"), (1, 11.0, "Upgraded"), (2, 60.0, "New")]
    assert {r.pfaf_id for r in P.final_alert(alerts, cent, apply_north_filter=True).collect()} == {1}
