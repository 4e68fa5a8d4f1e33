"""Scores, severity, alert classes and dates on hand-computed edges."""

import math

import pytest
from pyspark.sql import functions as F

from freshet import params as P
from freshet.functions import alerts as A
from freshet.functions import dates as D
from freshet.functions import numeric as N


def values(spark, data, schema, *exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_capped_score(spark):
    p = P.Capped(10.0, 1.0, 10.0)
    rows = [(100.0,), (100.1,), (0.0,), (-5.0,), (None,)]
    got = values(spark, rows, "v double", N.capped_score(F.col("v"), p), N.capped_score(F.col("v"), p, 2.5))
    assert got == [(10.0, 25.0), (10.0, 25.0), (0.0, 0.0), (-0.5, -1.25), (None, None)]


def test_capped_score_keeps_points_below_the_cap(spark):
    """Half a point per unit: the cap compares units, not points."""
    p = P.Capped(1.0, 0.5, 10.0)
    got = values(spark, [(10.0,), (10.5,)], "v double", N.capped_score(F.col("v"), p))
    assert got == [(5.0,), (10.0,)]


def test_step_score(spark):
    p = P.Step(2.0, 0.5, 1.0, 10.0)
    got = values(spark, [(1.999,), (2.0,), (2.5,), (99.0,), (None,)], "v double", N.step_score(F.col("v"), p))
    assert got == [(0.0,), (1.0,), (2.0,), (10.0,), (None,)]


def test_alert_score(spark):
    got = values(spark, [(0,), (1,), (2,), (3,)], "a int", N.alert_score(F.col("a")))
    assert got == [(0.0,), (3.0,), (7.0,), (10.0,)]


def test_alert_score_rounds_half_to_even(spark):
    got = spark.range(1).select(F.bround(F.lit(2.5), 0), F.bround(F.lit(3.5), 0)).first()
    assert tuple(got) == (2.0, 4.0)


def test_peak_score(spark):
    rows = [(0.0, 5), (1.0, 0), (1.0, 1), (1.0, 9), (1.0, 10), (1.0, 30), (1.0, -2)]
    got = values(spark, rows, "p double, d int", N.peak_score(F.col("d"), F.col("p")))
    assert [g[0] for g in got] == [0.0, 0.0, 10.0, 2.0, 1.0, 1.0, 0.0]


def test_normal_cdf(spark):
    xs = [-40.0, -37.5, -12.0, -7.1, -7.0, -2.0, -0.3, 0.0, 0.3, 2.0, 6.0, 12.0, 40.0]
    df = N.with_normal_cdf(spark.createDataFrame([(x,) for x in xs], "x double"), "x", "p")
    for x, p in [tuple(r) for r in df.collect()]:
        assert p == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2)), abs=1e-14)


def test_severity(spark):
    rows = [(50.0, 5.0, 0.0), (50.0, 5.1, 0.0), (50.0, None, None), (50.0, None, 2.0), (0.0, 1.0, 1.0), (-1.0, 1.0, 1.0),
            (None, 1.0, 1.0), (60.0, 2.0, 1.0)]
    df = N.with_severity(spark.createDataFrame(rows, "hazard_score double, rfr_score double, cfr_score double"))
    got = [r.severity for r in df.collect()]
    assert got[0] == 1.0 and got[1] is None and got[2] is None
    assert got[3] == pytest.approx(0.5 * math.erfc(-(math.log(50) - math.log(60)) / math.sqrt(2)))
    assert got[4] == 0.0 and got[5] is None and got[6] is None
    assert got[7] == pytest.approx(0.5)


def test_alert_class(spark):
    rows = [(0.8, 50.0), (0.8, 80.0), (None, 90.0), (0.0, 0.0), (0.81, 1.0), (0.7, 1.0), (0.6, 60.0), (0.4, None),
            (0.1, None), (None, None), (0.35, 35.0), (0.1, 61.0)]
    got = values(spark, rows, "s double, h double", A.alert_class(F.col("s"), F.col("h")))
    assert [g[0] for g in got] == ["Advisory", None, "Warning", None, "Warning", "Watch", None, "Advisory", "Information",
                                   None, None, "Watch"]


def test_alert_class_rounds_on_request(spark):
    rows = [(None, 60.0000000000001)]
    s, h = F.col("s"), F.col("h")
    assert values(spark, rows, "s double, h double", A.alert_class(s, h), A.alert_class(s, h, 9)) == [("Watch", None)]


def test_codes_and_status(spark):
    rows = [("Watch", None), ("Watch", "Watch"), ("Warning", "Watch"), ("Information", "Watch"), (None, "Watch"), (None, None)]
    code, previous = A.alert_code(F.col("a")), A.alert_code(F.col("b"))
    got = values(spark, rows, "a string, b string", A.alert_label(code), A.alert_status(code, previous))
    assert got == [("Watch", "New"), ("Watch", "Continued"), ("Warning", "Upgraded"), ("Information", "Downgraded"),
                   (None, "Other"), (None, "New")]


def test_clean_turns_nan_into_null(spark):
    df = N.clean(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, k int"))
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(None, 1), (2.0, 2)]


def test_dates(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    got = spark.range(1).select(
        D.days_from(t("2024-01-31 00:00:00"), t("2024-01-31 00:00:00")),
        D.days_from(t("2024-01-31 00:00:00"), t("2024-01-31 00:00:01")),
        D.days_from(t("2024-02-02 10:00:00"), t("2024-01-31 12:00:00")),
        D.hour_diff(t("2024-01-01 00:00:00"), t("2024-01-01 01:30:00")),
        D.hour_diff(t("2024-01-02 00:00:00"), t("2024-01-01 01:30:00")),
        D.doy_date(F.lit(2021), F.lit(21)).cast("string"),
        D.doy_date(F.lit(2024), F.lit(366)).cast("string"),
        D.date_from_text(F.lit("DFO_20240229.csv")).cast("string"),
        D.date_from_text(F.lit("none")).cast("string"),
        D.run_ts_from_path(F.lit("/a/20230101/flood_2024022918.csv")).cast("string"),
        D.run_ts_from_path(F.lit("/a/points_20240229.csv")).cast("string"),
        D.floor_hours(t("2024-01-01 17:59:59"), 6).cast("string"),
        D.processing_slot(t("2024-01-01 05:00:00")).cast("string"),
        D.is_ready(t("2024-01-01 00:00:00"), t("2024-01-01 06:00:00")),
        D.is_ready(t("2024-01-01 00:00:00"), t("2024-01-01 06:00:01")),
    ).first()
    assert tuple(got) == (0, -1, 1, -1, 22, "2021-01-21", "2024-12-31", "2024-02-29", None, "2024-02-29 18:00:00",
                          "2024-02-29 00:00:00", "2024-01-01 12:00:00", "2023-12-31 18:00:00", False, True)
