"""Flood duration against its recursion, as-of joins and status on edges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import temporal as W

T0 = dt.datetime(2024, 1, 1)


def recursion(steps, carry=None, gap=3):
    """(pfaf, ts) -> hours, step by step."""
    out, last = {}, dict(carry or {})
    for pfaf, ts, area in sorted(steps, key=lambda s: (s[0], s[1])):
        at, hours = last.get(pfaf, (None, 0))
        linked = at is not None and dt.timedelta(0) < ts - at <= dt.timedelta(hours=gap)
        hours = 3 + (hours if linked else 0) if area is not None and area == area and area > 100 else 0
        out[pfaf, ts] = hours
        last[pfaf] = (ts, hours)
    return out


def run(spark, steps, carry=None, **kw):
    df = spark.createDataFrame(steps, "pfaf_id long, run_ts timestamp, gfms_totalarea_km double")
    c = None
    if carry:
        c = spark.createDataFrame([(k, *v) for k, v in carry.items()], "pfaf_id long, last_ts timestamp, duration int")
    rows = W.flood_duration(df, carry=c, **kw).collect()
    return {(r.pfaf_id, r.run_ts): r.gfms_duration for r in rows}


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_from_scratch_carry_and_gap(spark):
    areas = [150.0, 150.0, 50.0, 150.0]
    steps = [(1, at(3 * i), a) for i, a in enumerate(areas)]
    assert [run(spark, steps)[1, at(3 * i)] for i in range(4)] == [3, 6, 0, 3]
    carried = run(spark, steps, {1: (at(-3), 9)})
    assert [carried[1, at(3 * i)] for i in range(4)] == [12, 15, 0, 3]
    stale = run(spark, steps, {1: (at(-6), 9)})
    assert [stale[1, at(3 * i)] for i in range(4)] == [3, 6, 0, 3]
    gapped = run(spark, [(1, at(0), 150.0), (1, at(6), 150.0), (1, at(9), 150.0)])
    assert [gapped[1, at(h)] for h in (0, 6, 9)] == [3, 3, 6]


def test_unknown_area_counts_as_dry(spark):
    got = run(spark, [(1, at(0), 150.0), (1, at(3), None), (1, at(6), float("nan")), (1, at(9), 101.0)])
    assert [got[1, at(h)] for h in (0, 3, 6, 9)] == [3, 0, 0, 3]


@pytest.mark.parametrize("seed,block_days,wet", [(1, 1, 0.9), (2, 2, 0.98), (3, 64, 0.5), (4, 1, 1.0)])
def test_equals_recursion_over_many_blocks(spark, seed, block_days, wet):
    rnd = random.Random(seed)
    steps, carry = [], {}
    for pfaf in range(12):
        if rnd.random() < 0.5:
            carry[pfaf] = (at(-3 * rnd.choice([1, 2])), rnd.randrange(0, 40, 3))
        for i in range(160):
            if rnd.random() < 0.97:
                steps.append((pfaf, at(3 * i), 200.0 if rnd.random() < wet else 10.0))
    rnd.shuffle(steps)
    assert run(spark, steps, carry, block_days=block_days) == recursion(steps, carry)


def test_other_gap_limit(spark):
    steps = [(1, at(0), 150.0), (1, at(6), 150.0), (1, at(13), 150.0)]
    assert run(spark, steps, max_gap_hours=6) == recursion(steps, gap=6)


def dates(spark, *days):
    return spark.createDataFrame([(dt.date(2024, 1, d),) for d in days], "run_date date")


def runs(spark, *times):
    return spark.createDataFrame([(t,) for t in times], "run_ts timestamp")


def test_asof_latest(spark):
    r = runs(spark, dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 10, 18), dt.datetime(2024, 1, 20, 18))
    got = {x.run_ts: x.latest_date for x in W.asof_latest(r, dates(spark, 10)).collect()}
    assert got[dt.datetime(2024, 1, 10, 6)] is None
    assert got[dt.datetime(2024, 1, 10, 18)] == dt.date(2024, 1, 10)
    assert got[dt.datetime(2024, 1, 20, 18)] is None


def test_asof_nine_and_ten_days(spark):
    r = runs(spark, dt.datetime(2024, 1, 19), dt.datetime(2024, 1, 20))
    got = {x.run_ts.day: x.latest_date for x in W.asof_latest(r, dates(spark, 10)).collect()}
    assert got == {19: dt.date(2024, 1, 10), 20: None}


def test_latest_within_and_or(spark):
    r = runs(spark, at(0), at(6), at(12), at(18), at(24))
    s = runs(spark, at(0), at(12))
    got = {x.run_ts: x.source_ts for x in W.latest_within(r, s).collect()}
    assert got == {at(0): at(0), at(6): at(0), at(12): at(12), at(18): at(12), at(24): None}
    got = {x.run_ts: x.source_ts for x in W.latest_within(r, s, look_ahead=True).collect()}
    assert got == {at(0): at(0), at(6): at(12), at(12): at(12), at(18): at(12), at(24): None}
    got = {x.run_ts: x.source_date for x in W.latest_or(r, dates(spark, 1)).collect()}
    assert set(got.values()) == {dt.date(2024, 1, 1)}


def test_a_later_source_changes_no_earlier_run(spark):
    r = runs(spark, at(0), at(6), at(30))
    before = {x.run_ts: x.source_ts for x in W.latest_within(r, runs(spark, at(0), at(26))).collect()}
    after = {x.run_ts: x.source_ts for x in W.latest_within(r, runs(spark, at(0), at(26), at(40))).collect()}
    assert before == after == {at(0): at(0), at(6): at(0), at(30): at(26)}
    early = {x.run_ts: x.source_date for x in W.latest_or(r, dates(spark, 2)).collect()}
    assert early == {at(0): None, at(6): None, at(30): dt.date(2024, 1, 2)}


def test_a_step_delivered_twice_counts_once(spark):
    rows = [(1, at(0), 200.0), (1, at(3), 200.0), (1, at(3), 150.0), (1, at(3), 200.0)]
    series = spark.createDataFrame(rows, "pfaf_id long, run_ts timestamp, gfms_totalarea_km double")
    got = sorted((x.run_ts, x.gfms_duration) for x in W.flood_duration(series).collect())
    assert got == [(at(0), 3), (at(3), 6)]


def test_inventories(spark):
    a, b = runs(spark, at(0), at(6), at(6)), runs(spark, at(6), at(12))
    assert [x.run_ts for x in W.run_dates(a, b).collect()] == [at(0), at(6), at(12)]
    assert [x.run_ts for x in W.latest_n(W.run_dates(a, b), n=2).collect()] == [at(12), at(6)]
    assert [x.run_date.day for x in W.pending_dates(dates(spark, 1, 2), dates(spark, 2)).collect()] == [1]


def test_day_over_day(spark):
    rows = [(at(0), 1, "Watch"), (at(24), 1, "Warning"), (at(24), 2, "Watch"), (at(24), 3, None), (at(0), 3, "Watch"),
            (at(30), 1, "Watch")]
    alerts = spark.createDataFrame(rows, "run_ts timestamp, pfaf_id long, alert string")
    got = {(x.run_ts, x.pfaf_id): x.status for x in W.day_over_day(alerts).collect()}
    assert got == {(at(24), 1): "Upgraded", (at(24), 2): "New", (at(24), 3): "Other"}
    every = {(x.run_ts, x.pfaf_id): x.status for x in W.day_over_day(alerts, require_previous_run=False).collect()}
    assert every[at(30), 1] == "New" and len(every) == 6


def test_latest_n_per(spark):
    df = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").alias("run_ts"))
    got = sorted((r.k, r.run_ts) for r in W.latest_n_per(df, ["k"], n=2).collect())
    assert got == [(0, 16), (0, 18), (1, 17), (1, 19)]
