"""Streams against their batch twins, over several micro-batches and out of order."""

import datetime as dt
import random


from freshet.operators import temporal as W
from freshet.streaming import streams as ST

T0 = dt.datetime(2024, 1, 1)


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


SERIES = "pfaf_id long, run_ts timestamp, gfms_totalarea_km double"


def series(n, seed=2):
    rnd = random.Random(seed)
    return [(p, T0 + dt.timedelta(hours=3 * i), 200.0 if rnd.random() < 0.8 else 5.0) for i in range(n) for p in range(3)]


def test_duration_over_batches_out_of_order(spark, tmp_path):
    rows = series(60)
    first, second = rows[: 30 * 3], rows[30 * 3 :]
    # Some steps of the first half arrive with the second, well within the lateness.
    late = first[-24:-12]
    first = [r for r in first if r not in late]
    random.Random(1).shuffle(first)
    schema, src = SERIES, f"{tmp_path}/in"

    def go():
        stream = spark.readStream.schema(schema).parquet(src)
        ST.run_available(ST.stream_flood_duration(stream, lateness="2 days"), f"{tmp_path}/out", f"{tmp_path}/state")

    feed(spark, src, first, schema)
    go()
    early = spark.read.parquet(f"{tmp_path}/out").count()
    feed(spark, src, second + late, schema)
    go()
    feed(spark, src, [(-1, T0 + dt.timedelta(days=60), 0.0)], schema)
    go()
    out = spark.read.parquet(f"{tmp_path}/out").where("pfaf_id >= 0")
    want = W.flood_duration(spark.createDataFrame(rows, schema))
    a = sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in out.collect())
    b = sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in want.collect())
    assert a == b and 0 < early < len(a)


def test_duration_goes_on_from_the_batch_carry(spark, tmp_path):
    rows = series(40, 9)
    old, new = rows[: 20 * 3], rows[20 * 3 :]
    carry = W.last_durations(W.flood_duration(spark.createDataFrame(old, SERIES)))
    feed(spark, f"{tmp_path}/in", new, SERIES)
    stream = spark.readStream.schema(SERIES).parquet(f"{tmp_path}/in")
    ST.run_available(
        ST.stream_flood_duration(stream, lateness="0 seconds", carry=carry), f"{tmp_path}/out", f"{tmp_path}/state"
    )
    got = sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    every = W.flood_duration(spark.createDataFrame(rows, SERIES)).collect()
    assert got == sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in every if r.run_ts >= new[0][1])


def test_status_over_batches(spark, tmp_path):
    rnd = random.Random(3)
    labels = [None, "Information", "Advisory", "Watch", "Warning"]
    rows = [(T0 + dt.timedelta(hours=6 * i), p, rnd.choice(labels)) for i in range(16) for p in range(6) if rnd.random() < 0.8]
    schema, src = "run_ts timestamp, pfaf_id long, alert string", f"{tmp_path}/in"
    end = (T0 + dt.timedelta(days=30), -1, None)
    for part in (rows[: len(rows) // 2], rows[len(rows) // 2 :], [end]):
        feed(spark, src, part, schema)
        stream = spark.readStream.schema(schema).parquet(src)
        ST.run_available(ST.stream_alert_status(stream), f"{tmp_path}/out", f"{tmp_path}/state")
    out = ST.published_runs(spark.read.parquet(f"{tmp_path}/out").where("pfaf_id >= 0"))
    want = W.day_over_day(spark.createDataFrame(rows, schema))
    cols = ("run_ts", "pfaf_id", "alert", "previous_alert", "status")
    key = lambda r: (r[0], r[1])
    assert sorted([tuple(r) for r in out.select(*cols).collect()], key=key) == sorted(
        [tuple(r) for r in want.select(*cols).collect()], key=key)


def test_new_files_are_read_once(spark, tmp_path):
    for i, hour in enumerate(("00", "03")):
        with open(f"{tmp_path}/Flood_20240101{hour}.csv", "w") as f:
            f.write(f"pfaf_id,a,b,c,d,e\n{i},1,2,3,4,5\n")
        ST.run_available(ST.stream_summaries(spark, f"{tmp_path}/*.csv", "gfms"), f"{tmp_path}/o/out", f"{tmp_path}/o/state")
    rows = spark.read.parquet(f"{tmp_path}/o/out").collect()
    assert sorted((r.pfaf_id, r.run_ts.hour) for r in rows) == [(0, 0), (1, 3)]


def test_corrected_files_replace_their_date(spark, tmp_path):
    schema, src, out = "d string, v int", f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in ([("a", 1), ("b", 2)], [("b", 3)]):
        feed(spark, src, rows, schema)
        ST.upsert_available(spark.readStream.schema(schema).parquet(src), out, ["d"], f"{tmp_path}/state")
    assert sorted((r.d, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]


def test_bins(spark, tmp_path):
    rows = [(1, T0 + dt.timedelta(minutes=m), 1.0) for m in range(0, 600, 30)]
    feed(spark, f"{tmp_path}/in", rows, "pfaf_id long, ts timestamp, value double")
    stream = spark.readStream.schema("pfaf_id long, ts timestamp, value double").parquet(f"{tmp_path}/in")
    ST.run_available(ST.stream_bins(stream, lateness="0 seconds"), f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted((r.run_ts.hour, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(0, 6), (3, 6), (6, 6)]


def go_batches(spark, tmp_path, schema=SERIES, **options):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    ST.durations_available(stream, f"{tmp_path}/out", f"{tmp_path}/carry", f"{tmp_path}/state", **options)


def durations(spark, tmp_path):
    return sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in spark.read.parquet(f"{tmp_path}/out").where("pfaf_id >= 0").collect())


def test_duration_batches_out_of_order(spark, tmp_path):
    rows = series(60)
    late = rows[66:78]
    first = [r for r in rows[:90] if r not in late] + [(None, T0, 1.0), (7, None, 1.0)]
    random.Random(1).shuffle(first)
    feed(spark, f"{tmp_path}/in", first, SERIES)
    go_batches(spark, tmp_path)
    early = len(durations(spark, tmp_path))
    # The late steps, some of them twice, and some that were applied long before.
    feed(spark, f"{tmp_path}/in", rows[90:] + late + late[:3] + rows[:3], SERIES)
    go_batches(spark, tmp_path)
    feed(spark, f"{tmp_path}/in", [(-1, T0 + dt.timedelta(days=60), 0.0)], SERIES)
    go_batches(spark, tmp_path)
    want = sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in W.flood_duration(spark.createDataFrame(rows, SERIES)).collect())
    assert durations(spark, tmp_path) == want and 0 < early < len(want)


def test_a_replayed_duration_batch_changes_nothing(spark, tmp_path):
    rows = series(40, 4)
    parts = [spark.createDataFrame(rows[i : i + 40], SERIES) for i in range(0, 120, 40)]
    paths = f"{tmp_path}/out", f"{tmp_path}/carry"
    for n, part in enumerate(parts):
        ST.advance_durations(part, n, *paths, lateness_hours=6)
        before = durations(spark, tmp_path)
        ST.advance_durations(part, n, *paths, lateness_hours=6)
        assert durations(spark, tmp_path) == before
    ST.advance_durations(parts[0].limit(0), 3, *paths, lateness_hours=0)
    want = sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in W.flood_duration(spark.createDataFrame(rows, SERIES)).collect())
    assert durations(spark, tmp_path) == want


def test_duration_batches_go_on_from_a_carry(spark, tmp_path):
    rows = series(40, 9)
    carry = W.last_durations(W.flood_duration(spark.createDataFrame(rows[:60], SERIES)))
    feed(spark, f"{tmp_path}/in", rows[60:], SERIES)
    go_batches(spark, tmp_path, lateness_hours=0, carry=carry)
    every = W.flood_duration(spark.createDataFrame(rows, SERIES)).collect()
    assert durations(spark, tmp_path) == sorted((r.pfaf_id, r.run_ts, r.gfms_duration) for r in every if r.run_ts >= rows[60][1])


def test_duration_batches_have_no_python(spark, tmp_path):
    done = W.flood_duration(spark.createDataFrame(series(10), SERIES), carry=spark.createDataFrame([], ST._CARRY))
    text = done._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text.replace("PythonRDD", "") and "Pandas" not in text


def test_a_file_delivered_twice_under_two_names_counts_once(spark, tmp_path):
    def put(name, rows):
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write("pfaf_id,a,b,c,d,e\n" + "".join(f"{p},{v},2,3,4,5\n" for p, v in rows))

    def go():
        stream = ST.stream_summaries(spark, f"{tmp_path}/*.csv", "gfms", once_within="2 days")
        ST.run_available(stream, f"{tmp_path}/o/out", f"{tmp_path}/o/state")

    put("Flood_2024010100.csv", [(1, 1), (2, 2)])
    put("Flood_2024010103.csv", [(1, 3)])
    go()
    put("Again_2024010100.csv", [(1, 1), (2, 2), (3, 4)])
    go()
    got = sorted((r.run_ts.hour, r.pfaf_id, r.gfms_totalarea_km) for r in spark.read.parquet(f"{tmp_path}/o/out").collect())
    assert got == [(0, 1, 1.0), (0, 2, 2.0), (0, 3, 4.0), (3, 1, 3.0)]


def test_bins_count_redelivered_rows_once(spark, tmp_path):
    schema = "pfaf_id long, ts timestamp, value double, event long"
    rows = [(1, T0 + dt.timedelta(minutes=m), 1.0, m) for m in range(0, 360, 30)]
    for part in (rows, rows[:5], [(-1, T0 + dt.timedelta(days=9), 0.0, -1)]):
        feed(spark, f"{tmp_path}/in", part, schema)
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        ST.run_available(ST.stream_bins(stream, unique=("event",)), f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted((r.run_ts.hour, r.n) for r in spark.read.parquet(f"{tmp_path}/out").where("pfaf_id = 1").collect())
    assert got == [(0, 6), (3, 6)]


def test_published_alerts_of_a_stream(spark, tmp_path):
    schema = "run_ts timestamp, pfaf_id long, alert string, dfo_total double, forecast_score double"
    centroids = spark.createDataFrame([(1, "one", 1.0)], "pfaf_id long, admin_name string, centroid_y double")
    days = [[(T0, 1, "Watch", None, 1.0)], [(T0 + dt.timedelta(days=1), 1, "Watch", None, 1.0)],
            [(T0 + dt.timedelta(days=2), 1, "Advisory", None, 1.0)], [(T0 + dt.timedelta(days=1), 1, "Warning", None, 1.0)]]
    seen = []
    for rows in days:
        feed(spark, f"{tmp_path}/in", rows, schema)
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        ST.publish_available(stream, f"{tmp_path}/alerts", f"{tmp_path}/out", centroids, f"{tmp_path}/state")
        try:
            seen.append(sorted((r.run_ts.day, r.status) for r in spark.read.parquet(f"{tmp_path}/out").collect()))
        except Exception:  # noqa: BLE001
            seen.append([])
    assert seen == [[], [(2, "Continued")], [(2, "Continued"), (3, "Downgraded")], [(2, "Upgraded"), (3, "Downgraded")]]
