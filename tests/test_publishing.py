"""Commit records and incremental publishing: what is read, what is replaced, and what a killed write leaves behind."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from freshet.plans import pipelines as P
from freshet.sources import commits
from freshet.sources import sinks as K

ALERTS = "run_ts timestamp, pfaf_id long, alert string, dfo_total double, forecast_score double"
CENTROIDS = "pfaf_id long, admin_name string, centroid_y double"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def rows(spark, *alerts):
    return spark.createDataFrame([(at(h), p, a, None, 1.0) for h, p, a in alerts], ALERTS)


def centroids(spark):
    return spark.createDataFrame([(1, "one", 10.0), (2, "two", 10.0), (2, "two b", 20.0)], CENTROIDS)


def files(path):
    return {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if "_commits" not in f}


def publish(spark, path):
    """(published runs, table) of one call."""
    table = spark.read.schema(ALERTS).parquet(f"{path}/alerts")
    done = P.publish_stale(table, f"{path}/alerts", f"{path}/out", centroids(spark))
    return {r.run_ts for r in done.collect()}


def statuses(spark, path):
    return {(r.run_ts, r.pfaf_id, r.admin_name): r.status for r in spark.read.parquet(f"{path}/out").collect()}


def test_only_runs_that_a_change_touches_are_published_again(spark, tmp_path):
    path, every = str(tmp_path), [(h, p, "Watch") for h in (0, 6, 24, 30, 48) for p in (1, 2)]
    K.write_partitions(rows(spark, *every), f"{path}/alerts", ["run_ts"])
    assert publish(spark, path) == {at(24), at(30), at(48)}
    assert publish(spark, path) == set()
    before = files(f"{path}/out")
    K.reprocess(rows(spark, (24, 1, "Warning"), (24, 2, "Watch")), f"{path}/alerts", ["run_ts"])
    assert publish(spark, path) == {at(24), at(48)}
    kept = before & files(f"{path}/out")
    assert kept and all("06%3A00" in f for f in kept)  # the run at 30 h keeps its files
    got = statuses(spark, path)
    assert got[at(24), 1, "one"] == "Upgraded" and got[at(48), 1, "one"] == "Downgraded"
    assert got[at(48), 2, "two b"] == got[at(30), 1, "one"] == "Continued" and len(got) == 9
    # The newest version of a run is what counts, and versions go on.
    key = [rows(spark).schema["run_ts"]]
    assert {r.run_ts: r._version for r in commits.committed(spark, f"{path}/alerts", key).collect()}[at(24)] == 2
    assert publish(spark, path) == set()


def test_a_run_that_comes_late_makes_the_next_day_publishable(spark, tmp_path):
    path = str(tmp_path)
    K.write_partitions(rows(spark, (24, 1, "Watch")), f"{path}/alerts", ["run_ts"])
    assert publish(spark, path) == set()
    K.write_partitions(rows(spark, (0, 1, "Warning"), (24, 1, "Information")), f"{path}/alerts", ["run_ts"])
    assert publish(spark, path) == {at(24)}
    assert statuses(spark, path) == {(at(24), 1, "one"): "Downgraded"}


def test_publishing_reads_the_partitions_of_stale_runs_only(spark, tmp_path):
    path = str(tmp_path)
    K.write_partitions(rows(spark, *[(h, 1, "Watch") for h in range(0, 240, 24)]), f"{path}/alerts", ["run_ts"])
    publish(spark, path)
    K.reprocess(rows(spark, (48, 1, "Warning")), f"{path}/alerts", ["run_ts"])
    stale = P.stale_runs(f"{path}/alerts", f"{path}/out", rows(spark))
    assert {r.run_ts for r in stale.select("run_ts").collect()} == {at(48), at(72)}
    read = P.at_times(spark.read.schema(ALERTS).parquet(f"{path}/alerts"), stale)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "run_ts" in plan.split("PartitionFilters: [")[1].split("]")[0]
    opened = {r.f for r in read.select(F.input_file_name().alias("f")).collect()}
    assert len(opened) == 2


def test_many_times_are_joined(spark):
    table = spark.range(20).select(F.timestamp_seconds(F.col("id") * 3600).alias("run_ts"))
    times = table.where("minute(run_ts) = 0").limit(12)
    assert P.at_times(table, times, most=5).count() == 12 and P.at_times(table, times.limit(0)).count() == 0


def test_a_write_killed_midway_is_done_again(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", killed)
        with pytest.raises(RuntimeError):
            K.write_partitions(df, path, ["k"])
    assert files(path) and K.existing_keys(df, path, ["k"]) is None
    # Part of what was written is lost, too.
    os.remove(sorted(files(path))[0])
    K.write_partitions(df.withColumn("v", F.upper("v")), path, ["k"])
    assert sorted(map(str, spark.read.parquet(path).select("k", "v").collect())) == sorted(map(str, df.withColumn("v", F.upper("v")).collect()))
    # NULL is a key: it is there now, and written once.
    before = files(path)
    K.write_partitions(df, path, ["k"])
    assert files(path) == before and K.existing_keys(df, path, ["k"]).count() == 3


def test_existing_keys_open_no_data(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(i, "a") for i in range(5)], "k int, v string")
    K.write_partitions(df, path, ["k"])
    for f in files(path):
        with open(f, "wb") as broken:
            broken.write(b"no parquet")
    assert sorted(r.k for r in K.existing_keys(df, path, ["k"]).collect()) == [0, 1, 2, 3, 4]


def test_nothing_to_write(spark, tmp_path):
    df = spark.createDataFrame([], "k int, v string")
    K.write_partitions(df, f"{tmp_path}/t", ["k"])
    assert K.existing_keys(df, f"{tmp_path}/t", ["k"]).count() == 0
    assert P.stale_runs(f"{tmp_path}/a", f"{tmp_path}/o", rows(spark)).count() == 0


def test_wide_alerts_are_shuffled_once_to_be_published(spark):
    """Centroids and the day before meet the keys first; the watershed's places multiply as before."""
    alerts = rows(spark, *[(h, p, "Watch") for h in (0, 24) for p in range(50)]).withColumn("wide", F.lit(1.0))
    places = spark.createDataFrame([(p, f"n{p}{i}", 10.0) for p in range(49) for i in range(1 + p % 2)], CENTROIDS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = P.final_alert(alerts, places)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 73 and {r.status for r in out.collect()} == {"Continued"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    steps = text.split("Exchange ")
    assert sum("wide" in part.split("Exchange")[0] and "FileScan" in part.split("Exchange")[0] for part in steps[1:]) == 1
    assert text.count("Join") == 3


def test_sources_are_filtered_below_their_aggregates(spark):
    """Times that no run uses never reach the exchange of a source's sums."""
    lines = spark.range(100).select(F.timestamp_seconds(F.col("id") % 10 * 3600).alias("run_ts"), (F.col("id") % 7).alias("pfaf_id"), F.lit(1.0).alias("v"))
    sums = lines.groupBy("run_ts", "pfaf_id").agg(F.sum("v").alias("v"))
    plan = lines.select("run_ts").where("hour(run_ts) = 3").distinct()
    for used in (P._same_run(sums, plan), P.on_runs(sums.withColumn("_at", F.col("run_ts")), plan.withColumn("at", F.col("run_ts")), "at", "_at")):
        text = used._jdf.queryExecution().executedPlan().toString()
        assert text.rindex("Filter") > text.rindex("Exchange hashpartitioning(run_ts") and used.count() == 7
    days = lines.select(F.to_date("run_ts").alias("day"))
    assert P.among(days, "day", days.limit(1)).count() == 100 and P.among(days, "day", days.limit(0)).count() == 0
