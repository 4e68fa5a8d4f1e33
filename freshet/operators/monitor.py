"""Product freshness and uptime rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet import params as P
from freshet.functions.dates import days_from


def freshness(runs: DataFrame, now: Column, limits=None) -> DataFrame:
    """Newest date, age in days and status of every product that has a limit; one without any row is a warning.

    ``limits`` lists (kind, product, oldest allowed age, counts for the overall status).
    """
    limits = P.FRESHNESS_LIMITS if limits is None else limits
    listed = runs.sparkSession.createDataFrame(limits, "kind string, product string, _limit int, counted boolean")
    newest = runs.groupBy("kind", "product").agg(F.max("run_date").alias("latest"))
    joined = listed.join(newest, ["kind", "product"], "left").withColumn("days", days_from(F.col("latest"), now))
    fine = F.col("days") >= F.col("_limit")
    return joined.withColumn("status", F.when(fine, "normal").otherwise("warning")).select(
        "kind", "product", "latest", "days", "status", "counted"
    )


def overall_freshness(fresh: DataFrame) -> DataFrame:
    """One row: warning when any counted product is late."""
    late = F.coalesce(F.bool_or(F.col("counted") & (F.col("status") == "warning")), F.lit(False))
    return fresh.agg(F.when(late, "warning").otherwise("normal").alias("status"), F.count("*").alias("products"))


def latest_checks(checks: DataFrame) -> DataFrame:
    """Newest check per site."""
    return checks.groupBy("name").agg(F.max("ts").alias("ts"), F.max_by("status", "ts").alias("status"))


def uptime_summary(checks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total, up, down and success rate in percent; anything but UP counts as down."""
    up = F.count_if(F.col("status") == "UP")
    total = F.count("*")
    grouped = checks.groupBy(*by)
    return grouped.agg(
        total.alias("total"),
        up.alias("up"),
        (total - up).alias("down"),
        F.when(total > 0, up / total * F.lit(100.0)).alias("success_rate"),
    )
