"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line of wall times.

Every query runs whole into a sink that discards the rows. Time includes building the plan. Each runs twice and the
better time counts, so that the compilation of the JVM's first encounter with a query is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from freshet.checks.queries import QUERIES  # noqa: E402
from freshet.session import build_session  # noqa: E402

HEADLINE = [
    "station_average", "forecast_alerts", "hwrf_alerts", "dfo_alerts", "viirs_alerts", "combined_alerts", "alerts_clean",
    "alert_status", "final_alert", "flood_duration", "asof_latest", "zonal_gfms", "zonal_hwrf", "zonal_dfo", "zonal_viirs",
    "gfms_pipeline", "hwrf_pipeline", "points_in_watersheds", "glofas_stations", "upsample", "mosaic", "freshness",
]


def depth_grid(spark) -> float:
    """Seconds for the statistics of one depth grid of 4916 x 1600 cells over 2,000 polygons; the inputs are stored before."""
    from pyspark.sql import functions as F

    from freshet.operators import zonal as Z
    from freshet.schemas import DEPTH
    from freshet.session import stored

    cell = F.col("id")
    pixels = spark.range(DEPTH.nrows * DEPTH.ncols).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("run_ts"), F.floor(cell / DEPTH.ncols).cast("int").alias("row"),
        (cell % DEPTH.ncols).cast("int").alias("col"), (cell % 97 / F.lit(10.0)).alias("value"))
    x, y = F.lit(-127.0) + cell % 50 * F.lit(6.1), F.lit(-49.5) + F.floor(cell / 50) * F.lit(2.4)
    ring = F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((0.1, 0.0), (5.9, 0.3), (5.2, 2.3), (0.4, 2.1))])
    sheds = stored(spark.range(2000).select(cell.alias("pfaf_id"), F.lit(50000.0).alias("area_km2"), F.array(ring).alias("rings")), "sheds")
    pixels = stored(pixels, "grid")
    runs, spans = stored(pixels.select("run_ts").distinct(), "runs"), Z.grid_spans(sheds, DEPTH)
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        Z.gfms_summary(pixels, sheds, DEPTH, runs, spans=spans).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def overlapping(spark) -> dict[str, float]:
    """Seconds by cells and by rows for one depth grid under 2,000 polygons of growing width, which overlap the more the wider they are."""
    from pyspark.sql import functions as F

    from freshet.operators import zonal as Z
    from freshet.operators.spatial import row_spans
    from freshet.schemas import DEPTH
    from freshet.session import stored

    cell, out = F.col("id"), {}
    pixels = stored(spark.range(DEPTH.nrows * DEPTH.ncols).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("run_ts"), F.floor(cell / DEPTH.ncols).cast("int").alias("row"),
        (cell % DEPTH.ncols).cast("int").alias("col"), (cell % 97 / F.lit(10.0)).alias("value")), "grid")
    for width in (3.0, 30.0, 150.0):
        x, y = F.lit(-127.0) + cell % 50 * F.lit(3.0), F.lit(-49.5) + F.floor(cell / 50) * F.lit(2.4)
        ring = F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((0.1, 0.0), (width, 0.3), (width - 0.5, 2.3), (0.4, 2.1))])
        sheds = stored(spark.range(2000).select(cell.alias("pfaf_id"), F.lit(50000.0).alias("area_km2"), F.array(ring).alias("rings")), "sheds")
        for by_rows in (False, True):
            spans = stored(row_spans(sheds, DEPTH), "spans") if by_rows else Z.grid_spans(sheds, DEPTH)
            best = float("inf")
            for _ in range(2):
                start = time.perf_counter()
                Z.depth_stats(pixels, sheds, DEPTH, spans, by_rows=by_rows).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            out[f"width {width:g} degrees, by {'rows' if by_rows else 'cells'}"] = round(best, 2)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    if sys.argv[1:] == ["overlapping"]:
        print(json.dumps(overlapping(spark)))
        return
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr)
    if not sys.argv[1:]:
        times["depth_grid_4916x1600"] = depth_grid(spark)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
