"""Writers: result files, GeoJSON lines, quarantine and idempotent partitions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import stored
from freshet.sources import commits
from freshet.sources.readers import LEGACY_CHARSETS


def write_product(df: DataFrame, path: str, fmt: str = "parquet", encoding: str = "UTF-8", mode: str = "overwrite") -> None:
    """Write a result as parquet or CSV with header; ``encoding`` is for CSV."""
    if fmt != "csv":
        df.write.mode(mode).format(fmt).save(path)
        return
    if encoding.lower() not in ("utf-8", "us-ascii", "iso-8859-1"):
        df.sparkSession.conf.set(LEGACY_CHARSETS, "true")
    df.write.mode(mode).option("header", True).option("encoding", encoding).csv(path)


def write_rejected(rejected: DataFrame, path: str) -> bool:
    """Write the quarantine only when there is something in it; returns whether it was written."""
    if rejected.isEmpty():
        return False
    write_product(rejected, path, "csv")
    return True


def to_geojson_lines(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """One GeoJSON point feature per row in a single column ``value``."""
    properties = [c for c in df.columns if c not in (lon, lat)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.select(F.to_json(feature).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat") -> None:
    to_geojson_lines(df, lon, lat).write.mode("overwrite").text(path)


def _fields(df: DataFrame, keys: list[str]) -> list:
    return [df.schema[k] for k in keys]


def existing_keys(df: DataFrame, path: str, keys: list[str]) -> DataFrame | None:
    """Partition keys written to the table at ``path``, from its commit records alone; None when there are none."""
    done = commits.committed(df.sparkSession, path, _fields(df, keys))
    return None if done is None else done.select(*keys)


def write_partitions(df: DataFrame, path: str, keys: list[str], overwrite: bool = False, written: DataFrame | None = None) -> None:
    """Write ``df`` partitioned by ``keys`` so that a second run changes nothing.

    By default partitions that exist are skipped; with ``overwrite`` the partitions in ``df`` replace theirs and all
    others stay. Rows are rebalanced over the keys first: small partitions get few files, a huge one is split. A partition
    exists when it is recorded; what a killed write left behind is replaced. ``written`` lists the keys to record when the
    caller knows them, with ``_inputs`` if they matter; otherwise they are those that the write has seen.
    """
    spark, fields = df.sparkSession, _fields(df, keys)
    if not overwrite:
        done = existing_keys(df, path, keys)
        if done is not None:
            done = stored(done.select(*[F.col(k).alias(f"_{k}") for k in keys]), "done")
            df = df.join(done, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    seen = Observation()
    df = df.hint("rebalance", *keys).observe(seen, F.collect_set(F.struct(*keys)).alias("keys"))
    df.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)
    if written is None:
        written = spark.createDataFrame([tuple(k) for k in seen.get["keys"]], T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    commits.commit(written, path, fields)


def reprocess(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the partitions of corrected or late data."""
    write_partitions(df, path, keys, overwrite=True)
