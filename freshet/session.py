"""Session defaults, the shared work folder and the size check in front of every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Used where the session says nothing; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # The JVM does not compile methods above 8000 bytes; a stage that needs a larger one runs faster in pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "freshet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session from elsewhere the settings that results (UTC) and generated code depend on."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, DEFAULTS[key])
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, and only in local mode: executors on other machines could not
    see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="freshet-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    It is computed once and safe from the loss of executors. As a join side its size is known from the files, so the
    planner itself decides between a broadcast and a shuffled join.
    """
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_side(df: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """Mark a stored join side for broadcast when it is small; a larger one goes through a shuffled join.

    For sides bounded by polygons and grid that may exceed the planner's own limit and yet are worth a broadcast, because
    the other side is huge and has not been shuffled. ``size`` is what a row weighs, 1 by default; weights are added up where
    the rows are.
    """
    weight = df.count() if size is None else df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if weight <= most else df.hint("merge")
