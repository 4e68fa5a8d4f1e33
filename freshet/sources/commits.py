"""Commit records of partitioned tables: which partitions are there, how often they were written, and from which inputs.

Records are appended below the table, in a folder that readers of the table skip: one row for each partition that a write
has finished. Data comes first and its records last, so a write that was killed midway is not recorded, and the next one does
it again. What exists is known from the records alone; no data file is opened. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_commits"
VERSION, INPUTS = "_version", "_inputs"


def _schema(keys: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(k.name, k.dataType) for k in keys]
                        + [T.StructField(VERSION, T.LongType()), T.StructField(INPUTS, T.MapType(T.StringType(), T.LongType()))])


def records(spark: SparkSession, path: str, keys: list[T.StructField]) -> DataFrame | None:
    """All records of the table at ``path``, None when nothing was ever committed."""
    try:
        return spark.read.schema(_schema(keys)).parquet(f"{path}/{FOLDER}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed(spark: SparkSession, path: str, keys: list[T.StructField]) -> DataFrame | None:
    """(keys, _version, _inputs): the newest record of each partition, None when there is none."""
    found = records(spark, path, keys)
    if found is None:
        return None
    newest = F.max_by(F.struct(VERSION, INPUTS), VERSION).alias("_r")
    return found.groupBy(*[k.name for k in keys]).agg(newest).select(*[k.name for k in keys], f"_r.{VERSION}", f"_r.{INPUTS}")


def commit(written: DataFrame, path: str, keys: list[T.StructField]) -> None:
    """Append a record for each row of ``written``, which has the keys and may have ``_inputs``; versions count on.

    ``written`` has one row per partition of one write.
    """
    spark, names = written.sparkSession, [k.name for k in keys]
    if INPUTS not in written.columns:
        written = written.withColumn(INPUTS, F.lit(None).cast("map<string,bigint>"))
    rows = written.select(*names, F.lit(1).cast("long").alias(VERSION), INPUTS)
    old = committed(spark, path, keys)
    if old is not None:
        # Stacked rather than joined, so that NULL keys meet: the old version has no inputs of this write.
        old = old.select(*names, (F.col(VERSION) + 1).alias(VERSION), F.lit(None).cast("map<string,bigint>").alias(INPUTS), F.lit(0).alias("_new"))
        both = old.unionByName(rows.withColumn("_new", F.lit(1)))
        rows = both.groupBy(*names).agg(F.max(VERSION).alias(VERSION), F.max_by(INPUTS, "_new").alias(INPUTS), F.max("_new").alias("_new")).where("_new = 1").drop("_new")
    rows.coalesce(1).write.mode("append").parquet(f"{path}/{FOLDER}")
