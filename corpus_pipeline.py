"""A corpus pipeline: toxic documents go, one of each group of near duplicates stays, contaminated documents go, secrets are
redacted, and what is left is mixed to source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontam, jaccard, secrets, toxicity
from freshet.llm.common import stored
from freshet.llm.queries import table, weighted_mix


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their five-word shingles, the one with the smallest id stays."""
    return jaccard.keep_one(docs, words=5, num=4, den=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row, or all words of a shorter item, from the benchmark go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced in the texts; their lengths follow."""
    redacted = secrets.redact_secrets(docs)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; documents that it does not take go."""
    return weighted_mix(docs, table(spark, sf_dir, "labels")).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

#: The classifier of the first stage has no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written as Parquet and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
