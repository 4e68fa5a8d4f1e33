"""Registered queries of the text operators: each applies its operator to a whole table and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import bpe, collocations, decontam, jaccard, lm, mixing, ranked, secrets, substrings, tokens, topk, toxicity, urls
from freshet.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight): 2 for documents labelled good, 1 for others; one row per id, whatever the labels repeat."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.when(F.max("quality") == 1, 2.0).otherwise(1.0).alias("weight"))


def weighted_mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix of documents with quality weights from labels."""
    return mixing.mix_sources(docs, quality=quality_weights(labels))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=3, num=9, den=10)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_scores_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), order=3)


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k, *_ in secrets.KINDS], F.sha2(secrets.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"), "n_live", "n_examples",
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # NULL and non-finite components take a vector out before it is cut to integers.
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(whole).select("vec_id", topk.integer_vector(F.col("embedding")).alias("vec"))
    return topk.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, urls.RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_lm_scores_order3": op6_lm_scores_order3,
    "op6_lm_scores": op6_lm_scores,
    "op7_secrets": op7_secrets,
    "op8_top_k": op8_top_k,
    "op9_url_filter": op9_url_filter,
    "op10_mixing": op10_mixing,
    "op11_bpe": op11_bpe,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}
