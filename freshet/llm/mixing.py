"""Mixing sources to target weights: weighted sampling without replacement by exponential keys (Efraimidis-Spirakis).

Built from DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import stored

#: Rows that one window of the prefix sum holds on average.
BUCKET_ROWS = 2048


def word_count(text: str = "text") -> Column:
    """Runs of characters other than blank, tab and line breaks; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09\\x0A\\x0B\\x0C\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(_source, source_size, n_rows, target) from (source, _source, source_size, n_rows), one row per source.

    A target is ``least(cap * size, level * weight)``; the level is where the targets add up to ``share`` of all words.
    With sources in the order of ``cap * size / weight``, those before some place are capped and share nothing further,
    so the level follows from running sums. One small row per source is sorted here, however many documents it has.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int") + 1)
    t = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    t = t.withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "_source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    t = t.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    first = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "_source", "level"))).over(everything)
    t = t.withColumn("settled", first["level"])
    target = F.when(F.col("settled").isNull(), F.col("most")).otherwise(F.least("most", F.col("settled") * F.col("weight")))
    return t.select("_source", "source_size", "n_rows", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    quality: DataFrame | None = None, seed: str = "mix", bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs`` (doc_id, text, source).

    Sources weigh ``weights`` in turn, in code point order, NULL last. A source's target counts ``target / size`` whole
    epochs first; the words left over are taken in the order of ``-ln(u) / weight``, where u in (0, 1) comes from a hash
    of seed, id and text, so that reruns and retried tasks agree. The document at the border gives its first words only.

    The order within a source is a prefix sum in two steps: the keys, which are spread evenly by ``1 - exp(-key)``, fall
    into buckets of some ``bucket_rows`` rows; sums of buckets are added up first, then rows within a bucket. No source
    is in one task, however large. ``quality`` (doc_id, weight) has weights of 1 or more; ids without a row or with a NULL
    weigh 1, of several rows the largest counts. It is joined to ids and sizes only, texts are never shuffled.

    NULL or empty text has size 0 and gives nothing; NULL ids are kept; repeated rows are each a document; a source
    without words has target 0; an empty table gives no rows. Other columns are ignored.
    """
    source = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    name = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).cast("binary"))
    rows = docs.select("doc_id", word_count().alias("size"), "source", source.alias("_source"), name.alias("_name"))
    if quality is None:
        rows = rows.withColumn("_weight", F.lit(1.0))
    else:
        best = quality.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("weight").cast("double")).alias("_weight"))
        rows = stored(rows, "words").join(best, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    q = F.greatest(F.coalesce("_weight", F.lit(1.0)), F.lit(1.0))
    u = (F.conv(F.substring("_name", 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    rows = stored(rows.withColumn("_key", -F.log(u) / q).drop("_weight"), "sizes")
    totals = rows.groupBy("source", "_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = stored(source_targets(totals, weights, share, cap), "targets")
    n_buckets = F.ceil(F.col("n_rows") / F.lit(float(bucket_rows)))
    spread = F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * n_buckets)
    rows = rows.drop("source").join(targets, "_source").withColumn("_bucket", F.least(spread, n_buckets - 1).cast("long"))
    sums = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_source", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
    rows = rows.join(stored(starts, "starts"), ["_source", "_bucket"])
    within = Window.partitionBy("_source", "_bucket").orderBy("_key", "_name").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.floor(F.col("target")).cast("long") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(left - ahead, F.col("size")))
    return rows.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).alias("taken"))
