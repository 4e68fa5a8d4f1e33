"""Benchmark decontamination by winnowing. Built from DataFrame operations only.

Fingerprints are hashes of ``K`` consecutive words; of each ``SPAN - K + 1`` consecutive ones the smallest is kept, so
every shared run of ``SPAN`` words shares a kept fingerprint. Shared fingerprints place an item in a document; there the
words are compared one by one and matching runs are extended over the whole item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import bounded_broadcast, let, stored, text_key

SPAN = 10
K = 7

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# Single characters, not ranges: the matcher looks those up in one table.
_BREAKS = "".join(f"\\x{i:02X}" for i in range(128) if not chr(i).isalnum())


def words_of(text: str = "text") -> Column:
    """Words of digits, Latin letters and anything beyond ASCII, A-Z lower-cased; NULL has none."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), f"[{_BREAKS}]+")
    # lower() is quick, and right where it changes nothing; only words with capitals are translated.
    plain = F.transform(parts, lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, _UPPER, _UPPER.lower())))
    return F.filter(plain, lambda w: w != "")


def _grams(hashes: str, k: int) -> Column:
    """Hash of the ``k`` words from each position on; ``hashes`` names an array of word hashes of at least k entries."""
    h = F.col(hashes)
    at = F.sequence(F.lit(0), F.size(h) - k)
    return F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(h, i + j) for j in range(k)]))


def _kept(grams: str, width: int) -> Column:
    """Positions of the smallest fingerprint of every ``width`` consecutive ones, the last of equal ones."""
    g = F.col(grams)

    def lowest(i: Column) -> Column:
        return F.least(*[F.struct(F.get(g, i + j).alias("g"), (-(i + j)).alias("back")) for j in range(width)])["back"]

    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(g) - width), lambda i: -lowest(i)))


_NONE = "array<struct<g:bigint,at:int>>"


def fingerprints(df: DataFrame, words: str, span: int, k: int, short: list[int]) -> DataFrame:
    """Adds ``_fps``, an array of (g, at): the winnowed ones, and every gram of the lengths in ``short``.

    Lengths in ``short`` are those of items with fewer than ``span`` words: each is a window of its own.
    """
    empty = F.from_json(F.lit("[]"), _NONE)
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", F.when(F.size("_h") >= span, _grams("_h", k)))
    kept = F.transform(_kept("_g", span - k + 1), lambda p: F.struct(F.get(F.col("_g"), p).alias("g"), p.alias("at")))
    parts = [F.when(F.size("_h") >= span, kept).otherwise(empty)]
    for m in short:
        every = F.transform(_grams("_h", m), lambda g, i: F.struct(F.xxhash64(F.lit("short"), g).alias("g"), i.alias("at")))
        parts.append(F.when(F.size("_h") >= m, every).otherwise(empty))
    return df.withColumn("_fps", F.concat(*parts)).drop("_h", "_g")


def find_items(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(_key, hits, items, n_items): for texts that hold a window of an item, the places of the words hit and the items.

    ``_key`` is the key of the text, so copies are looked up once. Items come as (item_id, text). Fingerprints of the items
    are stored; the planner broadcasts them when small and shuffles on the fingerprint otherwise. An item with a NULL id
    hits words but is neither listed nor counted; items that share an id count once.
    """
    items = items.select(F.col("item_id").cast("string").alias("_item"), words_of().alias("_words")).where(F.size("_words") > 0)
    items = stored(items.distinct().withColumn("_no", F.monotonically_increasing_id()), "items")
    short = [r[0] for r in items.where(F.size("_words") < span).select(F.size("_words").alias("m")).distinct().orderBy("m").collect()]
    marks = fingerprints(items, "_words", span, k, [])
    own = F.when(F.size("_words") >= span, F.col("_fps"))
    for m in short:
        whole = F.xxhash64(F.lit("short"), F.xxhash64(F.lit(m), *[F.xxhash64(F.get("_words", F.lit(j))) for j in range(m)]))
        own = own.when(F.size("_words") == m, F.array(F.struct(whole.alias("g"), F.lit(0).alias("at"))))
    marks = marks.select("_no", F.size("_words").alias("_m"), F.explode_outer(own).alias("f"))
    marks = stored(marks.select(F.col("f.g").alias("g"), "_no", "_m", F.col("f.at").alias("_j")), "marks")

    seen = fingerprints(docs.select(text_key().alias("_key"), words_of().alias("_w")), "_w", span, k, short)
    # Outer, since the optimizer would compute the array once more in a filter below an inner one; the join drops NULL.
    seen = seen.select("_key", F.explode_outer("_fps").alias("f")).select("_key", F.col("f.g").alias("g"), F.col("f.at").alias("_i"))
    places = seen.join(marks, "g").select("_key", "_no", "_m", (F.col("_i") - F.col("_j")).alias("_shift")).distinct()

    # One array of places per text; the texts are filtered by it before anything is shuffled, if it is small.
    per_text = stored(places.groupBy("_key").agg(F.collect_list(F.struct("_no", "_m", "_shift")).alias("_places")), "places")
    texts = docs.select(text_key().alias("_key"), "text").join(bounded_broadcast(per_text, 200_000), "_key")
    texts = texts.dropDuplicates(["_key"])
    # What stands in the places of the item's words, NULL beyond the document's ends.
    cut = let(words_of(), lambda w: F.transform("_places", lambda p: F.struct(
        p["_no"].alias("_no"), p["_shift"].alias("_shift"),
        F.transform(F.sequence(F.lit(0), p["_m"] - 1), lambda t: F.get(w, t + p["_shift"])).alias("_part"))))
    spots = texts.select("_key", F.explode_outer(cut).alias("p")).select("_key", "p.*").join(items, "_no")
    spots = spots.select("_key", "_item", "_shift", F.size("_words").alias("_m"), "_part", "_words")
    # Places of the item at which an occurrence of a window ends.
    width = F.least(F.col("_m"), F.lit(span))
    ends = let(
        F.zip_with("_part", "_words", lambda a, b: F.coalesce(a == b, F.lit(False))),
        lambda same: F.filter(F.sequence(width - 1, F.col("_m") - 1), lambda t: F.forall(F.slice(same, t - width + 2, width), lambda x: x)))
    spots = spots.withColumn("_ends", ends).where(F.size("_ends") > 0)
    hit = F.array_distinct(F.flatten(F.transform("_ends", lambda t: F.sequence(t - width + 1 + F.col("_shift"), t + F.col("_shift")))))
    spots = spots.select("_key", "_item", F.explode_outer(hit).alias("_at")).distinct()
    hits = spots.select("_key", "_at").distinct().groupBy("_key").agg(F.array_sort(F.collect_list("_at")).alias("hits"))
    named = spots.where(F.col("_item").isNotNull()).select("_key", "_item").distinct()
    named = named.groupBy("_key").agg(F.array_sort(F.collect_list("_item")).alias("items"))
    return hits.join(named, "_key", "left")


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row for each row of ``docs`` (doc_id, text).

    A window is ``span`` consecutive words of an item, or a whole item of fewer words; ``n_hit`` counts the words of a
    document inside any occurrence of any window. NULL and empty texts have no words; items without words match nothing;
    repeated rows are each judged; empty tables give no rows, or no hits. Other columns are ignored.
    """
    found = stored(find_items(docs.select("doc_id", "text"), items, span, k), "found")
    slim = found.select("_key", F.size("hits").cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    word_count = F.coalesce(F.regexp_count("text", F.lit(f"[^{_BREAKS}]+")), F.lit(0)).cast("long")
    rows = docs.select("doc_id", text_key().alias("_key"), word_count.alias("n_words"))
    rows = rows.join(slim, "_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """The rows of ``docs``, all columns, without any word inside an occurrence of a window; see ``decontaminate``."""
    found = stored(find_items(docs.select("text"), items, span, k).select(F.col("_key").alias("_hit_key")), "hit_texts")
    return docs.join(bounded_broadcast(found), text_key() == F.col("_hit_key"), "left_anti")
