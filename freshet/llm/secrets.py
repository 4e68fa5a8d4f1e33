"""Secret scans with corpus-wide ownership frequency. Built from DataFrame operations only.

Patterns give candidates with their places. Hashes of the candidates are counted over the whole corpus by distinct
repositories and owners: one that many owners share is a copied example, one that stays with its owner looks live. Bare
copies of live-looking values, without the words that gave them away, are found as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import bounded_broadcast, stored, text_key

# The kinds in order, their patterns, the group that holds the value and its least length.
KINDS = [
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
]
#: Only texts with such a run are searched for hex.
_LONG_HEX = "[0-9a-f]{24}"
#: A bare value: a whole run of value characters that has a digit and is long enough.
_BARE = "(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*+[0-9])[A-Za-z0-9+/_.=-]{%d,}"
VALUE_LENGTH = 16
#: A value with at most so many owners looks live.
LIVE_OWNERS = 1

_SPANS = "array<struct<kind:string,no:int,start:int,end:int,value:string>>"


def _find(text: Column, pattern: str, group: int, least: int, kind: str, no: int) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The text between matches comes from splitting by the pattern; running lengths give the places.
    """
    empty = F.from_json(F.lit("[]"), _SPANS)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), F.lit(no).alias("no"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        keep = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(parts, start, step, lambda acc: acc["spans"])


def candidates(text: Column) -> Column:
    """All candidates of a text as an array of (kind, no, start, end, value), by start, then kind."""
    empty = F.from_json(F.lit("[]"), _SPANS)
    found = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        probe = _LONG_HEX if kind == "hex" else pattern
        shorter = pattern.replace("]+", "]{%d,}" % least) if kind == "hex" else pattern
        found.append(F.when(text.rlike(probe), _find(text, shorter, group, least, kind, no)).otherwise(empty))
    return _by_place(F.concat(*found))


def ownership(found: DataFrame, live_owners: int = LIVE_OWNERS) -> DataFrame:
    """(value_hash, n_repositories, n_owners, n_uses, live) for rows (value_hash, repository, owner), NULLs as one value.

    Uses are first summed by hash, repository and owner, so a value in a third of all rows costs a row per task.
    """
    uses = found.groupBy("value_hash", "repository", "owner").agg(F.count("*").alias("n"))
    per_hash = uses.groupBy("value_hash").agg(
        F.count_distinct(F.struct("repository")).alias("n_repositories"), F.count_distinct(F.struct("owner")).alias("n_owners"),
        F.sum("n").alias("n_uses"),
    )
    return per_hash.withColumn("live", F.col("n_owners") <= live_owners)


def _by_place(spans: Column | str) -> Column:
    return F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["no"] - b["no"]))


def _scan(docs: DataFrame, repository: str, owner: str, live_owners: int, value_length: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows (_row, _key, doc_id, base) of all documents and (_row, spans, n_live, n_examples) of those with spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    pattern = _BARE % value_length
    bare_runs = F.when(text.rlike(pattern), _find(text, pattern, 0, value_length, "value", len(KINDS)))
    rows = docs.select(
        "doc_id", text_key().alias("_key"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"), candidates(text).alias("base"),
        F.coalesce(bare_runs, F.from_json(F.lit("[]"), _SPANS)).alias("bare"),
    )
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "scanned")
    hashed = F.unhex(F.md5(F.col("c.value").cast("binary"))).alias("value_hash")
    uses = rows.select("_row", "repository", "owner", F.explode("base").alias("c")).withColumn("value_hash", hashed)
    owned = stored(ownership(uses, live_owners), "owned").select("value_hash", "live")
    long_enough = uses.where(F.length("c.value") >= value_length).select("value_hash").distinct()
    live = owned.where("live").join(long_enough, "value_hash", "left_semi")
    inside = F.exists("base", lambda b: (b["start"] <= F.col("c.start")) & (b["end"] >= F.col("c.end")))
    bare = rows.where(F.size("bare") > 0).select("_row", "base", F.explode("bare").alias("c"))
    bare = bare.where(~inside).select("_row", "c", hashed)
    judged = uses.select("_row", "c", "value_hash").join(owned, "value_hash").union(
        bare.join(live, "value_hash").select("value_hash", "_row", "c", "live"))
    per_row = judged.groupBy("_row").agg(
        F.collect_list(F.struct("c.kind", "c.no", "c.start", "c.end", "c.value", "live")).alias("spans"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_examples"),
    )
    return rows.select("_row", "_key", "doc_id", "base"), stored(per_row.withColumn("spans", _by_place("spans")), "spans")


def scan_secrets(
    docs: DataFrame, repository: str = "source", owner: str = "source", live_owners: int = LIVE_OWNERS,
    value_length: int = VALUE_LENGTH,
) -> DataFrame:
    """(doc_id, base, spans, n_live, n_examples), one row for each row of ``docs`` (doc_id, text, repository, owner).

    ``base`` has the matches of the patterns as (kind, no, start, end, value). ``spans``, with a ``live`` flag each, adds
    kind ``value``: runs of value characters that equal, as a whole, a live-looking value of ``value_length`` or more
    characters found by a pattern anywhere in the corpus, and that no base span contains. ``n_live`` counts the spans whose
    value at most ``live_owners`` owners have, ``n_examples`` the others. NULL and empty texts have no spans; a NULL
    repository or owner counts as one of its own; repeated rows are each scanned; an empty table gives no rows. Other
    columns are ignored. Values are compared by 128 bits of hash.
    """
    rows, per_row = _scan(docs, repository, owner, live_owners, value_length)
    none = F.array().cast("array<struct<kind:string,no:int,start:int,end:int,value:string,live:boolean>>")
    return rows.join(per_row, "_row", "left").select(
        "doc_id", "base", F.coalesce("spans", none).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
    )


def redact_secrets(
    docs: DataFrame, repository: str = "source", owner: str = "source", mark: str = "[secret]",
    live_owners: int = LIVE_OWNERS, value_length: int = VALUE_LENGTH,
) -> DataFrame:
    """The rows of ``docs``, all columns, with live-looking values in ``text`` replaced by ``mark``; see ``scan_secrets``.

    Spans depend on the text alone, so they are joined by its key. Copied examples and texts without live-looking values,
    NULL and empty ones among them, stay as they are.
    """
    rows, per_row = _scan(docs, repository, owner, live_owners, value_length)
    kept = per_row.where("n_live > 0").select("_row", F.filter("spans", lambda s: s["live"]).alias("_spans"))
    per_text = kept.join(rows.select("_row", F.col("_key").alias("_hit_key")), "_row")
    per_text = stored(per_text.groupBy("_hit_key").agg(F.first("_spans").alias("_spans")), "live")

    def step(acc: Column, s: Column) -> Column:
        start = s["end"] - F.length(s["value"])
        piece = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, start - acc["at"]), F.lit(mark))
        apart = start >= acc["at"]
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.when(apart, piece).otherwise(acc["out"]).alias("out"))

    end = F.length("text")
    redacted = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                           lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, end - acc["at"])))
    joined = docs.join(bounded_broadcast(per_text, 200_000), text_key() == F.col("_hit_key"), "left")
    new = F.when(F.col("_spans").isNotNull(), redacted).otherwise(F.col("text"))
    return joined.select(*[new.alias("text") if c == "text" else docs[c] for c in docs.columns])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
