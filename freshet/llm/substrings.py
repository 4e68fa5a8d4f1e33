"""Suffix-array dedup: long byte strings that start at more than one place of the corpus.

A string of ``length`` bytes is sent to a shard by an anchor, the ``GRAM`` bytes inside it with the smallest hash, so equal
strings meet. Consecutive strings with one anchor are a segment; segments whose anchor is at one place of the corpus only
cannot hold a repeat and go no further, which is most text. A shard's segments become one string that is sorted by induction
(see ``suffixes``); neighbours in the order with long common prefixes are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import SpanHash, matching, stored, text_key, text_slices
from freshet.llm.suffixes import QUEUE_BYTES, common_prefixes, suffix_array

LENGTH = 400
GRAM = 100
#: Bytes of segments per shard, and different segments of one anchor beyond which its strings are counted one by one.
SHARD_BYTES = 2 << 20
MOST_SEGMENTS = 2000


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` consecutive values, the first of equal ones, by doubled windows."""
    best = np.arange(len(h))
    size = 1
    while size < width:
        step = min(size, width - size)
        a, b = best[:-step], best[step:]
        best = np.where(h[b] < h[a], b, a)
        size += step
    return best


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first start, strings, anchor hash, segment hash) for runs of strings of a row that have the same anchor."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    spans = SpanHash(data)
    at = np.arange(n - gram + 1)
    best = window_minima(spans.of(at, at + gram), length - gram + 1)
    starts = np.arange(len(best))
    row = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + length <= offsets[row + 1]
    new = inside.copy()
    new[1:] &= (best[1:] != best[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= (best[1:] != best[:-1]) | (row[1:] != row[:-1]) | ~inside[1:]
    first, end = np.flatnonzero(new), np.flatnonzero(last)
    anchor = spans.of(best[first], best[first] + gram)
    # The anchor's place in the segment belongs to its hash, so that equal segments are equal in all respects.
    segment = spans.of(first, end + length) + (best[first] - first).astype(np.uint64)
    return row[first], first - offsets[row[first]], end - first + 1, anchor, segment


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, segment, tkey, start, strings, n) of segments whose anchor has two or more places; n counts equal texts of a batch."""
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(0)):
                keys = batch.column(1).slice(first, end - first)
                number: dict[bytes, int] = {}
                same = np.array([number.setdefault(k, i) for i, k in enumerate(keys.to_pylist())])
                row, start, strings, anchor, segment = segments(data, offsets, length, gram)
                count = np.bincount(same, minlength=end - first)
                some = count[row] > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[some].view(np.int64)), pa.array(segment[some].view(np.int64)), keys.take(pa.array(row[some])),
                     pa.array(start[some]), pa.array(strings[some]), pa.array(count[row[some]])],
                    names=["anchor", "segment", "tkey", "start", "strings", "n"])

    def repeated(batches: Iterator) -> Iterator:
        """Rows of anchors with two or more places, from rows sorted by anchor; at most one row waits for the next batch."""
        import pyarrow as pa

        waiting, done = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            a, n = np.asarray(batch.column(0)), np.asarray(batch.column(5))
            run = np.concatenate([[0], np.cumsum(a[1:] != a[:-1])])
            ok = np.bincount(run, n) >= 2
            if done is not None and a[0] == done:
                ok[0] = True
            last_open = not ok[-1]
            done = None if last_open else a[-1]
            waiting = batch.slice(batch.num_rows - 1) if last_open else None
            yield batch.filter(pa.array(ok[run]))

    schema = "anchor long, segment long, tkey binary, start long, strings long, n long"
    rows = docs.select("text", text_key().alias("tkey")).mapInArrow(scan, schema)
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(repeated, schema)


def repeats_in_shard(pieces: list[bytes], length: int, limit: int = QUEUE_BYTES) -> list[np.ndarray]:
    """Per piece, the places at which a string of ``length`` bytes starts that also starts at another place of the pieces."""
    parts = [np.frombuffer(p, np.uint8).astype(np.uint16) + np.uint16(2) for p in pieces]
    ends = np.cumsum([len(p) + 1 for p in parts])
    t = np.ones(int(ends[-1]) + 1, np.uint16)
    begins = np.concatenate([[0], ends[:-1]])
    for p, b in zip(parts, begins.tolist(), strict=True):
        t[b : b + len(p)] = p
    t[-1] = 0
    prefix, before = common_prefixes(t, suffix_array(t, limit), 1)
    long = np.flatnonzero(prefix >= length)
    hit = np.unique(np.concatenate([long, before[long]]))
    cut = np.searchsorted(hit, np.append(begins, ends[-1]))
    return [hit[cut[k] : cut[k + 1]] - begins[k] for k in range(len(pieces))]


def _runs(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes covered by strings that start at sorted places, as maximal runs."""
    if not len(places):
        return places, places
    gap = np.flatnonzero(np.diff(places) > length)
    return places[np.concatenate([[0], gap + 1])], places[np.concatenate([gap, [len(places) - 1]])] + length


def _small(batches: Iterator, rows: int = 500) -> Iterator:
    """Batches of few rows, for what turns them into Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_COVERED = "anchor long, segment long, lo array<long>, hi array<long>"


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, most: int = MOST_SEGMENTS) -> DataFrame:
    """(tkey, spans): for texts with repeats, the byte runs covered by them as an array of (lo, hi), unordered, stored.

    Equal segments enter a shard once, with their number. An anchor with more than ``most`` different segments, as a line or
    passage of very many documents has, would fill one shard; the strings of its segments are counted one by one instead,
    combined before they are shuffled. That is as exact, and its tasks stay small.
    """
    seen = stored(_occurrences(docs, length, gram), "segments")
    rep = F.min(F.struct("tkey", "start", "strings"))
    unique = seen.groupBy("anchor", "segment").agg(F.sum("n").alias("n"), rep.alias("rep"))
    unique = stored(unique.select("anchor", "segment", "n", "rep.*"), "unique")
    sizes = unique.groupBy("anchor").agg(F.count("*").alias("different"))
    wanted = stored(unique.join(sizes, "anchor").withColumn("hot", F.col("different") > most), "wanted")
    total = wanted.where("NOT hot").agg(F.sum(F.col("strings") + length)).first()[0] or 0
    n_bins = max(12, -(-int(total) // shard_bytes))
    place = F.struct("anchor", "segment", "n", "start", "strings", "different", "hot", F.pmod(F.xxhash64("anchor"), F.lit(n_bins)).alias("bin"))
    per_text = stored(wanted.groupBy(F.col("tkey").alias("_key")).agg(F.collect_list(place).alias("places")), "per_text")
    texts = matching(docs.select(text_key().alias("_key"), "text"), per_text).dropDuplicates(["_key"])

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in _small(batches):
            out: dict[str, list] = {k: [] for k in ("bin", "anchor", "segment", "n", "different", "hot", "piece")}
            held = 0
            for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for p in places:
                    for k in ("bin", "anchor", "segment", "n", "different", "hot"):
                        out[k].append(p[k])
                    out["piece"].append(raw[p["start"] : p["start"] + p["strings"] + length - 1])
                    held += p["strings"] + length
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pydict(out)
                    out, held = {k: [] for k in out}, 0
            yield pa.RecordBatch.from_pydict(out, pa.schema([("bin", pa.int64()), ("anchor", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("different", pa.int64()), ("hot", pa.bool_()), ("piece", pa.binary())]))

    pieces = texts.select("text", "places").mapInArrow(cut, "bin long, anchor long, segment long, n long, different long, hot boolean, piece binary")
    pieces = stored(pieces, "pieces")

    def shard(pdf):
        import pandas as pd

        out = []
        several = pdf[pdf["different"] > 1]
        hits = dict(zip(several.index, repeats_in_shard(several["piece"].tolist(), length), strict=True)) if len(several) else {}
        for i, anchor, segment, n, piece in zip(pdf.index, pdf["anchor"], pdf["segment"], pdf["n"], pdf["piece"], strict=True):
            # A segment that occurs again repeats as a whole.
            places = np.arange(len(piece) - length + 1) if n > 1 else hits.get(i, np.zeros(0, np.int64))
            if len(places):
                lo, hi = _runs(places, length)
                out.append((anchor, segment, lo, hi))
        return pd.DataFrame(out, columns=["anchor", "segment", "lo", "hi"])

    covered = pieces.where("NOT hot").drop("hot").groupBy("bin").applyInPandas(shard, _COVERED)

    def strings(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in _small(batches):
            for anchor, segment, n, piece in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                at = np.arange(len(piece) - length + 1)
                codes = np.frombuffer(piece, np.uint8)
                h1, h2 = SpanHash(codes).of(at, at + length), SpanHash(255 - codes).of(at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(np.full(len(at), anchor)), pa.array(np.full(len(at), segment)),
                     pa.array(at), pa.array(np.full(len(at), n))], names=["h1", "h2", "anchor", "segment", "at", "n"])

    def join_runs(pdf):
        import pandas as pd

        out = [(a, s, *_runs(np.sort(g["at"].to_numpy()), length)) for (a, s), g in pdf.groupby(["anchor", "segment"])]
        return pd.DataFrame(out, columns=["anchor", "segment", "lo", "hi"])

    each = pieces.where("hot").select("anchor", "segment", "n", "piece").mapInArrow(strings, "h1 long, h2 long, anchor long, segment long, at long, n long")
    each = stored(each, "strings")
    again = stored(each.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1").drop("n"), "again")
    hot = each.join(again, ["h1", "h2"], "left_semi").withColumn("bin", F.pmod(F.xxhash64("anchor", "segment"), F.lit(4096)))
    covered = covered.union(hot.select("bin", "anchor", "segment", "at").groupBy("bin").applyInPandas(join_runs, _COVERED))
    covered = stored(covered, "covered")
    spans = seen.join(covered, ["anchor", "segment"]).select(
        "tkey", F.explode(F.zip_with("lo", "hi", lambda a, b: F.struct((a + F.col("start")).alias("lo"), (b + F.col("start")).alias("hi")))).alias("s"))
    return stored(spans.distinct().groupBy("tkey").agg(F.collect_list("s").alias("spans")), "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, most: int = MOST_SEGMENTS,
                   most_keys: int = 500_000) -> DataFrame:
    """(doc_id, n_bytes, spans, kept), one row for each row of ``docs`` (doc_id, text).

    Every byte of the UTF-8 text that is covered by a string of ``length`` bytes which also starts elsewhere in the corpus,
    the same text included, is removed; overlapping occurrences count, strings do not cross texts, and are judged on the
    input. ``spans`` has the maximal removed runs as (lo, hi) in bytes, ``kept`` the bytes left, which need not be valid UTF-8.
    NULL and texts shorter than ``length`` lose nothing; repeated rows are each other's repeats; NULL ids are kept; an empty
    table gives no rows. Other columns are ignored. Segments and anchors are known by 64-bit hashes; inside a shard bytes are
    compared.
    """
    spans = repeated_spans(docs.select("text"), length, gram, shard_bytes, most)

    def remove(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in _small(batches):
            n, runs, kept = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                merged: list[list[int]] = []
                for s in sorted((s["lo"], s["hi"]) for s in found or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                at, left = 0, []
                for lo, hi in merged:
                    left.append(raw[at:lo])
                    at = hi
                n.append(len(raw))
                runs.append([{"lo": lo, "hi": hi} for lo, hi in merged])
                kept.append(b"".join([*left, raw[at:]]))
            span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    side = spans.select(F.col("tkey").alias("_key"), "spans")
    rows = docs.select("doc_id", "text", text_key().alias("_key"))
    if side.count() <= most_keys:
        # Only texts with repeats are shuffled; the others are known by a broadcast of the keys.
        clean = rows.join(F.broadcast(side.select("_key")), "_key", "left_anti").withColumn("spans", F.lit(None).cast(side.schema["spans"].dataType))
        joined = matching(rows, side, most_keys).unionByName(clean)
    else:
        joined = rows.join(side.hint("merge"), "_key", "left")
    joined = joined.select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, f"doc_id {kind}, n_bytes long, spans array<struct<lo:long,hi:long>>, kept binary")
