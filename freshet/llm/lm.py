"""LM scoring by stupid backoff: n-gram counts partitioned by hash meet the n-grams of the documents and are summed per document.

Documents are dealt into slices of some megabytes. A slice's distinct n-grams, with their numbers in the slice, go to the
partitions of the count table; there the numbers of all slices are added up, and each slice gets the totals of its own
n-grams back, in its own order. So counts are combined before the shuffle, a frequent n-gram is one row per slice, and no
table is ever broadcast. Words and pairs are asked for first. A longer n-gram is in the table only if both its parts of one word
less are, so after their answers only such ones are asked for, one order at a time; most longer n-grams occur once and never
travel. Numbers travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import SpanHash, mix64, stored, text_key, text_slices, word_spans

ORDER = 2
BACKOFF = 0.4
#: N-grams of two and more words seen less often are not in the table.
LEAST_COUNT = 2
SLICE_BYTES = 8 << 20

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = (_BYTES != 32) & ~((_BYTES >= 9) & (_BYTES <= 13))


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, bounds of the texts) of an Arrow column of texts."""
    hashes, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, data, offsets in text_slices(texts):
        low = _LOWER[data]
        starts, ends, before = word_spans(low, offsets, _WORD)
        hashes.append(SpanHash(low).of(starts, ends))
        bounds.append(before[1:] + bounds[-1][-1])
    return np.concatenate(hashes), np.concatenate(bounds)


def gram_hashes(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n words that end at a place, place) wherever a text has so many."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(np.arange(len(h)) - bounds[doc] >= n - 1)
    g = h[at - n + 1]
    for j in range(n - 2, -1, -1):
        g = mix64(g * np.uint64(0x9E3779B97F4A7C15) + h[at - j])
    return g, at


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of as many bytes as the largest one needs, its number first."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)
    # Highest bytes differ little and are pressed; the others are as good as random.
    top = press(np.ascontiguousarray(body[:, width - 1]))
    return bytes([width]) + len(top).to_bytes(4, "little") + top + body[:, : width - 1].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width, size = raw[0], int.from_bytes(raw[1:5], "little")
    top = np.frombuffer(expand(raw[5 : 5 + size]), np.uint8)
    wide = np.zeros((len(top), 8), np.uint8)
    wide[:, width - 1] = top
    wide[:, : width - 1] = np.frombuffer(raw, np.uint8, offset=5 + size).reshape(len(top), width - 1)
    return np.cumsum(wide.view("<u8").ravel().astype(np.uint64), dtype=np.uint64)


def press(x) -> bytes:
    """Bytes compressed, their number first. What tasks exchange is mostly small counts, which need few bits."""
    import pyarrow as pa

    size = memoryview(x).nbytes
    return size.to_bytes(8, "little") + (pa.compress(x, codec="zstd", asbytes=True) if size else b"")


def expand(raw: bytes) -> bytes:
    import pyarrow as pa

    size = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def narrow(x: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest one needs, the size first; bytes of one place together, compressed."""
    size = next(b for b in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * b)
    return bytes([size]) + press(np.ascontiguousarray(x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T))


def widen(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(raw[1:]), np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel().astype(np.int64)


def bundles(batches: Iterator) -> Iterator:
    """(slice, ids, sizes, texts): the rows (slice, doc_id, text) of a batch that go to one slice, their texts compressed as one."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        to = batch.column(0).to_numpy()
        order = np.argsort(to, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(to[order])) + 1, [len(to)]]) if len(to) else [0]
        out: dict[str, list] = {"slice": [], "ids": [], "sizes": [], "texts": []}
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            rows = pa.array(order[lo:hi])
            texts = pc.fill_null(batch.column(2).take(rows), "").to_pylist()
            raw = [t.encode() for t in texts]
            out["slice"].append(int(to[order[lo]]))
            out["ids"].append(batch.column(1).take(rows).to_pylist())
            out["sizes"].append([len(r) for r in raw])
            out["texts"].append(press(b"".join(raw)))
        yield pa.RecordBatch.from_pydict(out, pa.schema([("slice", pa.int64()), ("ids", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())]))


def unbundled(pdf):
    """(ids, texts) of a slice's bundles, texts as an Arrow column."""
    import pyarrow as pa

    sizes = np.concatenate([np.zeros(0, np.int64), *pdf["sizes"]])
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    raw = b"".join(expand(x) for x in pdf["texts"])
    return [i for ids in pdf["ids"] for i in ids], pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw)])


def lm_scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least_count: int = LEAST_COUNT, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_backed, log_score, mean_log_score), one row for each row of ``docs`` (doc_id, text).

    Words are runs other than white space, A-Z lower-cased. A word after its ``order - 1`` predecessors in the text scores
    ``count(gram) / count(gram without its last word)`` if the gram is in the table, else ``backoff`` times its score after
    one predecessor fewer; a single word scores ``count / words of the corpus``. Counts are over the whole corpus;
    n-grams of two or more words are in the table from ``least_count`` on. ``log_score`` is the sum of natural logarithms,
    ``n_backed`` the number of steps back, the mean is per word.

    NULL and empty texts have no words, log_score 0 and a NULL mean; NULL ids are kept; repeated rows count each time and are
    each scored; an empty table gives no rows. Other columns are ignored. N-grams are known by 64-bit hashes.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_slices = max(1, -(-int(size) // slice_bytes))
    n_buckets = max(8, n_slices)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # As text, since a column of whole numbers with NULL would become floating point.
    sliced = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.pmod(F.xxhash64(F.col("doc_id"), text_key()), F.lit(n_slices)).alias("slice"))
    sliced = sliced.select("slice", "doc_id", "text").mapInArrow(bundles, "slice long, ids array<string>, sizes array<long>, texts binary")
    shift = np.uint64(32)

    def grams(h: np.ndarray, bounds: np.ndarray, known: dict[int, np.ndarray], upto: int, first: int = 1):
        """Per order: (order, distinct n-grams asked for in order of bucket and hash, their numbers, places of all n-grams, which
        of them are asked for, place of each one's answer). Of three words and more only those are asked for whose two shorter
        ones are in the table, since the others can't be; ``known`` has the answers of the orders before."""
        prior = None
        for n in range(first, upto + 1):
            g, at = gram_hashes(h, bounds, n)
            asked = np.ones(len(at), bool) if prior is None else (prior[at] >= least_count) & (prior[at - 1] >= least_count)
            keys, inverse, count = np.unique(g[asked], return_inverse=True, return_counts=True)
            yield n, keys, count, at, asked, inverse
            if 1 < n < upto:
                prior = np.zeros(len(h), np.int64)
                prior[at[asked]] = known[n][inverse] if len(keys) else 0

    def totals(answers) -> dict[int, np.ndarray]:
        return {n: np.concatenate([widen(x) for x in a.sort_values("bucket")["totals"]]) for n, a in answers.groupby("n")}

    def buckets(keys: np.ndarray) -> np.ndarray:
        """First place of each bucket: ranges of the sorted hashes."""
        edge = (keys >> shift) * np.uint64(n_buckets) >> shift
        return np.searchsorted(edge, np.arange(n_buckets + 1, dtype=np.uint64))

    def asking(texts, known: dict[int, np.ndarray], orders: range):
        import pandas as pd

        h, bounds = word_hashes(unbundled(texts)[1])
        out = []
        for n, keys, count, _, _, _ in grams(h, bounds, known, orders[-1], min(orders[0], 2)):
            cut = buckets(keys)
            for b in np.flatnonzero(np.diff(cut)).tolist() if n in orders else []:
                part = slice(cut[b], cut[b + 1])
                out.append((n, b, texts["slice"].iloc[0], pack(keys[part]), narrow(count[part])))
        return pd.DataFrame(out, columns=["n", "bucket", "slice", "keys", "counts"])

    def add(pdf):
        keys = [unpack(k) for k in pdf["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([widen(c) for c in pdf["counts"]])
        totals = np.bincount(inverse, counts)[inverse].astype(np.int64)
        out = pdf[["slice", "n", "bucket"]].copy()
        out["totals"] = [narrow(x) for x in np.split(totals, ends[:-1])]
        return out

    def tell(texts, answers):
        import pandas as pd

        ids, texts = unbundled(texts)
        h, bounds = word_hashes(texts)
        known = totals(answers)
        score, steps = np.zeros(len(h)), np.zeros(len(h), np.int64)
        lower = np.zeros(len(h))
        for n, keys, _, at, asked, inverse in grams(h, bounds, known, order):
            if not len(at):
                break
            count = np.zeros(len(at))
            if len(keys):
                count[asked] = known[n][inverse]
            if n == 1:
                score = np.log(count)  # less the logarithm of the corpus' words, below
                lower = count
                backed = np.ones(len(h), np.int64)
                continue
            kept = count >= least_count
            # The gram without its last word is the one that ends a place before.
            under = lower[at - 1]
            old = score[at] + np.log(backoff)
            score[at] = np.where(kept, np.log(np.maximum(count, 1)) - np.log(np.maximum(under, 1)), old)
            steps[at] = np.where(kept, 0, steps[at] + 1)
            backed[at] = np.where(kept, 0, backed[at])
            lower = np.zeros(len(h))
            lower[at] = count
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        total = lambda x: np.bincount(doc, x, minlength=len(texts))
        single = backed if len(h) else np.zeros(0, np.int64)
        return pd.DataFrame({
            "doc_id": np.array(ids, object), "n_words": np.diff(bounds), "n_backed": total(steps).astype(np.int64),
            "n_single": total(single).astype(np.int64), "score": total(score)})

    def ask_first(texts):
        return asking(texts, {}, range(1, min(order, 2) + 1))

    def ask_longer(n: int):
        return lambda texts, answers: asking(texts, totals(answers), range(n, n + 1))

    schema, answered = "n int, bucket int, slice long, keys binary, counts binary", None
    for upto in range(min(order, 2), order + 1):
        if answered is None:
            asked = sliced.groupBy("slice").applyInPandas(ask_first, schema)
        else:
            asked = sliced.groupBy("slice").cogroup(answered.groupBy("slice")).applyInPandas(ask_longer(upto), schema)
        new = asked.groupBy("n", "bucket").applyInPandas(add, "slice long, n int, bucket int, totals binary")
        answered = new if answered is None else answered.union(new)
    told = sliced.groupBy("slice").cogroup(answered.groupBy("slice")).applyInPandas(
        tell, "doc_id string, n_words long, n_backed long, n_single long, score double")
    told = stored(told, "told")
    words = told.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    log_score = F.col("score") - F.col("n_single") * F.lit(float(np.log(max(words, 1))))
    return told.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_words", "n_backed", log_score.alias("log_score"), F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"))
