"""Helpers of the text operators: stored tables, components, and vectorised words and hashes inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.session import stored

__all__ = ["stored", "text_key", "let", "bounded_broadcast", "matching", "components", "text_slices", "word_spans", "SpanHash", "mix64"]


def text_key(text: str = "text") -> Column:
    """16 bytes that stand for a text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    The optimizer moves an expression that is referred to once to where it is used; inside a lambda it would be computed
    again for each element. A lambda variable cannot be moved.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bounded_broadcast(side: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """A *stored* join side with rows of a few dozen bytes: broadcast when it is counted to be small, else shuffled.

    The count comes from the footers of the stored files.
    """
    return F.broadcast(side) if side.count() <= max_rows else side.hint("merge")


def matching(docs: DataFrame, side: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """``docs`` with a column ``_key`` joined to a *stored* side whose rows hold arrays of any length.

    Never the arrays but only the keys are broadcast, when counted to be few; what they leave of the documents is shuffled.
    """
    keys = side.select("_key")
    if keys.count() <= max_rows:
        docs = docs.join(F.broadcast(keys), "_key", "left_semi")
    return docs.join(side.hint("merge"), "_key")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for edges (a, b) of longs: the smallest node that can be reached.

    Alternating large-star and small-star steps. Each is an aggregate with a map-side combine and a join on the node, so
    no neighbourhood is gathered; every round is written to the shared folder and read back, which cuts the lineage.
    Self-loops are allowed and give a node its own component.
    """
    def lowest(directed: DataFrame) -> DataFrame:
        """Directed pairs (u, v) with the smallest of u and its neighbours."""
        least = directed.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        return directed.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))

    def mark(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()

    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = mark(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lowest(both).where("v >= u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = lowest(large)
        pairs = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
        e = stored(pairs.select("p.u", "p.v").distinct(), "edges")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


# --- inside tasks ---------------------------------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces (first row, end row, bytes, offsets) of an Arrow string column, about ``limit`` bytes each; NULL is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    whole = pc.fill_null(column, "").cast(pa.large_binary())
    if len(whole) == 0:
        return
    bounds = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(whole):
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row): maximal runs of bytes marked in ``word_byte``; runs end with their row."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = word_byte[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class SpanHash:
    """64-bit hashes of byte spans of one piece of text, from one prefix sum."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        if len(SpanHash._powers) < n:
            size = max(n, 1 << 21)
            SpanHash._powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, _ODD)]))
            SpanHash._inverses = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, _INVERSE)]))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * SpanHash._powers[: n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * SpanHash._inverses[starts])
