"""Exact top-k search over vector-approximation files.

Every component is cut into cells; the cells of all candidates are scanned for bounds on the score of every query. Exact
vectors are read in the order of their bounds, in two rounds: those with the best ones first, then those whose bound still
reaches the k-th best exact score, with which the result is certain. Queries meet candidates in blocks of bounded size; the
query set is stated by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import stored

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
#: Bits of a cell number, up to 7; a component's range is cut into so many equal cells.
BITS = 7


def integer_vector(v: Column) -> Column:
    """floor(256 * x) of each component."""
    return F.transform(v, lambda x: F.floor(x.cast("double") * 256.0).cast("long"))


def _distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids): ids of equal vectors in order, repeated ones as well, as many as can be among the k best of a query with any
    id of its own: ``k`` of each id and ``2 * k`` in all. In two steps, since one vector may have very many copies."""
    spread = rows.withColumns({"_v": F.xxhash64("vec"), "_s": F.pmod(F.hash("vec_id"), F.lit(64))})
    for keys in (["_v", "vec", "_s"], ["_v", "vec"]):
        again = F.row_number().over(Window.partitionBy(*keys, "vec_id").orderBy("vec_id"))
        spread = spread.withColumn("_n", again).where(F.col("_n") <= k)
        spread = spread.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).where(F.col("_n") <= 2 * k)
    return spread.groupBy("_v", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("vec", "ids")


def _matrix(series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in series]) if len(series) else np.zeros((0, 0), np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``, both (vec_id, vec) with vectors
    of integers. The score is the inner product, ties go to the smaller id; a query's own id is left out.

    NULL ids or vectors, and vectors that hold NULL, take no part. Vectors are compared with those of their own length. Equal
    rows are rows of their own: as candidates each takes a rank, as queries each has its ranks. An id may have several
    vectors; fewer than k others give fewer rows; empty tables give none.
    """
    return _searched(vectors, queries, k, bits).select("query_id", "rank", "vec_id", "score")


def _searched(vectors: DataFrame, queries: DataFrame, k: int, bits: int) -> DataFrame:
    """``top_k`` with the round in which the vector was read."""
    def valid(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "vec").where("vec_id IS NOT NULL AND vec IS NOT NULL").where(~F.exists("vec", lambda x: x.isNull()))

    spark = vectors.sparkSession
    rows, asked = stored(valid(vectors), "vectors"), valid(queries)
    stat = rows.agg(F.max(F.size("vec")).alias("d"), F.min(F.array_min("vec")).alias("lo"), F.max(F.array_max("vec")).alias("hi")).first()
    if not stat["d"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, round int")
    # The range of all components, two numbers, gives the cells their borders.
    lo, step = int(stat["lo"]), max(1, -(-(int(stat["hi"]) - int(stat["lo"]) + 1) // (1 << bits)))
    rows, asked = rows.where(F.size("vec") > 0), asked.where(F.size("vec") > 0)
    distinct = _distinct_vectors(rows, k).withColumn("node", F.monotonically_increasing_id())
    distinct = stored(distinct, "distinct")

    n_c = max(1, -(-distinct.count() // CANDIDATE_BLOCK))
    asked = stored(asked.withColumn("no", F.monotonically_increasing_id()), "queries")
    n_q = max(1, -(-asked.count() // QUERY_BLOCK))
    cells = F.transform("vec", lambda x: ((x - lo) / step).cast("int").cast("byte"))
    cand = distinct.select("node", "ids", cells.alias("cells"), F.size("vec").alias("_d"), F.pmod(F.xxhash64("node"), F.lit(n_c)).alias("_c"))
    cand = cand.withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    ask = asked.withColumns({"_q": F.pmod(F.xxhash64("no"), F.lit(n_q)).cast("int"), "_d": F.size("vec")})
    ask = ask.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))

    def scan(left, right):
        """Bounds from the cells; kept where the upper one reaches the k-th best lower one of this block."""
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"no": [], "node": [], "n": [], "low": [], "high": []}).astype("int64")
        q = _matrix(left["vec"]).astype(float)
        low = _matrix(right["cells"]).astype(float) * step + lo
        high = low + (step - 1)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        # Whole numbers below 2**53 in floating point, so the products are exact.
        lower = up @ low.T + down @ high.T
        upper = up @ high.T + down @ low.T
        # A node stands for its copies, less those with the query's own id.
        copies = np.array([len(x) for x in right["ids"]])
        id_of, at = np.concatenate(list(right["ids"])), np.repeat(np.arange(len(copies)), copies)
        order = np.argsort(id_of, kind="stable")
        id_of, at = id_of[order], at[order]
        mine = left["vec_id"].to_numpy()
        first, last = np.searchsorted(id_of, mine), np.searchsorted(id_of, mine, side="right")
        others = np.tile(copies, (len(q), 1))
        for i in np.flatnonzero(last > first):
            np.subtract.at(others[i], at[first[i] : last[i]], 1)
        top = min(k + 1, len(low))
        order = np.argpartition(-lower, top - 1, axis=1)[:, :top]
        best = np.take_along_axis(lower, order, axis=1)
        by_bound = np.argsort(-best, axis=1, kind="stable")
        order, best = np.take_along_axis(order, by_bound, axis=1), np.take_along_axis(best, by_bound, axis=1)
        enough = np.cumsum(np.take_along_axis(others, order, axis=1), axis=1) >= k
        bar = np.where(enough.any(axis=1), best[np.arange(len(q)), np.argmax(enough, axis=1)], -np.inf)
        i, j = np.nonzero((upper >= bar[:, None]) & (others > 0))
        return pd.DataFrame({
            "no": left["no"].to_numpy()[i], "node": right["node"].to_numpy()[j], "n": others[i, j],
            "low": lower[i, j].astype("int64"), "high": upper[i, j].astype("int64")})

    blocks = ask.groupBy("_d", "_q", "_c").cogroup(cand.groupBy("_d", "_q", "_c"))
    bounds = stored(blocks.applyInPandas(scan, "no long, node long, n long, low long, high long"), "bounds")
    # The k-th best lower bound over all blocks.
    by_low = Window.partitionBy("no").orderBy(F.desc("low"), "node").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bounds.withColumn("ahead", F.sum("n").over(by_low))
    bar = ranked.where(F.col("ahead") >= k).groupBy("no").agg(F.max("low").alias("bar"))
    alive = bounds.join(bar, "no", "left").where(F.col("high") >= F.coalesce("bar", "high")).select("no", "node", "n", "high")
    by_high = Window.partitionBy("no").orderBy(F.desc("high"), "node").rowsBetween(Window.unboundedPreceding, -1)
    alive = stored(alive.withColumn("round", F.when(F.coalesce(F.sum("n").over(by_high), F.lit(0)) < 2 * k, 1).otherwise(2)), "alive")

    def read(some: DataFrame) -> DataFrame:
        """Exact scores of the nodes' rows other than the query's own id."""
        pairs = some.join(distinct, "node").join(asked.select("no", F.col("vec_id").alias("query_id"), F.col("vec").alias("qvec")), "no")
        score = F.aggregate(F.zip_with("vec", "qvec", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return pairs.select("no", "query_id", score.alias("score"), "round", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")

    best = Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")

    def kept(scored: DataFrame) -> DataFrame:
        return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = stored(kept(read(alive.where("round = 1"))), "first")
    certain = first.where(F.col("rank") == k).select("no", F.col("score").alias("bar"))
    rest = alive.where("round = 2").join(certain, "no", "left").where(F.col("high") >= F.coalesce("bar", "high")).drop("bar")
    result = kept(first.drop("rank").unionByName(read(rest)))
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "round")
