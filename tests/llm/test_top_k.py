"""Exact top-k search on vectors of several lengths, repeated rows, ids with several vectors; how much of them is read."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from freshet.llm import topk
from freshet.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, vec array<long>"


def plain(rows, queries, k):
    out = []
    for q, a in queries:
        found = sorted((-int(np.dot(a, b)), i) for i, b in rows if i != q and len(a) == len(b))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def corpus(seed):
    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(0, 150)), rng.integers(-9, 9, rng.choice([2, 3, 6])).tolist()) for _ in range(400)]
    rows += [(7, [1, 1, 1])] * 20 + [(i, [9, 9, 9]) for i in range(30)] * 2 + [(50, [8] * 6)] * 9
    return rows


@pytest.mark.parametrize("blocks", [(512, 4096), (9, 40)])
def test_lengths_repeated_rows_and_ids_with_several_vectors(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    rows = corpus(3)
    queries = [r for r in rows if r[0] % 10 == 0]
    df = spark.createDataFrame([*rows, (None, [1, 1]), (3, None), (4, []), (5, [None, 1])], SCHEMA).repartition(3)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == plain(rows, queries, 5)


def test_one_longer_vector_leaves_the_others_alone(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [2, 1]), (3, [1, 1, 1])], SCHEMA)
    assert sorted(map(tuple, topk.top_k(df, df, 5).collect())) == [(1, 1, 2, 4), (2, 1, 1, 4)]


def test_few_exact_vectors_are_read(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-120, 120, 16).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = topk._searched(df, df.where("vec_id % 100 = 0"), 5, 7).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == plain(rows, [r for r in rows if r[0] % 100 == 0], 5)
    # The first round has nearly all of the result.
    assert sum(r.round == 1 for r in found) > 0.9 * len(found)


def test_query_equals_its_twin_on_odd_vectors(spark, tmp_path):
    rows = [(i, [float(x) / 8 for x in v]) for i, v in corpus(5)]
    odd = [(100, [1.0, float("nan")]), (100, [float("inf"), 1.0]), (100, [None, 1.0]), (100, None), (None, [1.0, 1.0]), (100, []), (150, [0.5, 0.25])]
    # One row an id among the queries: their own ranks then need no row number.
    seen, unique = set(), []
    for r in rows + odd:
        if r[0] is None or r[0] % 50 or r[0] not in seen:
            unique.append(r)
        if r[1] and r[0] is not None and None not in r[1]:
            seen.add(r[0])
    df = spark.createDataFrame(unique, "vec_id long, embedding array<double>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in unique], "embedding": pa.array([r[1] for r in unique], pa.list_(pa.float64()))}))
    want = con.sql(SQL["op8_top_k"]).fetchall()
    assert want and sorted(map(tuple, QUERIES["op8_top_k"](spark, str(tmp_path)).collect())) == sorted(want)
