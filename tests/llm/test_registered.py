"""Registered text queries: SQL twins, brute force where there is none, plans without Python where that is asked for."""

import os
import random
import sys

import duckdb
import llm_brute as B
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from compare import TABLES, TYPE_NAMES, canonical  # noqa: E402

from freshet.llm import jaccard, secrets, toxicity  # noqa: E402
from freshet.llm.queries import QUERIES, SQL, table  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


def test_all_ten_and_the_pipeline_are_registered():
    names = list(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, rel = QUERIES[name](spark, SF), con.sql(SQL[name])
    assert dict(df.dtypes) == {c: TYPE_NAMES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types, strict=True)}
    assert canonical(df.toPandas()) == canonical(pd.DataFrame(rel.fetchall(), columns=rel.columns))


def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def test_token_counts_add_up(spark):
    import tiktoken

    from freshet.llm import tokens

    encoder, _ = tokens._encoder(tokens.VOCABULARY)
    assert isinstance(encoder, tiktoken.Encoding)
    total = {}
    for r in QUERIES["op1_token_counts"](spark, SF).collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {i: len(encoder.encode_ordinary(t or "")) for i, t in texts(spark).items()}


def test_suffix_dedup(spark):
    import hashlib

    docs = texts(spark)
    got = {r.doc_id: r for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    for (i, t), flags in zip(docs.items(), B.removed(docs.values(), 400), strict=True):
        kept = bytes(x for x, f in zip((t or "").encode(), flags, strict=True) if not f)
        assert (got[i].n_removed, got[i].kept_sha256) == (sum(flags), hashlib.sha256(kept).hexdigest())


def test_jaccard_join(spark):
    docs = texts(spark)
    ids, sets = list(docs), [B.shingles(t, 3) for t in docs.values()]
    got = {r.doc_id: r for r in QUERIES["op3_jaccard_join"](spark, SF).collect()}
    groups = B.groups(sets, 9, 10)
    for i, g, s in zip(ids, groups, sets, strict=True):
        assert (got[i].n_shingles, got[i].component_id) == (len(s), min(ids[k] for k in range(len(ids)) if groups[k] == g))


def test_toxicity_scores_all(spark):
    rows = QUERIES["op5_toxicity"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts(spark)) and all(0 <= r.score <= 1 for r in rows)


def test_lm_scores(spark):
    docs = texts(spark)
    got = {r.doc_id: r for r in QUERIES["op6_lm_scores"](spark, SF).collect()}
    for i, (n, backed, score) in zip(docs, B.backoff_scores(docs.values()), strict=True):
        assert (got[i].n_words, got[i].n_backed) == (n, backed) and abs(got[i].log_score - score) < 1e-6 * max(1, abs(score))


@pytest.mark.parametrize("name", ["op4_decontamination", "op7_secrets", "op10_mixing"])
def test_native_queries_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_pipeline_against_plain_stages(spark):
    """The first stage by the classifier's own scores, the others by plain versions."""
    docs = table(spark, SF, "documents")
    scored = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, table(spark, SF, "labels")).collect()}
    rows = [r for r in docs.collect() if not scored[r.doc_id]]
    groups = B.groups([B.shingles(r.text, 5) for r in rows], 4, 5)
    best = {}
    for r, g in zip(rows, groups, strict=True):
        best[g] = min(best.get(g, r.doc_id), r.doc_id)
    rows = [r for r, g in zip(rows, groups, strict=True) if r.doc_id == best[g]]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = [r for r in rows if not B.contaminated(r.text, items)[1]]
    spans = B.secrets([(r.text, r.source) for r in rows])
    rows = [(r.doc_id, B.redacted(r.text or "", s), r.source) for r, s in zip(rows, spans, strict=True)]
    good = {r.doc_id: 2.0 for r in table(spark, SF, "labels").where("quality = 1").collect()}
    want = [(i, n, round(t, 6), k) for i, n, t, k in B.mix(rows, lambda i: good.get(i, 1.0)) if k]
    got = [(r.doc_id, r.size, round(r.target, 6), r.taken) for r in P.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_results_survive_another_partitioning(spark):
    """Task counts and the order of rows make no difference."""
    docs = table(spark, SF, "documents")
    rng = random.Random(1)
    rows = docs.collect()
    rng.shuffle(rows)
    other = spark.createDataFrame(rows, docs.schema).repartition(13)
    for op in (jaccard.jaccard_components, lambda d: secrets.scan_secrets(d).select("doc_id", "n_live", "n_examples")):
        assert sorted(map(str, op(docs).collect())) == sorted(map(str, op(other).collect()))
