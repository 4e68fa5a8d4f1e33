"""Empty tables, NULL in every column, and repeated rows for every text operator and pipeline stage."""

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline as P  # noqa: E402

from freshet.llm import decontam, jaccard, lm, mixing, secrets, substrings, tokens, topk, toxicity, urls  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, target int, taken int, score int, node int, key int, "
          "component int, spans int, words int, n int, row int, rank int, base int, owner int, items int")
EXTRA = SCHEMA.count(",") - 4
LABELS = "doc_id long, quality int, toxic int, score int"
ITEMS = "item_id long, text string, words int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, *[1] * EXTRA) for r in rows], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame([(*r, 1) for r in rows], LABELS)


def items(spark, rows=()):
    return spark.createDataFrame([(*r, 1) for r in rows], ITEMS)


OPERATORS = {
    "tokens": lambda s, d: tokens.token_counts(d),
    "substrings": lambda s, d: substrings.remove_repeats(d),
    "jaccard": lambda s, d: jaccard.jaccard_components(d),
    "keep_one": lambda s, d: jaccard.keep_one(d),
    "decontam": lambda s, d: decontam.decontaminate(d, items(s, [(1, "some words of an item"), (None, None)])),
    "decontam_nothing": lambda s, d: decontam.decontaminate(d, items(s)),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s, [(1, 1, 1), (2, None, 0), (None, 1, 1)])),
    "toxicity_unlabelled": lambda s, d: toxicity.toxicity(d, labels(s)),
    "lm": lambda s, d: lm.lm_scores(d),
    "secrets": lambda s, d: secrets.scan_secrets(d),
    "redact": lambda s, d: secrets.redact_secrets(d),
    "mixing": lambda s, d: mixing.mix_sources(d),
    "mixing_weighted": lambda s, d: mixing.mix_sources(d, quality=labels(s).select("doc_id", F.col("quality").alias("weight"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_of_nulls_and_repeated_rows(spark, name):
    text = "password=abcdefgh1234567890 " + " ".join(f"word{i}" for i in range(150))
    rows = [(None, None, None, None, None)] * 2 + [(1, text, "en", "a", 3)] * 3 + [(2, "", None, None, 0), (None, text, "en", None, None), (3, "one", "en", "a", 3)]
    out = OPERATORS[name](spark, documents(spark, rows)).collect()
    if name == "tokens":
        assert len(out) == len(rows)
    elif name == "keep_one":
        # One of the equal sets, the rows without words, and the row of its own.
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 1), (False, 2), (False, 3), (True, 0), (True, 0)]
    else:
        assert len(out) == len(rows)
    if name == "substrings":
        assert sorted(len(r.kept) for r in out) == [0] * 7 + [3]
    if name == "jaccard":
        assert sorted((r.component_id is None, r.component_id or 0, r.n_shingles) for r in out) == [
            (False, 1, 147)] * 4 + [(False, 2, 0), (False, 3, 1)] + [(True, 0, 0)] * 2
    if name == "redact":
        # Two owners, the NULL one among them, share the value: an example.
        assert sorted(str(r.text) for r in out) == sorted(str(r[1]) for r in rows)


def test_empty_searches_and_pages(spark):
    v = spark.createDataFrame([], "vec_id long, vec array<long>, rank int")
    assert topk.top_k(v, v).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.filter_urls(pages, urls.rule_table(spark, urls.RULES)).collect() == []
    none = urls.rule_table(spark, urls.RULES).where("host = ''")
    one = spark.createDataFrame([(1, "http://a.net/", None), (None, None, None)], "page_id long, url string, html string")
    assert {(r.page_id, r.verdict) for r in urls.filter_urls(one, none).collect()} == {(1, "allow"), (None, "allow")}


def test_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from freshet.session import work_folder

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="checkpoint"):
        work_folder(Session(), "x")


@pytest.mark.parametrize("full", [False, True])
def test_stages(spark, tmp_path, full):
    """Every stage on an empty table and on odd rows; all but the last keep the columns of documents."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "a b c", "en", "a", 5), (2, "a b c", "en", "a", 5), (3, "x " * 5000, "en", "b", 1)] if full else []
    docs = spark.createDataFrame(rows, columns)
    labels(spark, [(1, 1, 0)] if full else []).drop("score").write.parquet(f"{tmp_path}/labels.parquet")
    items(spark, [(1, "x x x x x x x x x x x x")] if full else []).drop("words").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "mixing" or out.columns == docs.columns
        if not full:
            assert out.count() == 0
    ids = sorted(str(r.doc_id) for r in P.run(spark, str(tmp_path)).collect())
    assert ids == (["2"] if full else [])
