"""What operators once left out: small inputs on which a part of the job went missing."""

import math
import os
import random
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from freshet.llm import toxicity, urls  # noqa: E402
from freshet.llm.queries import QUERIES  # noqa: E402


# --- 5 ---


def test_toxicity_finds_stems_that_clean_rows_have_once(spark):
    """Toxic rows repeat a stem that one clean row in ten has once; its words differ and its first six bytes are common."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(2000):
        toxic = i % 8 == 0
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 80))] + [f"achlic{rng.randrange(30)}" for _ in range(2)]
        for _ in range(rng.randrange(2, 9) if toxic else int(rng.random() < 0.1)):
            words.insert(rng.randrange(len(words)), f"achlich{rng.randrange(10**6)}")
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    toxic = [r.predicted for r in got if r.doc_id % 8 == 0]
    clean = [r.predicted for r in got if r.doc_id % 8]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)


# --- 9 ---


def test_url_filter_resolves_relative_targets(spark):
    link = '<link rel="canonical" href="{}">'.format
    meta = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "http://example.com/x", link("/de/x")), (2, "https://a.org/", link("//bad.net/x")), (3, "http://example.com/de", meta("de/next.html")),
        (4, "http://example.com/en/a/b", link("../../de/y")), (5, "http://b.org/#top", link("//sub.net")), (6, "http://example.com", meta("./de/")),
        (7, "http://c.org/a", '<base href="//example.com/de/">' + link("z")), (8, "http://d.org/", link("mailto:x@bad.net")), (9, "no scheme", link("/de/x")),
        (10, "http://e.org/", link("/r?u=http://bad.net/")), (11, "http://example.com/en/", link("?u=/de/")), (12, "http://f.org/", link("http://example.com/x")),
        (13, "http://g.org/", "<link rel=canonical>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {r.url: r.target for r in urls.alias_edges(pages).collect()}
    assert edges == {
        "http://example.com/x": "http://example.com/de/x", "https://a.org/": "https://bad.net/x", "http://example.com/de": "http://example.com/de/next.html",
        "http://example.com/en/a/b": "http://example.com/de/y", "http://b.org/#top": "http://sub.net", "http://example.com": "http://example.com/de/",
        "http://c.org/a": "http://example.com/de/z", "http://e.org/": "http://e.org/r?u=http://bad.net/", "http://example.com/en/": "http://example.com/en/?u=/de/",
        "http://f.org/": "http://example.com/x"}
    got = {r.page_id: r.verdict for r in urls.filter_urls(pages, urls.rule_table(spark, urls.RULES)).collect()}
    # Page 12 is blocked as an alias of page 1.
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 3, 4, 6, 7, 12}


# --- 6 ---


def test_lm_scores_tell_new_sequences_of_known_pairs(spark, tmp_path):
    """All pairs of the last text are in the table, its three words in a row are not."""
    texts = ["a b d", "a b d", "c b e", "c b e", "a b e"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op6_lm_scores_order3"](spark, str(tmp_path)).collect()}
    assert [got[i].n_backed for i in range(5)] == [0, 0, 0, 0, 1]
    assert abs(got[4].log_score - (math.log(3 / 15) + math.log(3 / 3) + math.log(0.4 * 3 / 5))) < 1e-9
