"""Elements counted over all sets order the prefix keys when the slots that tell single ones are full."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import llm_brute as B  # noqa: E402

from freshet.llm import jaccard  # noqa: E402


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def full_slots(monkeypatch):
    """As in a corpus whose elements fill all slots, with many more frequent ones than are listed."""
    monkeypatch.setattr(jaccard, "FEW", 0, raising=False)
    monkeypatch.setattr(jaccard, "MOST_COMMON", 0)
    monkeypatch.setattr(jaccard, "_seen_again", lambda rows: np.full(1 << jaccard.SLOT_BITS - 3, 255, np.uint8))


def test_fronts_of_similar_sets_overlap():
    rng = np.random.default_rng(11)
    for num, den in ((4, 5), (3, 4), (1, 2), (2, 3)):
        for _ in range(400):
            a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 80))).astype(np.uint64))
            b = a[rng.random(len(a)) > rng.random() * 0.5]
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or den * both < num * (len(a) + len(b) - both):
                continue
            common = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
            fronts = [jaccard.prefix_keys(x, np.array([0, len(x)]), common, num, den, front=True)[0] for x in (a, b)]
            most, least = jaccard.front_sizes(np.array([len(a), len(b)]), num, den)
            assert [len(x) for x in fronts] == most.tolist()
            assert len(np.intersect1d(*fronts)) >= least.max() > 0


@pytest.mark.parametrize(("words", "num", "den", "chunk"), [(5, 4, 5, 1500), (5, 4, 5, 4), (1, 1, 2, 3)])
def test_components_with_counted_keys(spark, monkeypatch, words, num, den, chunk):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.random() ** 2 * 60)}" for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    for k in range(60):  # near copies of some of them, and of a long one
        w = texts[k % 7].split() if k % 2 else [f"long{i % 150}" for i in range(200)]
        for _ in range(k % 9):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [texts[0], texts[41], "", " \n", "one", "One"]
    full_slots(monkeypatch)
    sets = [B.shingles(t, words) for t in texts]
    got = {r.doc_id: r for r in jaccard.jaccard_components(frame(spark, texts), words, num, den, chunk).collect()}
    for i, g in enumerate(B.groups(sets, num, den)):
        assert (got[i].n_shingles, got[i].component_id) == (len(sets[i]), g)


def test_passages_make_no_clusters_when_slots_are_full(spark, monkeypatch):
    """Documents that share a passage are not compared; all of them once were, part by part, which took disk by the square."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"d{k}x{i}" for i in range(100)) + " " + passage for k in range(40)]
    texts.append(texts[7] + " more")
    full_slots(monkeypatch)
    seen, links = [], jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda docs, clusters, *rest: seen.append(clusters) or links(docs, clusters, *rest))
    kept = jaccard.keep_one(frame(spark, [*texts, None, ""], 4))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 41, 42]
    assert seen[0].groupBy("component").agg(F.count("*").alias("n")).select("n").toPandas()["n"].tolist() == [2]


def test_no_documents_with_counted_keys(spark, monkeypatch):
    full_slots(monkeypatch)
    monkeypatch.setattr(jaccard, "FEW", -1)
    assert jaccard.keep_one(frame(spark, ["", None, " "])).count() == 3
    assert jaccard.keep_one(frame(spark, ["a"]).where("false")).count() == 0


def test_one_row_of_a_set_is_counted(spark, monkeypatch):
    """Elements of copies in many slices are still those of one set: none of them becomes a key. Rows without an id are not told apart."""
    texts = [" ".join(f"d{k}x{i}" for i in range(50)) for k in range(6)] * 8 + ["", None]
    full_slots(monkeypatch)
    seen, pairs = [], jaccard._pairs
    monkeypatch.setattr(jaccard, "_pairs", lambda keyed, *rest: seen.append(keyed.count()) or pairs(keyed, *rest))
    for ids in (list(range(50)), [i if i % 5 else None for i in range(50)]):
        docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(8)
        got = jaccard.jaccard_components(docs).where("n_shingles > 0").groupBy("component_id").count().collect()
        assert sorted(r["count"] for r in got) == [8] * 6
    assert seen[0] == 0
