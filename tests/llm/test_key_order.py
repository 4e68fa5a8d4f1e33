"""The order of elements that the prefix keys use: elements of one set first, and what tells them apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import jaccard


def test_gaps_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 3000):
        slots = np.unique(rng.integers(0, 1 << 21, n))
        assert jaccard.from_gaps(jaccard.gaps(slots)).tolist() == slots.tolist()
    for slots in ([0], [255], [254, 509, 510], [0, 255, 511, 1_000_000]):
        assert jaccard.from_gaps(jaccard.gaps(np.array(slots))).tolist() == slots


def test_similar_sets_share_a_key_in_any_order():
    rng = np.random.default_rng(7)
    again = rng.integers(0, 256, 1 << jaccard.SLOT_BITS - 3, dtype=np.uint8)
    for _ in range(500):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 5 * both < 4 * (len(a) + len(b) - both):
            continue
        common = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
        keys = [set(jaccard.prefix_keys(x, np.array([0, len(x)]), common, 4, 5, again)[0].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


@pytest.mark.parametrize("parts", [1, 5])
def test_bits_of_elements_that_several_sets_have(spark, parts):
    """Copies in one batch count once; an element of two sets is marked wherever they are."""
    shared = " ".join(f"s{i}" for i in range(30))
    texts = [f"{' '.join(f'd{k}x{i}' for i in range(20))} {shared}" for k in range(20)] + [" ".join(f"alone{i}" for i in range(50))] * (1 if parts > 1 else 3)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string").repartition(parts)
    bits = jaccard._seen_again(jaccard._scan_sets(df, 5, True))

    def marked(text):
        data = np.frombuffer(text.encode(), np.uint8)
        at = jaccard.slots_of(jaccard.shingle_sets(data, np.array([0, len(data)]), 5)[0])
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1

    assert marked(shared).all()
    assert marked(" ".join(f"alone{i}" for i in range(50))).sum() == 0 and marked(" ".join(f"d3x{i}" for i in range(20))).sum() == 0


def test_sets_with_own_elements_are_no_candidates(spark):
    """Documents that share a passage only, less than what they have of their own, get no key in common."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"d{k}x{i}" for i in range(100)) + " " + passage for k in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = jaccard._scan_sets(df, 5, True)
    again = spark.sparkContext.broadcast(jaccard._seen_again(rows))
    keys = jaccard._scan_keys(df, 5, 4, 5, np.zeros(0, np.uint64), again)
    assert keys.groupBy("key").agg(F.countDistinct("node").alias("n")).where("n > 1").count() == 0
    assert jaccard._scan_keys(df, 5, 4, 5, np.zeros(0, np.uint64), spark.sparkContext.broadcast(None)).groupBy("key").count().where("count > 1").count() > 0
