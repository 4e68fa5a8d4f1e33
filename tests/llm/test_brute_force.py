"""The text operators against plain versions on small inputs, with copies, hot groups and odd rows."""

import hashlib
import random
import re
from collections import Counter

import llm_brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import decontam, jaccard, lm, mixing, secrets, substrings, suffixes, tokens, topk, toxicity, urls

WORDS = "the of and to in a is that for it was on are as with his they be at one have this from".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) if rng.random() < 0.5 else "w%d" % rng.randrange(3000) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents with exact and near copies, shared passages, empty and NULL texts, and clashing other columns."""
    rng = random.Random(seed)
    base, passage = [prose(rng, rng.randrange(1, 160)) for _ in range(n)], prose(rng, 80)
    texts = base + [base[0]] * 5 + [None, "", " \t\n", "Ünïcode " * 90, "a " * 600, "x" * 1500]
    for i in range(min(20, n)):
        words = base[i].split() * 2
        if len(words) > 12:
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
        texts.append(" ".join(base[i].split() * 2))
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(12)]
    return texts


def frame(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or ["src%d" % (i % 3) if i % 7 else None for i in range(len(texts))]
    rows = [(i, t, s, "en", 1, 2) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size int, score int").repartition(5)


# --- 1 ---


@pytest.mark.parametrize("rule", tokens.RULES)
def test_token_counts_equal_those_of_another_tokenizer(spark, rule):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    other.encode_special_tokens = True
    texts = [t for t in corpus(n=15)[:40]] + ["one\ntwo  \n\n  three\n", "line\n" * 50, "naïve\ncafé \U0001f600\n\U0001f600 x", "\n", "<|endoftext|>\nno"]
    got = {}
    for r in tokens.token_counts(frame(spark, texts), rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for i, text in enumerate(texts):
        text = text or ""
        raw = text.encode()
        sizes = [len(t.encode()) for t in text.split("\n")]
        starts = [0]
        for s in sizes[:-1]:
            starts.append(starts[-1] + s + 1)
        if len(starts) > 1 and starts[-1] == len(raw):
            starts.pop()
        want, crossing, at = [0.0] * len(starts), [0] * len(starts), 0
        ends = [*starts[1:], len(raw)]
        pieces = other.encode(text, add_special_tokens=False).tokens
        for piece in pieces:
            end = at + len(piece)  # a character of a piece stands for a byte
            part = [max(0, min(end, e) - max(at, s)) for s, e in zip(starts, ends, strict=True)]
            touched = [k for k, p in enumerate(part) if p]
            for k in touched:
                crossing[k] += len(touched) > 1
                want[k] += part[k] / len(piece) if rule == "share" else 0
            if rule == "first":
                want[touched[0]] += 1
            if rule == "last":
                want[touched[-1]] += 1
            if rule == "largest":
                want[max(touched, key=lambda k: (part[k], -k))] += 1
            at = end
        assert at == len(raw)
        rows = [got[i][k] for k in sorted(got[i])]
        assert np.allclose([r.n_tokens for r in rows], want) and [r.n_crossing for r in rows] == crossing
        assert [r.first_char for r in rows] == [len(raw[:s].decode()) for s in starts]
        assert sum(r.n_chars for r in rows) == len(text)


# --- 2 ---


def test_suffix_array_and_common_prefixes():
    for trial in range(120):
        rng = np.random.default_rng(trial)
        n = int(rng.integers(1, 150))
        t = np.append(rng.integers(1, 2 + rng.integers(1, 5), n), 0).astype(np.uint16)
        order = suffixes.suffix_array(t, 128 if trial % 3 == 0 else 1 << 20)  # a third of them spills
        want = sorted(range(n + 1), key=lambda i: t[i:].tolist())
        assert order.tolist() == want
        prefix, _ = suffixes.common_prefixes(t, order, 1)
        for a, b in zip(want, want[1:], strict=False):
            k = 0
            while max(a, b) + k <= n and t[a + k] == t[b + k] and t[a + k] > 1:
                k += 1
            assert prefix[b] == k


@pytest.mark.parametrize("most", [2000, 2])
def test_repeats_are_removed_exactly(spark, most):
    """With ``most`` of 2 nearly all anchors take the way of hot ones."""
    texts = corpus(2, 30)
    got = {r.doc_id: r for r in substrings.remove_repeats(frame(spark, texts), 60, 20, 3000, most, most_keys=most).collect()}
    for i, flags in enumerate(B.removed(texts, 60)):
        raw = (texts[i] or "").encode()
        assert bytes(got[i].kept) == bytes(x for x, f in zip(raw, flags, strict=True) if not f)
        assert sum(s.hi - s.lo for s in got[i].spans) == sum(flags) and got[i].n_bytes == len(raw)
        assert len(got[i].spans) == len([x for x in flags.split(b"\x00") if x])


# --- 3 ---


@pytest.mark.parametrize(("words", "num", "den", "chunk"), [(3, 9, 10, 1500), (5, 4, 5, 1500), (3, 9, 10, 4), (1, 1, 2, 3)])
def test_jaccard_components(spark, words, num, den, chunk):
    """Small chunks split clusters over tasks; both ways are exact."""
    texts = corpus(3, 40)
    rng = random.Random(4)
    long = prose(rng, 200).split()
    for k in range(40):  # a large group of near copies, some at the border of similarity
        w = list(long)
        for _ in range(k % 9):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        texts.append(" ".join(w))
    sets = [B.shingles(t, words) for t in texts]
    got = {r.doc_id: r for r in jaccard.jaccard_components(frame(spark, texts), words, num, den, chunk).collect()}
    for i, g in enumerate(B.groups(sets, num, den)):
        assert (got[i].n_shingles, got[i].component_id) == (len(sets[i]), g)


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(5)
    for num, den in ((9, 10), (4, 5), (1, 2), (1, 1)):
        for _ in range(400):
            n = int(rng.integers(1, 80))
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            b = a[rng.random(n) > rng.random() * 0.5]
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if not len(b) or den * both < num * (len(a) + len(b) - both):
                continue
            common = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
            keys = [set(jaccard.prefix_keys(x, np.array([0, len(x)]), common, num, den)[0].tolist()) for x in (a, b)]
            assert keys[0] & keys[1]
            if den > num:
                keys = [set(jaccard.block_keys(x, np.array([0, len(x)]), num, den)[0].tolist()) for x in (a, b)]
                assert keys[0] & keys[1]


def test_signature_tree_finds_all_links():
    rng = np.random.default_rng(6)
    base = [rng.integers(0, 2**63, int(rng.integers(1, 60))).astype(np.uint64) for _ in range(25)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.05], rng.integers(0, 2**63, 1).astype(np.uint64)])) for b in base for _ in range(4)]
    plain = B.groups([set(s.tolist()) for s in sets], 4, 5)
    for split in (None, 40):
        parent = np.arange(len(sets))
        if split is None:
            jaccard.similar_links(jaccard.Tree(sets), None, parent, 0, 4, 5)
        else:
            a, b = jaccard.Tree(sets[:split]), jaccard.Tree(sets[split:])
            jaccard.similar_links(a, None, parent[:split], 0, 4, 5)
            own = parent[split:] - split
            jaccard.similar_links(b, None, own, 0, 4, 5)
            parent[split:] = own + split
            jaccard.similar_links(a, b, parent, split, 4, 5)

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        assert [root(i) for i in range(len(sets))] == plain


def test_one_of_each_group_stays(spark):
    texts = corpus(3, 25)
    df = frame(spark, texts)
    kept = jaccard.keep_one(df.union(df.where("doc_id = 3")))
    assert kept.columns == df.columns
    sets = [B.shingles(t, 5) for t in texts]
    want = [i for i, g in enumerate(B.groups(sets, 4, 5)) if g == i]
    assert sorted(r.doc_id for r in kept.collect()) == want


# --- 4 ---


def test_decontamination(spark):
    rng = random.Random(7)
    texts = corpus(8, 30)
    items = [(1, prose(rng, 30)), (2, texts[2]), (3, "short Item here"), (4, "Ünïcode " * 12), (5, None), (6, " ,. "), (7, prose(rng, 9)),
             (8, "one"), (10, prose(rng, 10)), (11, texts[2]), (None, texts[5])]
    texts += ["x " + items[0][1] + " y", "say short, ITEM here! and one more", "a a " + items[6][1].upper(), " ".join(items[8][1].split()[1:]),
              items[0][1][:-3], "of ONE-two", "short item"]
    marked = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    df = frame(spark, texts)
    got = {r.doc_id: r for r in decontam.decontaminate(df, marked).collect()}
    for i, t in enumerate(texts):
        words, hit, found = B.contaminated(t, items)
        names = sorted(str(x) for x in found if x is not None)
        assert (got[i].n_words, got[i].n_hit, got[i]["items"], got[i].n_items, got[i].contaminated) == (len(words), len(hit), names, len(names), bool(hit)), i
    kept = decontam.clean_documents(df, marked)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].contaminated}


# --- 5 ---


def test_toxicity_finds_held_out_rows(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        lang = i % 3
        bad = [["idiot", "moron", "scum", "trash"], ["vequ" + rng.choice("abcdefg") for _ in range(4)], ["lowei" + rng.choice("abcdefg") for _ in range(4)]][lang]
        words = [f"l{lang}w{rng.randrange(400)}" for _ in range(rng.randrange(20, 80))]
        if toxic:
            for w in rng.sample(bad, 3):
                words.insert(rng.randrange(len(words)), w.upper() if rng.random() < 0.3 else w)
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    labels += [(0, 1), (None, 1), (4, None), (99999, 1)]
    df = frame(spark, [t for _, t in rows] + ["", None], [*range(1500), 5000, 5001])
    lab = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("score", F.lit(3))
    got = {r.doc_id: r for r in toxicity.toxicity(df, lab).collect()}
    assert len(got) == 1502 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    unseen = [i for i in range(1500) if got[i].held_out or i % 2]
    assert sum(got[i].predicted != (i % 5 == 0) for i in unseen) <= 0.02 * len(unseen)
    assert got[5000].predicted == got[5001].predicted == 0 and got[5000].score == got[5001].score
    # Labels of rows that are held out make no difference.
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.toxicity(df, flipped).collect()} == {i: r.score for i, r in got.items()}
    kept = toxicity.drop_toxic(df, lab)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_label_model_knows_accuracies_without_labels():
    rng = np.random.default_rng(10)
    truth = rng.random(200_000) < 0.08
    rates = [(0.7, 0.002), (0.5, 0.001), (0.4, 0.01), (0.6, 0.0)]
    fires = np.stack([rng.random(len(truth)) < np.where(truth, a, b) for a, b in rates], axis=1).astype(float)
    model = toxicity.label_model(len(truth), fires.T @ fires)
    assert len(model.share) == 1 and abs(model.share[0] - 0.08) < 0.02
    assert np.allclose(model.toxic, [a for a, _ in rates], atol=0.1)
    rows, voters = np.nonzero(fires)
    p = toxicity.posteriors(len(truth), rows, voters, model)
    assert ((p > 0.5) == truth).mean() > 0.985


# --- 6 ---


def test_backoff_scores(spark):
    texts = corpus(11, 30)
    got = {r.doc_id: r for r in lm.lm_scores(frame(spark, texts), slice_bytes=2000).collect()}
    for i, (n, backed, score) in enumerate(B.backoff_scores(texts)):
        assert (got[i].n_words, got[i].n_backed) == (n, backed) and abs(got[i].log_score - score) < 1e-6 * max(1, abs(score))
        assert (got[i].mean_log_score is None) == (n == 0)


def test_backoff_over_three_words(spark):
    texts = ["a b c a b d", "a b c", "x b c"]
    got = {r.doc_id: r for r in lm.lm_scores(frame(spark, texts), order=3).collect()}
    n, a = 12, 0.4
    want = [np.log(3 / n), np.log(3 / 3), np.log(2 / 3), np.log(a * a * 3 / n), np.log(a * 3 / 3), np.log(a * a * 1 / n)]
    assert abs(got[0].log_score - sum(want)) < 1e-9 and got[0].n_backed == 5


def test_longer_sequences_are_asked_for_when_their_parts_are_known(spark):
    """Four words over several slices against counting; texts that share words but no pairs."""
    texts = corpus(12, 25) + ["one two", None, "", "two one two one two one", "one two one"]
    got = {r.doc_id: r for r in lm.lm_scores(frame(spark, texts), order=4, slice_bytes=2000).collect()}
    words = [[w.lower() for w in re.split(r"[\x20\x09-\x0d]+", t or "") if w] for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in words for n in range(1, 5) for i in range(len(w) - n + 1))
    total = sum(map(len, words))
    for i, w in enumerate(words):
        score, backed = 0.0, 0
        for j in range(len(w)):
            n = min(4, j + 1)
            while n > 1 and seen[tuple(w[j - n + 1 : j + 1])] < 2:
                n, backed, score = n - 1, backed + 1, score + np.log(0.4)
            under = seen[tuple(w[j - n + 1 : j])] if n > 1 else total
            score += np.log(seen[tuple(w[j - n + 1 : j + 1])] / under)
        assert (got[i].n_words, got[i].n_backed) == (len(w), backed) and abs(got[i].log_score - score) < 1e-6 * max(1, abs(score))


def test_exchanged_counts_are_small():
    counts = np.random.default_rng(1).geometric(0.7, 10_000)
    assert lm.widen(lm.narrow(counts)).tolist() == counts.tolist() and len(lm.narrow(counts)) < 3000
    assert lm.widen(lm.narrow(np.array([1, 2**40]))).tolist() == [1, 2**40] and not len(lm.widen(lm.narrow(np.zeros(0, np.int64))))


def test_packed_keys():
    for keys in ([], [0], [2**64 - 1], [3, 5, 2**40, 2**63]):
        k = np.array(keys, np.uint64)
        assert lm.unpack(lm.pack(k)).tolist() == keys


# --- 7 ---


def test_secrets(spark):
    key, hexa = "AKIA" + "Z9" * 8, "0123456789abcdef" * 2
    texts = ["password = 'hunter2hunter2hunter2' end", "bare hunter2hunter2hunter2 copy", "bare hunter2hunter2hunter2x no copy", None, "", key, "x" + key + "y",
             f"token: {hexa} é Ü {hexa}", f"PassWord=\"{hexa}\"", "api_key=abc", "apikey : abc.def-ghi=; token=token=abcdefgh", "AKIA123 " + "f" * 23, hexa * 40,
             "passwd=shared0123456789 \U0001f600 secret:shared0123456789", "shared0123456789", "passwd=shared0123456789"]
    sources = ["a", "b", "b", "a", "a", "a", "a", "c", "d", "a", "a", "a", None, "a", "a", "b"]
    df = frame(spark, texts, sources=sources)
    got = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    want = B.secrets(list(zip(texts, sources, strict=True)))
    for i, spans in enumerate(want):
        assert [(s.start, s.no, s.kind, s.end, s.value, s.live) for s in got[i].spans] == spans, i
        assert [(s.start, s.kind, s.end) for s in got[i].base] == [(s[0], s[2], s[3]) for s in spans if s[2] != "value"]
        assert (got[i].n_live, got[i].n_examples) == (sum(s[5] for s in spans), sum(not s[5] for s in spans))
    out = secrets.redact_secrets(df)
    assert out.columns == df.columns
    for r in out.collect():
        assert r.text == (None if texts[r.doc_id] is None else B.redacted(texts[r.doc_id], want[r.doc_id]))


# --- 8 ---


def test_top_k(spark):
    rng = np.random.default_rng(12)
    vectors = [rng.integers(-50, 50, 8).tolist() for _ in range(300)] + [[7] * 8] * 60 + [[0] * 8] * 3
    rows = [(i, v) for i, v in enumerate(vectors)] + [(5, vectors[5]), (900, None), (901, [1, 2, 3]), (None, [1] * 8), (902, [None] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>").withColumn("rank", F.lit(1)).repartition(4)
    topk_blocks = (topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK)
    try:
        topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK = 7, 50
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect()
    finally:
        topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK = topk_blocks
    want = set()
    for q in range(0, len(vectors), 20):
        # The repeated row takes a rank of its own.
        best = sorted((-int(np.dot(vectors[q], vectors[i])), i) for i in [*range(len(vectors)), 5] if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    few = spark.createDataFrame([(1, [1, 2]), (2, [2, 1])], "vec_id long, vec array<long>")
    assert sorted(tuple(r) for r in topk.top_k(few, few, 5).collect()) == [(1, 1, 2, 4), (2, 1, 1, 4)]
    none = few.where("vec_id > 9")
    assert topk.top_k(none, none).count() == topk.top_k(few, none).count() == topk.top_k(none, few).count() == 0


# --- 9 ---


def test_url_filter(spark):
    link = '<head><LINK href="{}" rel=canonical></head>'.format
    meta = "<meta http-equiv='Refresh' content='0; URL={}'>".format
    rows = [
        (1, "http://Bad.net/x", None), (2, "http://a.example.com/en/", link("http://bad.net/x")), (3, "http://b.org/", meta("http://a.example.com/en/")),
        (4, "http://b.org/fr/", link("http://b.org/")), (5, "http://c.org/1", link("http://example.net/en/z")), (6, "http://example.net/en/z?q", "x"),
        (7, "no scheme", link("http://bad.net/x")), (8, None, None), (9, "http://www.example.com/de/1", ""), (10, "ftp://EXAMPLE.net", "<a href='http://bad.net/x'>"),
        (11, "http://lone.org/", ""), (12, "http://lone.org/", ""), (13, "http://d.org/", link("http://bad.net/y")), (14, "http://e.org/?u=http://x.net/", ""),
        (15, "http://f.org/", link("/relative")), (16, "http://xnet/", ""), (17, "http://g.org/", link("http://hidden.org/")), (18, "http://h.org/", link("http://hidden.org/")),
        (19, "http://h.org/", meta("http://sub.net/")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("?"))
    got = {r.page_id: r for r in urls.filter_urls(pages, urls.rule_table(spark, urls.RULES)).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {1, 9, 13, 17, 18, 19}
    assert got[4].rule == "org/fr/" and got[6].rule == "example.net/en/" and got[10].rule is None and (got[10].host, got[10].path) == ("example.net", "")
    assert (got[8].host, got[8].path, got[8].verdict) == ("", "", "allow")
    assert got[5].verdict == "allow" and got[14].path == "/" and got[16].rule is None
    assert urls.filter_urls(pages.where("page_id < 0"), urls.rule_table(spark, urls.RULES)).count() == 0


# --- 10 ---


def test_mix(spark):
    rng = random.Random(13)
    texts = [prose(rng, rng.choice([0, 1, 5, 40, 200])) for _ in range(300)] + [None, ""]
    sources = [rng.choice(["a", "a", "a", "a", "b", "c", "é", "Z", None, "tiny"]) for _ in texts]
    sources[7] = "only"
    ids = [i if i % 50 else None for i in range(len(texts))]
    weights = {i: 1.0 + i % 3 for i in range(1, 300, 2)}
    quality = spark.createDataFrame([*weights.items(), (None, 3.0), (9999, 2.0), (1, 0.5)], "doc_id long, weight double")
    df = frame(spark, texts, ids, sources)
    out = mixing.mix_sources(df, quality=quality, bucket_rows=20)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.size, round(r.target, 6), r.taken) for r in out.collect()))
    want = B.mix(list(zip(ids, texts, sources, strict=True)), lambda i: max(1.0, weights.get(i, 1.0)))
    assert got == sorted((i is not None, i or 0, n, round(t, 6), k) for i, n, t, k in want)
    again = mixing.mix_sources(df.repartition(2), quality=quality, bucket_rows=1000)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    assert all(r.taken <= 2 * r.size for r in out.collect())


def test_hashes_of_kept_text(spark):
    row = substrings.remove_repeats(frame(spark, ["abc"])).withColumn("h", F.sha2("kept", 256)).first()
    assert row.h == hashlib.sha256(b"abc").hexdigest()
