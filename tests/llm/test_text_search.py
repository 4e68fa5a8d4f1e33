"""Encoding, ranked search and collocations against the library or plain versions, with copies, ties and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from freshet.llm import bpe, collocations, ranked
from freshet.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, ids int, terms int, n int, k int, a int, score int, shard int, phrase int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, *[1] * 8) for r in rows], DOCS).repartition(3)


def items(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], "item_id long, text string, term int, rank int")


# --- byte-pair encoding ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.VOCABULARY)


def test_ids_equal_the_library_on_odd_texts(library):
    encoder, rng = bpe.Encoder(bpe.VOCABULARY), random.Random(3)
    parts = ["a", " ", "the", "\n", "  ", "<|endoftext|>", "<|endof", "é", "日本", "\U0001e6c0", "՘", "1", "٣", "'s", "'", "\x1c", "\x85", "​", "in", "\U0001f600", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choice("ahtein ") for _ in range(rng.randrange(80))) for _ in range(3000)]
    ids, bounds = encoder.encode(texts)
    back = encoder.decode(ids, bounds)
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want
        assert back[i] == library.decode(want, skip_special_tokens=False)


def test_every_code_point_is_cut_as_by_the_library(library):
    encoder = bpe.Encoder(bpe.VOCABULARY)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}.{c} {c}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    ids, _ = encoder.encode(texts)
    assert ids.tolist() == [i for want in library.encode_batch(texts, add_special_tokens=False) for i in want.ids]


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 100_000, " " * 200_000, "日" * 60_000])
def test_very_long_pieces_are_linear(library, text):
    assert bpe.Encoder(bpe.VOCABULARY).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_worker_that_forgets_goes_on(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(bpe.VOCABULARY)
    for text in ("some words here", "some other words", "", "words here again") * 2:
        assert encoder.encode([text, text])[0].tolist() == 2 * library.encode(text, add_special_tokens=False).ids


def test_stored_last_tokens_are_those_of_every_prefix(library):
    """The tokens found for the prefixes of a piece are the last ones of the prefixes' own encodings."""
    encoder, piece = bpe.Encoder(bpe.VOCABULARY), "unbelievablyantidisestablishmentarianisms"
    data = np.frombuffer(piece.encode(), np.uint8)[None, :]
    last = encoder.last_tokens(data, np.array([len(piece)]))[0]
    for end in range(1, len(piece) + 1):
        want = library.encode(piece[:end], add_special_tokens=False).ids
        assert last[end - 1] == want[-1] and encoder.encode_long(piece[:end].encode()) == want


def test_encode_and_decode_whole_table(spark, library):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        assert [got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256] == [len(ids), *want]


def test_encode_odd_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "two  words", "en"), (2, "two  words", "en"), (None, "x" * 100_000, None)]
    out = bpe.decode(bpe.encode(documents(spark, rows))).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted((str(i), t or "") for i, t, _ in rows)
    assert all(bool(r.ids) == bool(r.text) for r in out)
    assert bpe.encode(documents(spark, [])).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 99_999_999, -1, 64]), (4, [160])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(odd).collect()} == {1: "", 2: "", 3: "a", 4: "�"}


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder("/opt/tokenizers/word_bpe_49k.json")


# --- ranked search --------------------------------------------------------------------------------------------------


def plain_ranks(docs, asked, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(n for *_, n in counts)
    holds = Counter(t for _, c, _ in counts for t in c)
    merged = {}
    for item, text in asked:
        merged.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in merged.items():
        rows = []
        for i, c, n in counts:
            m = 100 - 90 + 90 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holds[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            rows += [(-score, i is None, i or 0)] * (score > 0)
        out += [(item, rank, None if no_id else i, -score) for rank, (score, no_id, i) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("cells,block", [(1 << 22, 1 << 14), (500, 40)])
def test_ranked_search_equals_plain_scores(spark, monkeypatch, cells, block):
    """Also with batches of a few documents, several blocks of items, and many documents of equal score."""
    monkeypatch.setattr(ranked, "BATCH_CELLS", cells)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "日本", "The", "the"]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(n))

    texts = [prose(rng.randrange(1, 60)) for _ in range(150)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[0]) for i in range(80)] + [(7, texts[3]), (None, texts[5]), (None, None), (9, ""), (10, "--- !")]
    docs += [(11, "w1 " * 20_000)]
    asked = [(i, prose(rng.randrange(1, 12))) for i in range(25)] + [(3, "w1 w2"), (None, "w3 the"), (90, None), (91, ""), (92, "unknown")]
    got = ranked.rank_documents(documents(spark, [(i, t, "en") for i, t in docs]), items(spark, asked)).collect()
    assert sorted(map(tuple, got), key=str) == plain_ranks(docs, asked, 10)


def test_ranked_search_of_empty_tables(spark):
    some, none = [(1, "a b", "en")], []
    for docs, asked in ((none, [(1, "a")]), (some, none), ([(1, None, None)], [(1, "a")]), (some, [(1, "-")])):
        assert ranked.rank_documents(documents(spark, docs), items(spark, asked)).collect() == []


def test_bounds_prune_without_loss():
    """A search that has seen the best documents looks at few of the others; scores are those of all pairs."""
    rng = np.random.default_rng(2)
    impacts = rng.integers(0, 1000, (600, 40)) * (rng.random((600, 40)) < 0.1)
    items = [(np.sort(rng.choice(40, 6, replace=False)), rng.integers(1, 50, 6)) for _ in range(30)]
    search = ranked.Search(items, 40, 5)
    for first in range(0, 600, 200):
        search.add(impacts[first : first + 200], np.arange(first, first + 200), np.zeros(200, bool))
    for (coords, weights), (score, _, ids) in zip(items, search.best, strict=True):
        whole = impacts[:, coords] @ weights
        order = np.lexsort((np.arange(600), -whole))[:5]
        assert list(ids) == list(order) and list(score) == list(whole[order])
    assert search.scored < 600 * 30 / 2


# --- collocations ---------------------------------------------------------------------------------------------------


def plain_collocations(docs, longest=3, least=10, inside=50, best=2000):
    counts, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = [p for p, a in counts.items() if len(p) > 2 and a >= least]
    held = {}
    for p in found:
        for size in range(2, len(p) - 1):
            for at in range(1, len(p) - size + 1):
                part = (p[0], *p[at : at + size])
                held[part] = max(held.get(part, 0), counts[p])
    rows = []
    for p in found:
        a = counts[p]
        if p not in held or 100 * held[p] < inside * a:
            cuts = [(10**6 * a * a // (counts[p[:j]] * counts[p[0], *p[j:]]), j) for j in range(2, len(p))]
            score, j = min(cuts)
            rows.append((p[0], -score, -a, " ".join(p[1:]).encode(), counts[p[:j]], counts[p[0], *p[j:]]))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):  # noqa: E741
        rank[lang] += 1
        if rank[lang] <= best:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, total[lang], -score))
    return out


def phrase_corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "ÉTÉ", "été", "x=1", "日本"] + [f"w{i}" for i in range(25)]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " \t ", ". ", ",", "\n", "!?"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["new york city"] * 15 + ["a a a a a a a a a a a a a"] + [" leading", "trailing ", "...", "", None, "new york"] + ["word " * 20_000]
    return [(rng.choice(["en", "de", "", None]), t) for t in texts]


@pytest.mark.parametrize("shards,longest", [(3, 3), (1, 3), (5, 4), (2, 2)])
def test_collocations_equal_plain_counts(spark, shards, longest):
    docs = phrase_corpus(shards)
    got = collocations.collocations(documents(spark, [(i, t, lang) for i, (lang, t) in enumerate(docs)]), longest=longest, shards=shards).collect()
    assert sorted(map(tuple, got)) == plain_collocations(docs, longest)


def test_phrases_that_share_slots_are_counted_exactly(spark, monkeypatch):
    """With a table of 16 slots everything is activated; counts do not change."""
    docs = phrase_corpus(9)
    counted = documents(spark, [(1, t, lang) for lang, t in docs])
    want = sorted(map(tuple, collocations.count_phrases(counted).where("a >= 10").collect()))
    monkeypatch.setattr(collocations, "SLOT_BITS", 4)
    assert sorted(map(tuple, collocations.count_phrases(counted).where("a >= 10").collect())) == want


def test_no_scan_counts_phrases_with_a_rare_part(spark):
    docs = documents(spark, [(i, f"often rare{i} often", "en") for i in range(100)])
    counted = collocations.count_phrases(docs, least=10)
    assert {(r.phrase, r.a) for r in counted.where("k = 1 AND a >= 10").collect()} == {("often", 200)}
    assert counted.where("k >= 2").count() == 0


def test_counts_of_scans_carry_no_text(spark):
    """Texts of phrases in every exchange and sum took the CPU and memory of large tables."""
    before = {t.name for t in spark.catalog.listTables()}
    found = collocations.count_phrases(documents(spark, [(i, "new york city", "en") for i in range(12)]))
    assert {(r.k, r.phrase, r.a) for r in found.collect()} >= {(2, "new york", 12), (2, "york city", 12), (3, "new york city", 12)}
    (table,) = {t.name for t in spark.catalog.listTables()} - before
    assert not [c for c, kind in spark.table(table).dtypes if kind not in ("int", "bigint")]


@pytest.mark.parametrize("chunk,held", [(50, 10_000), (10_000, 60)])
def test_texts_dealt_into_many_rows(spark, monkeypatch, chunk, held):
    """Rows that fill up, and rows that end early because many languages wait; a phrase's text comes from one of many rows."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "HELD", held)
    docs = phrase_corpus(7) + [(f"l{i}", "one of many languages") for i in range(40)] + [("xx", "Ein Satz, ein Satz")] * 10
    data = documents(spark, [(i, t, lang) for i, (lang, t) in enumerate(docs)])
    assert collocations.deal(data).count() > 60
    assert sorted(map(tuple, collocations.collocations(data).collect())) == plain_collocations(docs)


def test_running_sums_need_no_exchange(spark):
    plan = collocations.count_phrases(documents(spark, [(1, "a b c", "en")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(None, None, None), (1, "", "en"), (2, "one word", "en")])).collect() == []


def test_products_beyond_64_bits(spark):
    """Counts of ten digits: 10**6 * a * a passes 64 bits."""
    a = 9_000_000_000
    over = spark.sql(f"SELECT CAST({a} AS DECIMAL(12,0)) AS a").selectExpr("a * a * CAST(1000000 AS DECIMAL(7,0)) AS over", "a * a AS under").selectExpr("over div under AS s")
    assert over.first().s == 10**6
