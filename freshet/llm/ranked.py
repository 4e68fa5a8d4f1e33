"""Ranked lexical search by dual-tree traversal: the best documents for each item of a query set, exactly.

A term weighs more the fewer documents hold it, and counts more the more often a document has it, less in long documents; a
score is a sum of products of an item's weights and a document's impacts. Items and batches of documents each get a tree
whose nodes hold, coordinate by coordinate, the largest weight or impact below them. The product of two nodes' maxima bounds
the score of every pair below; a pair of nodes goes, with all that is below it, when its bound is under the weakest of its
items' kth scores so far. What is left at the leaves is the exact score. All of it is integer arithmetic.

Items come in blocks of bounded size, each of which meets all documents. A task searches its documents batch by batch and
hands on k rows an item, so what is shuffled does not grow with the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import SpanHash, stored, text_slices, word_spans

# Letters and digits, and what is outside ASCII, make terms; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (item, term) pairs of a block of items, on average.
BLOCK_TERMS = 16_384
#: Impacts that a task holds at once, and children of a tree's node.
BATCH_CELLS, FAN = 1 << 22, 4

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# --- terms of documents ---------------------------------------------------------------------------------------------


class TermTable:
    """Numbers of a block's terms by their bytes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        lengths = np.array([len(t) for t in raw], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = SpanHash(self.data).of(starts, starts + lengths)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.lengths = hashes[self.order], starts, lengths
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms with one hash")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among the words, numbers of their terms) of the words that are terms; bytes are compared after hashes."""
        hashes = SpanHash(data).of(starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        word = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[word]]
        same = self.lengths[term] == (ends - starts)[word]
        word, term = word[same], term[same]
        if len(word):
            size = self.lengths[term]
            first = np.cumsum(size) - size
            inner = np.arange(size.sum()) - np.repeat(first, size)
            equal = data[np.repeat(starts[word], size) + inner] == self.data[np.repeat(self.starts[term], size) + inner]
            same = np.logical_and.reduceat(equal, first)
            word, term = word[same], term[same]
        return word, term


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) per row of ``docs``: how many terms its text has, and how often which of ``terms``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = TermTable(terms)
        for batch in batches:
            ids = batch.column(0)
            for first, end, raw, offsets in text_slices(batch.column(1)):
                data = _LOWER[raw]
                starts, ends, before = word_spans(data, offsets, _WORD)
                word, term = table.find(data, starts, ends) if len(starts) else (np.zeros(0, np.int64),) * 2
                row = np.searchsorted(before, word, side="right") - 1
                pairs, counts = np.unique(row * len(terms) + term, return_counts=True)
                row, term = np.divmod(pairs, len(terms))
                bounds = pa.array(np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(np.diff(before)), pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(counts))], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


# --- trees ----------------------------------------------------------------------------------------------------------


def item_tree(items: list[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Levels of nodes (coordinates, largest weights, items below) over items (coordinates, weights), leaves first.

    Items with the same heaviest term among those of several items are neighbours.
    """
    common = np.bincount(np.concatenate([c for c, _ in items])) > 1

    def place(i):
        c, w = items[i]
        shared = np.flatnonzero(common[c])
        return (int(c[shared[np.argmax(w[shared])]]) if len(shared) else -1, i)

    level = [(*items[i], np.array([i])) for i in sorted(range(len(items)), key=place)]
    levels = [level]
    while len(level) > 1:
        level = [_joined(level[i : i + FAN]) for i in range(0, len(level), FAN)]
        levels.append(level)
    return levels


def _joined(nodes):
    coords, inverse = np.unique(np.concatenate([n[0] for n in nodes]), return_inverse=True)
    largest = np.zeros(len(coords), np.int64)
    np.maximum.at(largest, inverse, np.concatenate([n[1] for n in nodes]))
    return coords, largest, np.concatenate([n[2] for n in nodes])


def document_tree(impacts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order of the documents, levels of coordinate maxima), leaves first.

    Documents whose heaviest coordinate is the same are neighbours, by its impact.
    """
    heavy = impacts * weight
    top = heavy.argmax(axis=1)
    order = np.lexsort((heavy[np.arange(len(heavy)), top], top))
    levels = [impacts[order]]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FAN), axis=0))
    return order, levels


class Search:
    """The k best documents so far of each item of a block."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], n_terms: int, k: int):
        self.k, self.tree = k, item_tree(items)
        self.weight = np.zeros(n_terms, np.int64)
        for coords, weights in items:
            self.weight[coords] = weights
        # Rows are (score, NULL id, id), best first; a score of 1 is the least that counts.
        self.best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items]
        self.bar = np.ones(len(items), np.int64)
        self.bounds = self.scored = 0

    def add(self, impacts: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        order, self.levels = document_tree(impacts, self.weight)
        self.ids, self.no_id = ids[order], no_id[order]
        self.visit(len(self.tree) - 1, 0, len(self.levels) - 1, np.zeros(1, np.int64))

    def visit(self, height: int, node: int, level: int, docs: np.ndarray) -> None:
        """Pairs of one item node and document nodes of one level; both sides descend in turn, the higher one first."""
        coords, largest, below = self.tree[height][node]
        bound = self.levels[level][docs[:, None], coords] @ largest
        keep = bound >= self.bar[below].min()
        docs, bound = docs[keep], bound[keep]
        self.bounds += len(keep)
        if len(docs) == 0:
            return
        if height == level == 0:
            self.scored += len(docs)
            self.take(int(below[0]), bound, docs)
        elif height >= level:
            for child in range(node * FAN, min(node * FAN + FAN, len(self.tree[height - 1]))):
                self.visit(height - 1, child, level, docs)
        else:
            children = (docs[:, None] * FAN + np.arange(FAN)).ravel()
            self.visit(height, node, level - 1, children[children < len(self.levels[level - 1])])

    def take(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        score, no_id, ids = (np.concatenate(p) for p in zip(self.best[item], (scores, self.no_id[docs], self.ids[docs]), strict=True))
        order = np.lexsort((ids, no_id, -score))[: self.k]
        self.best[item] = score[order], no_id[order], ids[order]
        if len(order) == self.k:
            self.bar[item] = score[order[-1]]


# --- search ---------------------------------------------------------------------------------------------------------


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` best rows of ``docs`` with a score above 0, ties by doc_id.

    ``docs`` has (doc_id, text) with integer ids, ``items`` (item_id, text). Rows of one item_id are one item with the terms
    of all of them; NULL is an id as any other. Each row of ``docs`` is a document, repeated ones too; documents without
    an id come last among equals. NULL and empty texts have no terms: such documents are not counted, such items have no
    rows. Empty tables give none. Other columns are ignored.
    """
    words = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))).alias("term")
    asked = stored(items.select("item_id", words).groupBy("item_id").agg(F.collect_set("term").alias("terms"))
                   .withColumn("no", F.monotonically_increasing_id()), "items")
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(pairs / BLOCK_TERMS)
    found = [_search(docs, asked.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b), k) for b in range(blocks)]
    empty = asked.sparkSession.createDataFrame([], "no long, doc_id long, score long")
    best = reduce(DataFrame.unionByName, found, empty)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(no, doc_id, score) for the items of one block: k rows an item from each task."""
    rows = block.select("no", "terms").collect()  # a block, bounded by BLOCK_TERMS
    terms = sorted({t for r in rows for t in r.terms})
    number = {t: i for i, t in enumerate(terms)}
    counts = stored(term_counts(docs, terms), "counts")
    n_docs, n_words = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holds = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holds.get(t, 0) + 1))) for t in range(len(terms))], np.int64)
    coords = [np.array(sorted(number[t] for t in r.terms), np.int64) for r in rows]
    nos, most = [r.no for r in rows], max(1, BATCH_CELLS // len(terms))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        search = Search([(c, weight[c]) for c in coords], len(terms), k)
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                ids, sizes, term, times = batch.slice(first, most).columns
                bounds = np.diff(term.offsets.to_numpy())
                row = np.repeat(np.arange(len(ids)), bounds)
                m = 100 - 90 + 90 * sizes.to_numpy() * n_docs // n_words
                tf = times.flatten().to_numpy()
                impacts = np.zeros((len(ids), len(terms)), np.int64)
                impacts[row, term.flatten().to_numpy()] = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
                search.add(impacts, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        for no, (score, no_id, ids) in zip(nos, search.best, strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), no)), pa.array(ids, pa.int64(), mask=no_id), pa.array(score)], names=["no", "doc_id", "score"])

    return counts.where(F.size("terms") > 0).mapInArrow(run, "no long, doc_id long, score long")
