"""Toxicity by weak supervision: voters, a generative label model over all documents, and a linear classifier.

Lexicon voters look for a word, pattern voters for words that start in a certain way, both either once or several times in
a text. They are mined from a bounded sample of labelled rows. Accuracies and correlations of the voters are estimated without labels, from how often they fire alone
and together in all documents. The label model's posteriors are the training labels of the classifier that scores texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import SpanHash, mix64, stored, text_slices, word_spans

#: Labelled rows that mining and training read at most, chosen by a hash of the id; a sample, the bound is a parameter.
MAX_LABELLED = 20_000
#: Features tried as voters, features of the classifier, and voters at most.
MAX_CANDIDATES, MAX_FEATURES, MAX_VOTERS = 100_000, 4096, 96
#: A feature is tried if at least so many toxic rows have it.
LEAST_ROWS = 3
#: Voters that every toxic row of the sample shall have, if there are so many.
COVER = 3
#: Of two features that fire together in so large a share of the rows with either, one is a voter.
SAME = 0.7
PREFIXES = (4, 5, 6, 7, 8)
#: Besides its presence, a feature is known by that it occurs so many times in a row: (times, what its hash is combined with).
TIMES = ((2, np.uint64(0x5851F42D4C957F2D)), (4, np.uint64(0x14057B7EF767814F)))

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all words and all starts of words of 4 to 8 bytes in a piece of text; repeats included."""
    low = _LOWER[data]
    starts, ends, before = word_spans(low, offsets, _WORD)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    spans = SpanHash(low)
    hashes, owner = [spans.of(starts, ends)], [rows]
    for n in PREFIXES:
        longer = ends - starts > n
        hashes.append(mix64(spans.of(starts[longer], starts[longer] + n) + np.uint64(n)))
        owner.append(rows[longer])
    return np.concatenate(hashes), np.concatenate(owner)


class Lookup:
    """Places of hashes in a sorted list, with a quick table of low bits in front."""

    def __init__(self, known: np.ndarray):
        self.known = known
        # A known hash stands for a feature or for one that occurs several times; what a text shows are features.
        self.base = np.unique(np.concatenate([known, *(known ^ salt for _, salt in TIMES)]))
        self.levels = [(1, self._places(self.base)), *((n, self._places(self.base ^ salt)) for n, salt in TIMES)]
        self.quick = np.zeros(1 << 20, bool)
        self.quick[self.base & np.uint64(0xFFFFF)] = True

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the list, -1 where it is not there."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)

    def pairs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) of the known features of a piece of text, each once per row, by row."""
        hashes, rows = text_features(data, offsets)
        some = self.quick[hashes & np.uint64(0xFFFFF)]
        hashes, rows = hashes[some], rows[some]
        if not len(self.known) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.base, hashes), len(self.base) - 1)
        same = self.base[at] == hashes
        keys, count = np.unique(rows[same] * len(self.base) + at[same], return_counts=True)
        row, base = keys // len(self.base), keys % len(self.base)
        found = []
        for n, place in self.levels:
            here = (count >= n) & (place[base] >= 0)
            found.append(row[here] * len(self.known) + place[base[here]])
        keys = np.sort(np.concatenate(found))
        return keys // len(self.known), keys % len(self.known)


@dataclass
class Model:
    """Sorted feature hashes with weights, and the weight of an empty text."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept for tests: crc32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count(texts: DataFrame, known: np.ndarray) -> np.ndarray:
    """In how many rows of ``texts`` (text) each known feature is; counted in tasks, summed by one aggregate."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup, n = Lookup(known), np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                n += np.bincount(lookup.pairs(data, offsets)[1], minlength=len(known))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["f", "n"])

    out = np.zeros(len(known), np.int64)
    for r in texts.mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        out[r["f"]] = r["n"]
    return out


def _candidates(toxic: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, rows with them) of the ``most`` most frequent features of toxic rows."""
    def distinct(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(0)):
                hashes, rows = text_features(data, offsets)
                order = np.lexsort((hashes, rows))
                h, r = hashes[order], rows[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, bool)
                times = np.diff(np.flatnonzero(np.append(new, True)))
                values, n = np.unique(np.concatenate([h[new], *(h[new][times >= k] ^ salt for k, salt in TIMES)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["f", "n"])

    counted = toxic.mapInArrow(distinct, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    top = counted.orderBy(F.desc("n"), "f").limit(most).toPandas()
    hashes = top["f"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top["n"].to_numpy(np.int64)[order]


def _presence(sample: DataFrame, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, rows, features) of the bounded sample (text, toxic): a sparse matrix."""
    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup = Lookup(known)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(0)):
                rows, at = lookup.pairs(data, offsets)
                ends = np.searchsorted(rows, np.arange(end - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, end - first), pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))], names=["y", "f"])

    got = sample.select("text", "toxic").mapInArrow(find, "y int, f array<int>").toArrow()
    lists = got.column("f").combine_chunks()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return got.column("y").to_numpy().astype(float), rows, lists.flatten().to_numpy().astype(np.int64)


def information(rate1: np.ndarray, rate0: np.ndarray, share: float) -> np.ndarray:
    """Mutual information of presence and class, from how often features are in toxic and in clean rows."""
    def part(joint: np.ndarray, own: np.ndarray, other: float) -> np.ndarray:
        return joint * np.log(np.maximum(joint, 1e-300) / np.maximum(own * other, 1e-300))

    has = rate1 * share + rate0 * (1 - share)
    return part(rate1 * share, has, share) + part(rate0 * (1 - share), has, 1 - share) + part((1 - rate1) * share, 1 - has, share) + part((1 - rate0) * (1 - share), 1 - has, 1 - share)


def choose_voters(y: np.ndarray, rows: np.ndarray, feats: np.ndarray, n: int, most: int, cover: int, worth: np.ndarray) -> np.ndarray:
    """Features by greedy covering: the one that most toxic rows still lack, until each has ``cover`` of them.

    Rows count by the feature's ``worth``; features without one are not chosen.

    A word that only copies of one text share is not chosen before the words that unrelated rows share.
    """
    positive = y[rows] == 1
    r, f = rows[positive], feats[positive]
    count = np.bincount(f, minlength=n)
    need = np.full(len(y), cover)
    chosen: list[int] = []
    open_ = np.ones(n, bool)
    while n and len(chosen) < most:
        gain = np.bincount(f, need[r] > 0, minlength=n) * open_
        best = int(np.argmax(np.where(gain < 2, 0, gain * worth)))
        if gain[best] < 2 or worth[best] <= 0:
            break
        chosen.append(best)
        mine = r[f == best]
        need[mine] -= 1
        both = np.bincount(f[np.isin(r, mine)], minlength=n)
        open_ &= both < SAME * (count + count[best] - both)
    return np.array(chosen, np.int64)


def vote_moments(docs: DataFrame, voters: np.ndarray) -> tuple[float, np.ndarray]:
    """(rows, matrix): over all rows of ``docs`` (text), how often each two voters fire together; the diagonal alone."""
    v = len(voters)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup, both, n = Lookup(voters), np.zeros((v, v), np.int64), 0
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(0)):
                rows, at = lookup.pairs(data, offsets)
                n += end - first
                some, rows = np.unique(rows, return_inverse=True)
                fires = np.zeros((len(some), v), np.float32)
                fires[rows, at] = 1
                both += np.rint(fires.T @ fires).astype(np.int64)
        i, j = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(both[i, j], n))], names=["i", "j", "n"])

    out, total = np.zeros((v, v)), 0
    for r in docs.select("text").mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        if r["i"] < 0:
            total = r["n"]
        else:
            out[r["i"], r["j"]] = r["n"]
    return float(total), out


@dataclass
class LabelModel:
    """Per voter: its block, how often it fires in toxic and in clean rows of the block, its trust; per block: its share."""

    block: np.ndarray
    toxic: np.ndarray
    clean: np.ndarray
    trust: np.ndarray
    share: np.ndarray


def label_model(total: float, both: np.ndarray, rounds: int = 40) -> LabelModel:
    """Accuracies and correlations of the voters from their moments alone, without labels.

    Voters that fire together more often than by chance form a block, as those of one language do; each block has a hidden
    class of its own, and a row is toxic if it is so for any block. Given the class, voters of a block are independent but
    for correlated pairs: then the covariance of two is the product of their loadings, and the share of the class is what
    two voters' rates and joint rate imply (capture and recapture). Loadings are fitted off the diagonal; pairs that covary
    more than twice as much as fitted are correlated and leave the fit. A voter's trust is one over the number of voters
    correlated with it, itself included.
    """
    v = len(both)
    p = np.maximum(np.diag(both), 0.5) / max(total, 1)
    joint = both / max(total, 1)
    cov = joint - np.outer(p, p)
    near = (cov > 0.05 * np.sqrt(np.outer(p, p))) & (both >= 2)
    block = np.arange(v)
    for _ in range(v):
        lower = np.array([min(block[i], block[near[i]].min(initial=block[i])) for i in range(v)])
        if (lower == block).all():
            break
        block = lower
    _, block = np.unique(block, return_inverse=True)
    toxic, clean, trust, shares = np.zeros(v), np.zeros(v), np.ones(v), np.zeros(block.max(initial=-1) + 1)
    for b in range(len(shares)):
        at = np.flatnonzero(block == b)
        q, c, jt = p[at], cov[np.ix_(at, at)], joint[np.ix_(at, at)]
        off = ~np.eye(len(at), dtype=bool) & (jt > 0)
        implied = (np.outer(q, q)[off] / jt[off]) if off.any() else q
        share = float(np.clip(np.median(implied), q.max() * 1.02, 0.5))
        linked = np.eye(len(at), dtype=bool)
        load = q * np.sqrt((1 - share) / share)
        for turn in range(rounds if off.any() else 0):
            weight = np.where(linked, 0.0, 1.0)
            fitted = np.maximum((weight * c) @ load / np.maximum(weight @ load**2, 1e-15), 0.1 * load)
            load = 0.5 * load + 0.5 * fitted
            if turn % 10 == 9:
                linked = (c > 2 * np.outer(load, load)) | np.eye(len(at), dtype=bool)
        gap = np.minimum(load / np.sqrt(share * (1 - share)), q / share)
        clean[at] = np.clip(q - share * gap, 0.01 * q, 0.5)
        toxic[at] = np.clip(q + (1 - share) * gap, clean[at] * 2, 0.99)
        trust[at] = 1.0 / linked.sum(axis=1)
        shares[b] = share
    return LabelModel(block, toxic, clean, trust, shares)


def posteriors(n: int, rows: np.ndarray, voters: np.ndarray, m: LabelModel) -> np.ndarray:
    """Probability of the toxic class per row, from the votes (row, voter): that of any block."""
    silent = m.trust * (np.log1p(-m.toxic) - np.log1p(-m.clean))
    fired = m.trust * (np.log(m.toxic) - np.log(m.clean)) - silent
    blocks = len(m.share)
    base = np.log(m.share / (1 - m.share)) + np.bincount(m.block, silent, minlength=blocks)
    votes = np.bincount(rows * blocks + m.block[voters], fired[voters], minlength=n * blocks).reshape(n, blocks)
    return 1 - np.prod(1 - 1 / (1 + np.exp(-np.clip(base + votes, -30, 30))), axis=1)


def fit_linear(n: int, rows: np.ndarray, feats: np.ndarray, width: int, target: np.ndarray, rounds: int = 300, decay: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full gradient steps with a step size per feature."""
    w, b = np.zeros(width), 0.0
    gw, gb = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        logit = b + np.bincount(rows, w[feats], minlength=n)
        err = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / max(n, 1)
        g = np.bincount(feats, err[rows], minlength=width) + decay * w / max(width, 1)
        gw += g * g
        gb += err.sum() ** 2
        w -= 0.5 * g / np.sqrt(gw)
        b -= 0.5 * err.sum() / np.sqrt(gb)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model from the labelled rows that are not held out; see the module. Without toxic rows it scores all texts alike."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # Toxic rows are few, so each class gives half of the bound at most; shares are counted on all labelled rows.
    picked = known.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled // 2).union(
        known.where("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled - max_labelled // 2))
    picked = stored(picked.select(F.col("doc_id").alias("_id"), "toxic"), "picked")
    split = known.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    share = min(0.5, max(1e-4, (split["p"] or 0) / max(split["n"], 1)))
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("text", "toxic")
    sample = stored(sample.repartition(24), "sample")
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    hashes, n_toxic = _candidates(sample.where("toxic = 1").select("text"), LEAST_ROWS, MAX_CANDIDATES)
    if not len(hashes):
        return nothing
    n_clean = _count(sample.where("toxic = 0").select("text"), hashes)
    sampled = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # Precision at the true share of toxic rows, since the sample holds more of them.
    rate1, rate0 = n_toxic / max(sampled.get(1, 0), 1), n_clean / max(sampled.get(0, 0), 1)
    precision = rate1 * share / (rate1 * share + rate0 * (1 - share))
    # The classifier weighs whatever toxic rows have more often; the features that tell most about the class come first.
    told = information(rate1, rate0, share)
    good = np.flatnonzero(rate1 > rate0)
    good = np.sort(good[np.argsort(-told[good], kind="stable")][:MAX_FEATURES])
    if not len(good):
        return nothing
    features = hashes[good]
    y, rows, feats = _presence(sample, features)
    voters = np.sort(choose_voters(y, rows, feats, len(features), MAX_VOTERS, COVER, 2 * precision[good] - 1))
    if not len(voters):
        return nothing
    total, both = vote_moments(docs, features[voters])
    model = label_model(total, both)
    place = np.full(len(features), -1)
    place[voters] = np.arange(len(voters))
    votes = place[feats] >= 0
    target = posteriors(len(y), rows[votes], place[feats[votes]], model)
    weights, bias = fit_linear(len(y), rows, feats, len(features), target)
    logit = bias + np.bincount(rows, weights[feats], minlength=len(y))
    # The border between the classes, set on the sample at the true share of toxic rows.
    order = np.argsort(-logit, kind="stable")
    weight = np.where(y == 1, share / max(sampled.get(1, 0), 1), (1 - share) / max(sampled.get(0, 0), 1))[order]
    hit = np.cumsum(weight * y[order])
    f1 = 2 * hit / (np.cumsum(weight) + share)
    last = np.concatenate([np.diff(logit[order]) != 0, [True]])
    best = int(np.argmax(np.where(last, f1, -1)))
    below = logit[order][best + 1] if best + 1 < len(order) else logit[order][best] - 2
    return Model(features, weights, bias - float(logit[order][best] + below) / 2)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text), from the text alone."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup = Lookup(model.hashes)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                rows, at = lookup.pairs(data, offsets)
                logit = model.bias + np.bincount(rows, model.weights[at], minlength=end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs`` (doc_id, text), with ``labels`` (doc_id, toxic).

    Labels of rows that are held out are never read, and a score depends on the text alone. Rows of ``labels`` without an id
    or label are left out, repeated ones count once, as toxic if any says so. NULL and empty texts are scored as texts
    without features; repeated rows are each scored; without toxic labels all scores are the share of toxic rows; an empty
    table gives no rows. Other columns are ignored.
    """
    scored = score(docs, train(docs, labels, max_labelled))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted to be toxic; see ``toxicity``."""
    model = train(docs, labels, max_labelled)
    names = docs.columns

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup, at_text = Lookup(model.hashes), names.index("text")
        for batch in batches:
            logits = [np.full(0, 0.0)]
            for first, end, data, offsets in text_slices(batch.column(at_text)):
                rows, at = lookup.pairs(data, offsets)
                logits.append(model.bias + np.bincount(rows, model.weights[at], minlength=end - first))
            yield batch.filter(pa.array(np.concatenate(logits) < 0))

    return docs.mapInArrow(keep, docs.schema)
