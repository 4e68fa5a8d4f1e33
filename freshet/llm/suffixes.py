"""Suffix arrays by induced sorting with bucket queues that spill, and common prefixes of neighbours.

Works on one shard of text inside a task. Suffixes are known by their place; the queue hands them out by their first
character and, within it, in the order of arrival, which is their order. From the sorted leftmost S-suffixes all L-suffixes
are induced in ascending order, from these all S-suffixes in descending order. The leftmost S-suffixes are sorted by the same
induction over their substrings, then by the string of the substrings' names.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Bytes of places that a queue keeps in memory.
QUEUE_BYTES = 64 << 20
#: Places that are compared with their predecessors at a time.
COMPARED = 1 << 15


class BucketQueue:
    """Batches of places by bucket, first in first out; what exceeds ``limit`` bytes goes to files in Spark's scratch folder."""

    def __init__(self, buckets: int, limit: int = QUEUE_BYTES):
        self.batches: list[list[np.ndarray]] = [[] for _ in range(buckets)]
        self.limit, self.held, self.folder = limit, 0, None

    def push(self, bucket: int, places: np.ndarray) -> None:
        self.batches[bucket].append(places)
        self.held += places.nbytes
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        if self.folder is None:
            scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.folder = tempfile.TemporaryDirectory(dir=scratch if scratch and os.path.isdir(scratch) else None)
        for bucket, held in enumerate(self.batches):
            if held:
                with open(os.path.join(self.folder.name, str(bucket)), "ab") as f:
                    for places in held:
                        f.write(places.tobytes())
                self.batches[bucket] = []
        self.held = 0

    def pop(self, bucket: int) -> np.ndarray:
        held = self.batches[bucket]
        self.batches[bucket] = []
        self.held -= sum(x.nbytes for x in held)
        path = os.path.join(self.folder.name, str(bucket)) if self.folder else ""
        if path and os.path.exists(path):
            held = [np.fromfile(path, np.int32), *held]
            os.remove(path)
        return np.concatenate(held) if held else np.zeros(0, np.int32)

    def close(self) -> None:
        if self.folder is not None:
            self.folder.cleanup()


def smaller_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the last is."""
    n = len(t)
    change = np.flatnonzero(t[:-1] != t[1:])
    s = np.ones(n, bool)
    if len(change):
        nearest = np.searchsorted(change, np.arange(n - 1))
        at = change[np.minimum(nearest, len(change) - 1)]
        s[:-1] = np.where(nearest < len(change), t[at] < t[np.minimum(at + 1, n - 1)], False)
    return s


def _deal(queue: BucketQueue, t: np.ndarray, places: np.ndarray, own: int) -> np.ndarray:
    """Put places into their buckets in their order; those of bucket ``own`` come back."""
    c = t[places]
    order = np.argsort(c, kind="stable")
    places, c = places[order], c[order]
    cuts = np.flatnonzero(np.diff(c)) + 1
    again = np.zeros(0, np.int32)
    for lo, hi in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(c)]]).tolist(), strict=True):
        if lo < hi:
            if c[lo] == own:
                again = places[lo:hi]
            else:
                queue.push(int(c[lo]), places[lo:hi])
    return again


def induce(t: np.ndarray, s: np.ndarray, lms: list[np.ndarray], limit: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S-suffixes of each bucket in order."""
    n_buckets = len(lms)
    empty = np.zeros(0, np.int32)

    def before(places: np.ndarray, smaller: bool) -> np.ndarray:
        p = places[places > 0] - np.int32(1)
        return p[s[p] == smaller]

    queue, larges = BucketQueue(n_buckets, limit), [empty] * n_buckets
    for c in range(n_buckets):
        now = queue.pop(c)
        found = [now]
        while len(now):
            now = _deal(queue, t, before(now, False), c)
            found.append(now)
        larges[c] = np.concatenate(found)
        if len(lms[c]):
            _deal(queue, t, before(lms[c], False), -1)
    queue.close()
    queue, out = BucketQueue(n_buckets, limit), []
    for c in range(n_buckets - 1, -1, -1):
        now = queue.pop(c)
        found = [now]
        while len(now):
            now = _deal(queue, t, before(now, True), c)
            found.append(now)
        descending = np.concatenate(found)
        if c == 0:  # the end of the string, which nothing induces
            descending = np.concatenate([descending, lms[0]])
        if len(larges[c]):
            _deal(queue, t, before(larges[c][::-1], True), -1)
        out += [descending, larges[c][::-1]]
        larges[c] = empty
    queue.close()
    return np.concatenate(out)[::-1]


def _by_bucket(t: np.ndarray, places: np.ndarray, buckets: int) -> list[np.ndarray]:
    c = t[places]
    order = np.argsort(c, kind="stable")
    bounds = np.searchsorted(c[order], np.arange(buckets + 1))
    places = places[order].astype(np.int32)
    return [places[bounds[b] : bounds[b + 1]] for b in range(buckets)]


def suffix_array(t: np.ndarray, limit: int = QUEUE_BYTES) -> np.ndarray:
    """Places of the suffixes of ``t`` in order.

    ``t`` has small whole numbers, a single 0 at its end and no other.
    """
    from freshet.llm.common import SpanHash

    buckets = int(t.max()) + 1
    s = smaller_types(t)
    first = np.zeros(len(t), bool)
    first[1:] = s[1:] & ~s[:-1]
    lms = np.flatnonzero(first)
    if len(lms) < 2:
        return induce(t, s, _by_bucket(t, np.array([len(t) - 1]), buckets), limit)
    # Order of the leftmost S-substrings, each up to the start of the next one.
    order = induce(t, s, _by_bucket(t, lms, buckets), limit)
    order = order[first[order]].astype(np.int64)
    ends = np.append(lms[1:] + 1, len(t))
    number = np.zeros(len(t), np.int64)
    number[lms] = np.arange(len(lms))
    name = SpanHash(t).of(lms, ends) + (ends - lms).astype(np.uint64)
    sorted_name = name[number[order]]
    rank = np.zeros(len(lms), np.int64)
    rank[number[order]] = np.concatenate([[0], np.cumsum(sorted_name[1:] != sorted_name[:-1])])
    # The string of names, by doubled prefixes.
    step = 1
    while rank.max() + 1 < len(rank):
        pair = rank * (len(rank) + 1)
        pair[:-step] += rank[step:] + 1
        by = np.argsort(pair, kind="stable")
        rank[by] = np.concatenate([[0], np.cumsum(np.diff(pair[by]) != 0)])
        step *= 2
    return induce(t, s, _by_bucket(t, lms[np.argsort(rank, kind="stable")], buckets), limit)


def common_prefixes(t: np.ndarray, order: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, predecessor) by place: the common prefix of each suffix with its predecessor in the order, none across a
    character of ``stop`` or less.

    Where the characters before both are equal, the length is one less than at the place before; only the other places are
    compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    own = (before < 0) | (at == 0) | (before == 0)
    own |= (t[at - 1] != t[before - 1]) | (t[at - 1] <= stop)
    todo = np.flatnonzero(own & (before >= 0))
    length = np.zeros(n, np.int64)
    width = 16
    padded = np.concatenate([t, np.zeros(width, t.dtype)])
    steps = np.arange(width)
    for lo in range(0, len(todo), COMPARED):
        place = todo[lo : lo + COMPARED]
        a, b = place, before[place]
        while len(place):
            x = padded[a[:, None] + steps]
            differs = (x != padded[b[:, None] + steps]) | (x <= stop)
            some = differs.any(axis=1)
            length[place] += np.where(some, differs.argmax(axis=1), width)
            place, a, b = place[~some], a[~some] + width, b[~some] + width
    last = np.maximum.accumulate(np.where(own, at, 0))
    return np.maximum(length[last] - (at - last), 0), before
