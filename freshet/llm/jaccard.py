"""N-gram Jaccard join with signature trees.

A document is its set of word shingles. Equal sets are one node of the join. Exact filters give every set keys, of which any
two similar ones share one: hashes of blocks of a set while similar sets differ in few elements, so that blocks hold many of
them, else its first elements in an order that has frequent elements last. Sets with a key in common form clusters, and within
a cluster a signature tree - nodes with OR-combined bitmaps of the elements and ranges of the sizes - is traversed against
itself, which discards pairs of nodes by the largest overlap that they allow; pairs of leaves are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import SpanHash, bounded_broadcast, components, mix64, stored, text_key, text_slices, word_spans

#: Bits of a node's bitmap, sets in a leaf, children of a node.
BITS, LEAF, FANOUT = 4096, 8, 4
#: Sets that one task holds of a cluster at most, and a side of a comparison of parts.
CHUNK = 800
#: Frequent elements that are listed at most, those that sets share in most batches first.
MOST_COMMON = 250_000

#: Slots that tell elements of one set from those of several, and ranges of slots that are added up apart. Slots shared by
#: different elements make clusters larger, never less complete.
SLOT_BITS, RANGES = 27, 64
#: Elements that are counted together.
HELD = 1 << 21
#: Elements of all sets up to which the slots tell them apart; of more, those near the front of a set are counted.
FEW = 1 << SLOT_BITS - 4
#: Bits of an element that is counted, elements that are counted at a time on average, and the fewest ranges they are cut into.
KEY_BITS, AT_ONCE, LEAST_RANGES = 40, 1 << 19, 256
#: Elements of a slice of documents that is dealt into the ranges.
SLICE = 1 << 18
#: Bits of the table that tells which row of a set is counted. Rows that share a slot are counted once more, never left out.
ROW_BITS = 25

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = (_BYTES != 32) & ~((_BYTES >= 9) & (_BYTES <= 13))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingles by row, bounds of the rows); fewer words than a shingle's are one shingle."""
    low = _LOWER[data]
    starts, ends, before = word_spans(low, offsets, _WORD)
    h = SpanHash(low).of(starts, ends)
    n = np.diff(before)
    rows = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) - before[rows]
    # Shorter documents are padded: their words beyond the end count as zero.
    keep = (place + words <= n[rows]) | (place == 0)
    at = np.flatnonzero(keep)
    total = np.full(len(at), np.uint64(words))
    for j in range(words):
        inside = place[at] + j < n[rows[at]]
        part = np.where(inside, h[np.minimum(at + j, len(h) - 1)] if len(h) else np.uint64(0), np.uint64(0))
        total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + part)
    r = rows[at]
    order = np.lexsort((total, r))
    total, r = total[order], r[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (r[1:] != r[:-1])
    total, r = total[new], r[new]
    return total, np.searchsorted(r, np.arange(len(n) + 1))


def has_wide_blocks(num: int, den: int) -> bool:
    """Whether blocks hold some eight elements: similar sets differ in few."""
    return 8 * (den - num) <= den


def _levels(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """Class of a size: sizes of similar sets are in the same or in neighbouring classes."""
    return np.floor(np.log(size) / np.log(den / num) + 1e-9).astype(np.int64)


def block_keys(elements: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): equal keys for every pair of sets with ``den * overlap >= num * union``.

    Sets of the classes L - 1 and L meet at level L. The largest of them has ``top`` elements, so two similar ones differ in
    at most ``d`` elements, and of ``d + 1 + spare`` blocks more than ``spare`` are equal: one of them is not empty unless a set
    has more than ``spare`` empty blocks. ``spare`` follows from the level alone and is rarely exceeded; sets that do so are
    cut into more blocks once more, and should that not do either, their elements themselves are keys.
    """
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    keys, owner = [], []
    level0 = np.where(size > 0, _levels(np.maximum(size, 1), num, den), 0)
    for step in (0, 1):
        level = level0 + step
        top = np.ceil((den / num) ** (level + 1)) + 1
        d = np.floor((den - num) / (den + num) * 2 * top + 1e-9).astype(np.int64)
        # Empty blocks to expect of the smallest sets of the level, and a good deal more.
        empties = (d + 1) * np.exp(-np.maximum((den / num) ** (level - 1.0), 1) / (d + 1))
        few = np.where(d > 0, np.ceil(2 * empties + 4 * np.sqrt(empties)), 0).astype(np.int64)
        todo = size > 0
        for family, spare in enumerate((few, 2 * few + 8)):
            if not todo.any():
                break
            some = todo[row]
            r, e = row[some], elements[some]
            blocks = d + 1 + spare
            b = (mix64(e + np.uint64(family)) % blocks[r].astype(np.uint64)).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(np.where(todo, blocks, 0))])
            slot = first[r] + b
            n = int(first[-1])
            low = np.zeros(n, np.uint64)
            np.add.at(low, slot, mix64(e ^ np.uint64(0x5851F42D4C957F2D)))
            high = np.bincount(slot, minlength=n)
            full = np.flatnonzero(high)
            of = np.searchsorted(first, full, side="right") - 1
            tag = (level[of].astype(np.uint64) << np.uint64(34)) + (np.uint64(family) << np.uint64(32)) + (full - first[of]).astype(np.uint64)
            keys.append(mix64(low[full] + mix64(tag) + high[full].astype(np.uint64)))
            owner.append(of)
            empty = blocks - np.bincount(of, minlength=len(size))
            todo = todo & (empty > spare)
        some = todo[row]
        keys.append(mix64(elements[some] + mix64(level[row[some]].astype(np.uint64) + np.uint64(1 << 50))))
        owner.append(row[some])
    return np.concatenate(keys), np.concatenate(owner)


def slots_of(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def gaps(slots: np.ndarray) -> bytes:
    """Ascending numbers as bytes: the gap to the next one, 255 for as much of it and more to come."""
    more, rest = np.divmod(np.diff(slots, prepend=0), 255)
    out = np.full(int(more.sum()) + len(slots), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def from_gaps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def prefix_keys(
    elements: np.ndarray, bounds: np.ndarray, common: np.ndarray, num: int, den: int, again: np.ndarray | None = None, front: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(element, row): the first elements of each set, of which two sets with ``den * overlap >= num * union`` share one.

    With ``front`` more of them, see ``front_sizes``.

    Their overlap has at least ``num / den`` of the elements of either. Both leave out fewer than that of their last elements
    here, so the first one of the overlap is among those kept, whatever the order, if it is the same for all sets:
    elements whose bit of ``again`` is not set come first, those in ``common`` (sorted) last, then by value.
    """
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    known = common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] == elements if len(common) else np.zeros(len(elements), bool)
    kind = known.astype(np.int8)
    if again is not None:
        at = slots_of(elements)
        kind += (again[at >> 3] >> (at & 7).astype(np.uint8)) & 1
    order = np.lexsort((kind, row))
    place = np.arange(len(elements)) - bounds[row]
    most = front_sizes(size, num, den)[0] if front else size - -(-num * size // den) + 1
    kept = place < most[row]
    return elements[order][kept], row[kept]


def front_sizes(size: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements in the front of a set, how many of them it has in common with that of each similar set at least).

    The overlap of two similar sets is ``num / den`` of the larger one or more. Of either set half as many elements stay out of
    the front, its last ones. So do the last ones of the overlap, in both sets: at most half as many as it has at least.
    """
    return size - num * size // (2 * den), -(-num * size // (2 * den))


# --- signature trees --------------------------------------------------------------------------------------------------


class Tree:
    """A signature tree over sets: leaves of neighbours in the order of size class and smallest elements."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        sizes = np.array([len(s) for s in sets])
        least = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        order = np.lexsort((sizes, least))
        bitmaps = np.zeros((len(sets), BITS // 8), np.uint8)
        for k, i in enumerate(order):
            bits = np.zeros(BITS, bool)
            bits[sets[i] % np.uint64(BITS)] = True
            bitmaps[k] = np.packbits(bits)
        self.order = order
        # levels[0] holds the sets, then leaves, then nodes up to the root: (bitmaps, smallest and largest size, most
        # elements of a set that share their bit with others).
        filled = np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes[order], sizes[order], sizes[order] - filled)]
        self.width = [1]
        while len(self.levels[-1][0]) > 1:
            bm, lo, hi, extra = self.levels[-1]
            at = np.arange(0, len(bm), LEAF if len(self.levels) == 1 else FANOUT)
            self.width.append(LEAF if len(self.levels) == 1 else FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bm, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(extra, at)))


def may_link(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether nodes may hold similar sets. Two sets share at most the common bits and the elements that share a bit with
    another of their set; similarity asks for ``(num + den) * overlap >= num * (size + size)``, and sizes within num/den."""
    common = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1).astype(np.int64)
    overlap = np.minimum(common + np.minimum(a[3][i], b[3][j]), np.minimum(a[2][i], b[2][j]))
    fits = (den * a[2][i] >= num * b[1][j]) & (den * b[2][j] >= num * a[1][i])
    return fits & ((num + den) * overlap >= num * (a[1][i] + b[1][j]))


def similar_links(left: Tree, right: Tree | None, parent: np.ndarray, shift: int, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets of two trees, or within one, by traversing both from their roots.

    ``parent`` is the union-find of the sets of ``left`` and, from ``shift`` on, ``right``; pairs already connected are not
    compared.
    """
    other = left if right is None else right

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    la, lb = len(left.levels) - 1, len(other.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while la or lb:
        # The tree that is higher is opened first, so that both reach their sets together.
        open_a, open_b = la >= lb and la > 0, lb >= la and lb > 0
        if open_a:
            w, size = left.width[la], len(left.levels[la - 1][0])
            i, j = np.repeat(i * w, w) + np.tile(np.arange(w), len(i)), np.repeat(j, w)
            ok = i < size
            i, j, la = i[ok], j[ok], la - 1
        if open_b:
            w, size = other.width[lb], len(other.levels[lb - 1][0])
            i, j = np.repeat(i, w), np.repeat(j * w, w) + np.tile(np.arange(w), len(j))
            ok = j < size
            i, j, lb = i[ok], j[ok], lb - 1
        if right is None and la == lb:
            ok = i <= j
            i, j = i[ok], j[ok]
        keep = []
        for at in range(0, len(i), 16384):
            part = slice(at, at + 16384)
            keep.append(may_link(left.levels[la], i[part], other.levels[lb], j[part], num, den))
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j = i[keep], j[keep]
    links = []
    for a, b in zip(left.order[i].tolist(), other.order[j].tolist(), strict=True):
        if right is None and a == b:
            continue
        x, y = root(a), root(b + shift)
        if x == y:
            continue
        s, t = left.sets[a], other.sets[b]
        overlap = len(np.intersect1d(s, t, assume_unique=True))
        if den * overlap >= num * (len(s) + len(t) - overlap):
            parent[max(x, y)] = min(x, y)
            links.append((a, b))
    return links


# --- the join ---------------------------------------------------------------------------------------------------------


def _compare(tasks: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) from rows (task, side, node, text): side 0 is compared with itself, or with side 1 if there is one."""
    def run(pdf):
        import pandas as pd
        import pyarrow as pa

        out: list[tuple[int, int]] = []
        for _, group in pdf.groupby("task", sort=False):
            sides = []
            for side in (0, 1):
                g = group[group["side"] == side]
                sets: list[np.ndarray] = []
                for first, end, data, offsets in text_slices(pa.array(g["text"], pa.large_string())):
                    elements, bounds = shingle_sets(data, offsets, words)
                    sets += [elements[bounds[k] : bounds[k + 1]] for k in range(end - first)]
                sides.append((g["node"].tolist(), sets))
            (a, sa), (b, sb) = sides
            if not a:
                continue
            if not b:
                out += [(a[x], a[y]) for x, y in similar_links(Tree(sa), None, np.arange(len(a)), 0, num, den)]
            else:
                out += [(a[x], b[y]) for x, y in similar_links(Tree(sa), Tree(sb), np.arange(len(a) + len(b)), len(a), num, den)]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return tasks.groupBy("bin").applyInPandas(run, "a long, b long")


def _scan_sets(docs: DataFrame, words: int, list_common: bool) -> DataFrame:
    """(doc_id, tkey, n, node, common, once, more) per row: size and hash of the set, NULL for a text without words.

    With ``list_common`` the first of some rows has the elements that several of their sets have, and by range the slots of the
    elements that they have at all and that several have; copies of a set in one piece of text are one set.
    """
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flushed(rows, sizes: list, nodes: list, every: list):
            n = np.concatenate(sizes)
            shared = np.concatenate([np.zeros(0, np.uint64), *every])
            every.clear()
            shared.sort()
            often = np.unique(shared[1:][shared[1:] == shared[:-1]])
            # The order of slots is that of elements.
            lists = [_by_range(slots_of(shared)), _by_range(slots_of(often))] if list_common else [[], []]
            often = often.view(np.int64)
            ends = np.concatenate([[0], np.full(len(n), len(often))]).astype(np.int32)
            seen = [pa.array([x, *[[]] * (len(n) - 1)], pa.list_(pa.binary())) for x in lists]
            return pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(n), pa.array(np.concatenate(nodes), mask=n == 0),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(often)), *seen], names=["doc_id", "tkey", "n", "node", "common", "once", "more"])

        for batch in batches:
            start, held, sizes, nodes, every = 0, 0, [], [], []
            for _, end, data, offsets in text_slices(batch.column(1)):
                elements, bounds = shingle_sets(data, offsets, words)
                sizes.append(np.diff(bounds))
                nodes.append(set_hashes(elements, bounds).view(np.int64))
                if list_common:
                    first = np.zeros(len(sizes[-1]), bool)
                    first[np.unique(nodes[-1], return_index=True)[1]] = True
                    every.append(elements[np.repeat(first, sizes[-1])])
                    held += len(every[-1])
                if held > HELD:
                    yield flushed(batch.slice(start, end - start), sizes, nodes, every)
                    start, held, sizes, nodes, every = end, 0, [], [], []
            if sizes:
                yield flushed(batch.slice(start), sizes, nodes, every)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_key().alias("tkey")).mapInArrow(
        scan, f"doc_id {kind}, tkey binary, n long, node long, common array<long>, once array<binary>, more array<binary>")


def _by_range(slots: np.ndarray) -> list[bytes]:
    """Sorted slots as gaps, a list for each range."""
    width = 1 << SLOT_BITS - int(RANGES).bit_length() + 1
    slots = slots[np.concatenate([[True], slots[1:] != slots[:-1]])] if len(slots) else slots
    cuts = np.searchsorted(slots, np.arange(1, RANGES) * width)
    return [gaps(part - i * width) for i, part in enumerate(np.split(slots, cuts))]


def _seen_again(rows: DataFrame) -> np.ndarray:
    """A bit per slot: whether several sets have an element in it. Its size does not depend on the rows.

    ``once`` lists every slot of a batch, ``more`` those of several of its sets. A range's lists are read as a stream.
    """
    width = 1 << SLOT_BITS - int(RANGES).bit_length() + 1

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def packed(of: int, seen: np.ndarray):
            bits = np.packbits(seen > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([bits], pa.binary())], names=["range", "bits"])

        now, seen = None, None
        for batch in batches:
            for of, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != now:
                    if now is not None:
                        yield packed(now, seen)
                    now, seen = of, np.zeros(width, np.uint8)
                at = from_gaps(once)
                seen[at] = np.minimum(seen[at] + 1, 2)
                seen[from_gaps(more)] = 2
        if now is not None:
            yield packed(now, seen)

    zipped = F.posexplode(F.arrays_zip("once", "more")).alias("range", "lists")
    lists = rows.where(F.size("once") > 0).select(zipped).select("range", "lists.once", "lists.more")
    out = np.zeros(1 << SLOT_BITS - 3, np.uint8)
    for r in lists.repartition("range").sortWithinPartitions("range").mapInArrow(add, "range int, bits binary").toArrow().to_pylist():
        out[r["range"] * width // 8 :][: width // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def set_hashes(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set."""
    n = np.diff(bounds)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(elements + np.uint64(1)), dtype=np.uint64)])
    return mix64(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64))


def _scan_keys(docs: DataFrame, words: int, num: int, den: int, common: np.ndarray, again) -> DataFrame:
    """(key, n, node): the keys of every set; copies within a piece of text once."""
    wide = has_wide_blocks(num, den)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                elements, bounds = shingle_sets(data, offsets, words)
                nodes = set_hashes(elements, bounds)
                keys, owner = block_keys(elements, bounds, num, den) if wide else prefix_keys(elements, bounds, common, num, den, again.value)
                first = np.zeros(len(nodes), bool)
                first[np.unique(nodes, return_index=True)[1]] = True
                keys, owner = keys[first[owner]], owner[first[owner]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.diff(bounds)[owner]), pa.array(nodes[owner].view(np.int64))], names=["key", "n", "node"])

    return docs.select("text").mapInArrow(scan, "key long, n long, node long")


def _row_hash() -> Column:
    return F.xxhash64("doc_id", "tkey")


def _row_table(rows: DataFrame) -> np.ndarray:
    """A bit per slot of a row's hash (column ``row``) that one of ``rows`` has; its size does not depend on the rows."""
    width = 1 << ROW_BITS - 4

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            of, at = (np.asarray(c) for c in batch.columns)
            for r in np.unique(of).tolist():
                seen.setdefault(r, np.zeros(width, bool))[at[of == r]] = True
        bits = [np.packbits(x, bitorder="little").tobytes() for x in seen.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(bits, pa.binary())], names=["range", "bits"])

    slot = F.pmod("row", F.lit(1 << ROW_BITS))
    slots = rows.select(F.shiftright(slot, ROW_BITS - 4).alias("range"), F.pmod("row", F.lit(width)).alias("at"))
    out = np.zeros(1 << ROW_BITS - 3, np.uint8)
    for r in slots.repartition("range").mapInArrow(mark, "range long, bits binary").toArrow().to_pylist():
        out[r["range"] * width // 8 :][: width // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _counted_keys(docs: DataFrame, nodes: DataFrame, words: int, num: int, den: int, common: np.ndarray, again, total: int) -> DataFrame:
    """(key, n, node) as from ``_scan_keys``, with the elements in the front of each set ordered by how many sets have them there.

    A table of slots says little once the elements of all sets fill it; counting has no such limit. Slices of documents deal
    their elements into ranges, which count them and send back those of several sets. Two similar sets have some ``least`` of
    their fronts in common, so one of those is not among the last ``least - 1`` of either in any order. Elements of one set
    come first in it and meet no other set: of the ``r`` that are left the first ``r - least + 1`` are keys, if there are any.
    Of copies of a set the row that ``nodes`` names is counted. Elements with equal ``KEY_BITS`` are one: clusters are larger,
    never less complete.
    """
    counted_rows = docs.sparkSession.sparkContext.broadcast(_row_table(nodes))
    bits = max(LEAST_RANGES, total // AT_ONCE).bit_length() - 1
    low = KEY_BITS - bits

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32

        def dealt(sizes: list, nodes: list, keys: list, owners: list):
            n, node = np.concatenate(sizes), np.concatenate(nodes)
            first = np.zeros(len(n), bool)
            first[np.unique(node, return_index=True)[1]] = True
            first &= n > 0
            key, owner = np.concatenate(keys), np.concatenate(owners)
            mine = first[owner]
            key, owner = key[mine], (np.cumsum(first) - 1)[owner[mine]]
            part = (key >> np.uint64(low)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, owner = part[order], owner[order]
            slots = (key[order] & np.uint64((1 << low) - 1)).astype(np.uint32)
            ranges, starts = np.unique(part, return_index=True)
            cuts = [*starts.tolist(), len(part)]
            columns = [
                pa.array([-1, *ranges.tolist()], pa.int32()), pa.array([at] * (len(ranges) + 1), pa.int64()),
                pa.array([node[first].tobytes(), *[gaps(owner[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]], pa.binary()),
                pa.array([n[first].tobytes(), *[slots[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["range", "slice", "owners", "slots"])

        for batch in batches:
            slot = np.asarray(batch.column(1))
            texts = batch.column(0).filter(pa.array((counted_rows.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            sizes, nodes, keys, owners, rows, held = [], [], [], [], 0, 0
            for _, _, data, offsets in text_slices(texts):
                elements, bounds = shingle_sets(data, offsets, words)
                key, owner = prefix_keys(elements, bounds, common, num, den, again.value, front=True)
                sizes.append(np.diff(bounds))
                nodes.append(set_hashes(elements, bounds))
                keys.append(key >> np.uint64(64 - KEY_BITS))
                owners.append(owner + rows)
                rows, held = rows + len(bounds) - 1, held + len(key)
                if held > SLICE:
                    yield dealt(sizes, nodes, keys, owners)
                    sizes, nodes, keys, owners, rows, held, at = [], [], [], [], 0, 0, at + 1
            if sizes:
                yield dealt(sizes, nodes, keys, owners)
                at += 1

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["range", "slice", "owners", "slots", "times"]

        def counted(of: int, lists: list):
            slots = [np.frombuffer(x, np.uint32) for _, _, x in lists]
            _, found, times = np.unique(np.concatenate(slots), return_inverse=True, return_counts=True)
            times = np.minimum(16 * np.log2(times), 255).astype(np.uint8)[found]  # 0: in one set only
            out, start = [], 0
            for (at, owners, _), mine in zip(lists, slots, strict=True):
                n = times[start : start + len(mine)]
                start += len(mine)
                several = n > 0
                if several.any():
                    out.append((of, at, gaps(from_gaps(owners)[several]), mine[several].tobytes(), n[several].tobytes()))
            columns = zip(*out, strict=True) if out else [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        now, lists = None, []
        for batch in batches:
            for of, at, owners, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != now and lists:
                    yield counted(now, lists)
                    lists = []
                now = of
                if of < 0:  # what a slice says of its sets goes back to it
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((of, at, owners, slots, b""), (pa.int32(), pa.int64(), *[pa.binary()] * 3), strict=True)], names=names)
                else:
                    lists.append((at, owners, slots))
        if lists:
            yield counted(now, lists)

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def chosen(head: tuple, lists: list):
            node, n = (np.frombuffer(x, np.int64) for x in head)
            owner = np.concatenate([from_gaps(x) for _, x, _, _ in lists])
            key = np.concatenate([np.frombuffer(x, np.uint32).astype(np.int64) + (of << low) for of, _, x, _ in lists])
            times = np.concatenate([np.frombuffer(x, np.uint8) for *_, x in lists])
            order = np.lexsort((key, times, owner))
            key, owner = key[order], owner[order]
            left = np.bincount(owner, minlength=len(n))
            place = np.arange(len(owner)) - (np.cumsum(left) - left)[owner]
            kept = place < (left - front_sizes(n, num, den)[1] + 1)[owner]
            key, owner = key[kept], owner[kept]
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n[owner]), pa.array(node[owner])], names=["key", "n", "node"])

        now, head, lists = None, None, []
        for batch in batches:
            for of, at, owners, slots, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != now:
                    if lists:
                        yield chosen(head, lists)
                    now, head, lists = at, (owners, slots), []
                else:
                    lists.append((of, owners, slots, times))
        if lists:
            yield chosen(head, lists)

    keyed = docs.select("text", "doc_id", text_key().alias("tkey"))
    asked = keyed.select("text", F.pmod(_row_hash(), F.lit(1 << ROW_BITS))).mapInArrow(deal, "range int, slice long, owners binary, slots binary")
    asked = asked.repartition(F.when(F.col("range") < 0, F.col("slice")).otherwise(F.col("range"))).sortWithinPartitions("range", "slice")
    told = asked.mapInArrow(count, "range int, slice long, owners binary, slots binary, times binary")
    return told.repartition("slice").sortWithinPartitions("slice", "range").mapInArrow(choose, "key long, n long, node long")


def _pairs(keyed: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): neighbours by size among the nodes with one key, unless their sizes rule out similarity.

    Of two similar sets with a key in common all those between them in size are close enough to their neighbours as well, so
    a chain of pairs connects them. Keys are sorted in their partitions and read as a stream.
    """
    def walk(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last = None
        for batch in batches:
            k, n, v = (np.asarray(batch.column(x)) for x in (0, 1, 2))
            if not len(k):
                continue
            if last is not None:
                k, n, v = (np.concatenate([[x], y]) for x, y in zip(last, (k, n, v), strict=True))
            last = k[-1], n[-1], v[-1]
            near = (k[1:] == k[:-1]) & (den * n[:-1] >= num * n[1:]) & (v[1:] != v[:-1])
            pairs = np.unique(np.stack([v[:-1][near], v[1:][near]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    sorted_keys = keyed.repartition("key").sortWithinPartitions("key", "n", "node")
    return sorted_keys.mapInArrow(walk, "a long, b long").distinct()


def _grouped(docs: DataFrame, words: int, num: int, den: int, chunk: int) -> DataFrame:
    """(doc_id, tkey, n, node, component), stored, one row for each row of ``docs``."""
    wide = has_wide_blocks(num, den)
    rows = stored(_scan_sets(docs, words, not wide), "sets")
    # One text stands for each set, and one row.
    nodes = stored(rows.where("n > 0").groupBy("node").agg(F.min("tkey").alias("tkey"), F.min(_row_hash()).alias("row")), "nodes")
    common, again = np.zeros(0, np.uint64), None
    if not wide:
        # A bounded list: what it lacks makes clusters larger, never less complete.
        often = rows.where(F.size("common") > 0).select(F.explode("common").alias("e")).groupBy("e").agg(F.count("*").alias("n"))
        often = often.orderBy(F.desc("n"), "e").limit(MOST_COMMON).select("e").toPandas()
        common = np.sort(often["e"].to_numpy(np.int64).view(np.uint64))
        again = docs.sparkSession.sparkContext.broadcast(_seen_again(rows))
    rows = rows.drop("common", "once", "more")
    total = 0 if wide else rows.agg(F.sum("n")).first()[0] or 0
    keyed = _scan_keys(docs, words, num, den, common, again) if total <= FEW else _counted_keys(docs, nodes, words, num, den, common, again, total)
    clusters = stored(components(_pairs(keyed, num, den)), "clusters")
    links = _links(docs, clusters, nodes, words, num, den, chunk)
    parts = stored(components(links).withColumnRenamed("node", "_node"), "parts")
    joined = rows.join(parts, F.col("node") == F.col("_node"), "left")
    return stored(joined.select("doc_id", "tkey", "n", "node", F.coalesce("component", "node").alias("component")), "grouped")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs`` (doc_id, text).

    Words are runs other than white space, A-Z lower-cased; a text of fewer than ``words`` words is one shingle; one without
    words has no shingles and no links. Two rows link when ``den * overlap >= num * union``; ``component_id`` is the smallest
    id that links lead to, the row's own id included. NULL ids are kept, and are component ids only where no other is there;
    repeated rows are rows with equal sets; an empty table gives no rows. Other columns are ignored.

    Nothing is dropped: equal sets are collapsed first, clusters larger than ``chunk`` sets are split over tasks. There,
    parts are compared with themselves and with the cluster's first part; then only what is not yet in the cluster's largest
    component is compared with all parts. Shingles and sets are known by 64-bit hashes.
    """
    grouped = _grouped(docs.select("doc_id", "text"), words, num, den, chunk)
    least = grouped.where("n > 0").groupBy(F.col("component").alias("_c")).agg(F.min("doc_id").alias("least"))
    joined = grouped.join(stored(least, "least"), F.col("component") == F.col("_c"), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def _links(docs: DataFrame, clusters: DataFrame, nodes: DataFrame, words: int, num: int, den: int, chunk: int) -> DataFrame:
    """Links (a, b) between nodes that span the components of each cluster (node, component)."""
    sizes = stored(clusters.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    wanted = clusters.join(sizes, "component").join(nodes.select("node", "tkey"), "node")
    parts = F.ceil(F.col("size") / F.lit(float(chunk))).cast("int")
    wanted = wanted.withColumns({"parts": parts, "part": F.pmod(F.hash("node"), parts)})
    wanted = stored(wanted.select("node", "component", "parts", "part", F.col("tkey").alias("_key")), "wanted")
    texts = docs.select(text_key().alias("_key"), "text").join(bounded_broadcast(wanted), "_key").dropDuplicates(["node"])
    texts = stored(texts.drop("_key"), "texts")
    n_bins = max(12, -(-texts.count() // 200))

    def binned(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumns({"task": F.concat_ws(":", "component", *keys), "bin": F.pmod(F.xxhash64("component", *keys), F.lit(n_bins))})

    # Every part with itself, and in large clusters with the first part.
    own = binned(texts.withColumn("x", F.col("part")).withColumn("side", F.lit(0)), "x")
    with_first = F.when(F.col("part") == 0, F.sequence(F.lit(1), F.col("parts") - 1)).otherwise(F.array("part"))
    first = texts.where("parts > 1").withColumn("side", (F.col("part") > 0).cast("int")).withColumn("x", F.explode(with_first))
    tasks = own.unionByName(binned(first.withColumn("x", -F.col("x")), "x"))
    links = stored(_compare(tasks, words, num, den), "links")
    if texts.where("parts > 2").limit(1).count() == 0:
        return links
    # The rest of large clusters: sets outside the largest component meet all parts.
    big = texts.where("parts > 2")
    found = components(links).withColumnRenamed("component", "root")
    placed = stored(big.drop("text").join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    count = placed.groupBy("component", "root").agg(F.count("*").alias("n"))
    top = count.groupBy("component").agg(F.max_by("root", F.struct("n", "root")).alias("top"))
    rest = placed.join(top, "component").where("root <> top").select("node", "component")
    shares = rest.groupBy("component").agg(F.ceil(F.count("*") / F.lit(float(chunk))).cast("int").alias("shares"))
    rest = stored(rest.join(shares, "component").withColumn("share", F.pmod(F.hash("node", F.lit(1)), F.col("shares"))), "rest")
    shares = stored(shares, "shares")
    every = big.join(shares, "component").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).withColumn("x", F.col("part")).withColumn("side", F.lit(0))
    few = big.join(rest.select("node", "share"), "node").withColumn("y", F.col("share")).withColumn("side", F.lit(1))
    few = few.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["node", "text", "component", "x", "y", "side"]
    more = _compare(binned(every.select(columns).unionByName(few.select(columns)), "x", "y"), words, num, den)
    return links.union(stored(more.where("a <> b"), "links"))


def keep_one(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest id of their component; see ``jaccard_components``.

    Of several such rows the one with the smallest hash of its text stays, of equal rows any one. NULL ids come last. Rows
    without words are linked with nothing and stay, each of them.
    """
    grouped = _grouped(docs.select("doc_id", "text"), words, num, den, chunk).where("n > 0")
    first = grouped.groupBy(F.col("component").alias("_c")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("_best"))
    judged = grouped.join(stored(first, "first"), F.col("component") == F.col("_c"))
    mine = F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")
    gone = judged.where(~mine.eqNullSafe(F.col("_best"))).select(F.col("tkey").alias("_key"), F.col("doc_id").alias("_id")).distinct()
    twice = judged.where(mine.eqNullSafe(F.col("_best"))).groupBy(F.col("tkey").alias("_key"), F.col("doc_id").alias("_id")).count().where("count > 1").drop("count")
    gone, twice = stored(gone, "gone"), stored(twice, "twice")
    same = (text_key() == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    kept = docs.join(bounded_broadcast(gone), same, "left_anti")
    if twice.isEmpty():
        return kept
    once = kept.join(bounded_broadcast(twice), same, "left_semi").withColumn("_key", text_key())
    return kept.join(bounded_broadcast(twice), same, "left_anti").union(once.dropDuplicates(["doc_id", "_key"]).drop("_key"))
