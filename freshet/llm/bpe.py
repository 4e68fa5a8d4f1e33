"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a prefix has one last token, and without it what is left is the encoding of a shorter prefix. So one token
per prefix describes the encodings of all prefixes. An automaton over the vocabulary gives the tokens that are suffixes of
a prefix; the one that is compatible with the last token of the prefix before it is stored. Two tokens are compatible if
merging would leave the border between them alone, which the merges that made the two decide. Back-pointers from the end
of the text give the ids. No merge is carried out, so the time is linear in the text, also for a run of one character.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from freshet.llm.common import text_slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: how byte-level tokenizers cut a text into pieces; merges stay inside a piece.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts up to U+024F, whose letters, numbers and blanks are a few ranges.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
NARROW = f" ?[{_L}]++| ?[{_N}]++|'(?:[stmd]|re|ve|ll)| ?[^{_S}{_L}{_N}]++|[{_S}]+(?![^{_S}])|[{_S}]+"
# Letters and numbers of Unicode 17. The tokenizer knows those of Unicode 16 and takes these for symbols.
NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
SYMBOL = "\u0378"  # an unassigned code point
#: Pieces and pairs that a worker remembers; beyond that it starts over.
REMEMBERED = 750_000
#: Bytes of text that are encoded together, and of pieces that are encoded side by side with others of their class.
CHUNK, SHORT = 1 << 22, (16, 64, 256)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones for themselves, others from 256 upwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """The tokens that are suffixes of what was read: states are the tokens' prefixes, links lead to the longest proper suffix
    that is a state, too. ``longest`` is a state's longest token, ``shorter`` the next one that is a suffix of a token."""

    def __init__(self, tokens: dict[int, bytes]):
        state = {b"": 0}
        for t in sorted(tokens.values(), key=len):
            for end in range(1, len(t) + 1):
                state.setdefault(t[:end], len(state))
        names = list(state)[1:]
        parent = np.array([state[n[:-1]] for n in names], np.int64)
        last = np.array([n[-1] for n in names], np.int64)
        depth = np.array([len(n) for n in names])
        order = np.argsort(parent * 256 + last)
        self.edges, self.to = (parent * 256 + last)[order], order + 1
        self.link = np.zeros(len(state), np.int64)
        self.longest = np.full(len(state), -1, np.int64)
        self.longest[[state[t] for t in tokens.values()]] = list(tokens)
        for d in range(1, int(depth.max()) + 1):
            at = np.flatnonzero(depth == d)
            if d > 1:
                self.link[at + 1] = self.step(self.link[parent[at]], last[at])
            none = at[self.longest[at + 1] < 0] + 1
            self.longest[none] = self.longest[self.link[none]]
        self.shorter = np.full(max(tokens) + 1, -1, np.int64)
        self.shorter[list(tokens)] = self.longest[self.link[[state[t] for t in tokens.values()]]]

    def step(self, states: np.ndarray, read: np.ndarray) -> np.ndarray:
        """States after a byte more; every byte is a token, so there is one."""
        out, todo = np.zeros(len(states), np.int64), np.arange(len(states))
        while len(todo):
            edge = states[todo] * 256 + read[todo]
            at = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            there = self.edges[at] == edge
            out[todo[there]] = self.to[at[there]]
            todo = todo[~there]
            states = states.copy()
            states[todo] = self.link[states[todo]]
        return out


class _Remembered(dict):
    """Values of ``make``, computed on first use."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class Encoder:
    """A byte-level vocabulary file: tokens, merges, the automaton over tokens, pieces and added tokens.

    Files with other normalizers, pre-tokenizers or options than plain byte-level merging are refused.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if odd or model["type"] != "BPE" or spec["normalizer"] or not plain:
            raise ValueError(f"{path} is no plain byte-level vocabulary: {odd or pre}")
        letters, ids = byte_letters(), model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take their surroundings")
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items() if all(c in letters for c in t)}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        # Per token its place among the merges (-1 for a byte) and the two tokens it was merged from.
        base = [ids[c] for c in letters if c in ids]
        if len(base) != 256:
            raise ValueError(f"{path} lacks bytes")
        self.rank = dict.fromkeys(base, -1)
        self.parts, self.merged = {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, token = (ids[left], ids[right]), ids[left + right]
            if token in self.rank or any(p not in self.rank for p in pair):
                raise ValueError(f"{path}: a token has two merges, or comes before its parts")
            self.rank[token], self.parts[token], self.merged[pair] = rank, pair, rank
        #: By token: places among the merges, parts and bytes; by pair of tokens, in order: the place of their merge.
        width = self.width = max(self.bytes_of) + 1
        self.size = np.array([len(self.bytes_of.get(i, b"")) for i in range(width)], np.int64)
        self.rank_of, self.left_of, self.right_of = np.full(width, -1, np.int64), np.zeros(width, np.int64), np.zeros(width, np.int64)
        self.rank_of[list(self.rank)] = list(self.rank.values())
        merges = [left * width + right for left, right in self.parts.values()]
        self.left_of[list(self.parts)], self.right_of[list(self.parts)] = np.divmod(np.array(merges, np.int64).reshape(-1), width)
        order = np.argsort(merges)
        self.merge_pairs, self.merge_ranks = np.array(merges, np.int64)[order], order
        self.automaton = SuffixAutomaton({t: self.bytes_of[t] for t in self.rank})
        self.sizes, self.longest, self.shorter = (a.tolist() for a in (self.size, self.automaton.longest, self.automaton.shorter))
        self.pattern, self.newer = regex.compile(PATTERN), regex.compile(f"[{NEWER}]")
        self.narrow, self.beyond = re.compile(NARROW), re.compile("[^\\x00-\u024f]")
        specials = "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.special = re.compile(f"({specials})") if specials else None
        #: All tokens' bytes in one piece, and where each starts.
        every = [self.bytes_of.get(i, b"") for i in range(width)]
        self.bounds = np.concatenate([[0], np.cumsum(self.size)])
        self.data = np.frombuffer(b"".join(every), np.uint8)
        self.forget()

    def forget(self) -> None:
        #: Pairs of tokens that were looked at, in order, and whether they stay apart.
        self.pairs, self.apart = np.zeros(0, np.int64), np.zeros(0, bool)
        #: Numbers of the pieces seen, and their ids, one after the other.
        self.pieces: dict[str, int] = {}
        self.ids, self.ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        #: For long pieces: states after a byte, and whether pairs stay apart.
        self.steps = _Remembered(lambda key: int(self.automaton.step(np.array([key // 256]), np.array([key % 256]))[0]))
        self.fits = _Remembered(lambda pair: bool(self.keep_apart(np.array([pair]))[0]))

    def keep_apart(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of two tokens ends with these two, for each pair ``left * width + right``.

        The merges of both are undone, latest first, while looking at the two tokens that touch: had they a merge that comes
        before the last one undone, it would have joined them. Of equal merges the left one comes first: one undone on the
        left came before the border's, one undone on the right after it.
        """
        left, right = np.divmod(pairs, self.width)
        limit, out, todo = np.full(len(pairs), len(self.merge_pairs)), np.ones(len(pairs), bool), np.arange(len(pairs))
        while len(todo):
            pair = left[todo] * self.width + right[todo]
            at = np.minimum(np.searchsorted(self.merge_pairs, pair), len(self.merge_pairs) - 1)
            joined = (self.merge_pairs[at] == pair) & (self.merge_ranks[at] < limit[todo])
            out[todo[joined]] = False
            a, b = self.rank_of[left[todo]], self.rank_of[right[todo]]
            more = ~joined & ((a >= 0) | (b >= 0))
            todo, a, b = todo[more], a[more], b[more]
            of_left = a > b
            x, y = todo[of_left], todo[~of_left]
            limit[x], left[x] = a[of_left], self.right_of[left[x]]
            limit[y], right[y] = b[~of_left] + 1, self.left_of[right[y]]
        return out

    def compatible(self, pairs: np.ndarray, new: list) -> np.ndarray:
        """``keep_apart`` of pairs; those not remembered are added to ``new``."""
        at = np.searchsorted(self.pairs, pairs)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == pairs[known]
        out = np.zeros(len(pairs), bool)
        out[known] = self.apart[at[known]]
        if not known.all():
            some, inverse = np.unique(pairs[~known], return_inverse=True)
            kept = self.keep_apart(some)
            out[~known] = kept[inverse]
            new.append((some, kept))
        return out

    def last_tokens(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The last token of each prefix of each piece; ``data`` has a row of bytes per piece, longest first."""
        auto, new = self.automaton, []
        last = np.zeros(data.shape, np.int32)
        states = np.zeros(len(data), np.int64)
        for end in range(data.shape[1]):
            todo = np.arange(np.searchsorted(-sizes, -end))
            states[todo] = auto.step(states[todo], data[todo, end].astype(np.int64))
            token = auto.longest[states[todo]]
            while len(todo):
                before = end - self.size[token]
                fits = before < 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.compatible(last[todo[inner], before[inner]].astype(np.int64) * self.width + token[inner], new)
                last[todo[fits], end] = token[fits]
                todo, token = todo[~fits], auto.shorter[token[~fits]]
        if new:
            pairs, one = np.unique(np.concatenate([self.pairs, *(p for p, _ in new)]), return_index=True)
            self.pairs, self.apart = pairs, np.concatenate([self.apart, *(k for _, k in new)])[one]
        return last

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that were not seen yet: short ones together, position by position, others one by one."""
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        size[[i for i, p in enumerate(pieces) if p in self.added]] = 0
        order, ids, ends = [], [], []
        for least, most in zip((0, *SHORT), SHORT, strict=False):
            some = np.flatnonzero((size > least) & (size <= most))
            if len(some):
                some = some[np.argsort(-size[some], kind="stable")]
                flat, of = self._side_by_side([raw[i] for i in some], size[some])
                order += some.tolist()
                ids.append(flat)
                ends.append(of)
        for i in np.flatnonzero((size == 0) | (size > SHORT[-1])).tolist():
            order.append(i)
            ids.append(np.array(self.encode_long(raw[i]) if size[i] else [self.added[pieces[i]]], np.int32))
            ends.append(np.array([len(ids[-1])]))
        first = len(self.pieces)
        self.pieces.update((pieces[i], first + k) for k, i in enumerate(order))
        for of in ends:
            self.ends.append(of + self.ends[-1][-1])
        self.ids, self.ends = [np.concatenate([*self.ids, *ids])], [np.concatenate(self.ends)]

    def _side_by_side(self, raw: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, end of each piece's) of pieces that are sorted by size, longest first."""
        data = np.zeros((len(raw), size[0]), np.uint8)
        data[np.arange(size[0]) < size[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
        last = self.last_tokens(data, size)
        # Back-pointers of all pieces at once; a piece's tokens come out last first.
        at, todo, found = size - 1, np.arange(len(raw)), []
        while len(todo):
            token = last[todo, at[todo]]
            found.append((todo, token))
            at[todo] -= self.size[token]
            todo = todo[at[todo] >= 0]
        owner, token = (np.concatenate([f[x] for f in found]) for x in (0, 1))
        turn = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        order = np.lexsort((-turn, owner))
        return token[order], np.cumsum(np.bincount(owner, minlength=len(raw)))

    def encode_long(self, data: bytes) -> list[int]:
        """Ids of one piece of any length, prefix by prefix."""
        size, width, last, state = self.sizes, self.width, [], 0
        for end, read in enumerate(data):
            state = self.steps[state * 256 + read]
            token = self.longest[state]
            while (before := end - size[token]) >= 0 and not self.fits[last[before] * width + token]:
                token = self.shorter[token]
            last.append(token)
        out, at = [], len(data) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[out[-1]]
        return out[::-1]

    def cut(self, text: str) -> list[str]:
        """Pieces of a text; strings of added tokens are pieces of their own."""
        if self.special is None or not self.special.search(text):
            return self._cut(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([p] if i % 2 else self._cut(p) for i, p in enumerate(parts)))

    def _cut(self, text: str) -> list[str]:
        if text.isascii() or not self.beyond.search(text):
            return self.narrow.findall(text)
        if not self.newer.search(text):
            return self.pattern.findall(text)
        # Code points are swapped one for one, so the places of the pieces are the text's.
        return [text[m.start():m.end()] for m in self.pattern.finditer(self.newer.sub(SYMBOL, text))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of the texts)."""
        if max(map(len, (self.pieces, self.pairs, self.steps, self.fits))) > REMEMBERED:
            self.forget()
        found = [self.cut(t) for t in texts]
        new = set(chain.from_iterable(found)).difference(self.pieces)
        if new:
            self.learn(list(new))
        of_text = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        piece = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(found)), np.int64, of_text[-1])
        ids, bounds = _gathered(self.ids[0], self.ends[0][piece], self.ends[0][piece + 1])
        return ids, bounds[of_text]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids; ids that are no token give nothing, broken characters U+FFFD."""
        known = np.where((ids >= 0) & (ids < len(self.size)), ids, len(self.size))
        places = np.append(self.bounds, self.bounds[-1])
        data, at = _gathered(self.data, places[known], places[known + 1])
        raw = data.tobytes()
        at = at[bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts of ``data``, one after the other, bounds of the parts)."""
    size = ends - starts
    bounds = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(starts - bounds[:-1], size) + np.arange(bounds[-1])], bounds


_encoders = _Remembered(Encoder)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text): the ids of its whole text.

    NULL and empty texts have no ids; NULL ids of documents are kept; repeated rows each give a row; an empty table gives
    none. Other columns are ignored. There is no shuffle; a task holds one batch of texts and the ids of about a megabyte of
    them. A text is one value of any length, also where it is a single piece.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = _encoders[vocabulary]
        for batch in batches:
            owner, texts = batch.column(0), batch.column(1)
            for first, end, _, _ in text_slices(texts, CHUNK):
                flat, bounds = encoder.encode([t or "" for t in texts.slice(first, end - first).to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([owner.slice(first, end - first), ids], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, text) for each row of ``encoded`` (doc_id, ids).

    No ids, or NULL for them, give the empty text; NULLs among ids and ids that the vocabulary lacks give nothing; bytes that
    are no UTF-8 give U+FFFD. Other columns are ignored.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = _encoders[vocabulary]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = part.column(1).fill_null([])
                bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
                texts = encoder.decode(ids.flatten().fill_null(-1).to_numpy(), bounds)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
