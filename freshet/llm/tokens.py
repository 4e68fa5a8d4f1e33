"""Token counts by offset-mapped attribution: documents are encoded once, whole, and their tokens are given to sections.

A token is a span of characters, a section too; the two sorted lists are joined by interval inside each document, so no
token leaves its task. Tokens that cross a border are allocated by an explicit rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from freshet.llm.common import text_slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts a text into pieces before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "largest", "share")

_encoders: dict[str, tuple] = {}


def _encoder(vocabulary: str):
    """(encoder, bytes per token id), read once per worker process."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, rank in ranks.items():
            lengths[rank] = len(word)
        _encoders[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[vocabulary]


def line_sections(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which lines start; a line holds its line break."""
    return np.concatenate([[0], np.flatnonzero(data[:-1] == 10) + 1])


def attribute(token_ends: np.ndarray, starts: np.ndarray, total: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section for sorted token ends and section starts over ``total`` bytes.

    ``first`` gives a token to the section of its first byte, ``last`` to that of its last byte, ``largest`` to the section
    with most of its bytes, the earlier of equal ones, ``share`` to each section the part of its bytes there. A crossing
    token counts for every section it touches.
    """
    token_starts = np.concatenate([[0], token_ends[:-1]])
    n = len(starts)
    a = np.searchsorted(starts, token_starts, side="right") - 1
    b = np.searchsorted(starts, token_ends - 1, side="right") - 1
    bounds = np.append(starts, total)
    crosses = np.flatnonzero(a != b)
    # A token may cover many short sections: one row for each section that it touches.
    reps = b[crosses] - a[crosses] + 1
    token = np.repeat(crosses, reps)
    section = np.arange(len(token)) - np.repeat(np.cumsum(reps) - reps, reps) + a[token]
    part = np.minimum(token_ends[token], bounds[section + 1]) - np.maximum(token_starts[token], bounds[section])
    crossing = np.bincount(section, minlength=n)
    if rule == "share":
        whole = np.bincount(a[a == b], minlength=n).astype(float)
        return whole + np.bincount(section, part / (token_ends[token] - token_starts[token]), minlength=n), crossing
    owner = b if rule == "last" else a
    if rule == "largest" and len(crosses):
        owner = a.copy()
        order = np.lexsort((section, -part, token))
        best = order[np.concatenate([[True], np.diff(token[order]) != 0])]
        owner[token[best]] = section[best]
    return np.bincount(owner, minlength=n).astype(float), crossing


def token_counts(docs: DataFrame, rule: str = "largest", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, section, first_char, n_chars, n_tokens, n_crossing), a row per line of each row of ``docs`` (doc_id, text).

    Each text is encoded once, as a whole; its lines, line breaks included, share its tokens by ``rule``, so that the lines'
    tokens add up to the text's. Sections count from 0, places are code points. NULL and empty texts have one section
    without characters or tokens; NULL ids are kept; repeated rows each give their rows; an empty table gives none. Other
    columns are ignored. There is no shuffle: a task holds one batch of texts.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, lengths = _encoder(vocabulary)
        names = ["doc_id", "section", "first_char", "n_chars", "n_tokens", "n_crossing"]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, end, data, offsets in text_slices(texts):
                owner, section, at, chars, tokens, crossing = [], [], [], [], [], []
                # Places in code points: continuation bytes do not count.
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                for i in range(first, end):
                    lo, hi = offsets[i - first], offsets[i - first + 1]
                    text = data[lo:hi]
                    if hi == lo:
                        starts, n, x = np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64)
                    else:
                        ids_of = np.asarray(encoder.encode_ordinary(text.tobytes().decode("utf-8", "replace")), np.int64)
                        starts = line_sections(text)
                        n, x = attribute(np.cumsum(lengths[ids_of]), starts, hi - lo, rule)
                    place = points[lo + starts] - points[lo]
                    owner.append(np.full(len(starts), i))
                    section.append(np.arange(len(starts)))
                    at.append(place)
                    chars.append(np.diff(np.append(place, points[hi] - points[lo])))
                    tokens.append(n)
                    crossing.append(x)
                cat = np.concatenate
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cat(owner))), pa.array(cat(section)), pa.array(cat(at)), pa.array(cat(chars)),
                     pa.array(cat(tokens).astype(float)), pa.array(cat(crossing).astype(np.int64))], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, section long, first_char long, n_chars long, n_tokens double, n_crossing long")
