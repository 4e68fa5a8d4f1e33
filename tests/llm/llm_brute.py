"""Plain versions of the text operators for small inputs."""

import hashlib
import math
import re
from collections import Counter

UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed(texts, length):
    """Per text, a flag for each byte covered by a string that starts elsewhere too."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        flags = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                flags[i : i + length] = b"\x01" * length
        out.append(bytes(flags))
    return out


def shingles(text, n):
    words = blanks(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def groups(sets, num, den):
    """Number of the component of each set; sets without elements are alone."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and den * both >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contaminated(text, items, span=10):
    """(words, places hit, ids of items found)."""
    words, hit, found = bench_words(text), set(), set()
    for item_id, item in items:
        own = bench_words(item)
        m = min(span, len(own))
        windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                found.add(item_id)
    return words, hit, found


KINDS = [
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def base_secrets(text):
    """(start, no, kind, end, value) in order."""
    out = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        out += [(m.start(), no, kind, m.end(), m[group]) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(out)


def secrets(rows):
    """Per row (text, owner): spans (start, no, kind, end, value, live)."""
    owners = {}
    base = [base_secrets(t) for t, _ in rows]
    for spans, (_, owner) in zip(base, rows, strict=True):
        for s in spans:
            owners.setdefault(s[4], set()).add(owner)
    live = {v for v, o in owners.items() if len(o) == 1}
    out = []
    for spans, (text, _) in zip(base, rows, strict=True):
        mine = [(*s, s[4] in live) for s in spans]
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text or ""):
            if len(m[0]) >= 16 and re.search("[0-9]", m[0]) and m[0] in live and not any(s[0] <= m.start() and s[3] >= m.end() for s in spans):
                mine.append((m.start(), 3, "value", m.end(), m[0], True))
        out.append(sorted(mine))
    return out


def redacted(text, spans, mark="[secret]"):
    out, at = "", 0
    for s in spans:
        if s[5]:
            start = s[3] - len(s[4])
            if start >= at:
                out += text[at:start] + mark
            at = max(at, s[3])
    return out + text[at:]


def backoff_scores(texts, factor=0.4, least=2):
    words = [blanks(lower(t)) for t in texts]
    one, two = Counter(), Counter()
    for w in words:
        one.update(w)
        two.update(zip(w, w[1:], strict=False))
    total = sum(one.values())
    out = []
    for w in words:
        score, backed = 0.0, 0
        for i, x in enumerate(w):
            if i and two[w[i - 1], x] >= least:
                score += math.log(two[w[i - 1], x] / one[w[i - 1]])
            else:
                score += math.log(one[x] / total) + (math.log(factor) if i else 0.0)
                backed += i > 0
        out.append((len(w), backed, score))
    return out


def mix(rows, weight_of, weights=(5, 2, 1), share=1.5, cap=2.0, seed="mix"):
    """Rows (doc_id, text, source): (doc_id, size, target, taken) by round after round of resharing."""
    size = [len(blanks(t)) for _, t, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}) + ([None] if any(s is None for *_, s in rows) else [])
    own = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(own.values()), set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > cap * own[s]}
        for s in over or free:
            target[s] = cap * own[s] if s in over else w[s] * level
        left -= sum(cap * own[s] for s in over)
        free = free - over if over else set()
    out = []
    for s in names:
        keyed = []
        for i, (doc_id, text, source) in enumerate(rows):
            if source == s:
                name = hashlib.md5(f"{seed}|{'' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
                keyed.append((-math.log((int(name[:13], 16) + 0.5) / 2**52) / weight_of(doc_id), name, i))
        epochs = int(target[s] // own[s]) if own[s] else 0
        left = math.floor(target[s]) - epochs * own[s]
        for _, _, i in sorted(keyed):
            part = max(0, min(left, size[i]))
            left -= part
            out.append((rows[i][0], size[i], target[s], epochs * size[i] + part))
    return out
