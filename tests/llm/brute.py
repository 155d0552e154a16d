"""Plain restatements of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substrings(docs: list[tuple], length: int = 35) -> list[tuple]:
    words = [SPACE_WORDS.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def _roots(ids: list, links: list[tuple]) -> dict:
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard(docs: list[tuple], n: int = 3, num: int = 90, den: int = 100) -> list[tuple]:
    sets = []
    for _, t in docs:
        w = SPACE_WORDS.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    of = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            of[x].add(i)
    links = []
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in of[x] if j < i)
        links += [(i, j) for j, k in both.items() if den * k >= num * (len(s) + len(sets[j]) - k)]
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    rank = {i: r for r, i in enumerate(order)}
    roots = _roots(list(range(len(docs))), [(rank[a], rank[b]) for a, b in links])
    return [(docs[i][0], len(sets[i]), docs[order[roots[rank[i]]]][0]) for i in range(len(docs))]


def vectors(rows: list[tuple], threshold: float = 0.98) -> list[tuple]:
    def fine(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        return math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(x * x for x in b))

    n, links = Counter(), []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if fine(a, la) and fine(b, lb) and la == lb and len(a) == len(b) and (list(a) == list(b) or cosine(a, b) >= threshold):
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    rank = {i: r for r, i in enumerate(order)}
    roots = _roots(list(range(len(rows))), [(rank[a], rank[b]) for a, b in links])
    out = []
    for i, r in enumerate(rows):
        root = rows[order[roots[rank[i]]]][0]
        out.append((r[0], n[i], root, root == r[0]))
    return out


def decontamination(docs: list[tuple], items: list[tuple], n: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, t in items:
        w = ALNUM_WORDS.findall((t or "").translate(LOWER))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])] |= {str(item)} - {"None"}
    sizes = {len(k) for k in windows}
    out = []
    for doc, t in docs:
        w = ALNUM_WORDS.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i : i + size]))
                if got is not None:
                    hit.update(range(i, i + size))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(rows: list[tuple], at_least: int = 3, top: int = 200) -> list[tuple]:
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    count, texts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = TERMS.findall(text.translate(LOWER))
        count[lang, source].update(found)
        texts[lang].update(set(found))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in texts[lang].items() if n >= at_least]

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        own = {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((own[s][t] - whole[t]) ** 2 // whole[t]), t) for t in kept if count[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:most])]
    return out


def token_files(docs: list[tuple], encode, end: int) -> list[tuple]:
    """docs: (doc_id, text), ids that repeat have the same text."""
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*encode(text or ""), end]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
