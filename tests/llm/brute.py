"""Plain versions of the operators over lists of (doc_id, text), written from the definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile("[^\x20\x09-\x0d]+")
NORMAL = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near(docs, percent=85):
    sets = []
    for _, text in docs:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            same_id = docs[i][0] == docs[j][0] and sets[i] and sets[j]
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) or same_id:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        key = -math.inf if d is None else d
        least[r] = min(least.get(r, math.inf), key)
    out = []
    for i, (d, _) in enumerate(docs):
        c = least[root(i)]
        c = None if c == -math.inf else c
        out.append((d, len(sets[i]), c, d == c))
    return out


def lines(docs, run=3):
    seqs = {d: ((t or "").split("\n") if t else []) for d, t in docs}
    first = {}
    for d in sorted(seqs):
        for p in range(len(seqs[d]) - run + 1):
            first.setdefault(tuple(seqs[d][p : p + run]), (d, p))
    out = []
    for d, _ in docs:
        gone = set()
        for p in range(len(seqs[d]) - run + 1):
            if first[tuple(seqs[d][p : p + run])] != (d, p):
                gone |= set(range(p, p + run))
        out.append((d, len(seqs[d]), len(gone), sha("\n".join(x for p, x in enumerate(seqs[d]) if p not in gone))))
    return out


def substrings(docs, window=35):
    words = [WORD.findall(t or "") for _, t in docs]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def hit_words(text, items, window=10):
    w = NORMAL.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        v = NORMAL.findall(lower(t))
        n = min(window, len(v))
        if n:
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    return w, hit, found


def contaminated(docs, items):
    out = []
    for d, t in docs:
        w, hit, found = hit_words(t, items)
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def exact(docs):
    best, size = {}, Counter()
    for d, t in docs:
        t = t or ""
        size[t] += 1
        best[t] = max(best.get(t, -math.inf), -math.inf if d is None else d)
    out = []
    for d, t in docs:
        keep = best[t or ""]
        keep = None if keep == -math.inf else keep
        out.append((d, keep, size[t or ""], d == keep, sha(t or "")))
    return out


def lm(docs, order=3, least=1, discount=0.75):
    tokens = [[*WORD.findall(lower(t)), ""] for _, t in docs]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in docs]
    count = [Counter() for _ in range(order + 1)]
    for w, h in zip(tokens, held, strict=True):
        if not h:
            for n in range(1, order + 1):
                count[n].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total, words = sum(count[1].values()), len(count[1])
    kept = [None, count[1], *[{k: v for k, v in c.items() if v >= least} for c in count[2:]]]
    used = defaultdict(float)
    for n in range(2, order + 1):
        for k, v in kept[n].items():
            used[k[:-1]] += (v - discount) / kept[n - 1][k[:-1]]

    def p(g):
        if len(g) == 1:
            return (count[1].get(g, 0) + 1) / (total + words + 1)
        c, lower_p = g[:-1], p(g[1:])
        if c not in kept[len(c)]:
            return lower_p
        return max(kept[len(g)].get(g, 0) - discount, 0) / kept[len(c)][c] + (1 - used[c]) * lower_p

    out = []
    for (d, _), w, h in zip(docs, tokens, held, strict=True):
        base = sum(math.log10((count[1].get((x,), 0) + 1) / (total + words + 1)) for x in w)
        score = sum(math.log10(p(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w)))
        out.append((d, h, len(w), sum((x,) in count[1] for x in w), total, base, score))
    return out


def grams(text):
    """Buckets of the byte 3-grams of the letters' words."""
    letters = "".join(c if c in LOWER or ord(c) > 127 else " " for c in lower(text)).split()
    raw = (" " + " ".join(letters) + " ").encode() if letters else b""
    return [((a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32) >> 20 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False)]


def fold(text):
    return xxhash.xxh64_intdigest((text or "").encode(), seed=42) % 2


def languages(rows, labelled, by_fold=False):
    """(n_grams, lang, confidence, accepted) of each of rows (text, declared, host), from labelled (text, lang)."""
    names = sorted({x for _, x in labelled if x is not None})
    counts = {(f, x): Counter() for f in (0, 1) for x in names}
    for t, x in labelled:
        if x is not None:
            counts[fold(t), x].update(grams(t))
    if not names:
        return [(0, None, 0.0, False)] * len(rows)

    def odds(f):
        out = {}
        for x in names:
            seen = sum((counts[g, x] for g in (0, 1) if not by_fold or g != f), Counter())
            total = sum(seen.values()) + 4096
            out[x] = [math.log((0.8 * (seen[b] + 1) / total + 0.2 / 4096) * 4096) for b in range(4096)]
        return out

    tables = [odds(0), odds(1)]
    found = []
    for t, declared, host in rows:
        g = grams(t)
        table = tables[fold(t)]
        said = (declared or "").lower().split("-")[0]
        own = {}
        for x in names:
            own[x] = sum(table[x][b] for b in g) * 200 / (200 + len(g))
            if said in names:
                own[x] += math.log(0.9 if x == said else 0.1 / max(1, len(names) - 1))
        best = max(own.values())
        vote = next(x for x in names if own[x] == best) if g or said in names else None
        labels = (host or "").split(".")
        keys = ["all", ("s", labels[-1]), ("p", ".".join(labels[-2:])), ("h", host or "")]
        found.append((len(g), own, vote, keys if host else keys[:1], keys))
    votes = defaultdict(Counter)
    for _, _, vote, _, keys in found:
        for k in keys:
            votes[k][vote] += vote is not None
    out = []
    for n, own, vote, keys, _ in found:
        prior = None
        for k in keys:
            others = {x: votes[k][x] - (x == vote) for x in names}
            size = sum(others.values())
            prior = {x: (others[x] + 1) / (size + len(names)) if prior is None else (others[x] + 10 * prior[x]) / (size + 10) for x in names}
        logs = {x: own[x] + math.log(prior[x]) for x in names}
        top = max(logs.values())
        confidence = 1 / (math.exp(math.log(1 / 20) - top) + sum(math.exp(v - top) for v in logs.values())) if vote is not None else 0.0
        out.append((n, next(x for x in names if logs[x] == top) if vote is not None else None, confidence, vote is not None and confidence >= 0.5))
    return out


def identified(docs):
    """docs (doc_id, text, lang, source) that stay: their language can be told and isn't surely another than lang."""
    names = {x[2] for x in docs if x[2] is not None}
    found = languages([(t, None, s) for _, t, _, s in docs], [(t, x) for _, t, x, _ in docs], by_fold=True)
    return [d for d, (_, lang, confidence, accepted) in zip(docs, found, strict=True) if accepted and not (d[2] in names and d[2] != lang and confidence >= 0.99)]
