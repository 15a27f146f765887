"""Brute-force versions of the operators on lists of rows, as the queries' contracts word them."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = {}
    for doc_id, text in docs:
        text = text or ""
        spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        n = Counter(k for k, _, _ in spans)
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        out[doc_id] = (n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
    return out


def shingles(text):
    w = BLANK.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    holders, up = defaultdict(list), {d: d for d in sets}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for a, s in sets.items():
        inter = Counter(b for x in s for b in holders[x] if b > a)
        for b, n in inter.items():
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def decontamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = LETTERS.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    out = {}
    for doc_id, text in docs:
        w = LETTERS.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        out[doc_id] = (len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit))
    return out


def substring_dedup(docs, width=35):
    split = {k: BLANK.findall(t or "") for k, (_, t) in enumerate(docs)}
    seen = Counter(tuple(w[i : i + width]) for w in split.values() for i in range(len(w) - width + 1))
    out = {}
    for k, w in split.items():
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out[docs[k][0]] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def top_k(rows, step=20, k=20):
    import math

    vectors = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors[vec_id] = [math.floor(64 * float(x)) for x in v]
    out = set()
    for q, v in vectors.items():
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vectors.items() if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out
