"""Plain single-machine versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_vectors(rows, least=0.98):
    good = []
    for vec_id, vector, label in rows:
        fine = vector is not None and label is not None and len(vector) and None not in vector
        v = np.array(vector, float) if fine else None
        good.append(v if fine and np.isfinite(v).all() and v.any() else None)
    counts, links = Counter(), []
    for i, (a, va) in enumerate(zip(rows, good)):
        for j in range(i):
            b, vb = rows[j], good[j]
            if va is None or vb is None or a[2] != b[2] or len(va) != len(vb):
                continue
            if va @ vb / (np.sqrt(va @ va) * np.sqrt(vb @ vb)) >= least:
                counts[i] += 1
                counts[j] += 1
                links.append((a[0], b[0]))
    roots = components({r[0] for r in rows}, links)
    return sorted(
        (r[0], counts[i], roots[r[0]], roots[r[0]] == r[0]) for i, r in enumerate(rows)
    )


ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)


def secret_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [
        (m.start(), 1, "access", m.end())
        for m in re.finditer("AKIA[A-Z0-9]+", text)
        if len(m[0]) >= 18
    ]
    found += [
        (m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def luhn(number):
    total = 0
    for n, d in enumerate(reversed(number)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_spans(text):
    def digits(value):
        return re.sub("[^0-9]", "", value)

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda v: all(int(p) <= 255 for p in v.split(".")),
        ),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(digits(v)) <= 15),
    )
    found = []
    for place, (kind, pattern, good) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            if good(m[0]):
                found.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_dedup(rows):
    def key(line):
        k = line.strip(WHITE).translate(LOWER)
        return k if len(k) >= 10 else None

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and key(line):
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(key(line), ()) if doc_id is not None else ()
            if len(held) < 2 or min(held) == doc_id:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingle_set(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    count = min(words, len(found))
    return frozenset(tuple(found[i : i + count]) for i in range(len(found) - count + 1))


def jaccard(rows, percent=90):
    sets = {doc_id: shingle_set(text) for doc_id, text in rows}
    by = defaultdict(list)
    for doc_id, s in sets.items():
        for x in s:
            by[x].append(doc_id)
    pairs = {(a, b) for held in by.values() for a in held for b in held if a < b}
    links = [
        (a, b)
        for a, b in pairs
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = components(sets, links)
    return sorted((d, len(s), roots[d]) for d, s in sets.items())


def top_k(rows, k=10):
    vectors = {
        i: [int(np.floor(1024 * float(x))) for x in v]
        for i, v in rows
        if v is not None and None not in v and np.isfinite(v).all()
    }
    out = []
    for q, vq in vectors.items():
        if q % 100 == 0:
            scores = [
                (-sum(a * b for a, b in zip(vq, v)), i) for i, v in vectors.items() if i != q
            ]
            for rank, (s, i) in enumerate(sorted(scores)[:k], 1):
                out.append((q, rank, i, -s))
    return sorted(out)


def crc(data: bytes) -> int:
    return zlib.crc32(data)
