"""Plain versions of what the operators compute, one document at a time."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
PATTERNS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
)


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    return sorted((m.start(), r, m.end()) for r, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m.group()))


def span_text(spans):
    return ",".join(f"{PATTERNS[r][0]}:{a}:{b}" for a, r, b in spans)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(docs):
    """doc_id -> smallest doc_id reachable, for (doc_id, text) with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(docs, length=100):
    """doc_id -> (bytes, removed, runs, SHA-256 of the rest), for documents in order."""
    seen, out = set(), {}
    for d, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(w)
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
