"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def substring(docs, k):
    """docs: (doc_id, text). Per row: n_words, n_removed, kept."""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for s in range(len(w) - k + 1):
            at = (LAST if d is None else d, s)
            key = tuple(w[s : s + k])
            first[key] = min(first.get(key, at), at)
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s : s + k])] < (LAST if d is None else d, s):
                gone.update(range(s, s + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fingerprint(text, size=4):
    words = WORD.findall(lower(text or ""))
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, linked):
    """The least index that links reach, for each of n items."""
    label = list(range(n))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


LETTERS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items, k):
    own = [(d, LETTERS.findall(lower(t or ""))) for d, t in docs]
    windows = {}
    for name, t in items:
        w = LETTERS.findall(lower(t or ""))
        size = min(k, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[s : s + size]), set()).add("null" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for d, w in own:
        hit, found = set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[tuple(w[s : s + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


BASE = (
    ("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base_secrets(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    return [f"{name}:{s}:{e}" for s, _, e, name in sorted(found)]


def common_lines(docs, least=8, size=lambda line: len(line.split())):
    """docs: (doc_id, text), ids distinct. Numbers of the lines in runs of at least so many words that an earlier document has."""
    own = {d: [x.strip() for x in t.split("\n") if x.strip()] for d, t in docs}
    runs = {d: {tuple(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)} for d, w in own.items()}
    out = {}
    for d, w in own.items():
        older = set().union(*(runs[e] for e in own if e < d))
        out[d] = {
            k for i in range(len(w)) for j in range(i + 1, len(w) + 1)
            if tuple(w[i:j]) in older and sum(map(size, w[i:j])) >= least for k in range(i, j)
        }
    return out
