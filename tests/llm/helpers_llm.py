"""Brute-force versions of the corpus operators, for small tables."""

import hashlib
import re
from collections import Counter


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def repeated_bytes(rows, length):
    """n_bytes, n_removed, n_spans and kept bytes of each row."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def later_bytes(rows, length):
    """Kept bytes if only later copies go, rows in order."""
    seen, out = set(), []
    for _, text in rows:
        t = (text or "").encode()
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = [True] * length
            seen.add(t[p : p + length])
        out.append(bytes(b for b, g in zip(t, gone) if not g))
    return out


def shingle_set(text, size):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def jaccard_components(rows, size, percent):
    sets = {i: shingle_set(text, size) for i, text in rows}
    union = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


def line_runs(rows, min_words):
    """Kept text of each (doc_id, text), rows in the order of doc_id; ids are unique."""
    lines = [(d, n, line, len(line.split())) for d, text in rows if text is not None
             for n, line in enumerate(x for x in text.split("\n") if x.split())]
    gone = set()
    for i, (d, *_) in enumerate(lines):
        for j in range(i):
            run = words = 0
            while i + run < len(lines) and lines[i + run][0] == d and lines[j + run][0] == lines[j][0]:
                if lines[i + run][2] != lines[j + run][2]:
                    break
                words += lines[i + run][3]
                run += 1
            if words >= min_words:
                gone |= {(d, lines[i + k][1]) for k in range(run)}
    out = {}
    for d, text in rows:
        if text is None:
            out[d] = None
            continue
        kept, number, pending, last = [], 0, [], False
        for line in text.split("\n"):
            if not line.split():
                pending.append(line)
                continue
            goes = (d, number) in gone
            kept += [] if last and goes else pending
            pending, last = [], goes
            kept += [] if goes else [line]
            number += 1
        out[d] = "\n".join(kept + pending)
    return out


def words(text):
    return re.findall(r"[^\W_]+|_", re.sub(r"_", " ", text.lower())) if text else []


def sha256(data):
    return hashlib.sha256(data).hexdigest()
