"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def groups(items, linked):
    """Index lists of connected items."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if find(i) != find(j) and linked(items[i], items[j]):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(items)):
        out[find(i)].append(i)
    return list(out.values())


def shingles(text):
    own = [w.lower() for w in words(text)]
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def jaccard_components(rows):
    """(doc_id, size, component) of (doc_id, text) rows."""
    sets = [shingles(text) for _, text in rows]
    out = []
    for members in groups(sets, similar):
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids, default=None)) for i in members]
    return out


def passages(rows, length=50):
    """(doc_id, bytes, removed, spans, digest) of (doc_id, text) rows."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            first[data[i : i + length]] = min(doc_id, first.get(data[i : i + length], doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            if first[data[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality_counts(text):
    own = words(text)
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    chars = sum(len(w.decode()) for w in own)
    return len(own), chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)
