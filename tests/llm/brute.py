"""Slow, plain versions of the operators, to hold their results against."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingle_set(text, size=5):
    w = words(lower(text))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_duplicates(docs, percent, size=5):
    """``{doc_id: (n_shingles, component)}``; every pair is compared that shares a shingle."""
    sets = {i: shingle_set(t, size) for i, t in docs}
    of = {}
    for i, s in sets.items():
        for x in s:
            of.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    from collections import Counter

    for i, s in sets.items():
        shared = Counter()
        for x in s:
            shared.update(j for j in of[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeated(units, window, seen):
    """Which units of one document lie in a window that ``seen`` holds; adds its windows to ``seen``."""
    gone = [False] * len(units)
    for i in range(len(units) - window + 1):
        key = tuple(units[i : i + window]) if isinstance(units, list) else units[i : i + window]
        if key in seen:
            gone[i : i + window] = [True] * window
        seen.add(key)
    return gone


def substring_dedup(docs, window):
    """``{doc_id: (n_words, n_removed, kept_sha256)}``."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        gone = repeated(w, window, seen)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def byte_dedup(docs, window):
    """``{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}``."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = repeated(raw, window, seen)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g)))
    return out
