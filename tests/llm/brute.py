"""Plain single-process forms of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _spans(covered: list[bool]) -> int:
    return sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))


def substring(rows: list[tuple], width: int) -> list[tuple]:
    """(key, n_words, n_removed, sha) per (key, text)."""
    order = lambda k: -(2**63) if k is None else k
    words = [WORD.findall(t or "") for _, t in rows]
    first: dict[tuple, int] = {}
    for (key, _), w in zip(rows, words):
        for i in range(len(w) - width + 1):
            window = tuple(w[i : i + width])
            first[window] = min(order(key), first.get(window, order(key)))
    out = []
    for (key, _), w in zip(rows, words):
        covered = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < order(key):
                covered[i : i + width] = [True] * width
        kept = " ".join(x for x, c in zip(w, covered) if not c)
        out.append((key, len(w), sum(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def suffix(rows: list[tuple], width: int) -> list[tuple]:
    """(key, n_bytes, n_removed, n_spans, sha) per (key, text)."""
    order = lambda k: -(2**63) if k is None else k
    texts = [(t or "").encode() for _, t in rows]
    first: dict[bytes, tuple] = {}
    for (key, _), t in zip(rows, texts):
        for i in range(len(t) - width + 1):
            window = t[i : i + width]
            first[window] = min((order(key), i), first.get(window, (order(key), i)))
    out = []
    for (key, _), t in zip(rows, texts):
        covered = [False] * len(t)
        for i in range(len(t) - width + 1):
            if first[t[i : i + width]] < (order(key), i):
                covered[i : i + width] = [True] * width
        kept = bytes(b for b, c in zip(t, covered) if not c)
        out.append((key, len(t), sum(covered), _spans(covered), hashlib.sha256(kept).hexdigest()))
    return out
