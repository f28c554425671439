"""Plain single-process form of the spelling operator."""

from __future__ import annotations

import re
import zlib
from collections import Counter

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows: list[tuple], least_length: int, least_count: int, one_in: int) -> dict[str, int]:
    found: Counter = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def variants(words: dict[str, int], times: int) -> dict[str, tuple]:
    """word -> (n, n_near, form, form_n, root); pairs meet through the word without any one character or with it masked."""
    holes: dict[tuple, set] = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :], "*"), set()).add(w)
            holes.setdefault(("", w[:i] + w[i + 1 :], "-"), set()).add(w)
        holes.setdefault(("", w, "-"), set()).add(w)
    near: dict[str, set] = {w: set() for w in words}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words.get(form[w]), root)
    return out
