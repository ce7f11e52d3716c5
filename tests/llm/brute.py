"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text: str | None, k: int = 4) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_groups(rows: list[tuple[int, str | None]], k: int = 4) -> dict[int, int]:
    """Smallest id reachable, by all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * (both := len(x & y)) >= 80 * (len(x) + len(y) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in ids}


def without_repeats(rows: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple[int, list[str]]]:
    """(words, kept words) by id."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), i)
    out = {}
    for i, own in words.items():
        gone = [False] * len(own)
        for s in range(len(own) - window + 1):
            if first[tuple(own[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out[i] = (len(own), [w for w, g in zip(own, gone, strict=True) if not g])
    return out


def luhn(number: str) -> bool:
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(number))]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for n, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if ok:
                found.append((m.start(), n, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def components(links: dict[int, set[int]]) -> dict[int, int]:
    """The least node reachable from each."""
    out: dict[int, int] = {}
    for start in sorted(links):
        todo = [start] if start not in out else []
        while todo:
            i = todo.pop()
            if i not in out:
                out[i] = start
                todo += links[i]
    return out


def linked(vectors: dict[int, tuple], threshold: float) -> dict[int, set[int]]:
    """Links by all pairs of equal labels; vectors: id -> (label, vector)."""
    import numpy as np

    out: dict[int, set[int]] = defaultdict(set)
    able = {i: (lab, np.array(v, float)) for i, (lab, v) in vectors.items() if lab is not None and v is not None and None not in v}
    able = {i: (lab, v) for i, (lab, v) in able.items() if len(v) and np.isfinite(v).all() and v.any()}
    for i, (la, a) in able.items():
        for j, (lb, b) in able.items():
            if i != j and la == lb and len(a) == len(b) and (a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                out[i].add(j)
    return {i: out.get(i, set()) for i in vectors}
