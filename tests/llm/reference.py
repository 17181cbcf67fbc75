"""Plain versions of the operators, row by row, for tests."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= n)


def base_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in base_spans(text)).encode()).hexdigest()


def quality_counts(text: str | None) -> dict[str, int]:
    text = text or ""
    w = words(text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORD.search(line))
        seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup, "n_repeat_words": len(covered)}


def shingles(text: str | None, k: int) -> frozenset:
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(rows: list[tuple], k: int, least: int) -> dict:
    """id -> smallest id reachable, of (id, text) with distinct ids, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):  # noqa: ANN001, ANN202
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by: dict = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    done = set()
    for members in by.values():
        for x in range(len(members)):
            for y in range(x + 1, len(members)):
                a, b = members[x], members[y]
                if (a, b) in done:
                    continue
                done.add((a, b))
                n = len(sets[a] & sets[b])
                if 100 * n >= least * (len(sets[a]) + len(sets[b]) - n):
                    ra, rb = find(a), find(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}
