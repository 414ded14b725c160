"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def remainder(doc_id, modulus: int) -> int:
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(texts: dict, percent: int = 75) -> dict:
    """Least id reachable from each id over links between the ids' texts."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    shared = Counter((a, b) for own in holders.values() for x, a in enumerate(own) for b in own[x + 1 :])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def jaccard(a: list, b: list) -> float:
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    found = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= least]
    return sorted(found)


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """By sharing out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        left, by = total - sum(out.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / by > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / by for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
    return out


def base_scores(rows: list[tuple], modulus: int = 7) -> tuple[dict, int]:
    """(n_tokens, n_known, base score) by doc_id, and the training tokens."""
    train = Counter()
    for i, t in rows:
        if remainder(i, modulus) != 2:
            train.update([*words(t), None])
    total, different = sum(train.values()), len(train)
    out = {}
    for i, t in rows:
        tokens = [*words(t), None]
        score = sum(math.log10((train[w] + 1) / (total + different + 1)) for w in tokens)
        out[i] = (len(tokens), sum(train[w] > 0 for w in tokens), score)
    return out, total


def pieces(ids: list[int], capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of one document."""
    cuts = list(range(len(ids), 0, -capacity))
    return [(max(0, end - capacity), end - max(0, end - capacity)) for end in reversed(cuts)]


def crc32(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
