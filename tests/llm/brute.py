"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None, width: int) -> frozenset:
    words = SPACE.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_duplicates(docs: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, tuple[int, int, bool]]:
    """doc_id to (n_shingles, component_id, kept), comparing every pair that shares a shingle."""
    sets = {i: shingles(t, width) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def contamination(docs, items, window=13):
    """Rows (doc_id, n_words, n_hit, sorted item ids)."""
    windows = defaultdict(set)
    for item, text in items:
        words = LETTER.findall(lower(text))
        if words:
            n = min(window, len(words))
            for i in range(len(words) - n + 1):
                windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = LETTER.findall(lower(text)), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def line_dedup(docs, least=10):
    """Rows (doc_id, n_lines, n_dropped, kept text)."""
    def key(line):
        return lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))

    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(docs, window=35):
    """Rows (doc_id, n_words, n_removed, kept text)."""
    split = [SPACE.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc, _), words in zip(docs, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def phrases(text, table):
    words = LETTER.findall(lower(text))
    places, labels = [], set()
    for phrase, label in table:
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), sorted(labels)
