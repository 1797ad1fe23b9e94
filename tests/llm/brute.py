"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter


class Classes:
    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def find(self, a):
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_classes(docs, percent=80):
    sets = {i: shingle_set(t) for i, t in docs}
    classes, ids = Classes(sets), [i for i in sets if sets[i]]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                classes.link(a, b)
    return sorted((i, len(sets[i]), classes.find(i)) for i in sets)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def far(a, b, distance):
    """Whether the letters alone show that the edit distance is larger."""
    one, two = Counter(a), Counter(b)
    return sum(((one - two) + (two - one)).values()) > 2 * distance


def deduped_lines(docs, distance=2, least=20, near=40):
    """(id, text, number of lines cut) with every pair of lines compared."""
    places = {}
    for i, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\n\r\v\f")
            if len(line) >= least:
                places.setdefault(line, []).append((i, n))
    lines = list(places)
    classes = Classes(range(len(lines)))
    for x, a in enumerate(lines):
        for y, b in enumerate(lines[:x]):
            if min(len(a), len(b)) >= near and abs(len(a) - len(b)) <= distance and not far(a, b, distance) and edit_distance(a, b) <= distance:
                classes.link(x, y)
    members = {}
    for x, line in enumerate(lines):
        members.setdefault(classes.find(x), []).extend(places[line])
    gone = {p for m in members.values() for p in m if p != min(m)}
    out = []
    for i, text in docs:
        kept = [x for n, x in enumerate((text or "").split("\n")) if (i, n) not in gone]
        out.append((i, None if text is None else "\n".join(kept), sum(p[0] == i for p in gone)))
    return sorted(out)


def cosine_links(rows, least=0.93):
    """(id, links, component, kept) of (id, vector, label) rows."""
    import math

    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    classes, links = Classes([r[0] for r in rows]), {r[0]: 0 for r in rows}
    for x, (i, u, l) in enumerate(rows):
        for j, v, k in rows[:x]:
            if l is not None and l == k and ok(u) and ok(v) and len(u) == len(v):
                dot = sum(a * b for a, b in zip(u, v))
                if dot / math.sqrt(sum(a * a for a in u) * sum(b * b for b in v)) >= least:
                    classes.link(i, j)
                    links[i] += 1
                    links[j] += 1
    return sorted((i, links[i], classes.find(i), classes.find(i) == i) for i in links)
