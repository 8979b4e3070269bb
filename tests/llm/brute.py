"""Plain Python versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def components(docs, k, num, den):
    """docs: (doc_id, text) rows -> list of (doc_id, n, component) in the same order."""
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[find(i)] = find(j)
    rank = lambda d: (d is not None, d or 0)  # noqa: E731  a null id is the smallest
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)], key=rank)) for i, (d, _) in enumerate(docs)]


def repeats(docs, width):
    """(doc_id, words, kept words) of every row."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, docs[i][1] or ""))
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    places = sorted(((docs[i][0] is not None, docs[i][0] or 0), s, order.index(i), i) for i in range(len(docs)) for s in range(len(words[i]) - width + 1))
    gone = [set() for _ in docs]
    for _, s, _, i in places:
        key = tuple(words[i][s:s + width])
        if first.setdefault(key, (i, s)) != (i, s):
            gone[i].update(range(s, s + width))
    return [(docs[i][0], words[i], [w for n, w in enumerate(words[i]) if n not in gone[i]]) for i in range(len(docs))]


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def best_fit(sizes, capacity):
    """Number of bins of plain best-fit decreasing, and the multiset of their fillings."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= s]
        if fit:
            i = min(fit, key=lambda j: (rooms[j], j))
            rooms[i] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms), sorted(rooms)
