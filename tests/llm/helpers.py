"""Plain reference versions, written without the library."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = [None, "", " ", "\n\t ", "a", "A b", "a b", "word " * 30, "é ü 漢字 😀",
             "one two three four five six seven eight nine ten " * 400]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def shingle_set(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def groups(links, nodes):
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_duplicate_groups(rows, size, percent):
    sets = {d: shingle_set(t, size) for d, t in rows}
    inverted, links = defaultdict(list), []
    for d in sorted(sets):
        shared = defaultdict(int)
        for s in sets[d]:
            for e in inverted[s]:
                shared[e] += 1
            inverted[s].append(d)
        links += [(d, e) for e, n in shared.items()
                  if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n)]
    found = groups(links, sets)
    return {d: (len(sets[d]), found[d]) for d in sets}


def repeated_bytes(rows, length=100):
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        marks = bytearray(b"." * len(data))
        for i in range(len(data) - length + 1):
            part = data[i:i + length]
            if part in seen:
                marks[i:i + length] = b"x" * length
            seen.add(part)
        kept = bytes(b for b, m in zip(data, marks) if m == 46)
        spans = [m.span() for m in re.finditer(b"x+", bytes(marks))]
        out[d] = (len(data), marks.count(b"x"), spans, hashlib.sha256(kept).hexdigest())
    return out
