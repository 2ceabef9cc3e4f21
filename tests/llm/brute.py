"""Plain Python versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_duplicates(rows):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text), by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def removed_bytes(rows, span=100):
    """{doc_id: (bytes, mask)} of (doc_id, text): bytes of strings that start earlier too."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        x = (t or "").encode()
        gone = [False] * len(x)
        for p in range(len(x) - span + 1):
            s = x[p:p + span]
            if s in seen:
                gone[p:p + span] = [True] * span
            seen.add(s)
        out[i] = (x, gone)
    return out


def fill(budget, rows):
    """Water filling of (name, most, weight), a token at a time to the row that is least served."""
    got = {n: 0 for n, _, _ in rows}
    for _ in range(min(budget, sum(m for _, m, _ in rows))):
        name = min((n for n, m, _ in rows if got[n] < m),
                   key=lambda n: (got[n] + 1) / next(w for x, _, w in rows if x == n))
        got[name] += 1
    return got
