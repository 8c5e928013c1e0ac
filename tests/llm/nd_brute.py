"""Brute-force near-duplicates on small inputs."""

import re


def sets(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, k=3, hundred=85):
    """rows: [(doc_id, text)] -> {doc_id: (n_shingles, component, kept)} comparing only sets that share a shingle."""
    s = {d: sets(t, k) for d, t in rows}
    root = {d: d for d in s}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    same, index = {}, {}
    for d in sorted(s):
        if s[d] and s[d] in same:
            root[d] = find(same[s[d]])
        elif s[d]:
            same[s[d]] = d
    for x, d in same.items():
        # of sets with at least 85 % in common, some element among the first 15 % + 1 (in one order) is shared
        o = sorted(x, key=hash)[: len(x) - -(-hundred * len(x) // 100) + 1]
        near = set()
        for e in o:
            near.update(index.get(e, ()))
            index.setdefault(e, []).append(d)
        for c in near:
            y = s[c]
            if find(c) != find(d) and 100 * len(x & y) >= hundred * len(x | y):
                a, b = sorted((find(c), find(d)))
                root[b] = a
    return {d: (len(s[d]), find(d), find(d) == d) for d in s}
