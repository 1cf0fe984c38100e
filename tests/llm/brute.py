"""Near duplicates by comparing every pair that shares a shingle."""

import re
from collections import defaultdict


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    near, root = defaultdict(set), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            near[x].add(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in near[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}
