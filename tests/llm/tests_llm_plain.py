"""Plain versions of what the operators do, on lists of rows."""

import re
from collections import Counter
from math import log2

import xxhash


def word_fingerprint(text):
    votes = [0] * 64
    for word, n in Counter((text or "").encode().lower().split()).items():
        h = xxhash.xxh64(word, seed=42).intdigest()
        for b in range(64):
            votes[b] += round(16 * log2(1 + n)) * (1 if h >> b & 1 else -1)
    return sum(1 << b for b in range(64) if votes[b] > 0)


def jaccard(a, b):
    parts = [{" ".join(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in ((x or "").encode().lower().decode().split() for x in (a, b))]
    return len(parts[0] & parts[1]) / len(parts[0] | parts[1])


def keep_exact(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        rank = (-len(r["text"] or ""), r["doc_id"])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    return [r for _, r in best.values()]


def keep_near(rows, radius=6):
    fps = [word_fingerprint(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and jaccard(rows[i]["text"], rows[j]["text"]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        k = find(i)
        if k not in least or r["doc_id"] < least[k]["doc_id"]:
            least[k] = r
    return list(least.values())
