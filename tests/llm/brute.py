"""Plain versions of the operators for small inputs."""

from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import pyarrow.parquet as pq

from chronostar.llm.common import words


def table(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def remainder(key, n):
    return crc32(str(key).encode()) % n


def contamination(texts, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - width + 1) if ws else 0):
            windows[tuple(ws[i : i + width])].add(str(item))
    out = []
    for text in texts:
        ws, own = words(text), set()
        hit = [False] * len(ws)
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in windows:
                    own |= windows[tuple(ws[i : i + n])]
                    hit[i : i + n] = [True] * n
        out.append((len(ws), sum(hit), sorted(own)))
    return out


def shingles(text, n=5):
    ws = words(text)
    return {tuple(ws[k : k + n]) for k in range(max(1, len(ws) - n + 1))} if ws else set()


def near_duplicates(rows, similarity=0.8):
    """(key, class, links) of (key, text) rows with different keys."""
    sets = [shingles(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    classes = defaultdict(list)
    for x in range(len(rows)):
        classes[top(x)].append(rows[x][0])
    return sorted((rows[x][0], min(classes[top(x)]), links[x]) for x in range(len(rows)))


class Bigrams:
    def __init__(self, rows):
        lower = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
        self.tokens = [(text or "").encode().translate(lower).split() + [b""] for _, text in rows]
        self.held = [remainder(key, 10) == 0 for key, _ in rows]
        self.counts, self.pairs, self.after, self.kinds = Counter(), Counter(), Counter(), Counter()
        for ws, held in zip(self.tokens, self.held):
            if held:
                continue
            self.counts.update(ws)
            for pair in zip([None, *ws], ws):
                self.after[pair[0]] += 1
                self.kinds[pair[0]] += not self.pairs[pair]
                self.pairs[pair] += 1
        self.total = sum(self.counts.values())
        once, twice = (sum(n == k for n in self.pairs.values()) for k in (1, 2))
        self.discount = min(0.95, max(0.5, once / (once + 2 * twice))) if once else 0.5

    def prior(self, w):
        return (self.counts[w] + 0.1) / (self.total + 0.1 * (len(self.counts) + 1))

    def base(self, ws):
        return sum(log10(self.prior(w)) for w in ws)

    def score(self, ws):
        out = 0.0
        for u, w in zip([None, *ws], ws):
            n = self.after[u]
            mass = self.discount * self.kinds[u] / n if n else 1.0
            own = max(self.pairs.get((u, w), 0) - self.discount, 0) / n if n else 0.0
            out += log10(own + mass * self.prior(w))
        return out
