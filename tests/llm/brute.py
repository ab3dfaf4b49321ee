"""The operators over again in plain Python, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def statistics(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def base_failed(text):
    n, *_, repeats = statistics(text)
    return n < 50 or 100 * repeats > 50 * n


def lowered(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = lowered(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """Smallest id in reach per row of (id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            ids[find(i)].append(name)
    return [min(ids[find(i)], default=None) if sets[i] else rows[i][0] for i in range(len(rows))]


def rates(sizes):
    """Source to (size, target) from a list of (source, size)."""
    total = defaultdict(int)
    for source, size in sizes:
        total[source] += size
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    target, stopped, rest = {}, set(), float(sum(total.values()))
    while True:
        free = [s for s in order if s not in stopped]
        level = rest / sum(weight[s] for s in free) if free else 0.0
        over = [s for s in free if weight[s] * level > 3 * total[s] + 1e-9]
        if not over:
            return {s: (total[s], target.get(s, weight[s] * level)) for s in order}
        for s in over:
            target[s] = 3.0 * total[s]
            stopped.add(s)
            rest -= target[s]


def copies(doc_id, source, of):
    size, target = of[source]
    rate = target / size if size else 0.0
    coin = int(hashlib.md5(f"mix:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    return math.floor(rate) + (coin < rate - math.floor(rate))


def ppm(train, order):
    """A function from text to log10 probability, trained on a list of texts."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]

    def stream(text):
        return [0xFE] * order + list(b" ".join(lowered(text))) + [0xFF]

    for text in train:
        s = stream(text)
        for p in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[p - k : p])][s[p]] += 1

    def symbol(context, byte):
        total, gone = 0.0, set()
        for k in range(order, -1, -1):
            left = {b: c for b, c in counts[k].get(tuple(context[order - k :]), {}).items() if b not in gone}
            if not left:
                continue
            mass = sum(left.values()) + len(left)
            if byte in left:
                return total + math.log10(left[byte] / mass)
            total, gone = total + math.log10(len(left) / mass), gone | set(left)
        return total - math.log10(256 - len(gone))

    def score(text):
        s = stream(text)
        return sum(symbol(s[p - order : p], s[p]) for p in range(order, len(s)))

    return score


def unigram(train):
    counts = Counter(w for t in train for w in [*lowered(t), None])
    n, v = sum(counts.values()), len(counts)

    def score(text):
        tokens = [*lowered(text), None]
        return len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)

    return score


def remainder(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n
