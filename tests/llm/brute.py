"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    """Union-find whose roots are the smallest members."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def unite(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def simhash(features):
    hashes = [xxhash.xxh64_intdigest(f.encode(), 42) for f in features]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    return simhash([" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)])


def near_duplicates(docs):
    """[(doc_id, fingerprint, component)] of [(doc_id, text)]."""
    prints = [(i, fingerprint(t)) for i, t in docs]
    groups = Groups({f for _, f in prints})
    for a, b in combinations(groups.parent, 2):
        if (a ^ b).bit_count() <= 2:
            groups.unite(a, b)
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[groups.root(f)].append(i)
    return [(i, f"{f:016x}", min(least[groups.root(f)], default=None)) for i, f in prints]


def edit_distance(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
        if min(row) > most:
            return most + 1
    return row[-1]


def long_edit_distance(a, b, most):
    """The edit distance, a row at a time in numpy, or a number over ``most``."""
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    steps = np.arange(len(y) + 1)
    row = steps.copy()
    for i, c in enumerate(x, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (y != c))
        row = np.minimum.accumulate(np.concatenate([[i], new]) - steps) + steps
        if i % 16 == 0 and row.min() > most:
            return most + 1
    return int(row[-1])


def similar_groups(norms, similarity=0.8):
    """Groups of texts that pairs of an edit similarity of 0.8 or more connect, with no blocks.

    One edit changes three runs of three characters at most, so a distance is at
    least a sixth of the difference of their counts; only pairs that this does not
    rule out, and that are not connected yet, are compared, the likeliest first.
    """
    counts = np.zeros((len(norms), 4096), np.int16)
    for i, x in enumerate(norms):
        padded = f"\n\n{x}\n\n"
        np.add.at(counts[i], [zlib.crc32(padded[k : k + 3].encode()) % 4096 for k in range(len(padded) - 2)], 1)
    order = sorted(range(len(norms)), key=lambda i: len(norms[i]))
    sizes = np.array([len(norms[i]) for i in order])
    sorted_counts, found = counts[order], []
    for at, i in enumerate(order):
        end = int(np.searchsorted(sizes, sizes[at] / similarity + 1e-9, "right"))
        most = np.floor((1 - similarity) * sizes[at + 1 : end] + 1e-9)
        apart = np.abs(sorted_counts[at + 1 : end] - sorted_counts[at]).sum(axis=1)
        found += [(int(apart[k]), i, order[at + 1 + k], int(most[k])) for k in np.nonzero(apart <= 6 * most)[0]]
    groups = Groups(range(len(norms)))
    for _, i, j, most in sorted(found):
        if groups.root(i) != groups.root(j) and long_edit_distance(norms[i], norms[j], most) <= most:
            groups.unite(i, j)
    return groups


def normalised(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def deduplicated_lines(docs):
    """[(doc_id, text)] with one occurrence of each group of similar lines."""
    first = {}
    for doc, text in sorted(d for d in docs if d[0] is not None and d[1] is not None):
        for at, line in enumerate(text.split("\n")):
            if norm := normalised(line):
                first.setdefault(norm, (doc, at))
    norms = {place: norm for norm, place in first.items()}
    groups, buckets, hashes = Groups(norms), defaultdict(list), {}
    for place, norm in norms.items():
        h = hashes[place] = simhash(sorted(set(norm.split(" "))))
        for i, j in combinations(range(4), 2):
            buckets[i, j, h >> 16 * i & 65535, h >> 16 * j & 65535].append(place)
    for bucket in buckets.values():
        for a, b in combinations(bucket, 2):
            x, y = norms[a], norms[b]
            most = int(0.2 * max(len(x), len(y)) + 1e-9)
            if (hashes[a] ^ hashes[b]).bit_count() <= 8 and edit_distance(x, y, most) <= most:
                groups.unite(a, b)
    kept = {groups.root(p) for p in norms}
    out = []
    for doc, text in docs:
        if doc is not None and text is not None:
            lines = text.split("\n")
            text = "\n".join(x for at, x in enumerate(lines) if (doc, at) in kept or not normalised(x))
        out.append((doc, text))
    return out


def redundant_lines(docs, longest):
    """Places (doc_id, line) of all but the first of each group of similar lines, found without blocks; and of the first.

    Only lines of up to ``longest`` characters, normalised, are looked at.
    """
    first = {}
    for doc, text in sorted(d for d in docs if d[0] is not None and d[1] is not None):
        for at, line in enumerate(text.split("\n")):
            if (norm := normalised(line)) and len(norm) <= longest:
                first.setdefault(norm, (doc, at))
    norms = sorted(first, key=first.get)
    groups = similar_groups(norms)
    kept = {first[norms[groups.root(i)]] for i in range(len(norms))}
    return {place for place in first.values() if place not in kept}, kept


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """[(doc_id, n_words, n_hit, item ids)]."""
    windows = defaultdict(set)
    for number, (item, text) in enumerate(items):
        words = words_of(text)
        if words:
            size = min(10, len(words))
            for i in range(len(words) - size + 1):
                windows[tuple(words[i : i + size])].add(number if item is None else ("id", item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, found = words_of(text), set()
        hit = [False] * len(words)
        for size in sizes:
            for i in range(len(words) - size + 1):
                if here := windows.get(tuple(words[i : i + size])):
                    found |= here
                    hit[i : i + size] = [True] * size
        out.append((doc, len(words), sum(hit), found))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c)
        total += (n * 2 - 9 if n > 4 else n * 2) if i % 2 else n
    return total % 10 == 0


def base_spans(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append((kind, m.start(), m.end()))
    return spans
