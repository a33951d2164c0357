"""Plain Python versions of the operators' rules, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text) if text else []


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def substring_dedup(texts, window=35):
    """[(n_words, n_removed, kept_sha256)] of a list of texts."""
    seen = Counter()
    all_words = [words(t) for t in texts]
    for ws in all_words:
        for i in range(len(ws) - window + 1):
            seen[tuple(ws[i : i + window])] += 1
    out = []
    for ws in all_words:
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if seen[tuple(ws[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(ws), sum(gone), sha(" ".join(w for w, g in zip(ws, gone) if not g))))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    ws = words(text)
    seen = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = set()
    for i in range(len(ws) - 2):
        if seen[tuple(ws[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def shingles(text, size=5):
    ws = words(text)
    if not ws:
        return Counter()
    if len(ws) < size:
        return Counter([tuple(ws)])
    return Counter(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))


def probability_jaccard(a, b):
    out = 0.0
    for d in a.keys() & b.keys():
        out += 1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in a.keys() | b.keys())
    return out


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_classes(docs, least=0.8):
    """{id: class id} for (id, text) pairs."""
    bags = {i: shingles(t) for i, t in docs}
    where = defaultdict(set)
    for i, bag in bags.items():
        for s in bag:
            where[s].add(i)
    links = set()
    for i, bag in bags.items():
        for j, n in Counter(j for s in bag for j in where[s] if j < i).items():
            if n * 2 > min(len(bag), len(bags[j])) and probability_jaccard(bag, bags[j]) >= least - 1e-9:
                links.add((j, i))
    return components(list(bags), links)


def char_shingles(line, size=10):
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def line_classes(docs, least=0.8):
    """{(id, line number): (id, line number) of the line kept}; blank lines are their own."""
    lines = {(i, n): x.strip(" \t\r") for i, t in docs if t is not None for n, x in enumerate(t.split("\n"))}
    distinct = sorted({x for x in lines.values() if x})
    sets = {x: char_shingles(x) for x in distinct}
    where = defaultdict(set)
    for x, s in sets.items():
        for g in s:
            where[g].add(x)
    links = set()
    for x, s in sets.items():
        for y, n in Counter(y for g in s for y in where[g] if y < x).items():
            if n >= least * (len(s) + len(sets[y]) - n):
                links.add((y, x))
    root = components(distinct, links)
    first = {}
    for at in sorted(lines):
        if lines[at]:
            first.setdefault(root[lines[at]], at)
    return {at: first[root[x]] if x else at for at, x in lines.items()}


def greedy_tiles(a, b, shortest):
    """Length of greedy string tiles of two word lists, by plain search."""
    used_a, used_b, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return total
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))
        total += n


def rake(cells, targets, rounds=200):
    """{cell: share} of {cell: tokens} raked to [{value: share} by margin]."""
    now = {c: float(t) for c, t in cells.items() if t > 0}
    for _ in range(rounds):
        for k, target in enumerate(targets):
            sums = Counter()
            for c, v in now.items():
                sums[c[k]] += v
            now = {c: v * target.get(c[k], 0.0) / sums[c[k]] for c, v in now.items()}
    return now
