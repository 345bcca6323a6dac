"""Plain Python versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    found = words((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4))


def components(nodes, links):
    """node -> smallest node of its component."""
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def jaccard(texts):
    """Row number -> (size of its set, smallest row number of its component)."""
    sets = [shingles(text) for text in texts]
    holders = defaultdict(list)
    links = []
    for i, own in enumerate(sets):
        common = Counter(j for shingle in own for j in holders[shingle])
        for j, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                links.append((i, j))
        for shingle in own:
            holders[shingle].append(i)
    roots = components(range(len(texts)), links)
    return {i: (len(own), roots[i]) for i, own in enumerate(sets)}


def measures(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    counts = Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if counts[w] > 1 for i in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_lower": len(re.findall("[a-z]", text)),
        "n_exclaims": text.count("!"),
    }


def seeded_hash(number, seed, prime=2_147_483_647):
    x = (number or 0) % prime
    y = (x * 48271 + seed % prime) % prime
    z = (y * y + x) % prime
    w = (z * 69621 + y) % prime
    return (w * w + z) % prime


def fill(sizes, weights, total, epochs):
    """Targets by clamping one round after the other."""
    clamped = set()
    while True:
        left = total - sum(sizes[s] * epochs for s in clamped)
        rest = sum(weights[s] for s in sizes if s not in clamped)
        share = left / rest if rest else 0.0
        new = {s for s in sizes if s not in clamped and sizes[s] * epochs <= weights[s] * share}
        if not new:
            return {s: sizes[s] * epochs if s in clamped else weights[s] * share for s in sizes}
        clamped |= new


def mix(rows, seed, epochs=3):
    """(id, source, size) rows -> sorted (id, source, size, target, repeats)."""
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size or 0
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    targets = fill(dict(sizes), weights, sum(sizes.values()), epochs)
    out = []
    for source in order:
        own = [(i, size or 0) for i, s, size in rows if s == source]
        own.sort(key=lambda r: (seeded_hash(r[0], seed), r[0] is not None, r[0] or 0, r[1]))
        whole = int(targets[source] // sizes[source]) if sizes[source] else 0
        left = targets[source] - whole * sizes[source]
        extra, at = set(), 0
        for k, (_, size) in enumerate(own):
            at += size
            if at > left:
                break
            if size:
                extra.add(k)
        rest = left - sum(own[k][1] for k in extra)
        near = [
            (abs(size - rest), k) for k, (_, size) in enumerate(own)
            if k not in extra and size and abs(size - rest) < rest
        ]
        if near:
            extra.add(min(near)[1])
        out += [
            (i, source, size, targets[source], whole + (k in extra)) for k, (i, size) in enumerate(own)
        ]
    return out
