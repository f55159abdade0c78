"""The operators' results computed the plain way, for small inputs."""

import re
from collections import Counter

import xxhash

from wordloom.llm.suffix_dedup import union


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    prints, root = list(prints), {p: p for p in prints}
    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[x] = y
    out = {}
    for p in prints:
        out.setdefault(find(p), set()).add(p)
    return sorted(map(frozenset, out.values()), key=min)


def repeats(parts, length=200):
    often = Counter(t[p : p + length] for t in parts for p in range(len(t) - length + 1))
    out = []
    for t in parts:
        out.append(union([x for p in range(len(t) - length + 1) if often[t[p : p + length]] > 1 for x in (p, p + length)]))
    return out


def brute_words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def leaks(text, items):
    doc, hit, names = brute_words(text), set(), []
    for name, item in items:
        own, found = brute_words(item), False
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for p in range(len(doc) - size + 1):
                if doc[p : p + size] == own[i : i + size]:
                    hit |= set(range(p, p + size))
                    found = True
        if found:
            names.append(str(name))
    return len(doc), len(hit), sorted(names)
