"""Plain definitions of the contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def substring_dedup(docs, window=35):
    words = {d: SPACE_WORD.findall(t or "") for d, t in docs}
    seen = defaultdict(int)
    for w in words.values():
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def suffix_dedup(docs, length=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, d), d)
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


TEXT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def decontaminate(docs, items, n=10):
    owners = defaultdict(set)
    for item, t in items:
        w = TEXT_WORD.findall((t or "").translate(LOWER))
        size = min(n, len(w))
        for i in range(len(w) - size + 1) if size else ():
            owners[tuple(w[i : i + size])].add(str(item))
    out = {}
    for d, t in docs:
        w, hit, found = TEXT_WORD.findall((t or "").translate(LOWER)), set(), set()
        for size in {len(x) for x in owners}:
            for i in range(len(w) - size + 1):
                if own := owners.get(tuple(w[i : i + size])):
                    found |= own
                    hit.update(range(i, i + size))
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out
