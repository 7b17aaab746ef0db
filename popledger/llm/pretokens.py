"""Splits text as byte-level BPE tokenizers do, for whole batches at once.

Merges never cross the bounds that the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

sets, so a text can be split first and every different piece encoded once. Here the pattern is applied with
array operations: stretches of one character class, then the three rules that move their bounds (a blank joins
what follows, the last of several white characters stands apart, contractions cut the letters behind an apostrophe).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import xxhash

from popledger.llm.sequences import LONG, mix, prefix, stretch_hash

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Characters split at once. Longer texts are cut where a letter is followed by a blank and a letter: always a bound.
PART = 1 << 19


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    import regex

    out = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = "".join(regex.findall(pattern, every))
        out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    return out


def bounds(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all pieces of the texts with these code points; ``offsets`` begin the texts."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    last_white = np.zeros(n, dtype=bool)  # white, and followed by another class in the same text
    last_white[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]
    at = np.flatnonzero(last_white)
    start[at] = True
    start[at[points[at] == 0x20] + 1] = False
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        ends = offsets[np.searchsorted(offsets, quotes, side="right")]  # end of the text
        padded = np.r_[points, np.zeros(3, points.dtype)]
        done = np.zeros(len(quotes), dtype=bool)
        for c in CONTRACTIONS:
            fits = ~done & (quotes + len(c) < ends)
            for i, letter in enumerate(c):
                fits &= padded[quotes + 1 + i] == ord(letter)
            cut = quotes[fits]
            start[cut + 1] = False
            after = cut + 1 + len(c)
            start[after[after < n]] = True
            done |= fits
    return np.flatnonzero(start)


def safe_parts(texts: list[str], limit: int = PART) -> Iterator[list[tuple[int, str]]]:
    """Lists of (text number, part) of about ``limit`` characters; parts of a text come in order and are cut at sure bounds."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        begin = 0
        while len(text) - begin > limit:
            at = begin + limit
            while at < len(text) - 1 and not (text[at] == " " and text[at - 1].isalpha() and text[at + 1].isalpha()):
                at += 1
            if at >= len(text) - 1:
                break
            yield [*batch, (i, text[begin:at])]
            batch, size, begin = [], 0, at
        batch.append((i, text[begin:]))
        size += len(text) - begin
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class PieceCache:
    """Token ids of different pieces, found by hash; cleared when ``limit`` ids or pieces are held, so that memory is constant."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 1 << 21):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def rows(self, keys: np.ndarray, piece_of: Callable[[int], str]) -> np.ndarray:
        """Place in the cache of each of the different, sorted ``keys``; ``piece_of(i)`` is the text of the i-th."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.keys) + len(new) > self.limit // 4 or len(self.ids) > self.limit:
                self.clear()
                new = np.arange(len(keys))
            found = self.encode([piece_of(i) for i in new])
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            flat = np.fromiter((x for ids in found for x in ids), dtype=np.uint32, count=int(sizes.sum()))
            begin = len(self.ids) + np.cumsum(sizes) - sizes
            place = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, place, keys[new])
            self.begin = np.insert(self.begin, place, begin)
            self.size = np.insert(self.size, place, sizes)
            self.ids = np.concatenate([self.ids, flat])
            at = np.searchsorted(self.keys, keys)
        return at


class BatchEncoder:
    """Encodes lists of texts; ``encode`` is asked once for every different piece. ``special`` strings become their id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], special: dict[str, int]):
        self.cache, self.special = PieceCache(encode), special
        longest_first = sorted(special, key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if special else None

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for batch in safe_parts(texts):
            owners, parts = [], []
            for i, part in batch:
                for j, x in enumerate(self.cut(part)):
                    if j % 2:
                        owners.append((i, self.special[x]))
                    elif x:
                        owners.append((i, None))
                        parts.append(x)
            found = iter(self.part_ids(parts))
            for i, special in owners:
                out[i].append(next(found) if special is None else np.array([special], dtype=np.uint32))
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, dtype=np.uint32) for x in out]

    def cut(self, text: str) -> list[str]:
        """Text, special string, text, ... in turn; the leftmost special string first, the longest of several."""
        return self.specials.split(text) if self.specials else [text]

    def part_ids(self, parts: list[str]) -> list[np.ndarray]:
        if not parts:
            return []
        whole = "".join(parts)
        points = np.frombuffer(whole.encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32)
        offsets = np.cumsum([0, *map(len, parts)])
        starts = bounds(points, offsets)
        ends = np.r_[starts[1:], len(points)]
        keys = stretch_hash(prefix(mix(points.astype(np.uint64) + np.uint64(1))), starts, ends)
        for i in np.flatnonzero(ends - starts > LONG):
            keys[i] = xxhash.xxh3_64_intdigest(whole[starts[i] : ends[i]].encode("utf-8", errors="surrogatepass"))
        different, first, which = np.unique(keys, return_index=True, return_inverse=True)
        rows = self.cache.rows(different, lambda i: whole[starts[first[i]] : ends[first[i]]])
        begin, size = self.cache.begin[rows], self.cache.size[rows]
        sizes = size[which]
        done = np.cumsum(sizes) - sizes
        ids = self.cache.ids[np.arange(int(sizes.sum())) + np.repeat(begin[which] - done, sizes)]
        at = np.r_[0, np.cumsum(sizes)][np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(at, at[1:])]
