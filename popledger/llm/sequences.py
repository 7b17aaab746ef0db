"""Numpy helpers on packed text: words, rolling hashes and window minima of whole Arrow batches.

Texts of a batch lie one after another in one byte array with offsets, so every step is a vector operation over
all of them. Hashes are 64-bit: a polynomial over random byte values, finished by a bit mixer. All constants are
derived from one seed, so every process of a job computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[ord("A") : ord("Z") + 1] = BYTE_VALUES[ord("a") : ord("z") + 1]  # A-Z count as a-z
BASE = int(_RNG.integers(1, 2**62)) * 4 + 1
INVERSE = pow(BASE, -1, 2**64)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Words of contracts on white space: every byte but blank and 0x09-0x0D.
NOT_WHITE = ~WHITE
#: Words of contracts on letters and digits: 0-9, A-Z, a-z and all bytes of other scripts.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True

_POWERS = np.ones(1, dtype=U64)
_INVERSES = np.ones(1, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        _POWERS = np.cumprod(np.r_[U64(1), np.full(size - 1, BASE, dtype=U64)], dtype=U64)
        _INVERSES = np.cumprod(np.r_[U64(1), np.full(size - 1, INVERSE, dtype=U64)], dtype=U64)
    return _POWERS[:n], _INVERSES[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective bit mixer, so that any bits of a hash can be used on their own."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows by one difference."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(len(values))[0], dtype=U64, out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end); equal contents hash alike wherever they lie."""
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


#: Stretches of more symbols than this are hashed whole. The polynomial is taken modulo 2**64, under which
#: there are strings of some thousand symbols that differ and hash alike, whatever its base.
LONG = 256


def exact_long(hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, folded: bool = False) -> np.ndarray:
    """``hashes`` of byte stretches with those of the long ones taken from all their bytes; ``folded``: A-Z count as a-z."""
    for i in np.flatnonzero(end - start > LONG):
        piece = data[start[i] : end[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(piece.lower() if folded else piece)
    return hashes


def window_hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of one length, by start."""
    n = len(sums) - length
    if n <= 0:
        return np.zeros(0, dtype=U64)
    return mix((sums[length:] - sums[:-length]) * powers(n)[1] + U64(length))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, span = x, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def packed(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(at):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def parts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and word offsets of the texts."""
    inside = is_word[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches in which ``flags`` holds."""
    edges = np.diff(np.r_[False, flags, False].astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every start, one after another."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(starts - first, counts)
