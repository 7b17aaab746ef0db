"""Suffix-array dedup: remove the bytes of a text that an earlier text already has, by longest previous factors.

The longest previous factor of a position is the longest string that starts there and also at an earlier place. In suffix
order the match lies at the previous or next smaller position, so one ordering answers all positions. Here "earlier"
is a text with a smaller id, and only factors of at least ``length`` bytes matter. Suffixes that cannot match are never ordered: runs of
positions meet by their anchor (``repeats``), equal runs collapse to one with the smallest id, and the bytes of the
distinct runs of an anchor, fetched once each, are put in suffix order with ties by id, where the previous smaller position of
a suffix stands directly above it and their common prefix tells whether the factor is long enough.

Defined results: a null or empty text has no bytes; texts shorter than ``length`` stay whole; matches never
cross texts and a text is never matched with itself; the text with the smallest id keeps its bytes, so of equal texts one
stays; rows with equal doc_id keep theirs against each other; rows without an id come after all others, and keep theirs against each other. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from popledger.llm.common import keyed, numbered, prepare, unnumbered
from popledger.llm.repeats import PART, Part, Sent, among_several, answer, covered, first_places, mark_windows, window_values
from popledger.llm.sequences import BYTE_VALUES, mix, packed, parts, runs_of, spread

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, span_start array<bigint>, span_end array<bigint>, kept binary"
#: Suffixes put in order at once. If an anchor has more, they go in several turns; equal ones meet in the same turn.
ORDERED = 1 << 15


def read(table: pa.Table):
    data, offsets = packed(table.column("text"))
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        yield i, BYTE_VALUES[piece], at, (piece,)


def columns_of(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` bytes of each suffix as numbers that compare alike, eight bytes each."""
    block = np.zeros((len(start), -(-length // 8) * 8), dtype=np.uint8)
    block[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[start]
    return block.view(">u8").astype(np.uint64)


def turns_of(data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes by turn, about ``ORDERED`` each, and where each turn begins; the turn follows from the bytes."""
    if len(start) <= ORDERED:
        return np.arange(len(start)), np.array([0, len(start)])
    turns = -(-len(start) // ORDERED)
    turn = np.empty(len(start), dtype=np.int32)
    for i in range(0, len(start), ORDERED):
        h = np.zeros(len(start[i : i + ORDERED]), dtype=np.uint64)
        for column in columns_of(data, start[i : i + ORDERED], length).T:
            h = mix(h ^ column)
        turn[i : i + ORDERED] = h % np.uint64(turns)
    order = np.argsort(turn, kind="stable")
    return order, np.searchsorted(turn[order], np.arange(turns + 1))


def suffix_order(data: np.ndarray, start: np.ndarray, length: int, doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``length`` bytes in order (group, bytes, doc), and whether each shares all of them with the one above."""
    columns = columns_of(data, start, length)
    order = np.lexsort([doc, *columns.T[::-1], group])
    columns, group = columns[order], group[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = np.all(columns[1:] == columns[:-1], axis=1) & (group[1:] == group[:-1])
    return order, same


def earliest(data: np.ndarray, start: np.ndarray, length: int, doc: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each suffix the smallest text among all suffixes of its group with the same first ``length`` bytes."""
    out = np.empty(len(start), dtype=np.int64)
    by, cut = turns_of(data, start, length)
    for i, j in zip(cut, cut[1:]):
        now = by[i:j]
        if len(now):
            order, same = suffix_order(data, start[now], length, doc[now], group[now])
            first = np.flatnonzero(~same)
            out[now[order]] = np.repeat(doc[now[order]][first], np.diff(np.r_[first, len(order)]))
    return out


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The bytes of all characters that have one of the bytes ``gone``."""
    first = (data & 0xC0) != 0x80
    first[:1] = True
    begins = np.flatnonzero(first)
    if not gone.any() or len(begins) == len(data):
        return gone
    return np.repeat(np.logical_or.reduceat(gone, begins), np.diff(np.r_[begins, len(data)]))


def find(docs: DataFrame, length: int = 50, k: int = 16, key: str = "doc_id", text: str = "text", characters: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, byte spans removed, and the bytes kept. With ``characters``, a character of
    which a byte is to go goes whole, so what is kept is text."""

    def collect(table: pa.Table, part: Part, chosen: np.ndarray) -> Sent:
        runs = part.runs
        doc = table.column("doc_id").to_numpy()[part.first + runs.doc[chosen]]
        return Sent(runs.anchor[chosen], runs.key[chosen], doc, doc, runs.count[chosen], np.zeros(0, np.uint8), counted=False)

    def content(table: pa.Table, part: Part, chosen: np.ndarray) -> Sent:
        runs = part.runs
        sizes = runs.count[chosen] + length - 1
        none = np.zeros(len(chosen), dtype=np.int64)
        return Sent(runs.anchor[chosen], runs.key[chosen], none, none, sizes, part.state[0][spread(runs.start[chosen], sizes)], counted=False)

    def resolve(asks: list[list[np.ndarray]], contents: list[list[np.ndarray]]) -> list[bytes | None]:
        """Per ask, the smallest text that has each window."""
        anchor, key, low, sizes = (np.concatenate([a[i] for a in asks]) for i in (0, 1, 2, 4))
        order, at = first_places(anchor, key)
        pick = order[at]
        least = np.minimum.reduceat(low[order], at)
        counts = sizes[pick].astype(np.int64)
        first = np.cumsum(counts) - counts
        value = np.repeat(least, counts)
        # anchors with several distinct runs: which of their windows agree is decided in suffix order
        of, run = anchor[pick], key[pick]
        several = among_several(of)
        if len(several):
            sent = np.concatenate([c[1] for c in contents])
            bytes_sent = np.concatenate([c[4] for c in contents]).astype(np.int64)
            data = np.concatenate([c[5] for c in contents])
            by = np.argsort(sent, kind="stable")
            begin = (np.cumsum(bytes_sent) - bytes_sent)[by[np.searchsorted(sent[by], run[several])]]
        done = 0
        while done < len(several):
            reach = np.cumsum(counts[several[done:]])
            until = min(done + max(1, int(np.searchsorted(reach, ORDERED))), len(several))
            while until < len(several) and of[several[until]] == of[several[until - 1]]:
                until += 1
            now = several[done:until]
            windows = spread(first[now], counts[now])
            value[windows] = earliest(data, spread(begin[done:until], counts[now]), length, value[windows], np.repeat(of[now], counts[now]))
            done = until
        place = np.empty(len(anchor), dtype=np.int64)
        place[order] = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(order)]))
        smallest = np.minimum.reduceat(value, first)
        out, i = [], 0
        for a in asks:
            mine = place[i : i + len(a[0])]
            i += len(a[0])
            chosen = smallest[mine] < a[3]
            mine = mine[chosen]
            out.append(answer(a[1][chosen], value[spread(first[mine], counts[mine])], counts[mine]) if len(mine) else None)
        return out

    def apply(table: pa.Table, found: list[Part], known: list[list[np.ndarray]]) -> pa.Table:
        n = table.num_rows
        ids = table.column("doc_id").to_numpy()
        total, removed, number = (np.zeros(n, np.int64) for _ in range(3))
        begins, ends, kept = [], [], []
        for p in found:
            (piece,) = p.state
            here = slice(p.first, p.first + len(p.offsets) - 1)
            start, doc, value = window_values(known, p.runs)
            gone = covered(len(piece), start[value < ids[p.first + doc]], length)
            if characters:
                gone = whole_characters(piece, gone)
            total[here] = np.diff(p.offsets)
            removed[here] = np.diff(np.r_[0, np.cumsum(gone)][p.offsets])
            left = (total[here] - removed[here]).cumsum()
            rest = piece[~gone].tobytes()
            kept += [rest[a:b] for a, b in zip(np.r_[0, left[:-1]], left)]
            for doc in np.flatnonzero(removed[here]):
                a, b = runs_of(gone[p.offsets[doc] : p.offsets[doc + 1]])
                begins.append(a)
                ends.append(b)
                number[p.first + doc] = len(a)
        at = pa.array(np.r_[0, np.cumsum(number)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x or [np.zeros(0, np.int64)]).astype(np.int64))) for x in (begins, ends)]
        return pa.table(
            [table.column("doc_id"), pa.array(total), pa.array(removed), pa.array(number), *lists, pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "span_start", "span_end", "kept"],
        )

    prepare(docs.sparkSession)
    found = mark_windows(numbered(keyed(docs, key, text)), read, length, k, collect, resolve, apply, SCHEMA, distinct_texts=True, content=content)
    return unnumbered(found)
