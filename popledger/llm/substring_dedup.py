"""Substring dedup by de Bruijn compaction: remove every word that lies in a long word window which occurs again.

The edges of the graph are the word windows (35 words by default). Windows that follow each other and share their minimizer
k-mer are a nonbranching piece of path; pieces are compacted where they are read, meet in Spark by minimizer
(``repeats``), and only pieces whose minimizer occurs again are sent, as the hashes of their edges. An edge's
occurrences are summed over all distinct pieces of its minimizer; edges seen twice are repeated. The repeated stretches come back to
their source coordinates, where neighbouring pieces join into maximal spans.

Defined results: a null or empty text has no words and keeps nothing; a text shorter than a window is kept whole; all copies
of a repeated window are removed, in the same text or in others; overlapping occurrences count; rows with the same doc_id are different texts.
Other columns are not read. An empty table gives no rows. A text is held whole by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from popledger.llm.common import keyed, prepare
from popledger.llm.repeats import Part, Sent, answer, covered, first_places, mark_windows, window_values, PART
from popledger.llm.sequences import BYTE_VALUES, NOT_WHITE, exact_long, packed, parts, prefix, runs_of, spread, stretch_hash, window_hashes, words

SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, span_start array<bigint>, span_end array<bigint>, kept string"


def read(table: pa.Table):
    data, offsets = packed(table.column("text"))
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, word_at = words(piece, at, NOT_WHITE)
        hashes = exact_long(stretch_hash(prefix(BYTE_VALUES[piece]), starts, ends), piece, starts, ends)
        yield i, hashes, word_at, (piece, starts, ends, hashes)


def resolve(asks: list[list[np.ndarray]]) -> list[bytes | None]:
    """Per ask, 1 for every window that occurs twice or more in all asks together, 0 for the others."""
    anchor, key, count, _, sizes, edges = (np.concatenate([a[i] for a in asks]) for i in range(6))
    sizes = sizes.astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    order, at = first_places(anchor, key)
    total = np.add.reduceat(count[order], at)
    pick = order[at]
    lengths = sizes[pick]
    edge = edges[spread(begin[pick], lengths)]
    by, new = first_places(edge, np.repeat(anchor[pick], lengths))
    seen = np.add.reduceat(np.repeat(total, lengths)[by], new)
    repeated = np.zeros(len(edge), dtype=np.uint8)
    repeated[by] = np.repeat(seen > 1, np.diff(np.r_[new, len(by)]))
    place = np.empty(len(anchor), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(order)]))
    first = np.cumsum(lengths) - lengths
    any_repeated = np.maximum.reduceat(repeated, first) > 0
    out, i = [], 0
    for a in asks:
        mine = place[i : i + len(a[0])]
        chosen = any_repeated[mine]
        i += len(a[0])
        mine = mine[chosen]
        out.append(answer(a[1][chosen], repeated[spread(first[mine], lengths[mine])], lengths[mine]) if len(mine) else None)
    return out


def find(docs: DataFrame, window: int = 35, k: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, word spans removed, and the words kept, joined by one blank."""

    def collect(table: pa.Table, part: Part, chosen: np.ndarray) -> Sent:
        runs = part.runs
        edges = window_hashes(prefix(part.state[3]), window)
        counts = runs.count[chosen]
        ones = np.ones(len(chosen), dtype=np.int64)
        return Sent(runs.anchor[chosen], runs.key[chosen], ones, ones, counts, edges[spread(runs.start[chosen], counts)], counted=True)

    def apply(table: pa.Table, found: list[Part], known: list[list[np.ndarray]]) -> pa.Table:
        n = table.num_rows
        total, removed, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        spans = ([], [], np.zeros(n, np.int64))
        for p in found:
            piece, starts, ends, _ = p.state
            here = slice(p.first, p.first + len(p.offsets) - 1)
            start, _, value = window_values(known, p.runs)
            gone = covered(len(starts), start[value > 0], window)
            total[here] = np.diff(p.offsets)
            removed[here] = np.diff(np.r_[0, np.cumsum(gone)][p.offsets])
            for doc in np.flatnonzero(removed[here]):
                a, b = runs_of(gone[p.offsets[doc] : p.offsets[doc + 1]])
                spans[0].append(a)
                spans[1].append(b)
                spans[2][p.first + doc] = len(a)
            words_kept = np.flatnonzero(~gone)
            sizes = ends[words_kept] - starts[words_kept] + 1
            out = np.r_[piece, np.uint8(0x20)][spread(starts[words_kept], sizes)]
            out[np.cumsum(sizes) - 1] = 0x20
            at = np.r_[0, np.cumsum(sizes)][np.searchsorted(words_kept, p.offsets)]
            text_of = out.tobytes()
            kept += [text_of[a : b - 1] if b > a else b"" for a, b in zip(at, at[1:])]
        at = pa.array(np.r_[0, np.cumsum(spans[2])].astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x or [np.zeros(0, np.int64)]).astype(np.int64))) for x in spans[:2]]
        return pa.table(
            [table.column("doc_id"), pa.array(total), pa.array(removed), *lists, pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "span_start", "span_end", "kept"],
        )

    prepare(docs.sparkSession)
    return mark_windows(keyed(docs, key, text), read, window, k, collect, resolve, apply, SCHEMA, distinct_texts=False)
