"""Benchmark decontamination: find the n-grams of test items in training texts and remove the spans or the documents.

Words are lower-cased (A-Z) stretches of letters, digits and bytes of other scripts. A window is ``n`` consecutive words of an item;
an item of fewer words is one window. The windows' hashes are broadcast, every text is scanned once against them, and
each hit is verified word by word. The broadcast is checked: benchmarks above ``BROADCAST_WINDOWS`` windows are
matched by a join on the windows instead, with the same result.

Defined results: a null or empty text has no words and is clean; items without words match nothing; repeated items each count;
overlapping hits count a word once; every row is scanned apart, also those with equal or no doc_id; the windows of items without an id are hit
like others, but are in no list of items. Other columns are
not read. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import keyed, lean, prepare, stored
from popledger.llm.sequences import FOLDED_VALUES, WORD_BYTE, exact_long, packed, parts, prefix, runs_of, stretch_hash, window_hashes, words

#: Windows that may be broadcast: at about 120 bytes each, under 64 MB in every worker.
BROADCAST_WINDOWS = 500_000
PART = 1 << 20

WINDOWS = "item string, length int, hash bigint, gram string"
SCAN = "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, span_start array<bigint>, span_end array<bigint>, clean string"
DOC_WINDOWS = "row bigint, start bigint, length int, gram string"


def word_hashes(column) -> Iterator[tuple]:
    data, offsets = packed(column)
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, word_at = words(piece, at, WORD_BYTE)
        own = exact_long(stretch_hash(prefix(FOLDED_VALUES[piece]), starts, ends), piece, starts, ends, folded=True)
        yield i, j, piece, at, starts, ends, word_at, prefix(own)


def gram(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, length: int) -> bytes:
    return b" ".join(piece[a:b].tobytes() for a, b in zip(starts[first : first + length], ends[first : first + length])).lower()


def benchmark_windows(benchmark: DataFrame, n: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, length, hash and words of every window of the benchmark."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, length, hashes, grams = [], [], [], []
            for i, _, piece, _, starts, ends, word_at, sums in word_hashes(batch.column(1)):
                for k, (a, b) in enumerate(zip(word_at, word_at[1:])):
                    size = min(n, b - a)
                    if not size:
                        continue
                    for first in range(a, b - size + 1):
                        item.append(batch.column(0)[i + k].as_py())
                        length.append(size)
                        grams.append(gram(piece, starts, ends, first, size).decode(errors="replace"))
                    hashes.append(window_hashes(sums, int(size))[a : b - size + 1])
            flat = np.concatenate(hashes or [np.zeros(0, np.uint64)]).astype(np.int64)
            yield pa.record_batch([pa.array(item, pa.string()), pa.array(length, pa.int32()), pa.array(flat), pa.array(grams, pa.string())], names=["item", "length", "hash", "gram"])

    return benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text")).mapInArrow(lean(cut), WINDOWS)


class Index:
    """Windows of a benchmark: sorted hashes per length, the words of each window, and the items that have it."""

    def __init__(self, windows: list):
        self.items = sorted({w.item for w in windows if w.item is not None})
        number = {x: i for i, x in enumerate(self.items)}
        grams: dict[tuple[int, str], set[int]] = {}
        hashes: dict[tuple[int, str], int] = {}
        for w in windows:
            grams.setdefault((w.length, w.gram), set()).update([number[w.item]] if w.item is not None else [])
            hashes[w.length, w.gram] = w.hash
        self.by_length = {}
        for length in sorted({k[0] for k in grams}):
            keys = sorted((k for k in grams if k[0] == length), key=lambda k: np.uint64(hashes[k] & (2**64 - 1)))
            self.by_length[length] = (
                np.array([hashes[k] for k in keys], dtype=np.int64).astype(np.uint64),
                [k[1].encode() for k in keys],
                [sorted(grams[k]) for k in keys],
            )


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, the items that occur, the spans of hit words, and the text without them (null: untouched)."""
    spark = prepare(docs.sparkSession)
    windows = benchmark_windows(benchmark, n)
    if windows.count() > broadcast_windows:
        return scan_by_join(docs, windows)
    shared = spark.sparkContext.broadcast(Index(windows.collect()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            size = batch.num_rows
            n_words, n_hit = np.zeros(size, np.int64), np.zeros(size, np.int64)
            items, begins, ends_of, clean = [[] for _ in range(size)], [[] for _ in range(size)], [[] for _ in range(size)], [None] * size
            for i, j, piece, at, starts, ends, word_at, sums in word_hashes(batch.column(1)):
                n_words[i:j] = np.diff(word_at)
                hit, found = np.zeros(len(starts) + 1, np.int64), {}
                for length, (hashes, grams, owners) in index.by_length.items():
                    own = window_hashes(sums, length)
                    place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    for w in np.flatnonzero(hashes[place] == own):
                        doc = int(np.searchsorted(word_at, w, side="right")) - 1
                        known = place[w]
                        if w + length > word_at[doc + 1]:
                            continue
                        words_here = gram(piece, starts, ends, w, length)
                        while known < len(hashes) and hashes[known] == own[w] and grams[known] != words_here:
                            known += 1
                        if known < len(hashes) and hashes[known] == own[w]:
                            hit[w] += 1
                            hit[w + length] -= 1
                            found.setdefault(doc, set()).update(owners[known])
                flags = np.cumsum(hit[:-1]) > 0
                n_hit[i:j] = np.diff(np.r_[0, np.cumsum(flags)][word_at])
                for doc, which in found.items():
                    a, b = runs_of(flags[word_at[doc] : word_at[doc + 1]])
                    items[i + doc], begins[i + doc], ends_of[i + doc] = [index.items[x] for x in sorted(which)], a.tolist(), b.tolist()
                    cut = [at[doc], *[x for s, e in zip(a, b) for x in (starts[word_at[doc] + s], ends[word_at[doc] + e - 1])], at[doc + 1]]
                    clean[i + doc] = b"".join(piece[s:e].tobytes() for s, e in zip(cut[::2], cut[1::2])).decode(errors="replace")
            lists = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(begins, lists), pa.array(ends_of, lists), pa.array(clean, pa.string())],
                names=["doc_id", "n_words", "n_hit", "items", "span_start", "span_end", "clean"],
            )

    return keyed(docs).mapInArrow(lean(find), SCAN)


def scan_by_join(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The same, for benchmarks too large to broadcast: all windows of the texts meet the benchmark's in a join."""
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, piece, _, starts, ends, word_at, _ in word_hashes(batch.column(1)):
                for doc, (a, b) in enumerate(zip(word_at, word_at[1:])):
                    own = [(int(w - a), m, gram(piece, starts, ends, w, m).decode(errors="replace")) for m in lengths for w in range(a, b - m + 1)]
                    ids = pa.array([batch.column(0)[i + doc].as_py()] * len(own), pa.int64())
                    yield pa.record_batch(
                        [ids, pa.array([x[0] for x in own], pa.int64()), pa.array([x[1] for x in own], pa.int32()), pa.array([x[2] for x in own], pa.string())],
                        names=["row", "start", "length", "gram"],
                    )

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            counts, hits, begins, ends_of, clean = [], [], [], [], []
            marks = table.column("hits").to_pylist()
            for i, j, piece, at, starts, ends, word_at, _ in word_hashes(batch.column(1)):
                for doc in range(j - i):
                    a, b = word_at[doc], word_at[doc + 1]
                    flags = np.zeros(b - a, dtype=bool)
                    for h in marks[i + doc] or []:
                        flags[h["start"] : h["start"] + h["length"]] = True
                    s, e = runs_of(flags)
                    counts.append(b - a)
                    hits.append(int(flags.sum()))
                    begins.append(s.tolist())
                    ends_of.append(e.tolist())
                    edges = [at[doc], *[x for p, q in zip(s, e) for x in (starts[a + p], ends[a + q - 1])], at[doc + 1]]
                    clean.append(b"".join(piece[p:q].tobytes() for p, q in zip(edges[::2], edges[1::2])).decode(errors="replace") if len(s) else None)
            lists = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), batch.column(2), pa.array(begins, lists), pa.array(ends_of, lists), pa.array(clean, pa.string())],
                names=["doc_id", "n_words", "n_hit", "items", "span_start", "span_end", "clean"],
            )

    # a written number for every row: ids may be missing or repeat
    texts = stored(keyed(docs).withColumn("row", F.monotonically_increasing_id()), "texts")
    met = texts.select("row", "text").mapInArrow(lean(cut), DOC_WINDOWS).join(windows.select("gram", "length", "item").distinct(), ["gram", "length"])
    found = met.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"), F.collect_set(F.struct("start", "length")).alias("hits"))
    joined = texts.join(found, "row", "left").select("doc_id", "text", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits")
    return joined.mapInArrow(lean(rest), SCAN)
