"""Which windows of L symbols occur again: exact, for symbols of any kind (bytes, words), without shipping windows.

Symbols are hashed per text. Every window of L symbols has an anchor, its k-mer of least hash; neighbouring
windows with the same anchor form a run (a "super-k-mer" of the de Bruijn graph whose edges are the windows), and a run is
a nonbranching piece of path that travels as one item. Equal windows have equal anchors, so:

1. Texts are dealt to groups by their id. A group asks, for its distinct anchors, whether they occur elsewhere.
   Questions are dealt by anchor hash to buckets; a bucket answers with one bit for each.
2. For anchors that occur again a group sends its distinct runs. The bucket of the anchor finds, for every window of
   these runs, what the caller wants to know (number of occurrences, first text) and answers each group that needs it.
3. Groups apply the answers to their texts.

An anchor of very many texts costs one question for each group, not for each text. Texts are shuffled once: all steps
read the same exchange. Memory of a task follows the size of a group or bucket, and their numbers follow the input.
Two windows count as equal when both a 64-bit hash of their anchor and their content (or a second 64-bit hash of it) agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import text_bytes
from popledger.llm.sequences import mix, prefix, sliding_min, spread, stretch_hash, window_hashes

GROUP_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Symbols handled at once inside a group.
PART = 1 << 18
POSITION_BITS = np.uint64(22)


@dataclass
class Runs:
    """Maximal runs of windows with one anchor: text, first window, number of windows, hashes of anchor and content."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    content: np.ndarray

    @property
    def key(self) -> np.ndarray:
        return mix(self.anchor ^ (self.content * np.uint64(0x9E3779B97F4A7C15)))


def find_runs(values: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Runs:
    """Runs of all windows of ``length`` symbols; ``values`` are the symbols' hashes, ``offsets`` the texts'."""
    n = len(values)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = prefix(values)
    kmers = window_hashes(sums, k)
    bits = max(POSITION_BITS, np.uint64(int(n).bit_length()))
    place = (kmers >> bits << bits) | np.arange(len(kmers), dtype=np.uint64)
    anchors = (sliding_min(place, length - k + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(anchors) + 1, dtype=np.int32)  # windows that lie in one text
    sizes = np.diff(offsets)
    long = sizes >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchors[1:] != anchors[:-1])
    at = np.flatnonzero(valid)
    start = np.flatnonzero(new)
    count = np.diff(np.r_[np.searchsorted(at, start), len(at)])
    anchor = anchors[start]
    content = stretch_hash(sums, start, start + count + length - 1) + mix((anchor - start).astype(np.uint64))
    return Runs(np.searchsorted(offsets, start, side="right") - 1, start, count, kmers[anchor], content)


def blob(*arrays: np.ndarray) -> bytes:
    """Arrays of any types in one value."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], dtype=np.int64).tobytes()
    return head + b"".join(a.dtype.str.encode().ljust(8) for a in arrays) + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unblob(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8)
    at, out = 8 * (n + 1) + 8 * n, []
    for i in range(n):
        kind = np.dtype(data[8 * (n + 1) + 8 * i :][:8].decode().strip())
        out.append(np.frombuffer(data, kind, int(sizes[i]), at))
        at += kind.itemsize * int(sizes[i])
    return out


@dataclass
class Part:
    """Some texts of a group: number of the first, symbol offsets, what the reader keeps of them, and their runs."""

    first: int
    offsets: np.ndarray
    state: tuple
    runs: Runs


@dataclass
class Sent:
    """Runs to send: hash of the anchor, key of the run, two numbers (the first is added up where ``counted``, else
    the least is kept; of the second the greatest), and ``sizes`` items of ``payload`` each, or no payload at all."""

    anchor: np.ndarray
    key: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray
    payload: np.ndarray
    counted: bool


ASK = "bucket int, gid int, ask binary"
ANSWER = "gid int, bucket int, answer binary"


def rows(schema: list[tuple[str, pa.DataType]], values: list[tuple]) -> pa.Table:
    return pa.table([pa.array([v[i] for v in values], kind) for i, (_, kind) in enumerate(schema)], names=[n for n, _ in schema])


_ASK = [("bucket", pa.int32()), ("gid", pa.int32()), ("ask", pa.binary())]
_ANSWER = [("gid", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())]


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket, and where each bucket begins in it. Anchors are least hashes, so they are mixed again to spread."""
    bucket = ((mix(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def first_places(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and the places in it where a new value begins."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    if not len(order):
        return order, order
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def grouped(docs: DataFrame) -> tuple[DataFrame, int]:
    """Texts with their group, and the number of buckets."""
    size = text_bytes(docs)
    groups, buckets = 48 + size // GROUP_BYTES, 48 + size // BUCKET_BYTES
    return docs.withColumn("gid", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")), int(buckets)


def mark_windows(
    docs: DataFrame,
    read: Callable,
    length: int,
    k: int,
    collect: Callable,
    resolve: Callable,
    apply: Callable,
    schema: str,
    distinct_texts: bool,
    content: Callable | None = None,
) -> DataFrame:
    """Run the three steps over ``docs`` (doc_id, text).

    ``read(table)`` yields (first text, symbols' hashes, offsets, state) for parts of a group. ``collect(table, part, chosen)``
    describes the runs to send (see ``merge``), ``resolve(asks)`` answers them in a bucket, and
    ``apply(table, parts, answers)`` makes the result rows. ``distinct_texts``: an anchor counts as occurring again
    only in another text. With ``content(table, part, chosen)``, groups ask with hashes only; of anchors that have several distinct
    runs the bucket then fetches the content of each run once, from one group that has it, and
    ``resolve(asks, contents)`` gets both.
    """
    texts, buckets = grouped(docs)

    def parts_of(table: pa.Table) -> list[Part]:
        return [Part(first, offsets, state, find_runs(values, offsets, length, k)) for first, values, offsets, state in read(table)]

    def anchors_of(found: list[Part]) -> tuple[np.ndarray, np.ndarray]:
        anchor = np.concatenate([p.runs.anchor for p in found] or [np.zeros(0, np.uint64)])
        doc = np.concatenate([p.runs.doc + p.first for p in found] or [np.zeros(0, np.int64)])
        order, at = first_places(anchor)
        if not len(order):
            return anchor, np.zeros(0, dtype=bool)
        if distinct_texts:
            again = np.minimum.reduceat(doc[order], at) != np.maximum.reduceat(doc[order], at)
        else:
            again = np.diff(np.r_[at, len(order)]) > 1
        return anchor[order][at], again

    def ask_anchors(key, table):
        anchor, again = anchors_of(parts_of(table))
        order, cut = by_bucket(anchor, buckets)
        gid = key[0].as_py()
        return rows(_ASK, [(b, gid, blob(anchor[o], again[o])) for b in range(buckets) if len(o := order[cut[b] : cut[b + 1]])])

    def answer_anchors(key, table):
        asks = [unblob(x.as_py()) for x in table.column("ask")]
        anchor, again = np.concatenate([a[0] for a in asks]), np.concatenate([a[1] for a in asks])
        order, at = first_places(anchor)
        size = np.diff(np.r_[at, len(order)])
        shared = np.zeros(len(anchor), dtype=bool)
        shared[order] = np.repeat((size > 1) | np.logical_or.reduceat(again[order], at), size)
        cut = np.cumsum([0, *(len(a[0]) for a in asks)])
        hits = [np.flatnonzero(shared[i:j]).astype(np.uint32) for i, j in zip(cut, cut[1:])]
        return rows(_ANSWER, [(g, key[0].as_py(), blob(x)) for g, x in zip(table.column("gid").to_pylist(), hits, strict=True) if len(x)])

    def ask_runs(key, table, answers):
        if not answers.num_rows:
            return rows(_ASK, [])
        found = parts_of(table)
        anchor, _ = anchors_of(found)
        order, cut = by_bucket(anchor, buckets)
        hits = [
            anchor[order[cut[b] : cut[b + 1]]][unblob(x.as_py())[0]]
            for b, x in zip(answers.column("bucket").to_pylist(), answers.column("answer"), strict=True)
        ]
        shared = np.sort(np.concatenate(hits))
        sent = []
        for part in found:
            at = np.minimum(np.searchsorted(shared, part.runs.anchor), len(shared) - 1)
            chosen = np.flatnonzero(shared[at] == part.runs.anchor)
            if len(chosen):
                sent.append(collect(table, part, chosen))
        return rows(_ASK, [(b, key[0].as_py(), x) for b, x in merge(sent, buckets)] if sent else [])

    def answer_runs(key, table):
        found = resolve([unblob(x.as_py()) for x in table.column("ask")])
        return rows(_ANSWER, [(g, key[0].as_py(), x) for g, x in zip(table.column("gid").to_pylist(), found, strict=True) if x is not None])

    def request(key, table):
        """For anchors with several distinct runs, each run's key, sent to one group that has the run."""
        asks = [unblob(x.as_py()) for x in table.column("ask")]
        gids = np.array(table.column("gid").to_pylist())
        anchor, run = np.concatenate([a[0] for a in asks]), np.concatenate([a[1] for a in asks])
        owner = np.repeat(gids, [len(a[0]) for a in asks])
        order, at = first_places(anchor, run)
        pick = order[at]
        wanted = pick[among_several(anchor[pick])]
        by = wanted[np.argsort(owner[wanted], kind="stable")]
        cut = np.flatnonzero(np.r_[True, owner[by][1:] != owner[by][:-1]]) if len(by) else by
        return rows(_ANSWER, [(int(owner[part[0]]), key[0].as_py(), blob(np.sort(run[part]))) for part in np.split(by, cut[1:]) if len(part)])

    def send(key, table, answers):
        if not answers.num_rows:
            return rows(_ASK, [])
        wanted = np.sort(np.concatenate([unblob(x.as_py())[0] for x in answers.column("answer")]))
        sent = []
        for part in parts_of(table):
            own = part.runs.key
            chosen = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own)
            if len(chosen):
                sent.append(content(table, part, chosen))
        return rows(_ASK, [(b, key[0].as_py(), x) for b, x in merge(sent, buckets)] if sent else [])

    def answer_with(key, table, sent):
        if not table.num_rows:
            return rows(_ANSWER, [])
        gids = table.column("gid").to_pylist()
        found = resolve([unblob(x.as_py()) for x in table.column("ask")], [unblob(x.as_py()) for x in sent.column("ask")])
        return rows(_ANSWER, [(g, key[0].as_py(), x) for g, x in zip(gids, found, strict=True) if x is not None])

    def finish(key, table, answers):
        return apply(table, parts_of(table), [unblob(x.as_py()) for x in answers.column("answer")])

    first = texts.groupBy("gid").applyInArrow(ask_anchors, ASK).groupBy("bucket").applyInArrow(answer_anchors, ANSWER)
    asked = texts.groupBy("gid").cogroup(first.groupBy("gid")).applyInArrow(ask_runs, ASK)
    if content is None:
        second = asked.groupBy("bucket").applyInArrow(answer_runs, ANSWER)
    else:
        wanted = asked.groupBy("bucket").applyInArrow(request, ANSWER)
        sent = texts.groupBy("gid").cogroup(wanted.groupBy("gid")).applyInArrow(send, ASK)
        second = asked.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(answer_with, ANSWER)
    return texts.groupBy("gid").cogroup(second.groupBy("gid")).applyInArrow(finish, schema)


def among_several(anchor: np.ndarray) -> np.ndarray:
    """Places of the sorted anchors that occur more than once."""
    at = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[at, len(anchor)])
    return np.flatnonzero(np.repeat(size > 1, size))


def merge(sent: list[Sent], buckets: int):
    """The distinct runs of a group, by bucket: anchor, key, low, high, sizes, payload."""
    anchor, key, low, high, sizes, payload = (np.concatenate([getattr(s, f) for s in sent]) for f in ("anchor", "key", "low", "high", "sizes", "payload"))
    begin = np.cumsum(sizes) - sizes
    order, at = first_places(anchor, key)
    low = (np.add if sent[0].counted else np.minimum).reduceat(low[order], at)
    high = np.maximum.reduceat(high[order], at)
    pick = order[at]
    anchor, key, sizes, begin = anchor[pick], key[pick], sizes[pick], begin[pick]
    order, cut = by_bucket(anchor, buckets)
    for b in range(buckets):
        o = order[cut[b] : cut[b + 1]]
        if len(o):
            data = payload[spread(begin[o], sizes[o])] if len(payload) else payload
            yield b, blob(anchor[o], key[o], low[o], high[o], sizes[o].astype(np.uint32), data)


def answer(key: np.ndarray, run_values: np.ndarray, counts: np.ndarray) -> bytes:
    """Values of each run's windows; a run whose windows all have one value carries it once."""
    begin = np.cumsum(counts) - counts
    even = np.minimum.reduceat(run_values, begin) == np.maximum.reduceat(run_values, begin)
    sizes = np.where(even, 1, counts)
    return blob(key, sizes.astype(np.uint32), run_values[spread(begin, sizes)])


def window_values(known: list[list[np.ndarray]], runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First symbol, text and value of every window that has an answer."""
    none = np.zeros(0, dtype=np.int64)
    if not known:
        return none, none, none
    keys, sizes, values = (np.concatenate([a[i] for a in known]) for i in range(3))
    sizes = sizes.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    at = order[np.minimum(np.searchsorted(keys[order], runs.key), len(keys) - 1)]
    has = np.flatnonzero(keys[at] == runs.key)
    at, counts = at[has], runs.count[has]
    start = spread(runs.start[has], counts)
    within = np.where(np.repeat(sizes[at] == 1, counts), 0, start - np.repeat(runs.start[has], counts))
    return start, np.repeat(runs.doc[has], counts), values[np.repeat((np.cumsum(sizes) - sizes)[at], counts) + within]


def covered(size: int, start: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a window that begins at one of ``start``."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0
