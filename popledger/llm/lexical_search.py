"""Ranked lexical search of many queries at once, by shared partial sums.

Queries with the same terms are one *class*, ranked once. Classes are dealt into blocks of bounded size. In each block the term sets
that several classes share are mined: the pair of symbols (terms, or sets found before) that stands in most classes becomes a
node, again and again, until no pair is shared. The nodes form a sharing graph: a term's weighted impact in a document is
computed once, each shared set's partial sum once from its two parts, and a class adds up the few nodes left to it. Graphs are
built in Spark tasks, one per block; texts are scanned twice per block, once for the statistics (N, L and the df of the block's terms)
and once for the scores. A task keeps the k best documents of each class, and these are merged: first by slot, then over all.

Score: terms are stretches of letters, digits and characters beyond ASCII, A-Z lower-cased. With N documents that have a term, L terms in all, n
in the document, df documents with the term and tf occurrences, w = floor(1000 ln((2N + 2) / (2 df + 1))),
m = 25 + (75 n N) div L, and the score is the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the query's terms, repeats included.

Defined results: null or empty texts have no terms and are neither counted nor found; queries without terms give no rows; every row of the
queries is a query of its own, also with a repeated or null id; rows with equal doc_id are documents of their own; only scores above
0 are returned, fewer than k rows where fewer documents have one; ties go to the smaller doc_id, null after all others. Whole texts
count, in pieces of bounded size. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from popledger.llm.common import lean, prepare, stored

#: Query terms (distinct in their query) of one block: at most a few MB of graph in every worker.
BLOCK_TERMS = 32_768
#: Symbols of a query among which shared pairs are mined together.
MINE_TOGETHER = 32
#: Bytes of a text that are split into words at once.
PIECE = 1 << 22
#: Cells (nodes x documents) of the partial sums held at once.
CELLS = 1 << 22
#: Slots over which a class's candidates are merged first.
SLOTS = 64

# a word byte stays (A-Z become a-z), any other becomes a blank
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

QUERY = "id bigint, class string, terms array<binary>, times array<bigint>"
GRAPH = (
    "block int, terms array<binary>, leaf_term array<int>, leaf_times array<bigint>, left array<int>, right array<int>, "
    "level array<int>, classes array<string>, part array<int>, part_at array<int>"
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = at + PIECE
        # a piece ends before a byte that is no word byte
        while end < len(text) and FOLD[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(FOLD).split()
        at = end


def texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def classes_of(queries: DataFrame, key: str, text: str) -> DataFrame:
    """id, class, distinct terms and their counts of every query that has terms."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for own, data in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                count: Counter[bytes] = Counter()
                for piece in terms_of(data):
                    count.update(piece)
                if count:
                    terms = sorted(count)
                    digest = hashlib.sha256(b" ".join(b"%s %d" % (t, count[t]) for t in terms)).hexdigest()
                    rows.append((own, digest, terms, [count[t] for t in terms]))
            kinds = (pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["id", "class", "terms", "times"])

    return queries.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(lean(cut), QUERY)


def share(sets: list[list[int]], symbols: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Mine shared sets: new symbols as pairs of earlier ones, and what is left of every set.

    Sets are cut into groups of their most common symbols, so that the number of pairs grows with the sets' size."""
    common = Counter(x for s in sets for x in s)
    groups: list[set[int]] = []
    owner: list[int] = []
    for i, s in enumerate(sets):
        ordered = sorted(s, key=lambda x: (-common[x], x))
        for at in range(0, len(ordered), MINE_TOGETHER):
            groups.append(set(ordered[at : at + MINE_TOGETHER]))
            owner.append(i)
    where: dict[tuple[int, int], set[int]] = {}
    for g, group in enumerate(groups):
        for pair in combinations(sorted(x for x in group if common[x] > 1), 2):
            where.setdefault(pair, set()).add(g)
    heap = [(-len(w), pair) for pair, w in where.items() if len(w) > 1]
    heapq.heapify(heap)
    made: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        now = where.get(pair, ())
        if len(now) != -count:  # an older count
            if len(now) > 1:
                heapq.heappush(heap, (-len(now), pair))
            continue
        new, touched = symbols + len(made), set()
        made.append(pair)
        for g in sorted(now):
            groups[g] -= set(pair)
            for x in groups[g]:
                for old in pair:
                    if own := where.get((min(x, old), max(x, old))):
                        own.discard(g)
                where.setdefault((x, new), set()).add(g)
                touched.add((x, new))
            groups[g].add(new)
        del where[pair]
        for p in touched:
            if len(where[p]) > 1:
                heapq.heappush(heap, (-len(where[p]), p))
    left: list[list[int]] = [[] for _ in sets]
    for i, group in zip(owner, groups):
        left[i] += sorted(group)
    return made, left


def graph(key: tuple, rows: pa.Table) -> pa.Table:
    """The sharing graph of one block: leaves (term, times), nodes by level, and the nodes each class adds up."""
    terms: dict[bytes, int] = {}
    leaves: dict[tuple[int, int], int] = {}
    sets, names = [], rows.column("class").to_pylist()
    for own, times in zip(rows.column("terms").to_pylist(), rows.column("times").to_pylist()):
        sets.append([leaves.setdefault((terms.setdefault(t, len(terms)), n), len(leaves)) for t, n in zip(own, times)])
    made, left = share(sets, len(leaves))
    level = [0] * len(leaves)
    for a, b in made:
        level.append(1 + max(level[a], level[b]))
    # nodes in the order of their level, so that a level is one vector operation
    order = sorted(range(len(level)), key=lambda x: level[x])
    number = {x: i for i, x in enumerate(order)}
    nodes = [x for x in order if level[x]]
    part = [number[x] for s in left for x in s]
    out = [
        key[0].as_py(), list(terms), [t for t, _ in leaves], [n for _, n in leaves],
        [number[made[x - len(leaves)][0]] for x in nodes], [number[made[x - len(leaves)][1]] for x in nodes], [level[x] for x in nodes],
        names, part, np.cumsum([0, *map(len, left)]).tolist(),
    ]
    numbers = pa.list_(pa.int32())
    kinds = [pa.int32(), pa.list_(pa.binary()), numbers, pa.list_(pa.int64()), numbers, numbers, numbers, pa.list_(pa.string()), numbers, numbers]
    return pa.table([pa.array([x], kind) for x, kind in zip(out, kinds)], names=[x.split()[0] for x in GRAPH.split(", ")])


class Scorer:
    """A block's graph with its weights: scores of documents for all classes of the block."""

    def __init__(self, row, documents: int, words: int, df: dict[int, int]):
        self.vocabulary = {bytes(t): i for i, t in enumerate(row.terms)}
        self.documents, self.words = documents, words
        ratio = np.array([(2 * documents + 2) / (2 * df.get(i, 0) + 1) for i in range(len(row.terms))])
        self.weight = np.floor(1000 * np.log(ratio)).astype(np.int64)
        self.leaf_term, self.leaf_times = np.array(row.leaf_term, np.int64), np.array(row.leaf_times, np.int64)
        self.left, self.right, level = np.array(row.left, np.int64), np.array(row.right, np.int64), np.array(row.level, np.int64)
        self.levels = np.flatnonzero(np.diff(np.r_[0, level, 0])).tolist() if len(level) else []
        self.classes = len(row.classes)
        self.part, self.part_at = np.array(row.part, np.int64), np.array(row.part_at, np.int64)[:-1]
        self.nodes = len(self.leaf_term) + len(self.left)

    def score(self, tf: np.ndarray, n: list[int]) -> np.ndarray:
        """Scores (class x document) from counts (term x document) and the documents' lengths."""
        m8 = 8 * np.array([25 + 75 * x * self.documents // self.words for x in n], np.int64)
        impact = np.zeros_like(tf)
        t, d = np.nonzero(tf)
        f = tf[t, d]
        impact[t, d] = self.weight[t] * (10**9 * f // (1000 * f + m8[d]))
        sums = np.empty((self.nodes, tf.shape[1]), np.int64)
        first = len(self.leaf_term)
        np.multiply(impact[self.leaf_term], self.leaf_times[:, None], out=sums[:first])
        for a, b in zip(self.levels, self.levels[1:]):
            sums[first + a : first + b] = sums[self.left[a:b]] + sums[self.right[a:b]]
        return np.add.reduceat(sums[self.part], self.part_at, axis=0)


class Best:
    """The k best documents of every class so far."""

    def __init__(self, classes: int, k: int):
        self.k, self.floor, self.last = k, np.ones(classes, np.int64), np.full(classes, np.iinfo(np.int64).max)
        self.rows = [np.zeros(0, np.int64)] * 4  # class, score, whether the id is null, id

    def add(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        c, d = np.nonzero(scores >= self.floor[:, None])
        s = scores[c, d]
        new = (s > self.floor[c]) | null[d].astype(bool) | (ids[d] <= self.last[c])
        c, d, s = c[new], d[new], s[new]
        rows = [np.r_[a, b] for a, b in zip(self.rows, (c, s, null[d], ids[d]))]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        c = rows[0][order]
        rank = np.arange(len(c)) - np.searchsorted(c, c)
        self.rows = [x[order[rank < self.k]] for x in rows]
        full = order[rank == self.k - 1]
        self.floor[rows[0][full]] = rows[1][full]
        self.last[rows[0][full]] = np.where(rows[2][full] == 1, np.iinfo(np.int64).max, rows[3][full])


def counts(batch: pa.RecordBatch, vocabulary: dict[bytes, int], step: int) -> Iterator[tuple[int, int, np.ndarray, list[int]]]:
    """Counts (term x document) and lengths of every ``step`` documents of a batch."""
    size, data = len(vocabulary), texts(batch.column(1))
    for i in range(0, len(data), step):
        part = data[i : i + step]
        tf, n = np.zeros((len(part), size), np.int64), [0] * len(part)
        for d, text in enumerate(part):
            for piece in terms_of(text):
                n[d] += len(piece)
                known = [x for x in map(vocabulary.get, piece) if x is not None]
                if known:
                    tf[d] += np.bincount(known, minlength=size)
        yield i, i + len(part), tf.T, n


def statistics(docs: DataFrame, row) -> dict[int, int]:
    """df by term number; N under -1 and L under -2."""
    vocabulary = {bytes(t): i for i, t in enumerate(row.terms)}
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        df, documents, words = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            for _, _, tf, n in counts(batch, known, max(1, CELLS // max(1, len(known)))):
                df += (tf > 0).sum(axis=1)
                documents += sum(x > 0 for x in n)
                words += sum(n)
        have = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.r_[have, -1, -2], pa.int32()), pa.array(np.r_[df[have], documents, words], pa.int64())], names=["term", "n"])

    found = docs.mapInArrow(lean(count), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in found.collect()}


def rank_block(docs: DataFrame, row, k: int) -> DataFrame:
    """class, doc_id and score of the k best documents in every task, for the classes of one block."""
    facts = statistics(docs, row)
    if not facts.get(-2):
        return docs.sparkSession.createDataFrame([], "class string, doc_id bigint, score bigint")
    shared = docs.sparkSession.sparkContext.broadcast((Scorer(row, facts[-1], facts[-2], facts), list(row.classes)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, classes = shared.value
        best = Best(len(classes), k)
        for batch in batches:
            ids = batch.column(0)
            null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.int64)
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for i, j, tf, n in counts(batch, scorer.vocabulary, max(1, CELLS // scorer.nodes)):
                best.add(scorer.score(tf, n), null[i:j], numbers[i:j])
        c, s, null, ids = best.rows
        names = pa.array(classes, pa.string()).take(pa.array(c, pa.int64()))
        yield pa.record_batch([names, pa.array(ids, pa.int64(), mask=null == 1), pa.array(s, pa.int64())], names=["class", "doc_id", "score"])

    return docs.mapInArrow(lean(score), "class string, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every query."""
    spark = prepare(docs.sparkSession)
    items = stored(classes_of(queries, key, text), "queries")
    # one row per class; the digest names the terms, so any of its rows will do
    classes = items.groupBy("class").agg(F.first(F.struct("terms", "times")).alias("x")).select("class", "x.*")
    total = classes.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int"))
    graphs = stored(dealt.groupBy("block").applyInArrow(graph, GRAPH), "sharing-graphs")
    texts_ = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for row in graphs.toLocalIterator():
        part = stored(rank_block(texts_, row, k), "candidates")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    slot = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SLOTS)).alias("slot")
    within = found.select("*", slot).withColumn("rank", F.row_number().over(Window.partitionBy("class", "slot").orderBy(*order))).where(F.col("rank") <= k)
    best = within.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy(*order))).where(F.col("rank") <= k)
    return items.select("id", "class").join(best, "class").select(F.col("id").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
