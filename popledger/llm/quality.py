"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics are computed for whole batches of texts with numpy, inside Spark tasks. The trees are fitted on a bounded sample of
labelled rows (``fit_rows``): values are cut into quantile bins, every level of a tree needs one histogram of
gradients per node, feature and bin, and leaves take a regularised Newton step of the log loss. A fitted forest is a few flat arrays
(feature, threshold, child, leaf value), broadcast to the tasks, which walk all rows of a batch down all trees level by level.

Defined results: a null or empty text has all statistics 0 and is scored like any other; duplicate labels of a document count
once, with the larger label; labels that are null or of unknown documents are left out; with no labelled row, or labels of one
kind only, every score is the (smoothed) share of label 1. Columns other than key and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import keyed, lean, prepare
from popledger.llm.sequences import FOLDED_VALUES, NOT_WHITE, packed, parts, prefix, stretch_hash, window_hashes, words

PART = 1 << 20
FEATURES = [
    "log_bytes", "log_words", "word_length", "upper", "digit", "punctuation", "bang", "bar", "symbol", "newline", "other_script",
    "blank", "distinct_words", "commonest_word", "repeated_pairs", "same_as_before", "short_words", "long_words", "word_end_symbol",
    "line_length", "distinct_lines", "sentence_end", "word_length_spread", "upper_words",
]


def byte_set(values) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_UPPER = byte_set(range(65, 91))
_CLASSES = {
    "upper": _UPPER,
    "digit": byte_set(range(48, 58)),
    "punctuation": byte_set(map(ord, ".,;:?'\"()-")),
    "bang": byte_set([ord("!")]),
    "bar": byte_set([ord("|")]),
    "symbol": byte_set(map(ord, "#$%&*+<=>@[]\\^_`{}~/")),
    "newline": byte_set([10]),
    "other_script": byte_set(range(128, 256)),
    "blank": byte_set([9, 11, 12, 13, 32]),
}
_STOP = byte_set(map(ord, ".!?"))
_NOT_END = ~byte_set([10])


def total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the stretches between neighbouring offsets, empty ones included."""
    return np.diff(np.r_[0, np.cumsum(values, dtype=np.float64)][at])


def statistics(column) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, offsets = packed(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)), dtype=np.float64)
    f = {name: i for i, name in enumerate(FEATURES)}
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        rows = out[i:j]
        sizes = np.diff(at).astype(np.float64)
        some = np.maximum(sizes, 1)
        for name, kind in _CLASSES.items():
            rows[:, f[name]] = total(kind[piece], at) / some
        starts, ends, word_at = words(piece, at, NOT_WHITE)
        n = np.diff(word_at).astype(np.float64)
        count = np.maximum(n, 1)
        doc = np.repeat(np.arange(j - i), np.diff(word_at))
        lengths = (ends - starts).astype(np.float64)
        rows[:, f["log_bytes"]], rows[:, f["log_words"]] = np.log1p(sizes), np.log1p(n)
        mean = total(lengths, word_at) / count
        rows[:, f["word_length"]] = mean
        rows[:, f["word_length_spread"]] = np.sqrt(np.maximum(total(lengths**2, word_at) / count - mean**2, 0))
        rows[:, f["short_words"]], rows[:, f["long_words"]] = total(lengths <= 2, word_at) / count, total(lengths > 12, word_at) / count
        if len(starts):
            hashes = stretch_hash(prefix(FOLDED_VALUES[piece]), starts, ends)
            last = piece[ends - 1]
            rows[:, f["word_end_symbol"]] = total(_CLASSES["symbol"][last] | _CLASSES["bang"][last], word_at) / count
            rows[:, f["sentence_end"]] = total(_STOP[last], word_at) / count
            rows[:, f["upper_words"]] = total(_UPPER[piece[starts]] & _UPPER[last], word_at) / count
            same = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])]
            rows[:, f["same_as_before"]] = total(same, word_at) / count
            order = np.lexsort([hashes, doc])
            new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
            first = np.flatnonzero(new)
            often = np.diff(np.r_[first, len(order)]).astype(np.float64)
            rows[:, f["distinct_words"]] = np.bincount(doc[order][first], minlength=j - i) / count
            most = np.zeros(j - i)
            np.maximum.at(most, doc[order][first], often)
            rows[:, f["commonest_word"]] = most / count
            pairs = window_hashes(prefix(hashes), 2)
            inside = doc[1:] == doc[:-1]
            pairs, owner = pairs[inside], doc[1:][inside]
            if len(pairs):
                order = np.lexsort([pairs, owner])
                again = np.r_[False, (pairs[order][1:] == pairs[order][:-1]) & (owner[order][1:] == owner[order][:-1])]
                rows[:, f["repeated_pairs"]] = np.bincount(owner[order][again], minlength=j - i) / count
        starts, ends, line_at = words(piece, at, _NOT_END)
        lines = np.maximum(np.diff(line_at), 1)
        rows[:, f["line_length"]] = np.log1p(sizes / lines)
        if len(starts):
            hashes = stretch_hash(prefix(FOLDED_VALUES[piece]), starts, ends)
            doc = np.repeat(np.arange(j - i), np.diff(line_at))
            order = np.lexsort([hashes, doc])
            new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
            rows[:, f["distinct_lines"]] = np.bincount(doc[order][new], minlength=j - i) / lines
    return out


@dataclass
class Forest:
    """Complete binary trees of one depth in flat arrays; leaf values add up to the log odds."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        odds = np.full(len(x), self.base)
        row = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            odds += leaf[node - inner]
        return 1 / (1 + np.exp(-odds))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2, ridge: float = 1.0) -> Forest:
    """Boost ``trees`` trees of one depth on the log loss."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    inner, leaves = 2**depth - 1, 2**depth
    none = Forest(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not 0 < y.sum() < len(y):
        return none
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1)
    cell = binned + np.arange(width) * bins
    odds = np.full(len(y), none.base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + cell).ravel()
            shape = (many, width, bins)
            left_g = np.bincount(at, np.repeat(g, width), many * width * bins).reshape(shape).cumsum(2)
            left_h = np.bincount(at, np.repeat(h, width), many * width * bins).reshape(shape).cumsum(2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < 1) | (all_h - left_h < 1)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k, b in enumerate(best):
                i, cut = divmod(int(b), bins)
                if gain[k].ravel()[b] > 1e-9 and cut < len(cuts[i]):
                    feature[first + k], threshold[first + k] = i, cuts[i][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf_g = np.bincount(node - inner, g, leaves)
        leaf_h = np.bincount(node - inner, h, leaves)
        leaf = -rate * leaf_g / (leaf_h + ridge)
        odds += leaf[node - inner]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Forest(none.base, np.array(features), np.array(thresholds), np.array(values))


def is_held_out(key) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def labelled_sample(labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """id and label of about ``fit_rows`` labelled documents that are not held out, chosen by a hash of the id; all, if fewer."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    known = known.where(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    n = known.count()
    if n <= fit_rows:
        return known
    return known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))


def sample_documents(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """Texts of the sample with their label. The sample's ids are bounded by ``fit_rows``, so they are broadcast."""
    sample = labelled_sample(labels, label, fit_rows)
    return keyed(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, label: str = "quality", **settings) -> Forest:
    prepare(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    found = sample_documents(docs, labels, label, fit_rows).mapInArrow(lean(measure), "doc_id bigint, y int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.argsort(found.column("doc_id").to_numpy(), kind="stable")  # the same forest whatever the order of tasks
    return fit_forest(x[order], found.column("y").to_numpy().astype(np.float64)[order], **settings)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score of every document."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(forest)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(shared.value.score(statistics(batch.column(1))))], names=["doc_id", "score"])

    return keyed(docs).mapInArrow(lean(walk), "doc_id bigint, score double")
