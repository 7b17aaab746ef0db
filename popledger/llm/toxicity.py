"""Toxic spans by a linear-chain conditional random field.

Training labels are on documents, so labelled tokens are derived first: words and word beginnings that occur in many more toxic than
clean documents of the sample form a lexicon with log odds, and in toxic documents the tokens that the lexicon is sure of are labelled.
Copies of a toxic document would make all its words look toxic, so a lexicon word counts at most once per word before it: copies share that.
A two-state chain is then fitted on these token sequences by gradient ascent of the conditional likelihood; its features are the
lexicon class of a token and of both neighbours, and its length. Scoring runs forward-backward over whole texts; the marginals of the toxic
state give offending spans, and their noisy-or gives the document's score.

All texts of a batch are one stream of tokens; a text's first token ignores what came before it. The recursions run over blocks of the stream
side by side (block products first, then all blocks at once), so a text of any length is one pass.

Defined results: a null or empty text, or one without words, has score 0 and no spans; a document's labels count once, with
the larger one; labels that are null or of unknown documents are left out; without toxic and clean labelled documents, or without a word that
tells them apart, all scores are 0, and the log says so. Words too rare for evidence of their own are taken together where no word has it.
Columns other than key and text are never read. The sample is bounded by ``fit_rows`` documents, the chain's by ``chain_rows``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import keyed, lean, prepare
from popledger.llm.quality import is_held_out, sample_documents
from popledger.llm.sequences import FOLDED_VALUES, WORD_BYTE, packed, parts, prefix, runs_of, stretch_hash, words

LOG = logging.getLogger("popledger.toxicity")
PART = 1 << 20
BEGINNINGS = (3, 4, 5, 6)
CLASS_BOUNDS = np.array([2.0, 3.0, 4.0, 5.0, 6.0])
SURE = 4.0
#: Log likelihood ratio (twice) from which a word's preference for toxic documents is no accident: about one in two million.
EVIDENCE = 25.0
#: Share of words that chance may explain, and the number of documents from which counts are taken together, where rare words are pooled.
POOLED_ERROR = 0.01
POOLED_MOST = 64
CLASSES = len(CLASS_BOUNDS) + 1
LENGTHS = np.array([3, 6, 10])
FEATURES = 3 * CLASSES + len(LENGTHS) + 1
NOTABLE = 0.05


def tokens(column) -> Iterator[tuple]:
    """Parts of a batch: texts, bytes before them, token bounds, token offsets, and token hashes (words, then their beginnings)."""
    data, offsets = packed(column)
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, word_at = words(piece, at, WORD_BYTE)
        sums = prefix(FOLDED_VALUES[piece])
        hashes = [stretch_hash(sums, starts, ends)]
        for size in BEGINNINGS:
            begun = stretch_hash(sums, starts, np.minimum(starts + size, ends)) ^ np.uint64(0xA5A5A5A5 * size)
            hashes.append(np.where(ends - starts > size, begun, np.uint64(0)))
        yield i, j, at, starts, ends, word_at, hashes


@dataclass
class Lexicon:
    """Hashes of words and beginnings, sorted, with their log odds."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def of(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Largest log odds among a token's word and beginnings; 0 if none is known."""
        best = np.zeros(len(hashes[0]))
        if len(self.keys):
            for h in hashes:
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                best = np.maximum(best, np.where(self.keys[at] == h, self.odds[at], 0))
        return best


def observe(odds: np.ndarray, sizes: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """Numbers of the four features that hold for each token: own class, class before, class after, length."""
    kind = np.searchsorted(CLASS_BOUNDS, odds, side="right")
    before, after = np.r_[0, kind[:-1]][: len(kind)], np.r_[kind[1:], 0][: len(kind)]
    first, last = word_at[:-1][np.diff(word_at) > 0], word_at[1:][np.diff(word_at) > 0] - 1
    before[first], after[last] = 0, 0
    return np.stack([kind, before + CLASSES, after + 2 * CLASSES, np.searchsorted(LENGTHS, sizes, side="right") + 3 * CLASSES], axis=1).astype(np.uint8)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of many 2 x 2 matrices, scaled."""
    out = np.empty_like(a)
    for i in (0, 1):
        for j in (0, 1):
            out[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
    return out / out.max(axis=(1, 2), keepdims=True)


def scan(m: np.ndarray) -> np.ndarray:
    """Scaled vectors v[t] = v[t-1] M[t] from v = (1, 1), block by block side by side."""
    n = len(m)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    padded = np.zeros((blocks * width, 2, 2))
    padded[:n] = m
    padded[n:] = np.eye(2)
    padded = padded.reshape(blocks, width, 2, 2)
    whole = np.broadcast_to(np.eye(2), (blocks, 2, 2)).copy()
    for t in range(width):
        whole = product(whole, padded[:, t])
    v = np.ones((blocks, 2))
    for b in range(1, blocks):
        now = v[b - 1] @ whole[b - 1]
        v[b] = now / now.max()
    out = np.empty((blocks, width, 2))
    for t in range(width):
        step = padded[:, t]
        v = np.stack([v[:, 0] * step[:, 0, 0] + v[:, 1] * step[:, 1, 0], v[:, 0] * step[:, 0, 1] + v[:, 1] * step[:, 1, 1]], axis=1)
        v = v / v.max(axis=1, keepdims=True)
        out[:, t] = v
    return out.reshape(-1, 2)[:n]


@dataclass
class Chain:
    """Weights of the toxic state for each feature, and log weights of the four transitions."""

    weight: np.ndarray
    move: np.ndarray

    def matrices(self, observed: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Transition times emission of every token; at a text's first token all rows are alike, which cuts the stream there."""
        emit = np.clip(self.weight[observed].sum(axis=1), -30, 30)
        emission = np.stack([np.ones(len(emit)), np.exp(emit)], axis=1)
        emission /= emission.max(axis=1, keepdims=True)
        m = np.exp(self.move)[None] * emission[:, None, :]
        m[first] = emission[first][:, None, :]
        return m

    def marginals(self, observed: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Probability of the toxic state at each token, and what the gradient needs."""
        first = np.zeros(len(observed), dtype=bool)
        first[word_at[:-1][np.diff(word_at) > 0]] = True
        m = self.matrices(observed, first)
        forward = scan(m)
        behind = np.r_[m[1:], np.ones((1, 2, 2))]  # what follows a token; nothing follows the last
        backward = scan(behind[::-1].transpose(0, 2, 1))[::-1]
        p = forward * backward
        return p[:, 1] / p.sum(axis=1), m, forward, backward

    @classmethod
    def fit(cls, observed: np.ndarray, word_at: np.ndarray, toxic: np.ndarray, rounds: int = 80, rate: float = 0.3, ridge: float = 1e-3) -> Chain:
        """Gradient ascent (with moment estimates) of the log likelihood of the labelled sequences."""
        chain = cls(np.zeros(FEATURES), np.zeros((2, 2)))
        n = len(observed)
        inner = np.ones(n, dtype=bool)
        inner[word_at[:-1][np.diff(word_at) > 0]] = False
        at = np.flatnonzero(inner)
        seen = np.bincount(observed.ravel(), np.repeat(toxic, observed.shape[1]).astype(float), FEATURES)
        moved = np.bincount(2 * toxic[at - 1] + toxic[at], minlength=4).reshape(2, 2).astype(float)
        mean, spread = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
        for step in range(1, rounds + 1):
            p, m, forward, backward = chain.marginals(observed, word_at)
            expected = np.bincount(observed.ravel(), np.repeat(p, observed.shape[1]), FEATURES)
            pair = forward[at - 1][:, :, None] * m[at] * backward[at][:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            g = np.r_[seen - expected, (moved - pair.sum(axis=0)).ravel()] / max(toxic.sum(), 1)
            g -= ridge * np.r_[chain.weight, chain.move.ravel()]
            mean, spread = 0.9 * mean + 0.1 * g, 0.99 * spread + 0.01 * g * g
            change = rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
            chain.weight = chain.weight + change[:FEATURES]
            chain.move = chain.move + change[FEATURES:].reshape(2, 2)
        return chain


@dataclass
class Model:
    lexicon: Lexicon
    chain: Chain | None


def word_counts(sample: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """Number of documents (n) with each word or beginning (key), or with each of the ``wanted`` ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, _, _, word_at, hashes in tokens(batch.column(1)):
                doc = np.repeat(np.arange(j - i), np.diff(word_at))
                every, owner = np.concatenate(hashes), np.tile(doc, len(hashes))
                keep = every != 0
                if wanted is not None:
                    keep &= np.isin(every, wanted)
                pairs = np.unique(np.stack([every[keep].astype(np.int64), owner[keep]], axis=1), axis=0)
                key, n = np.unique(pairs[:, 0], return_counts=True)
                yield pa.record_batch([pa.array(key), pa.array(n)], names=["key", "n"])

    return sample.select("doc_id", "text").mapInArrow(lean(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def counts_of(sample: DataFrame, wanted: np.ndarray | None, least: int) -> dict[int, int]:
    """The counts of the words in at least ``least`` documents."""
    found = word_counts(sample, wanted).where(F.col("n") >= least).toArrow()
    return dict(zip(found.column("key").to_pylist(), found.column("n").to_pylist()))


def fewest(evidence: float, base: float) -> int:
    """Fewest toxic documents with which a word that no clean one has can reach the evidence: rarer words never can."""
    return max(1, int(np.ceil(evidence / (-2 * np.log(base)))))


def pooled_words(toxic: DataFrame, clean: DataFrame, base: float) -> dict[int, int]:
    """Words of toxic documents only, where no single word has evidence of its own.

    A word in n documents is in toxic ones only with probability base**n by chance. From the fewest documents on where words that
    chance explains are at most POOLED_ERROR of those found, all of them count."""
    both = word_counts(toxic).join(word_counts(clean).withColumnRenamed("n", "c"), "key", "full").select("key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("c", F.lit(0)).alias("c"))
    times = F.least(F.col("n") + F.col("c"), F.lit(POOLED_MOST)).alias("times")
    seen = {r.times: (r.words, r.only) for r in both.groupBy(times).agg(F.count(F.lit(1)).alias("words"), F.count_if(F.col("c") == 0).alias("only")).collect()}
    from_, chance, found_ = None, 0.0, 0
    for n in range(POOLED_MOST, 0, -1):
        words_, only = seen.get(n, (0, 0))
        chance, found_ = chance + words_ * base**n, found_ + only
        if only and chance <= POOLED_ERROR * found_:
            from_ = n
    if from_ is None:
        return {}
    found = both.where((F.col("c") == 0) & (F.col("n") >= from_)).toArrow()
    return dict(zip(found.column("key").to_pylist(), found.column("n").to_pylist()))


def contexts_of(sample: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Number of different words that stand before each of the ``wanted`` words or beginnings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, _, word_at, hashes in tokens(batch.column(1)):
                before = np.r_[np.uint64(0), hashes[0][:-1]][: len(hashes[0])]
                before[word_at[:-1][np.diff(word_at) > 0]] = 0
                every, before = np.concatenate(hashes), np.tile(before, len(hashes))
                keep = np.isin(every, wanted)
                pairs = np.unique(np.stack([every[keep], before[keep]], axis=1).astype(np.int64), axis=0)
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "before"])

    found = sample.select("doc_id", "text").mapInArrow(lean(run), "key bigint, before bigint").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).toArrow()
    return dict(zip(found.column("key").to_pylist(), found.column("n").to_pylist()))


def preferred(n_toxic: np.ndarray, n_clean: np.ndarray, all_toxic: int, all_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of words for toxic documents, and which of them are large and no accident."""
    odds = np.log((n_toxic + 0.5) / (all_toxic + 1)) - np.log((n_clean + 0.5) / (all_clean + 1))
    both, base = n_toxic + n_clean, all_toxic / (all_clean + all_toxic)
    ratio = 2 * (n_toxic * np.log(n_toxic / (both * base)) + n_clean * np.log(np.maximum(n_clean, 1) / (both * (1 - base))))
    return odds, (odds >= CLASS_BOUNDS[0]) & (ratio >= EVIDENCE)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, chain_rows: int = 800, label: str = "toxic") -> Model:
    """Lexicon and chain from at most about ``fit_rows`` labelled documents that are not held out."""
    prepare(docs.sparkSession)
    sample = sample_documents(docs, labels, label, fit_rows)
    toxic, clean = sample.where("y = 1"), sample.where("y = 0")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(Lexicon(), None)
    base = sizes[1] / (sizes[0] + sizes[1])
    often = counts_of(toxic, None, fewest(EVIDENCE, base))
    keys = np.sort(np.array(list(often), dtype=np.int64).astype(np.uint64))
    rare = counts_of(clean, keys, 1)
    def numbers(counts: dict[int, int]) -> np.ndarray:
        return np.array([counts.get(int(k), 0) for k in keys.astype(np.int64)], dtype=float)

    n_toxic, n_clean = numbers(often), numbers(rare)
    kept = preferred(n_toxic, n_clean, sizes[1], sizes[0])[1]
    keys, n_toxic, n_clean = keys[kept], n_toxic[kept], n_clean[kept]
    alone = len(keys) > 0
    if not alone:
        pooled = pooled_words(toxic, clean, base)
        keys = np.sort(np.array(list(pooled), dtype=np.int64).astype(np.uint64))
        n_toxic, n_clean = numbers(pooled), np.zeros(len(keys))
    odds = preferred(n_toxic, n_clean, sizes[1], sizes[0])[0]
    kept = np.ones(len(keys), dtype=bool)
    if alone:
        capped = preferred(np.minimum(n_toxic, numbers(contexts_of(toxic, keys))), np.minimum(n_clean, numbers(contexts_of(clean, keys))), sizes[1], sizes[0])
        # where no word stands in enough contexts, the plain counts decide
        odds, kept = capped if capped[1].any() else (odds, kept)
    lexicon = Lexicon(keys[kept], odds[kept])
    if not len(lexicon.keys):
        LOG.warning("no word tells toxic documents from clean ones: all scores are 0")
        return Model(lexicon, None)
    # tokens of which the lexicon is sure, or all that it knows where it is sure of none
    sure = SURE if lexicon.odds.max() >= SURE else CLASS_BOUNDS[0]
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            for i, j, _, starts, ends, word_at, hashes in tokens(batch.column(1)):
                odds = shared.value.of(hashes)
                seen = observe(odds, ends - starts, word_at)
                marked = (odds >= sure) & (np.repeat(kinds[i:j], np.diff(word_at)) == 1)
                cut = list(zip(word_at, word_at[1:]))
                yield pa.record_batch(
                    [batch.column(0)[i:j], pa.array([seen[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([marked[a:b].tobytes() for a, b in cut], pa.binary())],
                    names=["doc_id", "seen", "marked"],
                )

    half = chain_rows // 2
    share = F.when(F.col("y") == 1, half / sizes[1]).otherwise(half / sizes[0])
    chosen = sample.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < share * 1_000_000)
    found = chosen.mapInArrow(lean(sequences), "doc_id bigint, seen binary, marked binary").toArrow().sort_by("doc_id")
    seen = np.frombuffer(b"".join(found.column("seen").to_pylist()), dtype=np.uint8).reshape(-1, 4).astype(np.int64)
    marked = np.frombuffer(b"".join(found.column("marked").to_pylist()), dtype=np.uint8).astype(np.int64)
    if not marked.any():
        return Model(lexicon, None)
    word_at = np.cumsum([0, *(len(x) for x in found.column("marked").to_pylist())])
    return Model(lexicon, Chain.fit(seen, word_at, marked))


SCORES = "doc_id bigint, score double, span_start array<bigint>, span_end array<bigint>, span_score array<double>"


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, and byte spans whose tokens are toxic with at least ``threshold``, each with its largest marginal."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            size = batch.num_rows
            scores, spans = np.zeros(size), [[[] for _ in range(size)] for _ in range(3)]
            for i, j, at, starts, ends, word_at, hashes in tokens(batch.column(1)) if model.chain else ():
                if not len(starts):
                    continue
                p = model.chain.marginals(observe(model.lexicon.of(hashes), ends - starts, word_at).astype(np.int64), word_at)[0]
                some = np.diff(word_at) > 0
                top = np.zeros(j - i)
                top[some] = np.maximum.reduceat(p, word_at[:-1][some])
                missing = np.diff(np.r_[0, np.cumsum(np.where(p >= NOTABLE, np.log1p(-np.minimum(p, 1 - 1e-12)), 0))][word_at])
                scores[i:j] = np.where(top >= NOTABLE, -np.expm1(missing), top)
                for doc in np.flatnonzero(top >= threshold):
                    a, b = word_at[doc], word_at[doc + 1]
                    for s, e in zip(*runs_of(p[a:b] >= threshold)):
                        spans[0][i + doc].append(int(starts[a + s] - at[doc]))
                        spans[1][i + doc].append(int(ends[a + e - 1] - at[doc]))
                        spans[2][i + doc].append(float(p[a + s : a + e].max()))
            lists = [pa.array(x, pa.list_(t)) for x, t in zip(spans, (pa.int64(), pa.int64(), pa.float64()))]
            yield pa.record_batch([batch.column(0), pa.array(np.clip(scores, 0, 1)), *lists], names=["doc_id", "score", "span_start", "span_end", "span_score"])

    return keyed(docs).mapInArrow(lean(run), SCORES)


__all__ = ["Chain", "Lexicon", "Model", "fit", "is_held_out", "score"]
