"""N-gram Jaccard join: documents whose sets of word n-grams overlap enough, exact, and the groups they form.

1. *Sets.* Each text becomes its sorted array of 64-bit n-gram hashes; equal sets are one node (a digest of the set), so copies cost nothing.
2. *Families.* Nodes that could link share a slice: sets are cut by hash value into more slices than two linked sets of
   that size can differ in elements. The number of slices is set per size class, and sets at the lower edge of a
   class also join the class below. If at most d slices of a set can differ, it shares one of its d + 1 rarest slices with any
   set it links to, whatever order of rarity all sets use. Tasks meet the slices in buckets and count them; a slice that stands once
   connects nothing, so a set with d + 1 slices of its own joins no family, however many common passages it has, and of the others
   only the rarest are used. Slices that very many sets have are counted beforehand (a list of bounded size); they come last in
   the order, and where a set needs one all the same, its task hangs the sets of the slice together and sends one row.
   Connected by such slices, nodes form families; no link leaves a family.
   Slices without elements say nothing: a set with too few others uses them too, and all its slices then.
3. *Size-banded tiles.* A family's nodes are dealt to size bands and blocks of at most ``BLOCK`` nodes; only tiles of bands whose
   sizes can link are compared. In a tile every set has a bitmap of its hashes, one bit flipped per element: bits in which two bitmaps differ
   are elements in which the sets differ, so the bit count bounds the overlap from above. Pairs that pass, and that are not connected yet
   inside the tile, are decided by intersecting the sorted arrays. A tile returns links that span what it has connected, never all pairs.
4. *Components* of the links, over all documents.

Defined results: words are lower-cased (A-Z) and separated by white space; with fewer words than ``n`` the whole sequence is the only n-gram;
a null or empty text, or one without words, has an empty set and stands alone; equal texts have equal sets; repeated rows with one id
count as that document, rows with one id and different texts are compared apart and are one document of the component; rows without an id
belong to the component of an equal set with an id, else to none (null). Other columns are not read. An empty table gives no rows.
N-grams count as equal when their 64-bit hashes are. Links are found as far as they connect: a pair that others connect is not tested.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from popledger.llm.common import keyed, lean, prepare, stored, text_bytes
from popledger.llm.components import attach, components
from popledger.llm.repeats import blob, by_bucket, unblob
from popledger.llm.sequences import FOLDED_VALUES, NOT_WHITE, exact_long, mix, packed, parts, prefix, stretch_hash, words

PART = 1 << 18
BLOCK = 128
#: Slices that a task holds before it sends them.
HELD = 1 << 18
BUCKET_BYTES = 8 << 20
#: Slices that stand this often are common; at most one in MOST_COMMON of all slices, so the list stays below 32 MB.
COMMON = 64
MOST_COMMON = 1 << 22
#: Families of up to BLOCK nodes share tasks of about this many nodes.
BATCH_NODES = 1000


@lru_cache(maxsize=None)
def size_classes(percent: int) -> list[int]:
    """Lower bounds of the size classes: each spans three times the ratio in which two linked sizes can stand."""
    out, low = [1], 1
    while low < 1 << 40:
        top = low
        for _ in range(3):
            top = top * 100 // percent
        low = top + 1
        out.append(low)
    return out


def class_of(n: int, percent: int) -> int:
    return int(np.searchsorted(size_classes(percent), n, side="right")) - 1


def differing(n: int, percent: int) -> int:
    """Most elements in which a set of ``n`` and one it links to can differ."""
    # 100 * |A & B| >= percent * |A | B|  is  |A ^ B| <= (|A| + |B|) * (100 - percent) / (100 + percent)
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def slices_of(i: int, percent: int) -> int:
    """Number of slices in a size class: more than can differ, with room for empty ones and for those that many sets share."""
    bounds = size_classes(percent)
    differ = differing(bounds[i + 1] - 1, percent)
    spare = 0
    while differ:
        m = differ + 1 + spare
        empty = m * exp(-bounds[i] / m)
        if ceil(empty + 2 * sqrt(empty)) <= spare or spare > differ:
            break
        spare += 1
    return max(differ + 1 + spare, differ * 8 // 5 + 1) if differ else 1


def sets_of(column, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    data, offsets = packed(column)
    for i, j in parts(offsets, PART):
        piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, word_at = words(piece, at, NOT_WHITE)
        sums = prefix(exact_long(stretch_hash(prefix(FOLDED_VALUES[piece]), starts, ends), piece, starts, ends, folded=True))
        counts = np.diff(word_at)
        grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        first = np.repeat(word_at[:-1], grams) + np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
        last = np.minimum(first + n, np.repeat(word_at[1:], grams))
        hashes = stretch_hash(sums, first, last)
        doc = np.repeat(np.arange(j - i), grams)
        order = np.lexsort([hashes, doc])
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        yield from np.split(hashes, np.searchsorted(doc, np.arange(1, j - i)))


def digest(hashes: np.ndarray) -> int:
    """Digest of a set, as a signed number; 0 for the empty set."""
    if not len(hashes):
        return 0
    total = mix(hashes.copy()).sum(dtype=np.uint64) ^ np.uint64(len(hashes) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return int(mix(np.array([total], dtype=np.uint64)).astype(np.int64)[0]) or 1


def slices(hashes: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """Keys of a set's slices, in its size class and, at the lower edge, in the class below, each with the number of its most common
    keys that it can do without. The keys' last bit tells the two classes apart."""
    n, out = len(hashes), []
    bounds = size_classes(percent)
    own = class_of(n, percent)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64, out=sums[1:])
    for i in (own, own - 1):
        if i < 0 or i < own and n * percent > 100 * (bounds[own] - 1):
            continue
        m = slices_of(i, percent)
        if m == 1:
            continue  # sets of this size link only if they are equal
        of = (hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
        cut = np.searchsorted(of, np.arange(m + 1, dtype=np.uint64))
        keys = mix((sums[cut[1:]] - sums[cut[:-1]]) ^ mix(np.arange(m, dtype=np.uint64) + np.uint64((i + 1) << 40)))
        keys = keys & ~np.uint64(1) | np.uint64(i & 1)
        full = cut[1:] > cut[:-1]
        spare = int(full.sum()) - differing(n, percent) - 1
        out.append((keys[full], spare) if spare >= 0 else (keys, 0))
    return out


def sets_table(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, number of n-grams and digest of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), digest(s)) for s in sets_of(batch.column(1), n)]
            yield pa.record_batch([batch.column(0), *(pa.array([x[i] for x in found], pa.int64()) for i in (0, 1))], names=["doc_id", "n", "node"])

    return docs.mapInArrow(lean(run), "doc_id bigint, n bigint, node bigint")


def stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the smallest node of each, and the other nodes with that one, each pair once."""
    order = np.lexsort([nodes, keys])
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    centre = np.repeat(nodes[first], np.diff(np.r_[first, len(keys)]))
    other = nodes != centre
    pairs = np.unique(np.stack([nodes[other], centre[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return keys[first], nodes[first], pairs[:, 0], pairs[:, 1]


def common_slices(docs: DataFrame, n: int, percent: int) -> np.ndarray:
    """Keys of the slices that many sets have, the rarest first: those that tasks see more than once, counted, from COMMON
    and from one in MOST_COMMON of all slices on. So there are MOST_COMMON at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for keys, _, _ in held_slices(batches, n, percent):
            total += len(keys)
            own, times = np.unique(keys, return_counts=True)
            again = times > 1
            yield pa.record_batch([pa.array(own[again].astype(np.int64)), pa.array(times[again].astype(np.int64)), pa.array(np.zeros(int(again.sum()), bool))], names=["key", "n", "all"])
        yield pa.record_batch([pa.array([0], pa.int64()), pa.array([total], pa.int64()), pa.array([True])], names=["key", "n", "all"])

    counted = stored(docs.mapInArrow(lean(count), "key bigint, n bigint, all boolean").groupBy("all", "key").agg(F.sum("n").alias("n")), "slice-counts")
    total = counted.where("all").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = counted.where(~F.col("all") & (F.col("n") >= max(COMMON, -(-total // MOST_COMMON)))).select("key", "n").toArrow()
    key, times = found.column("key").to_numpy().astype(np.uint64), found.column("n").to_numpy()
    return key[np.lexsort([key, times])]


def held_slices(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, nodes and spare keys of the distinct sets of a task, about HELD keys at a time."""
    keys, nodes, spares, held, seen = [], [], [], 0, set()
    for batch in batches:
        for s in sets_of(batch.column(1), n):
            node = digest(s)
            if not len(s) or node in seen:
                continue
            seen.add(node)
            for own, spare in slices(s, percent):
                keys.append(own)
                nodes.append(np.full(len(own), node, dtype=np.int64))
                spares.append(np.full(len(own), spare, dtype=np.int64))
                held += len(own)
            if held >= HELD:
                yield np.concatenate(keys), np.concatenate(nodes), np.concatenate(spares)
                keys, nodes, spares, held, seen = [], [], [], 0, set()
    if held:
        yield np.concatenate(keys), np.concatenate(nodes), np.concatenate(spares)


def family_edges(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a slice which could link them, enough to connect all that do."""
    buckets = int(48 + text_bytes(docs) // BUCKET_BYTES)
    common = common_slices(docs, n, percent)
    place = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[place], place))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for keys, nodes, spares in held_slices(batches, n, percent):
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            often = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            # the common slices of a set in one class, the most common last; its spare ones go, the others are needed
            k, v, spare, order = keys[often], nodes[often], spares[often], rank[at[often]] if len(known) else at[often]
            own = np.lexsort([-order, k & np.uint64(1), v])
            k, v, spare = k[own], v[own], spare[own]
            new = np.ones(len(k), dtype=bool)
            new[1:] = (v[1:] != v[:-1]) | ((k[1:] ^ k[:-1]) & np.uint64(1) != 0)
            first = np.flatnonzero(new)
            number = np.arange(len(k)) - np.repeat(first, np.diff(np.r_[first, len(k)]))
            hot, hot_node, a, b = stars(k[number >= spare], v[number >= spare])
            # what is left to spare, a row for each set and class
            order = np.lexsort([keys & np.uint64(1), nodes])
            new = np.ones(len(order), dtype=bool)
            new[1:] = (nodes[order][1:] != nodes[order][:-1]) | ((keys[order][1:] ^ keys[order][:-1]) & np.uint64(1) != 0)
            first = np.flatnonzero(new)
            left = spares[order][first] - np.add.reduceat(often[order].astype(np.int64), first)
            of = (nodes[order][first], (keys[order][first] & np.uint64(1)).astype(np.int64), np.maximum(left, 0))
            of = tuple(x[of[2] > 0] for x in of)
            keys, nodes = keys[~often], nodes[~often]
            order, at = by_bucket(keys, buckets)
            hot_order, hot_at = by_bucket(hot, buckets)
            packs = []
            for i in range(buckets):
                o, h = order[at[i] : at[i + 1]], hot_order[hot_at[i] : hot_at[i + 1]]
                part = [x[i::buckets] for x in (a, b, *of)]
                if len(o) or len(h) or any(map(len, part)):
                    packs.append((i, blob(keys[o], nodes[o], hot[h], hot_node[h], *part)))
            yield pa.record_batch([pa.array([p[0] for p in packs], pa.int32()), pa.array([p[1] for p in packs], pa.binary())], names=["bucket", "pack"])

    def meet(key, table):
        keys, nodes, hot, hot_node, a, b, *of = map(np.concatenate, zip(*(unblob(x.as_py()) for x in table.column("pack"))))
        _, _, left, right = stars(hot, hot_node)
        order = np.lexsort([nodes, keys])
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.r_[first, len(keys)])
        times = np.repeat(times, times)
        again = times > 1
        keys, nodes, times = keys[again], nodes[again], times[again]
        # kind 0: a pair of nodes; 1: a slice of a node and how often it stands; 2: the keys a node can spare in a class
        kinds = np.repeat(np.array([0, 0, 1, 2], np.int8), [len(a), len(left), len(keys), len(of[0])])
        none = np.zeros(len(a) + len(left), np.int64)
        columns = {
            "kind": kinds, "node": np.r_[a, left, nodes, of[0]], "part": np.r_[none, (keys & np.uint64(1)).astype(np.int64), of[1]],
            "other": np.r_[b, right, keys.astype(np.int64), np.zeros(len(of[0]), np.int64)], "n": np.r_[none, times, of[2]],
        }
        return pa.table([pa.array(x) for x in columns.values()], names=list(columns))

    schema = "kind tinyint, node bigint, part bigint, other bigint, n bigint"
    met = stored(docs.mapInArrow(lean(cut), "bucket int, pack binary").groupBy("bucket").applyInArrow(meet, schema), "slices")
    # a node's slices that stand again, the most common first, without those it can spare; a node has no more than its text gives
    rows = met.where("kind > 0").withColumn("spare", F.coalesce(F.max(F.when(F.col("kind") == 2, F.col("n"))).over(Window.partitionBy("node", "part")), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("node", "part").orderBy("kind", F.desc("n"), "other"))
    needed = rows.withColumn("place", place).where("kind = 1 and place > spare").select(F.col("other").alias("key"), "node")
    needed = stored(needed, "needed-slices")
    least = needed.groupBy("key").agg(F.min("node").alias("least"))
    pairs = needed.join(least, "key").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return pairs.unionByName(met.where("kind = 0").select(F.col("node").alias("a"), F.col("other").alias("b"))).distinct()


class Groups:
    """Union-find over the nodes of one tile."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One bitmap per set: every element flips the bit of its hash."""
    width = 1 << max(8, int(max(map(len, sets)) * 2 - 1).bit_length())
    bits = np.zeros((len(sets), width), dtype=np.uint8)
    for row, s in zip(bits, sets):
        row[:] = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits, axis=1).view(np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def tile_links(nodes: list[int], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between the sets numbered ``left`` and those numbered ``right`` that span all their links."""
    groups, out = Groups(len(sets)), []
    size = np.array([len(s) for s in sets])
    maps = bitmaps(sets) if len(sets) > 2 else None
    for i in left:
        others = right[right > i] if left is right else right
        big, small = np.maximum(size[i], size[others]), np.minimum(size[i], size[others])
        others = others[100 * small >= percent * big]
        if maps is not None and len(others):
            differ = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
            total = size[i] + size[others]
            others = others[100 * (total - differ) >= percent * (total + differ)]
        for j in others:
            if groups.root(i) == groups.root(j):
                continue
            common = overlap(sets[i], sets[j])
            if 100 * common >= percent * (size[i] + size[j] - common):
                groups.join(i, j)
                out.append((nodes[i], nodes[j]))
    return out


def links(docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of linked nodes that span all links; ``sets`` is the stored table of ``sets_table``."""
    families = components(family_edges(docs, n, percent)).select("node", F.col("component").alias("family"))
    first = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    members = stored(families.join(first, "node"), "families")
    sizes = stored(members.groupBy("family").agg(F.count(F.lit(1)).alias("size")), "family-sizes")
    batches = max(1, members.count() // BATCH_NODES)

    low = F.array(*[F.lit(x) for x in size_classes(percent) if x < 1 << 40])
    band = F.size(F.filter(low, lambda x: x <= F.col("n")))
    known = attach(members, sizes, "family")
    small = known.where(F.col("size") <= BLOCK).withColumn("tile", F.pmod(F.xxhash64("family"), F.lit(batches)))
    small = small.select("family", "tile", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("side"), "node", "doc_id")
    large = known.where(F.col("size") > BLOCK).withColumn("band", band)
    blocks = large.groupBy("family", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = large.join(blocks, ["family", "band"]).withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    # a block meets the blocks of its own band from itself on, and all blocks of the next band
    around = dealt.join(blocks.select("family", F.col("band").alias("next"), F.col("blocks").alias("more")), "family")
    around = around.where(F.abs(F.col("next") - F.col("band")) <= 1).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("more") - 1)))
    same, up = F.col("next") == F.col("band"), F.col("next") > F.col("band")
    number = lambda b, k: (b.cast("bigint") * (1 << 24) + k).alias("x")
    mine, theirs = number(F.col("band"), F.col("own")), number(F.col("next"), F.col("other"))
    side = F.when(same & (F.col("other") == F.col("own")), 0).when(up | (same & (F.col("own") < F.col("other"))), 1).otherwise(2)
    tiled = around.select(
        "family", F.lit(-1).cast("bigint").alias("tile"), F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y"),
        side.alias("side"), "node", "doc_id",
    )
    where = small.select("family", "tile", F.col("x").cast("bigint"), F.col("y").cast("bigint"), "side", "node", "doc_id").unionByName(tiled)

    wanted = bits_of(members.select("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(shared.value, batch.column(0))))
            if batch.num_rows:
                own = list(sets_of(batch.column(1), n))
                node, grams = pa.array([digest(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())
                yield pa.record_batch([batch.column(0), node, grams], names=["doc_id", "node", "grams"])

    def compare(key, table):
        family, node, side = (table.column(c).to_numpy() for c in ("family", "node", "side"))
        grams = table.column("grams")
        order = np.lexsort([node, family])
        found: list[tuple[int, int]] = []
        cut = np.flatnonzero(np.r_[True, family[order][1:] != family[order][:-1]])
        for part in np.split(order, cut[1:]):
            part = part[np.r_[True, node[part][1:] != node[part][:-1]]]  # rows repeated under one id
            own = [np.frombuffer(grams[int(i)].as_py(), dtype=np.uint64) for i in part]
            every = np.arange(len(part))
            left, right = (every, every) if not side[part].any() else (every[side[part] == 1], every[side[part] == 2])
            found += tile_links(node[part].tolist(), own, left, right, percent)
        return pa.table([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    by_tile = where.join(docs.mapInArrow(lean(arrays), "doc_id bigint, node bigint, grams binary"), ["doc_id", "node"])
    # small families share a task; tiles of large ones stand alone
    by_tile = by_tile.withColumn("of", F.when(F.col("tile") < 0, F.col("family")).otherwise(F.lit(0)))
    return by_tile.groupBy("of", "tile", "x", "y").applyInArrow(compare, "a bigint, b bigint")


FILTER_BITS = 25


def filter_places(ids: np.ndarray) -> np.ndarray:
    h = mix(ids.astype(np.int64).astype(np.uint64) + np.uint64(1))
    return np.stack([(h >> np.uint64(s)) & np.uint64((1 << FILTER_BITS) - 1) for s in (0, 19, 39)]).astype(np.int64)


def bits_of(ids: DataFrame) -> np.ndarray:
    """Bloom filter of ids, of a fixed 4 MB: a filter only, so that what it lets through by chance costs time, not results."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = filter_places(batch.column(0).to_numpy()).ravel()
            yield pa.record_batch([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], names=["word", "bit"])

    words_set = ids.mapInArrow(lean(places), "word bigint, bit bigint").groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[words_set.column("word").to_numpy()] = words_set.column("bits").to_numpy()
    return out


def may_hold(bits: np.ndarray, ids: pa.Array) -> np.ndarray:
    at = filter_places(ids.fill_null(0).to_numpy(zero_copy_only=False))
    return (bits[at >> 6] >> (at & 63) & 1).all(axis=0)


def join(docs: DataFrame, n: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id that links reach, itself included."""
    prepare(docs.sparkSession)
    texts = keyed(docs, key, text)
    sets = stored(sets_table(texts, n), "sets")
    roots = stored(components(links(texts.where("doc_id is not null"), sets.where("doc_id is not null"), n, percent)), "roots")
    own = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("smallest"))
    linked = roots.join(own, "node")
    ids = attach(linked.select("node", "component"), linked.groupBy("component").agg(F.min("smallest").alias("component_id")), "component")
    known = own.join(ids.select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "smallest").alias("component_id"))
    full = attach(sets.where("n > 0"), known, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
