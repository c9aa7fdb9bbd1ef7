"""Benchmark decontamination (operator 8): SimHash windows of item size.

Every window of a document that has as many words as a benchmark item gets a
512-bit SimHash of its five-word shingles, each labelled by its occurrence in
the window, so a repeated word or phrase weighs as much as it does in the
similarity. A multi-index over thirty-two 16-bit blocks, expanded to all block
values within distance 2, returns every item fingerprint within Hamming distance
95 (95 differing bits cannot put 3 into each of 32 blocks). Candidates are
verified by the exact weighted similarity of five-word shingles: sum of minima
over sum of maxima of the shingles' counts.

The radius follows from 0.8: sets of labelled shingles of that similarity have a
cosine of 8/9 or more, so a bit differs with probability 0.1515 at most: 77.6
bits expected, standard deviation 8.1. About 1.4 % of pairs of similarity exactly
0.8 are farther than 95 and lost, far fewer above.

Windows that cannot reach the similarity are not fingerprinted: sequences of n
and m shingles that are similar by s share s / (1 + s) * (n + m) of them, so a
window has at least so many places whose shingle some item holds. This bound
loses nothing.

Words are compared in lower case without ASCII punctuation. The benchmark is
the stated query set: it is read in blocks of bounded size, each held by the
tasks of one pass over all documents, so nothing of the corpus is collected and
documents are not shuffled.

Edge cases: null and empty texts and items have no windows; an item under five
words is one shingle; a document shorter than an item is compared whole; an
empty table gives an empty result; documents or items that repeat are each
compared; rows with a null doc_id are reported with a null id; rows that hold an item are
dropped one by one, never by their id. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, Tokens, chunks, column, constants, mix, normalised, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
BITS = 512
BLOCKS = BITS // 16
BLOCK_RADIUS = 2
RADIUS = (BLOCK_RADIUS + 1) * BLOCKS - 1
#: Items and item bytes that one pass over the documents holds.
PASS_ITEMS = 1000
PASS_BYTES = 16 << 20
#: Windows and words that are fingerprinted at a time.
BLOCK_WINDOWS = 1 << 16
BLOCK_WORDS = 1 << 15


def shingles(h: np.ndarray) -> np.ndarray:
    """Shingle hashes of a word sequence (one shingle if it is short)."""
    return window_hashes(h, min(SHINGLE, len(h)), 5) if len(h) else h


def similarity(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - shared
    return shared / union if union else 0.0


def least_shared(n, m, threshold: float):
    """Shingles that similar sequences of n and m shingles share at least."""
    return np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)


def _places(g: np.ndarray) -> np.ndarray:
    """A bit-table place of each shingle."""
    return (g >> np.uint64(42)).astype(np.int64)


# --------------------------------------------------------------------------
# SimHash
# --------------------------------------------------------------------------

def _signs(h: np.ndarray) -> np.ndarray:
    """+1/-1 per shingle and bit."""
    lanes = np.stack([mix(h ^ c) for c in constants(21, BITS // 64)], axis=1)
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(h), BITS // 8), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1, bitorder="little").view(np.uint16)


def _labelled_print(g: np.ndarray) -> np.ndarray:
    """SimHash of a window's shingles labelled by their occurrence."""
    g = np.sort(g)
    at = np.arange(len(g))
    fresh = np.concatenate(([True], g[1:] != g[:-1]))
    rank = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    labelled = np.where(rank > 0, mix(g + rank * constants(33, 1)[0]), g)
    return _packed(_signs(labelled).sum(axis=0, dtype=np.int32))


def _first_repeat(g: np.ndarray) -> np.ndarray:
    """For each place the first place whose shingle occurs before it, from that place on."""
    order = np.argsort(g, kind="stable")
    same = g[order][1:] == g[order][:-1]
    again = np.full(len(g) + 1, len(g))
    again[order[:-1][same]] = order[1:][same]
    return np.minimum.accumulate(again[::-1])[::-1]


def fingerprints(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of the words [start, end) for each window, as (n, BLOCKS) uint16."""
    out = np.zeros((len(starts), BLOCKS), dtype=np.uint16)
    for width in range(1, SHINGLE):  # shorter windows are one shingle
        short = np.flatnonzero(ends - starts == width)
        if len(short):
            out[short] = _packed(_signs(window_hashes(h, width, 5)[starts[short]]))
    held = np.flatnonzero(ends - starts >= SHINGLE)
    if not len(held):
        return out
    g = window_hashes(h, SHINGLE, 5)
    s, e = starts[held], ends[held] - SHINGLE + 1
    repeats = _first_repeat(g)[s] < e
    sums = np.zeros((len(g) + 1, BITS), dtype=np.int32)
    np.cumsum(_signs(g), axis=0, dtype=np.int32, out=sums[1:])
    plain = np.flatnonzero(~repeats)
    for a in range(0, len(plain), 1 << 13):
        part = plain[a:a + (1 << 13)]
        out[held[part]] = _packed(sums[e[part]] - sums[s[part]])
    # windows with a repeated shingle: each multiset of shingles once
    labelled = np.flatnonzero(repeats)
    if len(labelled):
        bag = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(g ^ constants(35, 1)[0]), dtype=np.uint64)))
        _, first, which = np.unique(bag[e[labelled]] - bag[s[labelled]], return_index=True, return_inverse=True)
        prints = np.stack([_labelled_print(g[s[w]:e[w]]) for w in labelled[first]])
        out[held[labelled]] = prints[which]
    return out


def _neighbours() -> np.ndarray:
    """All 16-bit masks with at most BLOCK_RADIUS bits."""
    masks = [sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in combinations(range(16), r)]
    return np.array(masks, dtype=np.int64)


class ItemIndex:
    """Fingerprints of one block of benchmark items with their multi-index."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = SIMILARITY):
        t = Tokens(normalised(pa.array([x[1] for x in items], pa.string())))
        h, n = t.hashes(), t.counts()
        held = np.flatnonzero(n > 0)
        self.threshold = threshold
        self.ids = [items[i][0] for i in held]
        self.length = n[held]
        self.bags = [Counter(shingles(h[t.ptr[i]:t.ptr[i + 1]]).tolist()) for i in held]
        self.prints = np.concatenate([np.zeros((0, BLOCKS), np.uint16)] + [
            fingerprints(h[t.ptr[i]:t.ptr[i + 1]], np.array([0]), n[i:i + 1]) for i in held])
        self.lengths = np.unique(self.length)
        # known shingles as a bit table: false positives only cost time
        self.known = np.zeros(1 << 22, dtype=bool)
        for i in held:
            self.known[_places(shingles(h[t.ptr[i]:t.ptr[i + 1]]))] = True
        values = self.prints.astype(np.int64)[:, :, None] ^ _neighbours()
        rank = np.searchsorted(self.lengths, self.length)
        keys = self._key(rank[:, None, None], np.arange(BLOCKS)[None, :, None], values)
        owner = np.broadcast_to(np.arange(len(held))[:, None, None], keys.shape)
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner = keys.ravel()[order], owner.ravel()[order].astype(np.int32)

    @staticmethod
    def _key(rank, block, value):
        return (rank * BLOCKS + block) * 65536 + value

    def candidates(self, rank: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS of each other."""
        windows, items = [], []
        for block in range(BLOCKS):
            keys = self._key(rank, block, prints[:, block].astype(np.int64))
            lo = np.searchsorted(self.keys, keys, side="left")
            n = np.searchsorted(self.keys, keys, side="right") - lo
            hit = np.flatnonzero(n)
            n = n[hit]
            windows.append(np.repeat(hit, n))
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            items.append(self.owner[np.repeat(lo[hit], n) + step])
        pairs = np.unique(np.concatenate(windows) * len(self.ids) + np.concatenate(items))
        window, item = pairs // max(1, len(self.ids)), pairs % max(1, len(self.ids))
        far = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        near = far <= RADIUS
        return window[near], item[near]


def _possible(t: Tokens, h: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (start, end, rank of the length) that can reach the similarity."""
    # known shingles that begin before each word
    total = np.zeros(t.n_words + 1, dtype=np.int32)
    g = window_hashes(h, SHINGLE, 5)
    np.cumsum(index.known[_places(g)], out=total[1:len(g) + 1])
    total[len(g) + 1:] = total[len(g)]
    size = t.counts()
    last = np.repeat(t.ptr[1:], size)
    starts, ends, ranks = [], [], []
    for rank, length in enumerate(index.lengths.tolist()):
        if length < SHINGLE:  # one shingle of this width
            at = np.flatnonzero(index.known[_places(window_hashes(h, length, 5))])
        else:
            n = length - SHINGLE + 1
            at = np.flatnonzero(total[n:] - total[:-n] >= least_shared(n, n, index.threshold))
        at = at[at + length <= t.n_words]
        at = at[at + length <= last[at]]
        starts.append(at)
        ends.append(at + length)
        ranks.append(np.full(len(at), rank))
        # whole documents that are shorter; shingles of unlike widths are never equal
        short = np.flatnonzero((size < length) & (size >= SHINGLE))
        own = size[short] - SHINGLE + 1
        shared = total[t.ptr[short] + own] - total[t.ptr[short]]
        short = short[shared >= least_shared(own, length - SHINGLE + 1, index.threshold)]
        starts.append(t.ptr[short])
        ends.append(t.ptr[short + 1])
        ranks.append(np.full(len(short), rank))
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(ranks)


def matches(texts: pa.Array, index: ItemIndex) -> list[tuple[int, int, float, int, int]]:
    """(document, item, similarity, start, end) of the best window of each
    document and item that are similar enough."""
    t = Tokens(normalised(texts))
    h = t.hashes()
    starts, ends, ranks = _possible(t, h, index)
    if not len(starts):
        return []
    # hash only the words that some possible window covers
    step = np.zeros(t.n_words + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    used = np.cumsum(step[:-1]) > 0
    place = np.concatenate(([0], np.cumsum(used)))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    order = np.argsort(starts, kind="stable")
    starts, ends, ranks = starts[order], ends[order], ranks[order]
    words = h[used]
    a = 0
    while a < len(starts):
        # by windows and by words, so sparse windows take no more memory than dense ones
        to = int(np.searchsorted(place[starts], place[starts[a]] + BLOCK_WORDS, side="right"))
        block = slice(a, min(to, a + BLOCK_WINDOWS))
        a = block.stop
        s, e, r = starts[block], ends[block], ranks[block]
        lo, hi = place[s[0]], place[e.max()]
        prints = fingerprints(words[lo:hi], place[s] - lo, place[e] - lo)
        for w, item in zip(*index.candidates(r, prints)):
            begin, end = int(s[w]), int(e[w])
            got = similarity(Counter(shingles(h[begin:end]).tolist()), index.bags[item])
            if got >= index.threshold:
                doc = int(np.searchsorted(t.ptr, begin, side="right") - 1)
                found = (got, -begin, -end)
                if found > best.get((doc, int(item)), (0.0, 0, 0)):
                    best[doc, int(item)] = found
    return [(doc, index.ids[item], sim, -b - int(t.ptr[doc]), -e - int(t.ptr[doc]))
            for (doc, item), (sim, b, e) in sorted(best.items())]


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

_RESULT = "doc_id long, item_id long, similarity double, word_start long, word_end long"


def _scan(index: ItemIndex):
    def run(batches):
        for b in chunks(batches, max_bytes=2 << 20):
            found = matches(column(b, "text"), index)
            if found:
                ids = column(b, "doc_id").to_pylist()
                cols = list(zip(*((ids[f[0]], *f[1:]) for f in found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "similarity", "word_start", "word_end"])
    return run


def _keep(index: ItemIndex):
    def run(batches):
        for b in chunks(batches, max_bytes=2 << 20):
            keep = np.ones(b.num_rows, dtype=bool)
            keep[[f[0] for f in matches(column(b, "text"), index)]] = False
            yield b.filter(pa.array(keep, pa.bool_()))
    return run


def _indexes(benchmark: DataFrame, threshold: float) -> Iterator[ItemIndex]:
    """The benchmark's items, a block of bounded size for each pass."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, -(-n // PASS_ITEMS), -(-int(size) // PASS_BYTES))
    for k in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        index = ItemIndex([(r.item_id, r.text) for r in block.collect()], threshold)
        if index.ids:
            yield index


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                 threshold: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id,
    similarity and place (in words that are more than punctuation) of the best
    window."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = None
    for index in _indexes(benchmark, threshold):
        found = docs.mapInArrow(_scan(index), _RESULT)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], _RESULT) if result is None else result


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item. Each row
    is decided by its own text, so neither null ids nor repeated ones matter."""
    scratch, last = Scratch(spark, "decontam"), None
    for k, index in enumerate(_indexes(benchmark, SIMILARITY)):
        if k:  # a task holds the index of one pass at a time
            docs = scratch.table(docs, f"pass-{k}")
            if last:
                scratch.drop(last)
            last = f"pass-{k}"
        docs = docs.mapInArrow(_keep(index), docs.schema)
    return docs
