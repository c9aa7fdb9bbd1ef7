"""Near-duplicate classes (operator 6): Order MinHash and banded alignment.

Each text is a sequence of five-word shingles, labelled by their occurrence. A
sketch keeps the ``ELL`` smallest of them under one hash function *in the order
of the text*; two texts agree in a sketch when they share these shingles and
their order. Two sketches make a band; texts that share a band are candidates
(a pair of similarity 0.8 shares one of the 16 bands with probability 0.999).

Candidates are verified by a banded alignment of the shingle sequences:
``similarity = aligned / (shingles of a + shingles of b - aligned)``, at least
0.8. The band is as wide as that similarity can need, so it never rejects.

Copies (equal lower-case words) are one text from the start. Within a bucket
pairs are not enumerated; classes are the connected components, so pairs that
are connected already need no test:

1. every member is compared with the bucket's smallest one, and in buckets that
   still hold several components with its most central members, of either half
   of its texts;
2. what lies outside a bucket's largest component is searched by rare shingles.
   In the order of rarity, the first shingle that two similar texts share is
   among the first n - needed + 1 of the n shingles of *either* text (the prefix
   filter of set-similarity joins, exact), so only these prefixes are joined.
   Every text is first compared with one text of each shingle of its prefix, a
   number of pairs in proportion to the prefixes; the exact join then runs on
   the texts whose components still differ.

Edge cases: texts are compared whole; null and empty texts are copies of one
another; texts of up to five words are similar only if equal; rows are known by
their number, so rows with a null doc_id are classed like others (null counts as
larger than any id; a class without ids has class_id null); rows that repeat a
doc_id are classed by their own texts, so classes that share their smallest
doc_id have equal class_ids but sizes and kept rows of their own; of repeated
rows one stays; an empty table gives an empty result. Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.components import star_components
from .common import Scratch, Tokens, chunks, column, constants, mix, spare_name, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Shingles per sketch, sketches per band, bands.
ELL = 2
ROWS = 2
BANDS = 16
#: Links that a task joins into trees, and nodes that it holds for it (about 100 MB).
TASK_NODES = 500_000
#: Parts of a bucket, by hash, whose most central member is compared with the whole bucket.
CENTRAL = 2


# --------------------------------------------------------------------------
# Sketches
# --------------------------------------------------------------------------

def _labelled(t: Tokens, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrence-labelled shingles of all documents that have two or more:
    hashes, the documents, and where each document's shingles begin."""
    n = np.maximum(t.counts() - SHINGLE + 1, 0)
    n[n < 2] = 0
    docs = np.flatnonzero(n)
    count = n[docs]
    begin = np.cumsum(count) - count
    at = np.arange(count.sum()) - np.repeat(begin - t.ptr[docs], count)
    g = window_hashes(h, SHINGLE, 5)[at]
    owner = np.repeat(np.arange(len(docs)), count)
    order = np.lexsort((owner, g))
    gs, os = g[order], owner[order]
    again = np.flatnonzero((gs[1:] == gs[:-1]) & (os[1:] == os[:-1])) + 1
    if len(again):
        # rank of each repeated shingle in its run (the sort keeps text order)
        fresh = np.ones(len(gs), dtype=bool)
        fresh[again] = False
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(gs)), 0))
        rank = (again - run[again]).astype(np.uint64)
        g[order[again]] = mix(gs[again] + rank * constants(31, 1)[0])
    return g, docs, begin


def _smallest(v: np.ndarray, owner: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.minimum.reduceat(v, begin)
    at = np.flatnonzero(v == low[owner])
    if len(at) > len(begin):
        at = at[np.unique(owner[at], return_index=True)[1]]
    return low, at


def band_keys(t: Tokens, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents with sketches, and their (documents, BANDS) keys."""
    g, docs, begin = _labelled(t, h)
    keys = np.zeros((len(docs), BANDS), dtype=np.uint64)
    if not len(docs):
        return docs, keys
    owner = np.repeat(np.arange(len(docs)), np.diff(np.append(begin, len(g))))
    multipliers, masks = constants(41, BANDS * ROWS), constants(43, BANDS * ROWS)
    first, second = constants(47, 2)
    for band in range(BANDS):
        key = np.full(len(docs), constants(53, BANDS)[band], dtype=np.uint64)
        for j in range(band * ROWS, (band + 1) * ROWS):
            v = (g ^ masks[j]) * multipliers[j]
            chosen = []
            for _ in range(ELL):
                low, at = _smallest(v, owner, begin)
                chosen.append((low, at))
                v[at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            (a, at_a), (b, at_b) = chosen
            forward = at_a < at_b
            sketch = np.where(forward, a, b) * first + np.where(forward, b, a) * second
            key = mix(key * first + sketch)
        keys[:, band] = key
    return docs, keys


def _text_key() -> Column:
    """With the doc_id this names a row up to rows that repeat both."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


_SKETCH = "doc_id long, text_key binary, digest binary, shingles int, bands array<long>"


def _sketch(batches):
    for batch in chunks(batches):
        texts = pc.utf8_lower(pc.fill_null(column(batch, "text"), ""))
        t = Tokens(texts)
        docs, keys = band_keys(t, t.hashes())
        bands: list = [None] * t.n_docs
        for d, k in zip(docs.tolist(), keys.view(np.int64).tolist()):
            bands[d] = k
        digests = [hashlib.blake2b(b" ".join(x.as_buffer().to_pybytes().split()), digest_size=16).digest() for x in texts]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id").cast(pa.int64()), column(batch, "text_key"), pa.array(digests, pa.binary()),
             pa.array(np.maximum(t.counts() - SHINGLE + 1, 0), pa.int32()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "text_key", "digest", "shingles", "bands"])


# --------------------------------------------------------------------------
# Alignment
# --------------------------------------------------------------------------

def shingle_sequence(text: str) -> list[str]:
    words = text.lower().encode().split()
    words = [w.decode() for w in words]
    if len(words) < SHINGLE:
        return [" ".join(words)] if words else []
    return [" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def aligned(a: list, b: list, band: int) -> int:
    """Length of the longest common subsequence of ``a`` and ``b`` whose pairs
    lie within ``band`` places of the diagonal (bit-parallel; bits that leave
    the band are counted and dropped)."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not a or not b:
        return start + end
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    width = 2 * band + 1
    full = (1 << width) - 1
    low = -band          # place in b of the lowest bit held
    state = full         # 0 bits are matched places
    matched = 0
    for i, x in enumerate(a):
        hits = 0
        for j in places.get(x, ()):
            if 0 <= j - low < width:
                hits |= 1 << (j - low)
        if hits:
            both = state & hits
            state = ((state + both) | (state - both)) & full
        if not state & 1:
            matched += 1
        state = (state >> 1) | (1 << (width - 1))
        low += 1
    return start + end + matched + width - state.bit_count()


def similarity(a: list, b: list, threshold: float = SIMILARITY) -> float:
    """Share of aligned shingles; 0 if the lengths rule the threshold out."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if min(n, m) < threshold * max(n, m):
        return 0.0
    # a similarity of s leaves at most (1 - s) / (1 + s) * (n + m) unaligned
    # shingles, and the diagonal moves by no more than these
    band = int((1 - threshold) / (1 + threshold) * (n + m)) + 1
    got = aligned(a, b, band)
    return got / (n + m - got)


_VERIFIED = "a long, b long, similarity double"


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            sides = [column(batch, c) for c in ("a", "b", "text_a", "text_b")]
            last, seq = None, []
            out = []
            for i in range(batch.num_rows):
                a, b = sides[0][i].as_py(), sides[1][i].as_py()
                if a != last:
                    last, seq = a, shingle_sequence(sides[2][i].as_py() or "")
                sim = similarity(seq, shingle_sequence(sides[3][i].as_py() or ""), threshold)
                if sim >= threshold:
                    out.append((a, b, sim))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))],
                    names=["a", "b", "similarity"])
    return run


def _shingle_hashes(batches):
    """(doc_id, hash, n) of the distinct shingles of each text."""
    for batch in chunks(batches):
        t = Tokens(pc.utf8_lower(pc.fill_null(column(batch, "text"), "")))
        n = np.maximum(t.counts() - SHINGLE + 1, 0)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - t.ptr[:-1], n)
        if not len(at):
            continue
        g = window_hashes(t.hashes(), SHINGLE, 5)[at]
        owner = np.repeat(np.arange(t.n_docs), n)
        order = np.lexsort((g, owner))
        g, owner = g[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (owner[1:] != owner[:-1]))))
        count = np.diff(np.append(first, len(g)))
        ids = column(batch, "doc_id").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[owner[first]], pa.int64()), pa.array(g[first].view(np.int64)), pa.array(count, pa.int32())],
            names=["rep", "hash", "n"])


# --------------------------------------------------------------------------
# Classes
# --------------------------------------------------------------------------

def _forests(nodes: int):
    """Links of a task as trees of depth one over the same nodes: fewer links,
    equal components. The trees are given out when they hold ``nodes`` nodes."""
    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        def trees():
            links = [(x, root(x)) for x in parent if root(x) != x]
            parent.clear()
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

        for batch in batches:
            for a, b in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist()):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
            if len(parent) > nodes:
                yield from trees()
        yield from trees()
    return run


def components(links: DataFrame, scratch: Scratch, task_nodes: int = TASK_NODES, name: str = "cc") -> DataFrame:
    """(rep, component) of every linked text; the component is its smallest
    text. Each task turns about ``task_nodes`` links into trees, distributed
    rounds join these. The number of tasks grows with that of the links: links
    spread over many small files would give a tree for each file, and rounds
    that do nothing but join them."""
    tasks = math.ceil(links.count() / max(1, task_nodes))
    trees = links.select("a", "b").coalesce(max(1, tasks)).mapInArrow(_forests(task_nodes), "a long, b long")
    return star_components(trees, scratch, "a", "b", name=name).withColumnRenamed("node", "rep")


class _Search:
    """Links between representatives (documents that stand for their copies)."""

    def __init__(self, scratch: Scratch, texts: DataFrame, threshold: float):
        self.scratch, self.texts, self.threshold = scratch, texts, threshold
        self.new = self.roots = None
        self.tested: list[DataFrame] = []

    def compare(self, pairs: DataFrame) -> None:
        """Verify the (a, b) pairs that were not tested before."""
        scratch, k = self.scratch, len(self.tested)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(False).alias("old"))
        for before in self.tested:
            pairs = pairs.unionByName(before.withColumn("old", F.lit(True)))
        pairs = scratch.table(pairs.groupBy("a", "b").agg(F.max("old").alias("old")).where("NOT old").select("a", "b"),
                              f"pairs-{k}")
        texts = self.texts
        left = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
        both = left.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
        found = scratch.table(both.select("a", "b", "text_a", "text_b")
                              .mapInArrow(_verify(self.threshold), _VERIFIED), f"links-{k}")
        self.new = None if found.isEmpty() else found.select("a", "b")
        self.tested.append(pairs)

    def labelled(self, members: DataFrame) -> DataFrame:
        """members with the component of each (its own id if it has no link)."""
        if self.new is not None:
            links = self.new
            if self.roots is not None:  # the components so far are links to their smallest texts
                links = links.unionByName(self.roots.select(F.col("rep").alias("a"), F.col("component").alias("b")))
            self.roots = components(links, self.scratch, name=f"roots-{len(self.tested)}")
            self.new = None
        if self.roots is None:
            return members.withColumn("component", F.col("rep"))
        joined = members.join(self.roots, "rep", "left")
        return joined.withColumn("component", F.coalesce("component", "rep"))


def _open(scratch: Scratch, members: DataFrame, name: str) -> DataFrame:
    """Members of the buckets that hold several components. These buckets are
    found by an aggregate that is written, so that the join with the members
    has a plain file on either side and AQE may split a large bucket."""
    members = scratch.table(members, f"{name}-members")
    several = scratch.table(members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                            .where("low < high").select("key"), f"{name}-keys")
    found = scratch.table(members.join(several, "key"), name)
    scratch.drop(f"{name}-members", f"{name}-keys")
    return found


def _links(scratch: Scratch, members: DataFrame, texts: DataFrame, threshold: float) -> _Search:
    """All links that the classes need; members is (key, rep, pivot, shingles,
    least_shingles), texts (rep, text)."""
    search = _Search(scratch, texts, threshold)
    search.compare(members.where("rep <> pivot AND shingles >= least_shingles")
                   .select(F.col("pivot").alias("a"), F.col("rep").alias("b")))
    rest = _open(scratch, search.labelled(members.select("key", "rep", "shingles")), "open-1")
    if rest.isEmpty():
        return search

    # Shingle frequencies among the open texts: the most central member of a
    # bucket is the one with the fewest shingles of its own.
    texts = scratch.table(texts.join(rest.select("rep"), "rep", "left_semi"), "open-texts")
    search.texts = texts
    counted = scratch.table(texts.withColumnRenamed("rep", "doc_id")
                            .mapInArrow(_shingle_hashes, "rep long, hash long, n int"), "shingles")
    often = scratch.table(counted.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")), "often")
    weighed = scratch.table(counted.join(often, "hash"), "weighed")
    scratch.drop("shingles", "often")
    own = weighed.groupBy("rep").agg(F.coalesce(F.sum(F.when(F.col("texts") == 1, F.col("n"))), F.lit(0)).alias("own"))
    left = scratch.table(rest.join(own, "rep"), "weighed-members")
    rank = F.struct(-F.col("own") / F.col("shingles"), -F.col("rep"))
    central = scratch.table(left.groupBy("key", F.pmod(F.xxhash64("rep"), F.lit(CENTRAL)).alias("part"))
                            .agg(F.max_by(F.struct("rep", "component", "shingles"), rank).alias("p"))
                            .select("key", "p.*"), "central")
    pairs = (central.join(left.select("key", F.col("rep").alias("b"), F.col("component").alias("cb"),
                                      F.col("shingles").alias("nb")), "key")
             .where((F.col("cb") != F.col("component"))
                    & (F.least("nb", "shingles") >= threshold * F.greatest("nb", "shingles"))))
    search.compare(pairs.select(F.col("rep").alias("a"), "b"))
    left = _open(scratch, search.labelled(left.select("key", "rep", "shingles")), "open-2")
    scratch.drop("weighed-members", "central", "open-1")
    if left.isEmpty():
        return search

    # Prefixes: the first shingle, by rarity, that two texts of n and m shingles
    # share has at least needed = share * (n + m) shared ones from it on in both
    # texts, so fewer than n - needed + 1 shingles of either come before it.
    share = threshold / (1 + threshold)
    rarer = W.partitionBy("rep").orderBy("texts", "hash").rowsBetween(W.unboundedPreceding, -1)
    reps = scratch.table(left.groupBy("rep").agg(F.first("shingles").alias("shingles"),
                                                 F.first("component").alias("component")), "open-reps")
    # the smallest partner of n shingles has threshold * n: needed is threshold * n
    prefixes = scratch.table(
        weighed.join(reps, "rep").withColumn("before", F.coalesce(F.sum("n").over(rarer), F.lit(0)))
        .where((F.col("before") <= F.col("shingles") - F.ceil(threshold * F.col("shingles") - 1e-6))
               & (F.col("texts") > 1)).select("hash", "rep", "shingles", "before", "component"), "prefixes")
    scratch.drop("weighed", "open-reps")

    # One text of each shingle first: pairs in proportion to the prefixes.
    heads = scratch.table(prefixes.groupBy("hash").agg(F.max_by(F.struct("rep", "shingles", "component"),
                                                                F.struct("shingles", "rep")).alias("p"))
                          .select("hash", F.col("p.rep").alias("a"), F.col("p.shingles").alias("na"),
                                  F.col("p.component").alias("ca")), "heads")
    search.compare(prefixes.join(heads, "hash")
                   .where((F.col("ca") != F.col("component")) & (F.col("shingles") >= threshold * F.col("na")))
                   .select("a", F.col("rep").alias("b")))
    left = _open(scratch, search.labelled(left.select("key", "rep", "shingles")), "open-3")
    scratch.drop("heads", "open-2")
    if left.isEmpty():
        return search

    # What the largest component of a bucket does not hold, against all prefixes
    # of open buckets; a pair of two such texts is found from either, one is enough.
    biggest = scratch.table(left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
                            .groupBy("key").agg(F.max(F.struct("n", "component")).alias("top")), "biggest")
    labels = scratch.table(left.join(biggest, "key").groupBy("rep").agg(
        F.first("component").alias("component"),
        F.max(F.col("component") != F.col("top.component")).alias("outside")), "labels")
    held = scratch.table(prefixes.drop("component").join(labels, "rep"), "held")
    probes = held.where("outside").select("hash", F.col("rep").alias("a"), F.col("component").alias("ca"),
                                          F.col("shingles").alias("na"), F.col("before").alias("before_a"))
    needed = F.ceil(share * (F.col("na") + F.col("shingles")) - 1e-6)
    pairs = held.join(probes, "hash").where(
        (F.col("ca") != F.col("component"))
        & (F.least("na", "shingles") >= threshold * F.greatest("na", "shingles"))
        & (~F.col("outside") | (F.col("a") < F.col("rep")))
        & (F.col("before_a") <= F.col("na") - needed)
        & (F.col("before") <= F.col("shingles") - needed)).select("a", F.col("rep").alias("b"))
    search.compare(pairs)
    search.labelled(left.select("key", "rep"))
    return search


def _classed(scratch: Scratch, docs: DataFrame, threshold: float) -> DataFrame:
    """The columns of ``classes`` and the text_key of each row, read from two
    tables of ``scratch``. A row is known by its number in the written sketch
    table, for doc_ids may repeat."""
    searched = Scratch(scratch.spark, "near-dedup-search")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))
    made = scratch.table(docs.mapInArrow(_sketch, _SKETCH).withColumn("row", F.monotonically_increasing_id()), "sketches")
    copies = scratch.table(made.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc_id").alias("rep_id")), "copies")
    reps = made.join(copies, made.row == copies.rep, "left_semi")
    keyed = scratch.table(reps.where("bands IS NOT NULL")
                          .select(F.col("row").alias("rep"), "shingles", F.explode("bands").alias("key")), "keyed")
    buckets = scratch.table(keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"),
                                                     F.min(F.struct("rep", "shingles")).alias("first"))
                            .where("pivot < top")
                            .select("key", "pivot", (F.col("first.shingles") * threshold).alias("least_shingles")),
                            "buckets")
    members = searched.table(keyed.join(buckets, "key"), "members")
    scratch.drop("keyed", "buckets")
    roots = None
    if not members.isEmpty():
        ids = (made.select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key"), F.col("row").alias("rep"))
               .join(members.select("rep").distinct(), "rep", "left_semi"))
        texts = searched.table(docs.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of_doc"))
                                        & (F.col("text_key") == F.col("of_key")))
                              .select("rep", "text").dropDuplicates(["rep"]), "texts")
        roots = _links(searched, members, texts, threshold).roots
    of_rep = copies
    if roots is not None:
        of_rep = copies.join(roots, "rep", "left")
    else:
        of_rep = copies.withColumn("component", F.lit(None).cast("long"))
    of_rep = scratch.table(of_rep.select("digest", "rep_id", F.coalesce("component", "rep").alias("component")), "classes")
    searched.clear()
    classed = scratch.table(made.select("doc_id", "text_key", "row", "digest").join(of_rep, "digest").drop("digest"),
                            "classed")
    scratch.drop("sketches", "copies", "classes")
    sizes = scratch.table(classed.groupBy("component").agg(
        F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "row")).alias("first")), "sizes")
    return (classed.join(sizes, "component")
           .select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
                   (F.col("row") == F.col("first.row")).alias("kept"), "rep_id", "text_key"))


def classes(spark: SparkSession, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the class),
    class_size, kept (the row that stays for its class), rep_id (smallest
    doc_id with the same words)."""
    return _classed(Scratch(spark, "near-dedup"), docs, threshold).drop("text_key")


def drop_near_copies(spark: SparkSession, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stay for their class. A decision
    names (doc_id, text_key); of rows that repeat both, one stays."""
    scratch, classed = Scratch(spark, "near-dedup-keep"), Scratch(spark, "near-dedup")
    doc, key = spare_name(docs, "_gone"), spare_name(docs, "_gone_key")
    listed = scratch.table(
        _classed(classed, docs, threshold)
        .groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).where("NOT kept OR rows > 1"), "listed")
    classed.clear()
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (_text_key() == F.col(key))
    rest = docs.join(listed.select(doc, key).hint("merge"), same, "left_anti")
    several = listed.where("kept").select(doc, key)
    if several.isEmpty():
        return rest
    repeated = (docs.join(several.hint("merge"), same, "left_semi").withColumn(key, _text_key())
                .dropDuplicates(["doc_id", key]).drop(key))
    return rest.unionByName(repeated)
