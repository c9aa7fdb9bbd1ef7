"""Phrase collocation mining (operator 12) with counting quotient filters.

Phrases of 2 to 5 words are counted by level. A phrase is packed from word ids
(ids of the words that occur often enough; a rarer one ends a phrase), permuted
by an invertible Feistel network and split into a quotient and the full
remainder: a filter stores, for each quotient, its run of remainders and their
counters, in sorted order, and gives back every phrase and count exactly. Each
shard sends its filter in blocks of the leading quotient bits; the sorted blocks
of all shards are merged block by block. The permutation spreads phrases evenly,
and a shard sends a phrase once, so frequent phrases make no large block.

From the third level on, a phrase is counted only if a bitmap of fixed size
(``BITMAP_BITS`` bits, whatever the corpus) holds both phrases that it is made
of. The bitmap has all frequent phrases of the level before and is the only
broadcast; where it errs, a phrase is counted in vain.

Edge cases: null texts are empty; a null language is ``und``, joined with
documents that say ``und``; languages without candidates give no rows; repeated
rows count each time; an empty table gives no rows; texts are read whole. Only
text and lang are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, chunks, column, constants, mix
from .shards import (SHARD_BYTES, local_values, lower_bytes, numbered, numbered_words, one_list, squeezed,
                     unsqueezed, with_local, word_runs)
from .succinct import joined, opened, pack, unpack

LONGEST = 5
LEAST = 100
TOP = 2000
#: Bits of the bitmap that is broadcast (8 MB).
BITMAP_BITS = 1 << 26
#: Phrase occurrences that a block of the filters has at most on average.
BLOCK_PHRASES = 1 << 20
#: Buckets of the first level of the top lists.
TOP_BUCKETS = 16

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_SEPARATOR
_WORD[[0x20, 0x09]] = False


# --------------------------------------------------------------------------
# Packed phrases
# --------------------------------------------------------------------------

class Packing:
    """Phrases of n word ids of ``bits`` bits as permuted keys: one number if 64
    bits hold it, else several, the first one leading."""

    def __init__(self, n: int, bits: int):
        self.n, self.bits = n, max(1, bits)
        parts = max(2, -(-n // (64 // self.bits)))
        self.groups = np.array_split(np.arange(n), parts)
        self.branch = [len(g) * self.bits for g in self.groups]
        self.widths = [sum(self.branch)] if sum(self.branch) <= 64 else self.branch

    def _rounds(self):
        for r, c in enumerate(constants(61, 3 * len(self.groups))):
            yield r % len(self.groups), c

    def _stir(self, parts: list[np.ndarray], target: int, c: np.uint64) -> None:
        other = np.zeros(len(parts[0]), dtype=np.uint64)
        for i, p in enumerate(parts):
            if i != target:
                other = mix(other + p * c)
        parts[target] = parts[target] ^ (other & np.uint64((1 << self.branch[target]) - 1))

    def keys(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        parts = []
        for g in self.groups:
            p = np.zeros(len(ids[0]), dtype=np.uint64)
            for i in g:
                p = (p << np.uint64(self.bits)) | ids[i].astype(np.uint64)
            parts.append(p)
        for target, c in self._rounds():
            self._stir(parts, target, c)
        if len(self.widths) == 1 < len(parts):
            key = parts[0]
            for p, w in zip(parts[1:], self.branch[1:]):
                key = (key << np.uint64(w)) | p
            return [key]
        return parts

    def ids(self, keys: list[np.ndarray]) -> list[np.ndarray]:
        parts = list(keys)
        if len(self.widths) == 1 < len(self.branch):
            key, parts = keys[0], []
            for w in reversed(self.branch):
                parts.insert(0, key & np.uint64((1 << w) - 1))
                key = key >> np.uint64(w) if w < 64 else key
        for target, c in reversed(list(self._rounds())):
            self._stir(parts, target, c)
        out = []
        for g, p in zip(self.groups, parts):
            out += [(p >> np.uint64(self.bits * (len(g) - 1 - k))) & np.uint64((1 << self.bits) - 1) for k in range(len(g))]
        return out


def summed(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in rising order with the sum of their counts (None: one
    each). Sorted stretches of the input are merged, not sorted again."""
    if counts is None and len(keys) == 1:
        ordered = [np.sort(keys[0])]
    else:
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        ordered = [k[order] for k in keys]
        counts = None if counts is None else counts[order]
    n = len(ordered[0])
    fresh = np.ones(n, dtype=bool)
    if n:
        fresh[1:] = np.any([k[1:] != k[:-1] for k in ordered], axis=0)
    first = np.flatnonzero(fresh)
    total = np.diff(np.append(first, n)) if counts is None else \
        np.add.reduceat(counts, first) if n else np.zeros(0, np.int64)
    return [k[first] for k in ordered], total.astype(np.int64)


class QuotientFilter:
    """Sorted distinct keys and their counts, compact and lossless: which
    quotients occur, where each run of remainders ends, the packed remainders,
    one byte a counter and the counters that need more."""

    @staticmethod
    def built(keys: list[np.ndarray], widths: list[int], counts: np.ndarray) -> bytes:
        n = len(counts)
        q = min(widths[0], max(0, n.bit_length() - 1))
        rest = widths[0] - q
        quotient = (keys[0] >> np.uint64(rest)) if rest < 64 else np.zeros(n, np.uint64)
        occupied = np.zeros(1 << q, dtype=bool)
        occupied[quotient.astype(np.int64)] = True
        ends = np.ones(n, dtype=bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        low = keys[0] & np.uint64((1 << rest) - 1)
        large = counts >= 255
        return joined([np.array([n, q], np.int64), np.packbits(occupied, bitorder="little"),
                       np.packbits(ends, bitorder="little"), pack(low, rest),
                       *[pack(k, w) for k, w in zip(keys[1:], widths[1:])],
                       np.where(large, 255, counts).astype(np.uint8), counts[large].astype(np.int64)])

    @staticmethod
    def items(payload, widths: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
        meta, occupied, ends, low, *more = opened(payload)
        n, q = (int(x) for x in meta)
        rest, at = widths[0] - q, np.arange(n)
        quotients = np.flatnonzero(np.unpackbits(occupied, bitorder="little"))
        ends = np.unpackbits(ends, bitorder="little", count=n)
        run = np.cumsum(ends) - ends
        first = unpack(low, rest, at)
        if rest < 64:
            first |= quotients[run].astype(np.uint64) << np.uint64(rest)
        *others, small, large = more
        counts = small.astype(np.int64)
        counts[small == 255] = large
        return [first, *[unpack(k, w, at) for k, w in zip(others, widths[1:])]], counts


# --------------------------------------------------------------------------
# Shards
# --------------------------------------------------------------------------

_SHARD = "lang string, words array<binary>, counts array<long>, codes binary"


def _shard(batches):
    for batch in chunks(batches, max_bytes=SHARD_BYTES):
        langs = pc.fill_null(column(batch, "lang"), "und").dictionary_encode()
        which = langs.indices.to_numpy(zero_copy_only=False)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            raw, offsets = lower_bytes(column(batch, "text").take(pa.array(np.flatnonzero(which == k))))
            mask = _WORD[raw]
            begin, end = word_runs(mask, offsets)
            places, words = numbered_words(raw, mask, begin, end)
            if not len(places):
                continue
            # a piece ends at a separator and at the end of a text
            piece = np.cumsum(_SEPARATOR[raw], dtype=np.int32)[begin] + np.searchsorted(offsets, begin, side="right")
            fresh = np.concatenate(([0], (piece[1:] != piece[:-1]).astype(np.int64)))
            codes = np.full(len(places) + fresh.sum(), -1, dtype=np.int32)
            codes[np.arange(len(places)) + np.cumsum(fresh)] = places
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), one_list(words), one_list(pa.array(np.bincount(places, minlength=len(words)))),
                 pa.array([squeezed(codes)], pa.binary())], names=["lang", "words", "counts", "codes"])


def _global(batches):
    """Shards as global word ids, -1 for what ends a phrase."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes = unsqueezed(column(batch, "codes")[i], np.int32)
            ids = local_values(column(batch, "local"), i, "id", column(batch, "distinct")[i].as_py(), -1)
            ids = np.where(codes >= 0, ids[codes], -1)
            inside = ids >= 0
            beside = np.zeros(len(ids) + 1, dtype=bool)
            beside[1:-1] = inside[1:] & inside[:-1]
            keep = beside[1:] | beside[:-1]  # words of phrases, and one end after each
            keep[1:] |= keep[:-1] & ~inside[1:]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "lang").slice(i, 1), pa.array([squeezed(ids[keep])], pa.binary())], names=["lang", "ids"])


# --------------------------------------------------------------------------
# Levels
# --------------------------------------------------------------------------

def _seed(lang: str) -> np.uint64:
    seed = np.zeros(1, np.uint64)
    for b in lang.encode():
        seed = mix(seed + np.uint64(b + 1))
    return seed[0]


def _places(ids: list[np.ndarray], lang: str) -> np.ndarray:
    """Bits of phrases in the bitmap."""
    h = np.full(len(ids[0]), _seed(lang), dtype=np.uint64)
    for column_, c in zip(ids, constants(67, len(ids))):
        h = h + mix(column_.astype(np.uint64) * c)
    return (mix(h) % np.uint64(BITMAP_BITS)).astype(np.int64)


def _filters(packing: Packing, block_bits: int, known):
    """Filters of a shard's phrases by block; ``known`` is the broadcast bitmap
    of the level before."""
    n = packing.n

    def run(batches):
        bitmap = known.value if known is not None else None
        for batch in batches:
            for i in range(batch.num_rows):
                lang = column(batch, "lang")[i].as_py()
                ids = unsqueezed(column(batch, "ids")[i], np.int64)
                if len(ids) < n:
                    continue
                inside = ids >= 0
                whole = np.lib.stride_tricks.sliding_window_view(inside, n).all(axis=1)
                if bitmap is not None:
                    place = _places([ids[k:len(ids) - n + 2 + k] for k in range(n - 1)], lang)
                    often = (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    whole &= often[:-1] & often[1:]
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                keys, counts = summed(packing.keys([ids[at + k] for k in range(n)]))
                rest = packing.widths[0] - block_bits
                block = (keys[0] >> np.uint64(rest)).astype(np.int64) if block_bits else np.zeros(len(counts), np.int64)
                cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
                widths = [rest, *packing.widths[1:]]
                mask = np.uint64((1 << rest) - 1)
                payloads = [QuotientFilter.built([keys[0][a:b] & mask, *[k[a:b] for k in keys[1:]]], widths, counts[a:b])
                            for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(payloads), pa.string()), pa.array(block[cut[:-1]], pa.int64()),
                     pa.array(payloads, pa.binary())], names=["lang", "block", "filter"])
    return run


_COUNTED = "lang string, ids array<long>, f long, place long"


def _merged(packing: Packing, block_bits: int, least: int):
    """The frequent phrases of a block, from the filters of all shards."""
    rest = packing.widths[0] - block_bits
    widths = [rest, *packing.widths[1:]]

    def run(table: pa.Table) -> pa.Table:
        lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
        parts = [QuotientFilter.items(f.as_buffer(), widths) for f in table.column("filter")]
        keys, counts = summed([np.concatenate([p[0][k] for p in parts]) for k in range(len(widths))],
                              np.concatenate([p[1] for p in parts]))
        often = np.flatnonzero(counts >= least)
        keys = [k[often] for k in keys]
        if block_bits:
            keys[0] = keys[0] | (np.uint64(block) << np.uint64(rest))
        ids = packing.ids(keys)
        flat = np.stack(ids, axis=1).astype(np.int64).ravel() if len(often) else np.zeros(0, np.int64)
        return pa.table({"lang": pa.array([lang] * len(often), pa.string()),
                         "ids": pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, packing.n), pa.int32()), pa.array(flat)),
                         "f": pa.array(counts[often]), "place": pa.array(_places(ids, lang), pa.int64())})
    return run


def _bitmap(level: DataFrame) -> np.ndarray:
    """All phrases of a level as bits; of fixed size whatever their number."""
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    at = F.col("place") + 1
    for r in (level.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toLocalIterator()):
        out[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def phrases(docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of all phrases that occur ``least`` times in a language (lang,
    ids, f; single words too), the words (lang, id, word) and the number of word
    occurrences (lang, n)."""
    spark = scratch.spark
    shards = scratch.table(docs.select("text", "lang").mapInArrow(_shard, _SHARD)
                           .withColumn("shard", F.monotonically_increasing_id()), "shards")
    totals = scratch.table(shards.groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")), "totals")
    often = scratch.table(
        shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
        .groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= least), "often")
    words, bits = numbered(often, scratch, "words", "lang")
    encoded = scratch.table(
        with_local(shards, words.select("lang", "word", "id"), ["id"], "lang")
        .select("lang", "distinct", "codes", "local").mapInArrow(_global, "lang string, ids binary"), "encoded")
    scratch.drop("shards")

    spread = max(0, (int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // BLOCK_PHRASES).bit_length())
    levels = [words.select("lang", F.array("id").alias("ids"), "f")]
    known = None
    for n in range(2, longest + 1):
        packing = Packing(n, bits)
        block_bits = min(spread, packing.widths[0])
        level = scratch.table(
            encoded.mapInArrow(_filters(packing, block_bits, known), "lang string, block long, filter binary")
            .groupBy("lang", "block").applyInArrow(_merged(packing, block_bits, least), _COUNTED), f"level-{n}")
        if known is not None:
            known.unpersist()
            known = None
        if level.isEmpty():
            break
        levels.append(level.drop("place"))
        if n < longest:
            known = spark.sparkContext.broadcast(_bitmap(level))
    scratch.drop("encoded")
    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    return scratch.table(counted, "counted"), words.select("lang", "id", "word"), totals


def _exact_floor(above, below):
    """floor(above / below) of positive whole decimals."""
    return ((above - above % below) / below).cast("long")


def collocations(spark: SparkSession, docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n,
    score."""
    scratch = Scratch(spark, "collocation")
    counted, words, totals = phrases(docs, scratch, longest, least)
    several = counted.where(F.size("ids") > 1)

    # A phrase inside a longer one of the same count is dropped; such a chain
    # goes on word by word, so the phrases one word longer decide.
    inner = (counted.where(F.size("ids") > 2)
             .select("lang", "f", F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"),
                                                    F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"))
             .groupBy("lang", "ids").agg(F.max("f").alias("longer")))
    kept = scratch.table(several.join(inner, ["lang", "ids"], "left")
                         .where("longer IS NULL OR longer < f").select("lang", "ids", F.col("f").alias("a")), "kept")

    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = (cuts.withColumn("first", F.expr("slice(ids, 1, k)"))
            .withColumn("rest", F.expr("slice(ids, k + 1, size(ids) - k)")))
    cuts = cuts.join(counted.select("lang", F.col("ids").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("ids").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    whole = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r", "n")}
    score = _exact_floor(whole["a"] * whole["n"] * F.lit(1000).cast("decimal(4,0)"), whole["l"] * whole["r"])
    scored = scratch.table(
        cuts.select("lang", "ids", F.struct(score.alias("score"), "k", "a", "l", "r", "n").alias("cut"))
        .groupBy("lang", "ids").agg(F.min("cut").alias("cut")).select("lang", "ids", "cut.*"), "scored")

    spelled = (scored.select("lang", "ids", F.posexplode("ids").alias("place", "id")).join(words, ["lang", "id"])
               .groupBy("lang", "ids").agg(F.sort_array(F.collect_list(F.struct("place", F.col("word").cast("string").alias("word"))))
                                           .alias("parts"))
               .select("lang", "ids", F.array_join(F.col("parts.word"), " ").alias("phrase")))
    named = scored.join(spelled, ["lang", "ids"]).drop("ids", "k")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = (named.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(TOP_BUCKETS)))
             .withColumn("place", F.row_number().over(W.partitionBy("lang", "bucket").orderBy(*best)))
             .where(F.col("place") <= top).drop("bucket", "place"))
    return (first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
