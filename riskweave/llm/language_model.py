"""Language-model scoring (operator 11): a trigram model in Elias-Fano tries.

Probabilities are interpolated with Dirichlet weights: a context seen ``c``
times gives ``(count + kappa * lower) / (c + kappa)``, the lowest level being
``(count + 0.1) / (tokens + 0.1 * (words + 1))``. Words seen at most once in
training share one class above that level; its probability is divided among
them as the lowest level has it. Every text begins after two pads and ends with
an end token, so the probabilities of all continuations sum to one.

1. Texts become shards of local word numbers (``shards.py``), in buckets by
   shard. Counts and ids of words come back to each shard's list of words, by
   one shuffle of these lists; frequent words get small ids.
2. Each shard sends its distinct bigrams and trigrams, with their training
   counts, to the part of the model that their middle context word names. A word
   with more than ``PART_TOKENS`` tokens is spread over several parts: trigrams by
   the word before, bigrams by the word after.
3. A part sums the counts and builds its trie: context words, their successors
   with quantised bigram weights, the words before them with quantised backoff
   weights, and for each such pair the successors that follow it, written as
   places among the successors of the shorter context. All levels and pointers
   are Elias-Fano sequences in one memory-mapped file; n-grams are looked up by
   successor search. The answers go back as 16-bit codes.
4. Each shard adds up the logarithms of its texts.

No task holds more than some shards or one part of the model; the driver gets
four numbers. Weights are quantised in steps of 1/2047 of a factor of two.

Edge cases: null and empty texts are one end token; without training rows every
token has probability one; rows that repeat a doc_id are scored one by one;
rows with a null doc_id too (the empty id's fold); an empty table gives an empty
result; texts are read whole, as long as they are. Only doc_id and text are read.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _IS_SPACE, Scratch, chunks, column, constants, fold, mix
from .shards import lower_bytes, numbered_words, one_list, squeezed, unsqueezed, word_runs
from .succinct import EliasFano, Lists, joined, opened

PAD, END, RARE, FIRST = 0, 1, 2, 3
#: Weights of the lower level in a bigram's and a trigram's context.
KAPPA = (20.0, 4.0)
#: Text bytes of a shard (one text at least).
SHARD_BYTES = 16 << 20
#: Text bytes of a shard that are split into words at a time.
PIECE_BYTES = 2 << 20
#: Tokens of a part of the model (about 100 MB while it is built).
PART_TOKENS = 500_000
#: Tokens or n-grams of a shard whose numbers are worked on at a time.
BLOCK = 1 << 18
#: Word rows that a task holds before it sends them to their shards.
TOLD_ROWS = 1 << 20
_STEPS, _RANGE = 2047, 32


def quantised(weights: np.ndarray) -> np.ndarray:
    """16-bit codes of weights from 2^-32 to 1 by their logarithm; 0 is nothing."""
    with np.errstate(divide="ignore"):
        code = np.rint((np.log2(weights) + _RANGE) * _STEPS)
    return np.where(weights > 0, np.clip(code, 1, 65535), 0).astype(np.uint16)


def weights(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, np.exp2(codes / _STEPS - _RANGE), 0.0)


# --------------------------------------------------------------------------
# Trie
# --------------------------------------------------------------------------

def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the combination of some sorted columns changes."""
    n = len(columns[0])
    fresh = np.ones(n, dtype=bool)
    if n:
        fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(fresh)


class Trie:
    """Levels of one part of the model, as views of a buffer."""

    def __init__(self, buffer):
        arrays = opened(buffer)
        at = EliasFano.FIELDS
        self.words = EliasFano(arrays[:at])
        self.after, self.before, self.pairs = (Lists(arrays[i:i + Lists.FIELDS])
                                               for i in range(at, at + 3 * Lists.FIELDS, Lists.FIELDS))
        self.after_code, self.before_code, self.pair_code = arrays[at + 3 * Lists.FIELDS:]

    @staticmethod
    def built(bigrams: list[np.ndarray], trigrams: list[np.ndarray], kappa=KAPPA) -> bytes:
        """From sorted (v, w, count, count of v) and (v, u, w, count): successors
        w of v, predecessors u of v, and the successors of each pair."""
        v2, w2, n2, of_v = bigrams
        v3, u3, w3, n3 = trigrams
        # successors of v: those of its bigrams here and those of its trigrams
        bits = np.uint64(max(1, int(max(w2.max(initial=0), w3.max(initial=0))).bit_length()))
        two, three = (v2.astype(np.uint64) << bits) | w2.astype(np.uint64), (v3.astype(np.uint64) << bits) | w3.astype(np.uint64)
        both = np.sort(np.concatenate((two, three)))
        both = both[_starts(both)]
        v, w = (both >> bits).astype(np.int64), (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        code = np.zeros(len(both), np.uint16)
        code[np.searchsorted(both, two)] = quantised(n2 / (of_v + kappa[0]))
        begin = _starts(v)
        words = v[begin]
        after = np.append(begin, len(v))
        # predecessors of v, in the order of the trigrams
        first = _starts(v3, u3)
        context = np.add.reduceat(n3, first) if len(n3) else np.zeros(0, np.int64)
        before = np.searchsorted(v3[first], words)
        before = np.append(before, len(first))
        pairs = np.append(first, len(v3))
        # places of w among the successors of v
        node = np.repeat(np.arange(len(words)), np.diff(np.searchsorted(v3, np.append(words, v3[-1:] + 1)))) if len(v3) else v3
        place = np.searchsorted(both, three) - after[node]
        held = np.repeat(context, np.diff(pairs))
        return joined([*EliasFano.built(words), *Lists.built(after, w), *Lists.built(before, u3[first]),
                       *Lists.built(pairs, place), code, quantised(kappa[1] / (context + kappa[1])),
                       quantised(n3 / (held + kappa[1]))])

    def _node(self, v: np.ndarray) -> np.ndarray:
        if not self.words.n:
            return np.full(len(v), -1)
        first = _starts(v)  # questions come in runs of one context word
        asked = v[first].astype(np.uint64)
        at = self.words.successor(asked)
        there = self.words.get(np.minimum(at, self.words.n - 1)) == asked
        return np.repeat(np.where(there & (at < self.words.n), at, -1), np.diff(np.append(first, len(v))))

    def bigrams(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Codes of the weights of w after v."""
        at, there = self.after.find(self._node(v), w)
        return np.where(there, _taken(self.after_code, at), 0).astype(np.uint16)

    def trigrams(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the weights of w after u v and of what the pair leaves to the
        bigram (1 for an unknown pair)."""
        node = self._node(v)
        pair, known = self.before.find(node, u)
        at, there = self.after.find(node, w)
        place = at - self.after.begin[np.maximum(node, 0)] if self.words.n else at
        leaf, found = self.pairs.find(np.where(known & there, pair, -1), np.where(there, place, 0))
        one = quantised(np.ones(1))[0]
        return (np.where(found, _taken(self.pair_code, leaf), 0).astype(np.uint16),
                np.where(known, _taken(self.before_code, pair), one).astype(np.uint16))


def _taken(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return codes[np.minimum(at, len(codes) - 1)] if len(codes) else np.zeros(len(at), np.uint16)


def _mapped(data: bytes) -> mmap.mmap:
    """The data as a memory-mapped file that goes with its last reference."""
    with tempfile.TemporaryFile() as f:
        f.write(data)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


# --------------------------------------------------------------------------
# Shards
# --------------------------------------------------------------------------

_SHARD = "words array<binary>, counts array<long>, codes binary, doc_ids array<long>, sizes array<int>, train array<boolean>"


def _numbered(batch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each word of a shard its place among the distinct words (in order of
    first occurrence), these, and the words of each text. Texts are split
    ``PIECE_BYTES`` at a time, as splitting takes many times their bytes."""
    pieces, sizes = [], []
    for piece in chunks([batch], max_bytes=PIECE_BYTES):
        raw, offsets = lower_bytes(column(piece, "text"))
        mask = ~_IS_SPACE[raw]
        begin, end = word_runs(mask, offsets)
        pieces.append(pa.DictionaryArray.from_arrays(*numbered_words(raw, mask, begin, end)))
        sizes.append(np.diff(np.searchsorted(begin, offsets)))
    whole = pa.chunked_array(pieces).unify_dictionaries()
    words = whole.chunk(0).dictionary
    return np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in whole.chunks]), words, np.concatenate(sizes)


def _shard(batches):
    for batch in chunks(batches, max_bytes=SHARD_BYTES):
        places, words, sizes = _numbered(batch)
        train = column(batch, "train").to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(places[np.repeat(train, sizes)], minlength=len(words))
        yield pa.RecordBatch.from_arrays(
            [one_list(words), one_list(pa.array(counts, pa.int64())), pa.array([squeezed(places.astype(np.int32))], pa.binary()),
             one_list(column(batch, "doc_id").cast(pa.int64())), one_list(pa.array(sizes, pa.int32())), one_list(pa.array(train))],
            names=["words", "counts", "codes", "doc_ids", "sizes", "train"])


class _Stats:
    """Totals of the training rows: tokens, distinct tokens, words seen once, texts."""

    def __init__(self, words: int, distinct: int, once: int, texts: int):
        self.tokens, self.distinct, self.once, self.texts = words + texts, distinct + (texts > 0), once, texts
        self.below = self.tokens + 0.1 * (self.distinct + 1)


class _Texts:
    """A shard as tokens with their contexts. Tokens are ranks among the shard's
    own ids, which keep the order of the ids and need few bits in any corpus."""

    def __init__(self, batch, i: int, stats: _Stats):
        # A word that is not told of was seen in this shard alone, once or never.
        self.count = column(batch, "counts")[i].values.to_numpy(zero_copy_only=False).copy()
        word = np.full(len(self.count), RARE, dtype=np.int64)
        told = column(batch, "told")[i].values
        for blob in told if told is not None else ():
            place, c, known = _read(blob)
            self.count[place], word[place] = c, known
        self.ids, rank = np.unique(np.concatenate(([PAD, END, RARE], word)), return_inverse=True)
        rank = rank[FIRST:].astype(np.int32)
        #: Training tokens of each id, that is, how often it is a context.
        self.seen = np.zeros(len(self.ids), dtype=np.int64)
        self.seen[rank] = self.count
        self.seen[[PAD, END, RARE]] = stats.texts, stats.texts, stats.once

        self.codes = unsqueezed(column(batch, "codes")[i], np.int32)
        self.doc_ids = column(batch, "doc_ids")[i].values
        self.train = column(batch, "train")[i].values.to_numpy(zero_copy_only=False).astype(bool)
        self.lengths = column(batch, "sizes")[i].values.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(self.lengths) - 1
        self.first = ends - self.lengths + 1
        self.is_word = np.ones(int(self.lengths.sum()), dtype=bool)
        self.is_word[ends] = False
        self.w = np.full(len(self.is_word), END, dtype=np.int32)
        self.w[self.is_word] = rank[self.codes]
        self.v = np.concatenate((self.w[-1:], self.w[:-1]))
        self.v[self.first] = PAD
        self.u = np.concatenate((self.v[-1:], self.v[:-1]))
        self.u[self.first] = PAD


def _limbs(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Columns of ``bits`` bits as few sort keys, the first one leading."""
    out = []
    for at in range(0, len(columns), 64 // bits):
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns[at:at + 64 // bits]:
            key <<= np.uint64(bits)
            key |= c.astype(np.uint64)
        out.append(key)
    return out


def _distinct(columns: list[np.ndarray], bits: int, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the rows, and where each distinct row begins in it."""
    keys = _limbs(columns, bits)
    order = np.argsort(keys[0], kind=kind) if len(keys) == 1 else np.lexsort(keys[::-1])
    return order, _starts(*[k[order] for k in keys])


def _part(v: np.ndarray, of_v: np.ndarray, other: np.ndarray, parts: int, part_tokens: int) -> np.ndarray:
    a, b, c = constants(71, 3)
    slices = (of_v // part_tokens + 1).astype(np.uint64)
    which = mix(other.astype(np.uint64) * a) % slices
    return (mix(v.astype(np.uint64) * b + which * c) % np.uint64(parts)).astype(np.int64)


class _Grams:
    """Distinct bigrams (v, w) or trigrams (v, u, w) of a shard, by part and
    rising in each part. With ``train`` (whether each token is learned from)
    their training counts, else ``place``: where each token's n-gram is."""

    def __init__(self, t: _Texts, n: int, parts: int, part_tokens: int, train: np.ndarray | None = None):
        tokens = [t.v, t.w] if n == 2 else [t.v, t.u, t.w]
        bits = len(t.ids).bit_length()
        order = None
        if train is not None and n * bits < 64:  # the flag fits beside the n-gram: sort the numbers alone
            key = (_limbs([*tokens, train], bits)[0] if (n + 1) * bits <= 64
                   else (_limbs(tokens, bits)[0] << np.uint64(1)) | train)
            key.sort()
            shift = bits if (n + 1) * bits <= 64 else 1
            first = _starts(key >> np.uint64(shift))
            counts = np.add.reduceat(key & np.uint64(1), first).astype(np.int64) if len(first) else first
            lead = key[first] >> np.uint64(shift)
            ranks = [((lead >> np.uint64(bits * k)) & np.uint64((1 << bits) - 1)).astype(np.int32) for k in range(n - 1, -1, -1)]
            del key, lead
        else:
            order, first = _distinct(tokens, bits)
            counts = np.add.reduceat(train[order].astype(np.int64), first) if train is not None and len(first) else None
            ranks = [c[order[first]] for c in tokens]
        part = np.empty(len(first), np.uint16 if parts <= 1 << 16 else np.int64)
        for a in range(0, len(part), BLOCK):
            v, other = (r[a:a + BLOCK] for r in ranks[:2])
            part[a:a + BLOCK] = _part(t.ids[v], t.seen[v], t.ids[other], parts, part_tokens)
        by = np.argsort(part, kind="stable")
        self.part = part[by]
        if train is not None:
            self._ids, self._seen, self._ranks, self._by, self._counts = t.ids, t.seen, ranks, by, counts
        else:
            at = np.empty(len(by), np.int32)
            at[by] = np.arange(len(by), dtype=np.int32)
            self.place = np.empty(len(order), np.int32)
            self.place[order] = np.repeat(at, np.diff(np.append(first, len(order))))

    def rows(self, a: int, b: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The columns of some n-grams with their training counts, and the counts of v."""
        at = self._by[a:b]
        ranks = [r[at] for r in self._ranks]
        return [*[self._ids[r] for r in ranks], self._counts[at]], self._seen[ranks[0]]


def _planes(values: np.ndarray) -> list[np.ndarray]:
    """Numbers as their bytes, lowest plane first, as many as the largest needs."""
    size = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return list(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T))


def _written(columns: list[np.ndarray]) -> bytes:
    """Columns of non-negative numbers, compressed; the first one rising."""
    planes = [_planes(np.diff(columns[0], prepend=0)), *map(_planes, columns[1:])]
    return squeezed(np.frombuffer(joined([np.array([len(p) for p in planes]), *[a for p in planes for a in p]]), np.uint8))


def _read(value: pa.Scalar) -> list[np.ndarray]:
    sizes, *flat = opened(unsqueezed(value, np.uint8))
    out, at = [], 0
    for size in sizes.tolist():
        number = np.zeros(len(flat[at]), dtype=np.int64)
        for k in range(size):
            number |= flat[at + k].astype(np.int64) << (8 * k)
        out.append(number)
        at += size
    out[0] = np.cumsum(out[0])
    return out


def _sent(stats: _Stats, parts: int, part_tokens: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                t = _Texts(batch, i, stats)
                train = np.repeat(t.train, t.lengths)
                found: dict[int, list] = {}
                for n in (2, 3):
                    grams = _Grams(t, n, parts, part_tokens, train)
                    cut = np.append(_starts(grams.part), len(grams.part))
                    for a, b in zip(cut[:-1], cut[1:]):
                        columns, of_v = grams.rows(a, b)
                        found.setdefault(int(grams.part[a]), [None, None])[n - 2] = _written(
                            [*columns, of_v] if n == 2 else columns)
                    del grams
                shard = column(batch, "shard")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array([shard] * len(found), pa.int64()),
                     *[pa.array([f[k] for f in found.values()], pa.binary()) for k in (0, 1)]],
                    names=["part", "shard", "bigrams", "trigrams"])
    return run


def _answered(bits: int):
    """Build the part's trie from the counts of all shards; answer each shard."""
    def merged(rows: list[list[np.ndarray]], keys: int) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * (keys + 2)
        seen = np.flatnonzero(columns[keys])
        columns = [c[seen] for c in columns]
        order, first = _distinct(columns[:keys], bits, "stable")  # merges the shards' sorted stretches
        counts = np.add.reduceat(columns[keys][order], first) if len(first) else first
        return [*[c[order[first]] for c in columns[:keys]], counts, *[c[order[first]] for c in columns[keys + 1:]]]

    def run(table: pa.Table) -> pa.Table:
        asked = [[_read(x) if x.is_valid else None for x in table.column(c)] for c in ("bigrams", "trigrams")]
        two, three = (merged([r for r in rows if r is not None], k) for rows, k in zip(asked, (2, 3)))
        trie = Trie(_mapped(Trie.built(two, three[:4])))
        answers = []
        for pair, triple in zip(*asked):
            codes = [trie.bigrams(*pair[:2])] if pair is not None else [np.zeros(0, np.uint16)]
            codes += trie.trigrams(*triple[:3]) if triple is not None else [np.zeros(0, np.uint16)] * 2
            answers.append(squeezed(np.frombuffer(joined(codes), np.uint8)))
        return pa.table({"shard": table.column("shard"), "part": table.column("part"), "codes": pa.array(answers, pa.binary())})
    return run


def _scored(stats: _Stats, parts: int, part_tokens: int):
    rare = (1.1 * stats.once + 0.1) / stats.below

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                t = _Texts(batch, i, stats)
                got = column(batch, "answers")[i].values
                order = np.argsort(got.field("part").to_numpy(zero_copy_only=False))
                codes = [opened(unsqueezed(got.field("codes")[int(k)], np.uint8)) for k in order]
                pair, triple, left = (np.concatenate([c[k] for c in codes]) for k in range(3))
                del codes
                two, three = (_Grams(t, n, parts, part_tokens).place for n in (2, 3))
                # the number of words before each block of tokens says where its words are in the codes
                words = np.concatenate(([0], np.cumsum(np.add.reduceat(t.is_word, np.arange(0, len(t.w), BLOCK), dtype=np.int64))))
                found = np.empty(len(t.w), dtype=bool)
                log_base, log_p = np.empty(len(t.w)), np.empty(len(t.w))
                for k, a in enumerate(range(0, len(t.w), BLOCK)):
                    now = slice(a, a + BLOCK)
                    count = np.full(len(t.w[now]), stats.texts)
                    count[t.is_word[now]] = t.count[t.codes[words[k]:words[k + 1]]]
                    base = (count + 0.1) / stats.below
                    lowest = np.where(t.w[now] == RARE, rare, base)
                    seen = t.seen[t.v[now]]
                    p = weights(pair[two[now]]) + KAPPA[0] / (seen + KAPPA[0]) * lowest
                    p = (weights(triple[three[now]]) + weights(left[three[now]]) * p) * (base / lowest)
                    found[now], log_base[now], log_p[now] = count > 0, np.log10(base), np.log10(p)
                known = np.add.reduceat(found, t.first, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [t.doc_ids, pa.array(~t.train), pa.array(t.lengths), pa.array(known),
                     pa.array(np.full(len(t.first), stats.tokens)), pa.array(np.add.reduceat(log_base, t.first)),
                     pa.array(np.add.reduceat(log_p, t.first))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def _told(spread: int):
    """Word rows, ordered by bucket, as one blob of (place, c, id) for each
    shard; and for each bucket (shard null) its training tokens and how many of
    its words have been seen, and seen twice."""
    def blobs(rows: list[np.ndarray]):
        shard, place, own, c, bucket, rank = (np.concatenate(x) for x in zip(*rows))
        lead = _starts(bucket)  # rows of a bucket fall in c, and ranks rise
        over = [np.maximum.reduceat(np.where(c > n, rank + 1, 0), lead) for n in (0, 1)]
        stats = (bucket[lead], np.add.reduceat(own, lead), *over)
        known = np.where(c > 1, ((rank << spread) | bucket) + FIRST, RARE)
        at = np.flatnonzero((c > 1) | (c != own))
        at = at[np.lexsort((place[at], shard[at]))]
        cut = np.append(_starts(shard[at]), len(at))
        parts = [at[a:b] for a, b in zip(cut[:-1], cut[1:])]
        n, m = len(parts), len(lead)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(shard[x[0]]) for x in parts] + [None] * m, pa.int64()),
             pa.array([_written([place[x], c[x], known[x]]) for x in parts] + [None] * m, pa.binary()),
             *[pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(x, pa.int64())]) for x in stats]],
            names=["shard", "blob", "bucket", "tokens", "over_0", "over_1"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append([x.to_numpy(zero_copy_only=False).astype(np.int64) for x in batch.columns])
                size += batch.num_rows
            if size >= TOLD_ROWS:
                yield from blobs(held)
                held, size = [], 0
        if held:
            yield from blobs(held)
    return run


def _word_counts(shards: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """What ``_told`` makes of every word of every shard, and the bits of a bucket. Words are dealt into
    hash buckets of about 4096; an id is the word's rank by count in its bucket,
    then the bucket, so frequent words get small ids. One exchange by bucket
    serves all, and no task sees more than its buckets."""
    distinct = shards.select(F.explode("words").alias("word")).agg(F.approx_count_distinct("word")).first()[0]
    spread = (distinct >> 12).bit_length()
    single = shards.select("shard", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    rows = single.select(
        "shard", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("own"),
        (F.shiftrightunsigned(F.xxhash64("w.words"), 64 - spread) if spread else F.lit(0).cast("long")).alias("bucket"))
    # sorts are led by the hash, which decides nearly every comparison
    ranked = (rows.repartition("bucket").withColumn("hash", F.xxhash64("word"))
              .withColumn("c", F.sum("own").over(W.partitionBy("hash", "bucket", "word")))
              .withColumn("rank", F.dense_rank().over(W.partitionBy("bucket").orderBy(F.desc("c"), "hash", "word")) - 1))
    return scratch.table(ranked.select("shard", "place", "own", "c", "bucket", "rank").mapInArrow(
        _told(spread), "shard long, blob binary, bucket long, tokens long, over_0 long, over_1 long"), "told"), spread


def score(spark: SparkSession, docs: DataFrame, train: Column, part_tokens: int = PART_TOKENS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (not ``train``), n_tokens,
    n_known, train_tokens, base_score, score. The model learns from the rows for
    which ``train`` is true and scores all."""
    scratch = Scratch(spark, "language-model")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = scratch.bucketed(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("train"))
        .mapInArrow(_shard, _SHARD).withColumn("shard", F.monotonically_increasing_id()), "shards", buckets, "shard")
    told, spread = _word_counts(shards, scratch)
    last = (told.where("shard IS NULL").groupBy("bucket").agg(
        F.sum("tokens").alias("tokens"), F.max("over_0").alias("over_0"), F.max("over_1").alias("over_1"))
        .agg(F.sum("tokens"), F.sum("over_0"), F.sum("over_1"), F.max("over_1")).first())
    tokens, distinct, often, most = (int(x or 0) for x in last)
    texts = shards.select(F.size(F.filter("train", lambda x: x)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    stats = _Stats(tokens, distinct, distinct - often, int(texts))
    parts = stats.tokens // part_tokens + 1
    bits = (((most + 1) << spread) + FIRST).bit_length()

    local = scratch.bucketed(told.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list("blob").alias("told")),
                             "local", buckets, "shard")
    scratch.drop("told")
    coded = shards.drop("words").join(local, "shard", "left")
    by_shard = (coded.mapInArrow(_sent(stats, parts, part_tokens), "part long, shard long, bigrams binary, trigrams binary")
                .groupBy("part").applyInArrow(_answered(bits), "shard long, part long, codes binary")
                .groupBy("shard").agg(F.collect_list(F.struct("part", "codes")).alias("answers")))
    return coded.join(by_shard, "shard").mapInArrow(
        _scored(stats, parts, part_tokens),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def training_rows(doc_id: Column) -> Column:
    return fold(doc_id, 10) != 0
