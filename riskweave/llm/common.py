"""Helpers shared by the operators: scratch tables, whole-text tokenising on
Arrow buffers, 64-bit word and window hashes.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; null texts have
no words. All hashes are fixed functions of the text, alike in every task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch  # noqa: F401 (the operators import it from here)

#: The whitespace of every operator's word definition, as Spark's ``translate`` takes it.
SPACES = " \t\n\x0b\f\r"
#: Text bytes that a task tokenises at a time.
CHUNK_BYTES = 4 << 20
#: Copies of a row that one task writes out at a time.
COPIES = 1 << 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added a name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


# --------------------------------------------------------------------------
# Tokenising
# --------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3's)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def constants(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed)) | np.uint64(1)


_POWERS: dict[int, np.ndarray] = {}


def _powers(seed: int, n: int) -> np.ndarray:
    """Powers of an odd base, grown by doubling to the longest word seen."""
    have = _POWERS.get(seed)
    if have is None or len(have) < n:
        size = max(64, 1 << int(n - 1).bit_length())
        base = np.full(size, constants(seed, 1)[0], dtype=np.uint64)
        base[0] = 1
        have = _POWERS[seed] = np.cumprod(base, dtype=np.uint64)
    return have


_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def normalised(texts: pa.Array) -> pa.Array:
    """Lower case, ASCII punctuation removed."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    n = len(low)
    if not n:
        return low
    offsets = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset:low.offset + n + 1]
    data = low.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    keep = ~_PUNCTUATION[raw]
    places = np.concatenate(([0], np.cumsum(keep)))[offsets - offsets[0]].astype(np.int64)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(places.tobytes()), pa.py_buffer(raw[keep].tobytes()))


class Tokens:
    """The words of some texts: byte ``starts``/``ends`` into ``buf``, and
    ``ptr`` so that document d has words ``ptr[d]:ptr[d + 1]``. With
    ``punctuation`` runs of ASCII punctuation are words of their own."""

    def __init__(self, texts: pa.Array, punctuation: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1] \
            if n else np.zeros(1, dtype=np.int64)
        data = texts.buffers()[2] if n else None
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.buf = raw[lo:hi]
        self.offsets = offsets - lo
        word = ~_IS_SPACE[self.buf]
        # one place more than there are bytes: starts and ends are where a run
        # of word bytes begins or stops, and at document boundaries
        edge = np.zeros(len(word) + 1, dtype=bool)
        edge[self.offsets] = True
        if punctuation and len(word):
            mark = _PUNCTUATION[self.buf]
            edge[1:-1] |= mark[1:] != mark[:-1]
        before = np.concatenate(([False], word))
        after = np.concatenate((word, [False]))
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.ptr = np.searchsorted(self.starts, self.offsets)
        self.n_words = len(self.starts)
        self.n_docs = n
        self._word = word

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())

    def hashes(self, seed: int = 1) -> np.ndarray:
        """One 64-bit hash per word: a polynomial in position over random byte values."""
        if not self.n_words:
            return np.zeros(0, dtype=np.uint64)
        nb = self.buf[self._word]
        lens = self.ends - self.starts
        first = np.concatenate(([0], np.cumsum(lens)[:-1]))
        place = np.arange(len(nb)) - np.repeat(first, lens)
        values = constants(seed + 77, 256)[nb] * _powers(seed, int(lens.max()))[place]
        return mix(np.add.reduceat(values, first) + lens.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()


def window_hashes(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of the ``width`` words from each position of ``h`` on; positions
    with fewer than ``width`` words behind them are left out."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k, c in enumerate(constants(seed, width)):
        out += h[k:k + n] * c
    return mix(out)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts hold about ``max_bytes`` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def numbered_copies(groups: DataFrame, n: str, place: str) -> DataFrame:
    """Each row ``n`` times, its copies numbered from 0 in ``place``. A row with
    many copies is first cut into slices, which are dealt over the tasks."""
    cut = spare_name(groups, "_slice")
    few = groups.where(F.col(n) <= COPIES).withColumn(place, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    slices = (groups.where(F.col(n) > COPIES)
              .withColumn(cut, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / COPIES))))
              .repartition(F.col(cut)))
    first = F.col(cut) * F.lit(COPIES)
    many = slices.withColumn(place, F.explode(F.sequence(first, F.least(first + F.lit(COPIES), F.col(n)) - 1))).drop(cut)
    return few.unionByName(many)


def sampled(docs: DataFrame, condition: Column, n: int, *columns: str) -> DataFrame:
    """At most n rows that fulfil the condition, those whose ids have the
    smallest hashes. The ids are chosen first (n of them are broadcast), so no
    task gathers texts that are not in the sample."""
    place = [F.xxhash64("doc_id"), "doc_id"]
    name = spare_name(docs, "_sampled")
    ids = docs.where(condition).select("doc_id").where("doc_id IS NOT NULL").orderBy(*place).limit(n)
    return (docs.where(condition)
            .join(F.broadcast(ids.withColumnRenamed("doc_id", name)), F.col("doc_id") == F.col(name), "left_semi")
            .select("doc_id", *columns).orderBy(*place, *columns).limit(n).select(*columns))


def trained_in_task(sample: DataFrame, train) -> object:
    """``train(rows)`` run by one task on a bounded sample; only the model comes
    to the driver. ``rows`` are the sample's rows as dictionaries."""
    def run(batches):
        rows = [row for b in batches for row in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    made = sample.coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(made.model) if made else train([])  # a plan without rows runs no task
