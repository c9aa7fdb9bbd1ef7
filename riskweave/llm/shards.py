"""The corpus as shards of words with local numbers, and their global ids.

A shard is a few megabytes of text: its distinct words, how often each occurs,
and its text as places in that list. Global ids and statistics of words are
joined to the distinct words of each shard, so no dictionary of the corpus is
broadcast, and the words of a text never travel one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

#: Text bytes of a shard (one text at least).
SHARD_BYTES = 16 << 20


def lower_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts (null: empty) with A-Z in lower case, and where
    each text begins."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]].copy()
    raw[(raw >= 0x41) & (raw <= 0x5A)] += 0x20
    return raw, offsets - offsets[0]


def word_runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of word bytes; runs end with their text."""
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.concatenate(([False], mask)), np.concatenate((mask, [False]))
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))


def numbered_words(raw: np.ndarray, mask: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each word its place among the distinct words, and these (binary)."""
    if not len(begin):
        return np.zeros(0, np.int32), pa.array([], pa.binary())
    size = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin),
                                  [None, pa.py_buffer(size.tobytes()), pa.py_buffer(raw[mask].tobytes())])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary())


def squeezed(array: np.ndarray) -> bytes:
    """The bytes of an array, compressed (their number in front)."""
    raw = array.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(value: pa.Scalar, dtype) -> np.ndarray:
    raw = value.as_buffer()
    size = int.from_bytes(raw.slice(0, 8).to_pybytes(), "little")
    return np.frombuffer(pa.decompress(raw.slice(8), size, codec="zstd"), dtype)


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def numbered(words: DataFrame, scratch: Scratch, name: str, *by: str) -> tuple[DataFrame, int]:
    """``words`` (distinct in word and ``by``) with an id below 2^bits, and bits.
    Words are dealt into hash buckets of about 256; an id is the bucket and the
    place in it, so no task sees more than its buckets."""
    spread = (words.count() >> 8).bit_length()
    placed = scratch.table(
        words.withColumn("bucket", F.shiftrightunsigned(F.xxhash64("word", *by), 64 - spread) if spread else F.lit(0).cast("long"))
        .withColumn("place", F.row_number().over(W.partitionBy("bucket", *by).orderBy("word")) - 1), f"{name}-placed")
    inner = (placed.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0]).bit_length()
    ids = placed.withColumn("id", F.shiftleft("bucket", inner).bitwiseOR(F.col("place"))).drop("bucket", "place")
    return ids, spread + inner


def with_local(shards: DataFrame, words: DataFrame, values: list[str], *by: str) -> DataFrame:
    """``shards``, with the number of ``distinct`` words instead of the words and
    the array ``local``: for every word of the shard that ``words`` has, its
    place in the shard's list and the ``values``."""
    single = shards.select("shard", *by, F.posexplode("words").alias("place", "word"))
    known = F.when(F.col(values[0]).isNotNull(), F.struct("place", *values))
    # a sort-merge join at every size: the words grow with the corpus
    local = single.join(words.hint("merge"), ["word", *by], "left").groupBy("shard").agg(F.collect_list(known).alias("local"))
    return shards.withColumn("distinct", F.size("words")).drop("words").join(local, "shard")


def local_values(local: pa.Array, row: int, name: str, size: int, missing: int) -> np.ndarray:
    """One of the ``values`` by place in the shard's list."""
    out = np.full(size, missing, dtype=np.int64)
    got = local[row].values
    if got is not None and len(got):
        out[got.field("place").to_numpy(zero_copy_only=False)] = got.field(name).to_numpy(zero_copy_only=False)
    return out
