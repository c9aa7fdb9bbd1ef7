"""Removal of repeated passages (operator 10): difference-cover anchors.

A passage of ``WINDOW`` words that two documents share starts at unrelated
places in them. {0, 1, 3} is a difference cover modulo 7: for any two places
there is a shift below 7 at which both are cover positions. Hashing only the
7-word windows at cover positions (three in seven) therefore leaves every
shared 13-word passage with one anchor that both documents hash.

1. Anchors are hashed per task, reduced to one sender per distinct anchor and
   task, shuffled by hash, and those with several documents are sent back to
   the documents that hold them.
2. Documents extend their shared anchors to all 13-word windows around them and
   hash those with 96 bits; the smallest doc_id of each window is found the
   same way and the other documents get it back.
3. Covered words are removed.

A passage that a third of all documents hold moves one row per task through
the shuffle by hash; what the other documents need is decided in their own task
and travels by document.

Edge cases: null and empty texts have no words (hash of the empty string);
documents shorter than a window keep all; copies inside one document, or in rows
that repeat a doc_id, do not count as earlier; rows with a null doc_id neither
remove nor lose words; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, Tokens, chunks, column, mix, window_hashes

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Text bytes whose anchors one reducing task holds.
PART_BYTES = 32 << 20
MIN_PARTS = 32

_SENT = "part int, settled boolean, entries binary"
_BACK = "doc_id long, entries binary"


# --------------------------------------------------------------------------
# Packing: (document, hash) entries as one binary per part
# --------------------------------------------------------------------------

def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return first, np.diff(np.append(first, len(keys)))


def _pack(docs: np.ndarray, body: np.ndarray) -> bytes:
    first, count = _runs(docs)
    return (np.array([len(first)], dtype=np.int64).tobytes() + docs[first].tobytes()
            + count.astype(np.int32).tobytes() + np.ascontiguousarray(body).tobytes())


def _unpack(blob: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    ids = np.frombuffer(blob, np.int64, n, 8)
    count = np.frombuffer(blob, np.int32, n, 8 + 8 * n)
    body = np.frombuffer(blob, np.uint8, -1, 8 + 12 * n).reshape(-1, width)
    return np.repeat(ids, count), body


def _by_part(part: np.ndarray, docs: np.ndarray, body: np.ndarray, settled: bool):
    order = np.lexsort((docs, part))
    part, docs, body = part[order], docs[order], body[order]
    first, count = _runs(part)
    return [(int(part[a]), settled, _pack(docs[a:a + n], body[a:a + n])) for a, n in zip(first, count)]


def _send(keys: np.ndarray, docs: np.ndarray, parts: int, width: int, strict: bool):
    """Rows for the shuffle from the (hash, document) pairs of one chunk.
    ``keys`` is (n, 1) or (n, 2) uint64. Of each distinct hash the smallest
    document asks; documents that this chunk already settles (``strict``: larger
    than the smallest one; otherwise all of several) are answered directly."""
    order = np.lexsort((docs, *keys.T[::-1]))
    keys, docs = keys[order], docs[order]
    new_key = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
    fresh = new_key | np.concatenate(([True], docs[1:] != docs[:-1]))
    keys, docs, new_key = keys[fresh], docs[fresh], new_key[fresh]
    first = np.flatnonzero(new_key)
    size = np.diff(np.append(first, len(keys)))
    body = np.ascontiguousarray(keys).view(np.uint8).reshape(len(keys), -1)[:, :width]
    part = ((keys[:, 0] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    answered = np.repeat(size > 1, size) & ~(new_key & strict)
    spread = docs[answered] % parts
    return (_by_part(part[first], docs[first], body[first], False)
            + _by_part(spread, docs[answered], body[answered], True))


def _table(rows) -> pa.RecordBatch:
    part, settled, entries = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(settled, pa.bool_()), pa.array(entries, pa.binary())],
        names=["part", "settled", "entries"])


def _answer(width: int, strict: bool):
    """Reducer of one part: which documents hold a hash that others hold too."""
    def reduce(table: pa.Table) -> pa.Table:
        got, asked = [], []
        for settled, blob in zip(table["settled"].to_pylist(), table["entries"].to_pylist()):
            (got if settled else asked).append(_unpack(blob, width))
        if asked:
            docs = np.concatenate([d for d, _ in asked])
            body = np.concatenate([b for _, b in asked])
            keys = _words64(body)
            order = np.lexsort(keys.T[::-1])
            keys, docs, body = keys[order], docs[order], body[order]
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
            size = np.diff(np.append(first, len(keys)))
            low = np.repeat(np.minimum.reduceat(docs, first), size)
            high = np.repeat(np.maximum.reduceat(docs, first), size)
            told = docs > low if strict else low < high
            got.append((docs[told], body[told]))
        docs = np.concatenate([d for d, _ in got]) if got else np.zeros(0, np.int64)
        body = np.concatenate([b for _, b in got]) if got else np.zeros((0, width), np.uint8)
        order = np.argsort(docs, kind="stable")
        docs, body = docs[order], body[order]
        first, count = _runs(docs)
        return pa.table({"doc_id": pa.array(docs[first], pa.int64()),
                         "entries": pa.array([body[a:a + n].tobytes() for a, n in zip(first, count)], pa.binary())})
    return reduce


def _exchange(sent: DataFrame, width: int, strict: bool) -> DataFrame:
    back = sent.groupBy("part").applyInArrow(_answer(width, strict), _BACK)
    return back.groupBy("doc_id").agg(F.collect_list("entries").alias("entries"))


def _told(answers: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys sent back to the documents of a chunk: (row, key bytes)."""
    rows, parts = [], []
    for row, blobs in enumerate(answers.to_pylist()):
        for blob in blobs or ():
            rows.append(np.full(len(blob) // width, row))
            parts.append(blob)
    body = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)), body


def _words64(body: np.ndarray) -> np.ndarray:
    """Key bytes, zero padded, as whole 64-bit numbers."""
    wide = np.zeros((len(body), 8 * -(-body.shape[1] // 8)), dtype=np.uint8)
    wide[:, :body.shape[1]] = body
    return wide.view(np.uint64)


def _of_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One number per (key, row) of a chunk, to look up keys row by row."""
    out = mix(rows.astype(np.uint64) + np.uint64(1))
    for lane in keys.T:
        out = mix(out ^ lane)
    return out


# --------------------------------------------------------------------------
# The three steps
# --------------------------------------------------------------------------

def _cover_positions(t: Tokens) -> np.ndarray:
    """Positions of anchors: at cover places of documents that hold a window."""
    n = t.counts()
    place = np.arange(t.n_words) - np.repeat(t.ptr[:-1], n)
    size = np.repeat(n, n)
    covered = np.isin(np.arange(PERIOD), COVER)[place % PERIOD]
    return np.flatnonzero(covered & (place + ANCHOR <= size) & (size >= WINDOW))


def _anchors(parts: int):
    def run(batches):
        for b in chunks(batches):
            t = Tokens(column(b, "text"))
            at = _cover_positions(t)
            if not len(at):
                continue
            ids = column(b, "doc_id").to_numpy(zero_copy_only=False)
            keys = window_hashes(t.hashes(), ANCHOR, 7)[at]
            yield _table(_send(keys[:, None], ids[np.searchsorted(t.ptr, at, side="right") - 1].astype(np.int64),
                               parts, 6, strict=False))
    return run


def _wide_windows(t: Tokens, at: np.ndarray) -> np.ndarray:
    """96-bit hash of the WINDOW words from each of the positions, as (n, 2)."""
    high = window_hashes(t.hashes(3), WINDOW, 11)[at]
    low = window_hashes(t.hashes(5), WINDOW, 13)[at] & np.uint64(0xFFFFFFFF)
    return np.stack([high, low], axis=1)


def _runs_blob(marked: np.ndarray) -> bytes:
    """Runs of marked places as pairs (first, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return edges.astype(np.int64).tobytes()


def _marked(t: Tokens, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in the runs of each document, and their documents."""
    at = []
    for row, blob in enumerate(runs.to_pylist()):
        edges = np.frombuffer(blob, np.int64).reshape(-1, 2)
        at += [np.arange(a, b) + t.ptr[row] for a, b in edges.tolist()]
    at = np.concatenate(at) if at else np.zeros(0, np.int64)
    return at, np.searchsorted(t.ptr, at, side="right") - 1


def _sha(words) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


_EXTENDED = "doc_id long, n_words long, kept_sha256 string, runs binary, text string"


def _extend(batches):
    """Per document: size, hash of all its words and, if it has shared anchors,
    the runs of windows around them (with the text, for the next steps)."""
    for b in chunks(batches):
        texts = column(b, "text")
        t = Tokens(texts)
        told, body = _told(column(b, "entries"), 6)
        marked = np.zeros(t.n_words + 1, dtype=bool)
        if len(told):
            at = _cover_positions(t)
            rows = np.searchsorted(t.ptr, at, side="right") - 1
            keys = window_hashes(t.hashes(), ANCHOR, 7)[at] & np.uint64((1 << 48) - 1)
            hit = np.isin(_of_row(keys[:, None], rows), _of_row(_words64(body), told))
            at, rows = at[hit], rows[hit]
            step = np.zeros(t.n_words + 1, dtype=np.int32)
            first = np.maximum(at + ANCHOR - WINDOW, t.ptr[rows])
            last = np.minimum(at, t.ptr[rows + 1] - WINDOW)
            np.add.at(step, first, 1)
            np.add.at(step, last + 1, -1)
            marked = np.cumsum(step) > 0
        before = np.concatenate(([0], np.cumsum(marked)))
        some = before[t.ptr[1:]] > before[t.ptr[:-1]]
        runs = [_runs_blob(marked[t.ptr[d]:t.ptr[d + 1]]) if some[d] else None for d in range(t.n_docs)]
        shas = [_sha(x.as_buffer().to_pybytes().split() if x.is_valid else []) for x in texts]
        yield pa.RecordBatch.from_arrays(
            [column(b, "doc_id"), pa.array(t.counts(), pa.int64()), pa.array(shas, pa.string()),
             pa.array(runs, pa.binary()),
             pa.array([texts[d].as_py() if some[d] else None for d in range(t.n_docs)], pa.string())],
            names=["doc_id", "n_words", "kept_sha256", "runs", "text"])


def _windows(parts: int):
    def run(batches):
        for b in chunks(batches):
            t = Tokens(column(b, "text"))
            at, rows = _marked(t, column(b, "runs"))
            ids = column(b, "doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            yield _table(_send(_wide_windows(t, at), ids[rows], parts, 12, strict=True))
    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def _remove(keep_text: bool):
    def run(batches):
        for b in chunks(batches):
            texts = column(b, "text")
            t = Tokens(texts)
            told, body = _told(column(b, "entries"), 12)
            gone = np.zeros(t.n_words, dtype=bool)
            if len(told):
                at, rows = _marked(t, column(b, "runs"))
                at = at[np.isin(_of_row(_wide_windows(t, at), rows), _of_row(_words64(body), told))]
                step = np.zeros(t.n_words + 1, dtype=np.int32)
                np.add.at(step, at, 1)
                np.add.at(step, at + WINDOW, -1)
                gone = np.cumsum(step[:-1]) > 0
            shas, kept = column(b, "kept_sha256").to_pylist(), [None] * t.n_docs
            total = np.concatenate(([0], np.cumsum(gone)))
            removed = total[t.ptr[1:]] - total[t.ptr[:-1]]
            for d in np.flatnonzero(removed).tolist():
                stay = ~gone[t.ptr[d]:t.ptr[d + 1]]
                words = list(compress(texts[d].as_buffer().to_pybytes().split(), stay.tolist()))
                shas[d] = _sha(words)
                if keep_text:
                    kept[d] = b" ".join(words).decode()
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), column(b, "n_words"), pa.array(removed, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"])
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with
    ``keep_text`` the kept words of documents that lost some (``text``)."""
    scratch = Scratch(spark, "substring")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(MIN_PARTS, -(-int(size) // PART_BYTES))
    known = docs.where("doc_id IS NOT NULL")

    shared = _exchange(known.mapInArrow(_anchors(parts), _SENT), 6, strict=False)
    extended = scratch.table(docs.join(shared, "doc_id", "left").select("doc_id", "text", "entries")
                             .mapInArrow(_extend, _EXTENDED), "extended")
    held = extended.where("runs IS NOT NULL")
    later = _exchange(held.select("doc_id", "runs", "text").mapInArrow(_windows(parts), _SENT), 12, strict=True)
    touched = (held.join(later, "doc_id", "left")
               .select("doc_id", "n_words", "kept_sha256", "runs", "text", "entries")
               .mapInArrow(_remove(keep_text), _RESULT))
    whole = (extended.where("runs IS NULL")
             .select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
                     F.lit(None).cast("string").alias("text")))
    out = touched.unionByName(whole)
    return out if keep_text else out.drop("text")
