"""Language identification (operator 7): a linear-chain conditional random field.

Every word is labelled with a language; emissions come from hashed affixes and
byte n-grams of the word and from learned lexicon entries, transitions between
neighbouring words are learned as well (the training sequences splice passages
of several documents, as code-switched text does). Forward-backward gives each
word's label probabilities; a document's prediction is the language with the
largest mean probability over its words.

The model is fitted by Adagrad on a bounded sample: ``SAMPLE_DOCS`` labelled
documents of at most ``SAMPLE_BYTES`` each, drawn by the hash of their id, in one
task. Its size is fixed, so tasks hold it whole. Prediction covers whole texts of all
documents; long texts are split into blocks that pass exact messages on.

Edge cases: null and empty texts and texts without a letter are ``und`` with
score 0; null languages are not learned from; without any labelled row all
documents are ``und``; ties go to the first language in code-point order; rows
that repeat are each predicted; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tokens, chunks, column, fold, mix, normalised, sampled, trained_in_task

SAMPLE_DOCS = 2000
SAMPLE_BYTES = 64 << 10
#: Rows of the hashed feature table.
FEATURES = 1 << 16
#: Lexicon words per language.
LEXICON = 2000
#: Words of a training passage, passages of a training sequence.
PASSAGE = 24
SPLICED = 4
EPOCHS = 4
RATE = 0.5
#: Distinct words whose features are built at a time in training.
PART = 20000
#: Words of an inference block.
BLOCK = 128
#: Text bytes that a task predicts at a time: their words take some 50 times as much.
PREDICT_BYTES = 1 << 20
#: Mean of the words' highest label probabilities under which the filter rejects a document.
MIN_SCORE = 0.5

UNKNOWN = "und"


# --------------------------------------------------------------------------
# Features
# --------------------------------------------------------------------------

def distinct_words(t: Tokens, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each distinct word, and every word's number among them."""
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    return first, code


def features(t: Tokens, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the given words, flat, and where each word's begin:
    prefixes and suffixes of 1 to 3 bytes, n-grams of 2 and 3 bytes."""
    start, length = t.starts[words], (t.ends - t.starts)[words]
    begin = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(begin, length)
    at = np.repeat(start, length) + place
    left = np.repeat(length, length) - place
    pad = np.concatenate((t.buf, np.zeros(3, np.uint8))).astype(np.uint64)
    one, two, three = pad[at], pad[at] | pad[at + 1] << np.uint64(8), None
    three = two | pad[at + 2] << np.uint64(16)
    owner = np.repeat(np.arange(len(words)), length)
    tag = lambda kind, value: (mix(value + np.uint64(kind << 32)) % np.uint64(FEATURES)).astype(np.int64)
    rows, owners = [], []
    for kind, value, fits in (
            (1, two, left >= 2), (2, three, left >= 3),
            (3, one, place == 0), (4, two, (place == 0) & (left >= 2)), (5, three, (place == 0) & (left >= 3)),
            (6, one, left == 1), (7, two, left == 2), (8, three, left == 3)):
        rows.append(tag(kind, value[fits]))
        owners.append(owner[fits])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order].astype(np.int32), np.searchsorted(owners[order], np.arange(len(words)))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # (FEATURES, K)
    lexicon: np.ndarray      # sorted word hashes
    entries: np.ndarray      # (lexicon, K)
    transitions: np.ndarray  # (K, K)

    def emissions(self, t: Tokens, words: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Scores of the given words; ``h`` are their hashes."""
        rows, begin = features(t, words)
        out = np.add.reduceat(self.weights[rows], begin, axis=0) if len(words) else \
            np.zeros((0, len(self.languages)), np.float32)
        place, known = _lookup(self.lexicon, h)
        out[known] += self.entries[place[known]]
        return out


def _lookup(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, h), max(0, len(table) - 1))
    return place, (table[place] == h) if len(table) else np.zeros(len(h), bool)


# --------------------------------------------------------------------------
# Training
# --------------------------------------------------------------------------

def _marginals(psi: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities and expected transitions of (batch, steps, K) scores."""
    n, steps, k = psi.shape
    alpha, beta = np.empty_like(psi), np.empty_like(psi)
    a = np.ones((n, k), psi.dtype)
    for s in range(steps):
        a = (a @ move) * psi[:, s]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, s] = a
    b = np.ones((n, k), psi.dtype)
    pairs = np.zeros((k, k))
    for s in range(steps - 1, -1, -1):
        beta[:, s] = b
        here = psi[:, s] * b
        if s:
            joint = alpha[:, s - 1][:, :, None] * move * here[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = here @ move.T
        b /= b.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both / both.sum(axis=2, keepdims=True), pairs


def train(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Fit on labelled documents by Adagrad on the conditional likelihood."""
    languages = sorted(set(langs))
    k = len(languages)
    if not k:
        return Model([], np.zeros((FEATURES, 0)), np.zeros(0, np.uint64), np.zeros((1, 0)), np.zeros((0, 0)))
    label = np.array([languages.index(x) for x in langs], dtype=np.int64)
    t = Tokens(normalised(pa.array(texts, pa.string())))
    h = t.hashes()
    first, code = distinct_words(t, h)
    owner = label[t.doc_of_word()]
    uses = np.stack([np.bincount(code[owner == c], minlength=len(first)) for c in range(k)], axis=1)
    common = [np.argsort(-uses[:, c], kind="stable")[:LEXICON] for c in range(k)]
    common = np.unique(np.concatenate([x[uses[x, c] > 1] for c, x in enumerate(common)]))
    lexicon = np.sort(h[first[common]])
    parts = [features(t, first[a:a + PART]) for a in range(0, len(first), PART)]
    rows = np.concatenate([r for r, _ in parts] or [np.zeros(0, np.int32)])
    many = np.concatenate([np.diff(np.append(b, len(r))) for r, b in parts] or [np.zeros(0, int)])
    begin = np.cumsum(many) - many
    place, known = _lookup(lexicon, h[first])
    weights, entries = np.zeros((FEATURES, k), np.float32), np.zeros((max(1, len(lexicon)), k), np.float32)
    transitions = np.zeros((k, k))
    model = Model(languages, weights, lexicon, entries, transitions)
    rng = np.random.default_rng(seed)
    fits = np.flatnonzero(t.counts() >= PASSAGE)
    if not len(fits) or k < 2:
        return model
    sums = [np.full_like(weights, 1e-2), np.full_like(entries, 1e-2), np.full((k, k), 1.0)]
    per_batch = 64
    for _ in range(EPOCHS * max(1, -(-len(fits) * 2 // (per_batch * SPLICED)))):
        docs = rng.choice(fits, (per_batch, SPLICED))
        at = t.ptr[docs] + (rng.random(docs.shape) * (t.counts()[docs] - PASSAGE + 1)).astype(int)
        index = (at[:, :, None] + np.arange(PASSAGE)).reshape(per_batch, -1)
        words, inverse = np.unique(code[index], return_inverse=True)
        inverse = inverse.reshape(index.shape)
        flat = np.repeat(begin[words], many[words]) + (
            np.arange(many[words].sum()) - np.repeat(np.cumsum(many[words]) - many[words], many[words]))
        ids, whose = rows[flat], np.repeat(np.arange(len(words)), many[words])
        scores = np.zeros((len(words), k))
        for c in range(k):
            scores[:, c] = np.bincount(whose, weights=weights[ids, c], minlength=len(words))
        in_lexicon = known[words]
        scores[in_lexicon] += entries[place[words[in_lexicon]]]
        e = scores[inverse]
        psi = np.exp(e - e.max(axis=2, keepdims=True))
        p, pairs = _marginals(psi, np.exp(transitions))
        truth = np.repeat(label[docs], PASSAGE, axis=1)
        p[np.arange(per_batch)[:, None], np.arange(truth.shape[1]), truth] -= 1
        scale = per_batch
        by_word = np.stack([np.bincount(inverse.ravel(), weights=p[:, :, c].ravel(), minlength=len(words))
                            for c in range(k)], axis=1) / scale
        grad = np.stack([np.bincount(ids, weights=by_word[whose, c], minlength=FEATURES) for c in range(k)], axis=1)
        steps = np.zeros((k, k))
        np.add.at(steps, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
        lex = np.zeros_like(entries)
        np.add.at(lex, place[words[in_lexicon]], by_word[in_lexicon])
        for value, total, g in ((weights, sums[0], grad + 1e-5 * weights), (entries, sums[1], lex + 1e-5 * entries),
                                (transitions, sums[2], (pairs - steps) / scale)):
            total += g * g
            value -= RATE * 0.2 * g / np.sqrt(total)
    return model


def fit(docs: DataFrame, training, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Train on a bounded sample of the rows that ``training`` selects."""
    fits = (training & F.col("lang").isNotNull() & F.col("text").isNotNull()
            & (F.octet_length("text") <= sample_bytes))
    sample = sampled(docs, fits, sample_docs, "lang", "text")
    return trained_in_task(sample, lambda rows: train([r["text"] for r in rows], [r["lang"] for r in rows]))


# --------------------------------------------------------------------------
# Inference
# --------------------------------------------------------------------------

def document_shares(psi: np.ndarray, ptr: np.ndarray, move: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted sums of the words' label probabilities per document."""
    return _marginal_sums(psi, ptr, move, weight)[0]


def _marginal_sums(psi: np.ndarray, ptr: np.ndarray, move: np.ndarray,
                   weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted sums of the words' label probabilities per document, and each
    word's most probable label with its probability, by forward-
    backward over whole documents. Documents are cut into blocks; a first pass
    multiplies each block's transfer matrix, a second hands messages from block
    to block, a third computes the probabilities inside all blocks at once."""
    k = psi.shape[1]
    n_docs = len(ptr) - 1
    length = np.diff(ptr)
    n_blocks = -(-length // BLOCK)
    first_block = np.cumsum(n_blocks) - n_blocks
    total = int(n_blocks.sum())
    sums = np.zeros((n_docs, k))
    labels, sure = np.zeros(len(psi), dtype=int), np.zeros(len(psi))
    if not total:
        return sums, labels, sure
    doc = np.repeat(np.arange(n_docs), n_blocks)
    nth = np.arange(total) - first_block[doc]
    start = ptr[doc] + nth * BLOCK
    size = np.minimum(BLOCK, ptr[doc + 1] - start)
    order = np.argsort(-size, kind="stable")
    back = np.empty(total, int)
    back[order] = np.arange(total)
    start, size, doc = start[order], size[order], doc[order]
    active = np.searchsorted(-size, -np.arange(1, BLOCK + 1), side="right")  # blocks that have a step
    steps = int(size[0])

    several = np.flatnonzero(n_blocks > 1)
    incoming, outgoing = np.ones((total, k)), np.ones((total, k))
    if len(several):
        m = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for s in range(steps):
            n = active[s]
            step = (m[:n].reshape(-1, k) @ move).reshape(n, k, k) * psi[start[:n] + s][:, None, :]
            m[:n] = step / step.max(axis=(1, 2), keepdims=True)
        longest = several[np.argsort(-n_blocks[several], kind="stable")]
        counts = n_blocks[longest]
        v = np.ones((len(longest), k))
        for s in range(int(counts[0]) - 1):
            n = int(np.searchsorted(-counts, -(s + 1), side="left"))
            at = back[first_block[longest[:n]] + s]
            v = np.einsum("nk,nkl->nl", v[:n], m[at])
            v /= v.sum(axis=1, keepdims=True)
            incoming[back[first_block[longest[:n]] + s + 1]] = v
        u = np.ones((len(longest), k))
        for s in range(int(counts[0]) - 1, 0, -1):
            n = int(np.searchsorted(-counts, -s, side="left"))
            at = back[first_block[longest[:n]] + s]
            u[:n] = np.einsum("nkl,nl->nk", m[at], u[:n])
            u[:n] /= u[:n].sum(axis=1, keepdims=True)
            outgoing[back[first_block[longest[:n]] + s - 1]] = u[:n]

    alphas = []
    a = incoming
    for s in range(steps):
        n = active[s]
        a = (a[:n] @ move) * psi[start[:n] + s]
        a /= a.sum(axis=1, keepdims=True)
        alphas.append(a)
    found = np.zeros((total, k))
    b = outgoing
    for s in range(steps - 1, -1, -1):
        n = active[s]
        p = alphas[s] * b[:n]
        p /= p.sum(axis=1, keepdims=True)
        found[:n] += p * weight[start[:n] + s][:, None]
        labels[start[:n] + s], sure[start[:n] + s] = p.argmax(axis=1), p.max(axis=1)
        here = (psi[start[:n] + s] * b[:n]) @ move.T
        b[:n] = here / here.sum(axis=1, keepdims=True)
    np.add.at(sums, doc, found)
    return sums, labels, sure


@dataclass
class Prediction:
    """Language, score, label shares and certainty (mean of the words' highest
    label probabilities) of each text, and its words' labels."""
    lang: list[str]
    score: np.ndarray
    shares: np.ndarray
    certainty: np.ndarray
    ptr: np.ndarray
    labels: np.ndarray


def predict(texts: pa.Array, model: Model) -> Prediction:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    k = len(model.languages)
    if not k or not len(texts):
        none = np.zeros(len(texts))
        return Prediction([UNKNOWN] * len(texts), none, np.zeros((len(texts), k)), none,
                          np.zeros(len(texts) + 1, dtype=int), np.zeros(0, dtype=int))
    t = Tokens(normalised(texts))
    h = t.hashes()
    first, code = distinct_words(t, h)
    e = model.emissions(t, first, h[first])
    psi = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float64) if len(first) else np.zeros((0, k))
    # words of digits only say nothing; texts of nothing else keep them all
    digits = np.zeros(256, dtype=bool)
    digits[0x30:0x3A] = True
    wordy = np.add.reduceat((~digits)[t.buf] & t._word, t.starts) > 0 if t.n_words else np.zeros(0, bool)
    sums, labels, sure = _marginal_sums(psi[code], t.ptr, np.exp(model.transitions), wordy.astype(float))
    total = sums.sum(axis=1, keepdims=True)
    shares = np.divide(sums, total, out=np.full_like(sums, 1.0 / k), where=total > 0)
    best = shares.argmax(axis=1)
    score = np.where(letters, shares[np.arange(len(best)), best], 0.0)
    lang = [model.languages[b] if x else UNKNOWN for b, x in zip(best.tolist(), letters.tolist())]
    certain = np.bincount(t.doc_of_word(), weights=sure * wordy, minlength=t.n_docs)
    certainty = np.divide(certain, total[:, 0], out=np.zeros(t.n_docs), where=(total[:, 0] > 0) & letters)
    return Prediction(lang, np.clip(score, 0.0, 1.0), np.where(letters[:, None], shares, 0.0), certainty, t.ptr, labels)


_RESULT = "doc_id long, lang_pred string, score double, shares map<string,double>"


def _label(model: Model):
    def run(batches):
        for b in chunks(batches, max_bytes=PREDICT_BYTES):
            found = predict(column(b, "text"), model)
            k = len(model.languages)
            maps = pa.MapArray.from_arrays(
                pa.array(np.arange(b.num_rows + 1) * k, pa.int32()),
                pa.array(model.languages * b.num_rows, pa.string()), pa.array(found.shares.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id").cast(pa.int64()), pa.array(found.lang, pa.string()),
                 pa.array(found.score, pa.float64()), maps],
                names=["doc_id", "lang_pred", "score", "shares"])
    return run


def label(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, and the share of each
    learned language in its words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_label(model), _RESULT)


_WORDS = "doc_id long, spans array<struct<lang:string,word_start:long,word_end:long>>"


def _label_words(model: Model):
    def run(batches):
        for b in chunks(batches, max_bytes=PREDICT_BYTES):
            found = predict(column(b, "text"), model)
            spans = []
            for x, lo, hi in zip(found.lang, found.ptr[:-1].tolist(), found.ptr[1:].tolist()):
                labels = found.labels[lo:hi]
                edges = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), hi - lo]
                spans.append([] if x == UNKNOWN else
                             [(model.languages[labels[a]], a, z) for a, z in zip(edges, edges[1:])])
            kind = pa.list_(pa.struct([("lang", pa.string()), ("word_start", pa.int64()), ("word_end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(spans, kind)],
                                             names=["doc_id", "spans"])
    return run


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id and the runs of words with one most probable
    label, places in words that are more than punctuation (``und``: none)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_label_words(model), _WORDS)


def _accept(model: Model, at: int, min_score: float):
    def run(batches):
        for b in chunks(batches, max_bytes=PREDICT_BYTES):
            found = predict(b.column(at), model)
            keep = [x != UNKNOWN and c >= min_score for x, c in zip(found.lang, found.certainty.tolist())]
            yield b.filter(pa.array(keep, pa.bool_()))
    return run


def training_rows(doc_id):
    """The rows that the query may learn from."""
    return fold(doc_id, 3) != 1


def keep_identified(spark: SparkSession, docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose words' languages are identified:
    a text in several languages stays if its words are labelled with certainty."""
    model = fit(docs, training_rows(F.col("doc_id")))
    return docs.mapInArrow(_accept(model, docs.columns.index("text"), min_score), docs.schema)
