"""Toxicity scores (operator 1): non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; unlabelled text of the corpus,
toxic documents among it, stands for everything. With the class prior pi the
risk on negatives is estimated from both,

    R = pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1)),

and the gradient is turned round where the bracket is negative, so that the
classifier cannot push the corrected risk below zero by overfitting (Kiryo et
al., "Positive-Unlabeled Learning with Non-Negative Risk Estimator", 2017).

Features are hashed words and byte n-grams of words, present or not in a
document; those whose share differs clearly between positives and unlabelled
text are kept. ``MEMBERS`` numpy classifiers are fitted on different unlabelled
draws and averaged. Training uses a bounded sample (``SAMPLE_DOCS`` documents of
each kind, of at most ``SAMPLE_BYTES`` each, drawn by the hash of the id, in one
task); scores cover whole texts of all documents.

Edge cases: null and empty texts have no features and get the bias score;
documents with several label rows count as toxic if one says so; without any
positive all scores are 0; rows that repeat are each scored; extra columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tokens, chunks, column, fold, mix, normalised, sampled, trained_in_task

SAMPLE_DOCS = 2000
SAMPLE_BYTES = 64 << 10
FEATURES = 1 << 20
#: Byte lengths of the n-grams.
GRAMS = (5, 6, 7, 8)
#: Standard errors by which a feature's shares must differ, and most features kept.
CLEAR = 4.0
MOST_FEATURES = 20000
MEMBERS = 3
#: Documents whose features are built at a time in training.
PART = 64
STEPS = 800
BATCH = 256
RATE = 0.1
DECAY = 1e-3
THRESHOLD = 0.3


def document_features(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs, as two arrays ordered by document."""
    if not t.n_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = t.hashes()
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    # distinct words of each document
    seen = np.unique(t.doc_of_word() * len(first) + code)
    docs, words = seen // len(first), seen % len(first)
    rows, begin, many = word_features(t, first, h[first])
    flat = np.repeat(begin[words], many[words]) + _within(many[words])
    pairs = np.unique(np.repeat(docs, many[words]) * FEATURES + rows[flat])
    return pairs // FEATURES, pairs % FEATURES


def _within(count: np.ndarray) -> np.ndarray:
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def word_features(t: Tokens, words: np.ndarray, h: np.ndarray):
    """Feature rows of words, flat, where each word's begin, and how many."""
    start, length = t.starts[words], (t.ends - t.starts)[words]
    pad = np.concatenate((t.buf, np.zeros(8, np.uint8))).astype(np.uint64)
    rows = [(h % np.uint64(FEATURES)).astype(np.int64)]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        count = np.maximum(length - n + 1, 0)
        at = np.repeat(start, count) + _within(count)
        value = np.zeros(len(at), dtype=np.uint64)
        for k in range(n):
            value |= pad[at + k] << np.uint64(8 * k)
        rows.append((mix(value * np.uint64(2 * n + 1)) % np.uint64(FEATURES)).astype(np.int64))
        owners.append(np.repeat(np.arange(len(words)), count))
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    many = np.bincount(owners, minlength=len(words))
    return rows[order], np.cumsum(many) - many, many


@dataclass
class Model:
    place: np.ndarray     # FEATURES -> row of the kept features, or -1
    weights: np.ndarray   # (MEMBERS, kept + 1), the bias last
    prior: float

    def score(self, texts: pa.Array) -> np.ndarray:
        t = Tokens(normalised(texts))
        if not len(self.weights):
            return np.zeros(t.n_docs)
        docs, rows = kept_features(t, self.place)
        out = np.zeros(t.n_docs)
        for w in self.weights:
            g = w[-1] + np.bincount(docs, weights=w[rows], minlength=t.n_docs)
            out += 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        return out / len(self.weights)


def kept_features(t: Tokens, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, kept feature) pairs. Words without a kept feature are
    dropped before documents are looked at."""
    if not t.n_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = t.hashes()
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    rows, _, many = word_features(t, first, h[first])
    kept = place[rows]
    owner = np.repeat(np.arange(len(first)), many)[kept >= 0]
    kept = kept[kept >= 0]
    count = np.bincount(owner, minlength=len(first))
    begin = np.cumsum(count) - count
    at = np.flatnonzero(count[code])
    words, docs = code[at], np.searchsorted(t.ptr, at, side="right") - 1
    flat = np.repeat(begin[words], count[words]) + _within(count[words])
    size = int(place.max()) + 1
    pairs = np.unique(np.repeat(docs, count[words]) * size + kept[flat])
    return pairs // max(1, size), pairs % max(1, size)


def _slices(texts: list[str]):
    for a in range(0, len(texts), PART):
        yield Tokens(normalised(pa.array(texts[a:a + PART], pa.string())))


def _choose(positive: list[str], unlabelled: list[str]) -> np.ndarray:
    """Kept features: shares in positives and unlabelled text that differ."""
    shares, n = [], (len(positive), len(unlabelled))
    for texts in (positive, unlabelled):
        held = np.zeros(FEATURES, dtype=np.int64)
        for t in _slices(texts):
            held += np.bincount(document_features(t)[1], minlength=FEATURES)
        shares.append(held)
    p, u = shares[0] / n[0], shares[1] / n[1]
    both = (shares[0] + shares[1]) / (n[0] + n[1])
    error = np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    z = np.divide(np.abs(p - u), error, out=np.zeros_like(p), where=error > 0)
    chosen = np.flatnonzero(z > CLEAR)
    chosen = np.sort(chosen[np.argsort(-z[chosen], kind="stable")[:MOST_FEATURES]])
    place = np.full(FEATURES, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    return place


def _csr(texts: list[str], place: np.ndarray):
    """Kept features of each document, flat, and where each document's begin."""
    rows, counts = [], []
    for t in _slices(texts):
        docs, held = kept_features(t, place)
        rows.append(held)
        counts.append(np.bincount(docs, minlength=t.n_docs))
    return np.concatenate(rows), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def _margins(data, pick: np.ndarray, w: np.ndarray):
    rows, ptr = data
    count = (ptr[pick + 1] - ptr[pick])
    flat = np.repeat(ptr[pick], count) + _within(count)
    whose = np.repeat(np.arange(len(pick)), count)
    ids = rows[flat]
    return w[-1] + np.bincount(whose, weights=w[ids], minlength=len(pick)), ids, whose


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(positive: list[str], unlabelled: list[str], prior: float, seed: int = 11) -> Model:
    """Fit the classifiers with the logistic loss on the non-negative risk."""
    place = _choose(positive, unlabelled)
    size = int(place.max()) + 1
    p_data, u_data = _csr(positive, place), _csr(unlabelled, place)
    members = []
    for member in range(MEMBERS):
        rng = np.random.default_rng(seed + member)
        w = np.zeros(size + 1)
        w[-1] = np.log(prior / (1 - prior))
        total = np.full(size + 1, 1e-2)
        pool_u = rng.choice(len(unlabelled), len(unlabelled))   # a bootstrap draw
        for _ in range(STEPS):
            ip = rng.choice(len(positive), BATCH)
            iu = pool_u[rng.choice(len(pool_u), BATCH)]
            gp, p_ids, p_whose = _margins(p_data, ip, w)
            gu, u_ids, u_whose = _margins(u_data, iu, w)
            # logistic loss log(1 + exp(-y g)): slopes for y = +1 and y = -1
            p_pos, p_neg, u_neg = -_sigmoid(-gp), _sigmoid(gp), _sigmoid(gu)
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if negative >= 0:
                dp, du = prior * (p_pos - p_neg), u_neg
            else:
                dp, du = prior * p_neg, -u_neg
            dp, du = dp / len(ip), du / len(iu)
            grad = DECAY * w
            grad[-1] = 0
            grad[:-1] += (np.bincount(p_ids, weights=dp[p_whose], minlength=size)
                          + np.bincount(u_ids, weights=du[u_whose], minlength=size))
            grad[-1] += dp.sum() + du.sum()
            total += grad * grad
            w -= RATE * grad / np.sqrt(total)
        members.append(w)
    return Model(place, np.array(members), prior)


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

def fit(docs: DataFrame, labels: DataFrame, training, sample_docs: int = SAMPLE_DOCS,
        sample_bytes: int = SAMPLE_BYTES) -> Model:
    """``training`` selects the rows whose labels may be used (a condition on
    doc_id); the prior is the toxic share of the labelled ones among them."""
    named = (labels.select("doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .where(training).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    toxic, count = named.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not toxic:
        return _nothing(0.0)
    order = [F.xxhash64("doc_id"), "doc_id", "text"]
    fits = F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes)
    # ids first: the sample's texts are the only ones that are gathered
    chosen = named.where("toxic = 1").select(F.col("doc_id").alias("_toxic")).orderBy(
        F.xxhash64("_toxic"), "_toxic").limit(4 * sample_docs)
    positive = (docs.select("doc_id", "text").where(fits)
                .join(F.broadcast(chosen), F.col("doc_id") == F.col("_toxic"), "left_semi")
                .orderBy(*order).limit(sample_docs).select("text", F.lit(True).alias("positive")))
    unlabelled = (sampled(docs.select("doc_id", "text"), training & fits, sample_docs, "text")
                  .withColumn("positive", F.lit(False)))
    prior = min(max(toxic / count, 0.01), 0.9)

    def run(rows):
        texts = [[r["text"] for r in rows if r["positive"] == kind] for kind in (True, False)]
        return train(*texts, prior) if all(texts) else _nothing(prior)
    return trained_in_task(positive.unionByName(unlabelled), run)


def _nothing(prior: float) -> Model:
    return Model(np.full(FEATURES, -1, dtype=np.int32), np.zeros((0, 1)), prior)


def _score(model: Model):
    def run(batches):
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id").cast(pa.int64()), pa.array(model.score(column(b, "text")), pa.float64())],
                names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (score >= 0.3)."""
    made = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_score(model), "doc_id long, score double"))
    return made.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def training_rows(doc_id):
    """The rows whose labels the query may learn from."""
    return fold(doc_id, 4) != 2
