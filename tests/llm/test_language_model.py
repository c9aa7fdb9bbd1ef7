"""Scores against a model of plain dictionaries; sums of probabilities; tries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskweave.llm import language_model as lm
from riskweave.llm import queries


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^ \t-\r]+", low) + [None]


class Plain:
    """The same model by counting: ``True`` is the pad, ``""`` the rare class."""

    def __init__(self, texts):
        split = [tokens(t) for t in texts]
        self.count = Counter(w for t in split for w in t)
        self.total = sum(self.count.values())
        self.below = self.total + 0.1 * (len(self.count) + 1)
        self.grams = Counter()
        for t in split:
            full = [True, True, *map(self.classed, t)]
            for i in range(2, len(full)):
                for n in (2, 3):
                    gram = tuple(full[i - n + 1:i + 1])
                    self.grams[gram] += 1
                    self.grams[(*gram[:-1], "context")] += 1
        once = sum(c == 1 for w, c in self.count.items() if w is not None)
        self.rare = (1.1 * once + 0.1) / self.below

    def classed(self, w):
        return w if w is None or self.count[w] > 1 else ""

    def base(self, w):
        return (self.count[w] + 0.1) / self.below

    def p(self, u, v, w):
        lowest = self.rare if self.classed(w) == "" else self.base(w)
        u, v, c = (x if x is True else self.classed(x) for x in (u, v, w))
        lower = lowest
        for k, context in ((lm.KAPPA[0], (v,)), (lm.KAPPA[1], (u, v))):
            lower = (self.grams[(*context, c)] + k * lower) / (self.grams[(*context, "context")] + k)
        return lower * self.base(w) / lowest

    def score(self, text):
        full = [True, True, *tokens(text)]
        return sum(math.log10(self.p(*full[i - 2:i + 1])) for i in range(2, len(full)))


def check(got, rows):
    fold = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 for i, _ in rows}
    model = Plain([t for i, t in rows if fold[i]])
    assert len(got) == len(rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(t)
    for r in got:
        near = [t for t in by_id[r.doc_id] if abs(model.score(t) - r.score) < 2e-3 * len(tokens(t)) + 1e-9]
        assert near, (r, [model.score(t) for t in by_id[r.doc_id]])
        t = near[0]
        assert r.held_out == (fold[r.doc_id] == 0) and r.train_tokens == model.total
        assert r.n_tokens == len(tokens(t)) and r.n_known == sum(model.count[w] > 0 for w in tokens(t))
        assert r.base_score == pytest.approx(sum(math.log10(model.base(w)) for w in tokens(t)), abs=1e-6)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)


def rows():
    r = random.Random(3)
    vocabulary = ["w%d" % i for i in range(60)] + ["the"] * 80 + ["É", "A.", "a."]
    out = [(None, "the lone row"), (None, None), (1, ""), (2, " \n"), (3, "the the the"), (3, "the w1")]
    out += [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(10, 300)]
    out += [(400 + i, "rare%d rare%d the" % (i, i + 1)) for i in range(30)]
    return out + out[20:25] + [(500, " ".join("x%d" % (i % 977) for i in range(20000)))]


@pytest.mark.parametrize("part_tokens", [lm.PART_TOKENS, 300])
def test_against_counting(spark, part_tokens):
    data = rows()
    docs = spark.createDataFrame([(i, t, "s", 1, "p") for i, t in data],
                                 "doc_id long, text string, shard string, part long, words string").repartition(4)
    got = lm.score(spark, docs, lm.training_rows(F.col("doc_id")), part_tokens).collect()
    check(got, data)


def test_query_base_columns_and_gain(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.QUERIES["op11_lm_score"](spark, SF001).collect()
    check(got, data)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one(spark):
    model = Plain([t for i, t in rows() if zlib.crc32(str(i).encode()) % 10])
    unknown = "never seen"
    for u, v in ((True, True), (True, "the"), ("the", "w1"), (unknown, unknown)):
        total = sum(model.p(u, v, w) for w in [*model.count, unknown])
        assert total == pytest.approx(1, abs=1e-9)


def test_tables_without_training_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(spark, none, F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = lm.score(spark, one, F.lit(False)).collect()
    assert {(r.held_out, r.train_tokens, r.n_known, round(r.base_score, 9), round(r.score, 2)) for r in got} == {(True, 0, 0, 0.0, 0.0)}


def test_trie_finds_what_it_holds_and_nothing_else():
    r = np.random.default_rng(1)
    grams = np.unique(r.integers(0, 40, (3000, 3)) * np.array([1, 7, 11]), axis=0)
    v, u, w = (np.ascontiguousarray(c) for c in grams.T)
    n = r.integers(1, 9, len(v))
    two, at = np.unique(np.stack((v, w), axis=1), axis=0, return_inverse=True)
    n2 = np.bincount(at.ravel(), n).astype(np.int64)
    of_v = np.bincount(v, n, minlength=40).astype(np.int64)
    keep = two[:, 1] % 3 > 0  # the other bigrams belong to another part
    trie = lm.Trie(lm._mapped(lm.Trie.built([two[keep, 0], two[keep, 1], n2[keep], of_v[two[keep, 0]]], [v, u, w, n])))
    asked = r.integers(0, 45, (20000, 3)) * np.array([1, 7, 11])
    weight, left = trie.trigrams(*asked.T)
    bigram = trie.bigrams(asked[:, 0], asked[:, 2])
    held = {tuple(g): c for g, c in zip(grams.tolist(), n.tolist())}
    pairs = Counter()
    for (a, b, _), c in held.items():
        pairs[a, b] += c
    firsts = {tuple(g): c for g, c, k in zip(two.tolist(), n2.tolist(), keep) if k}
    for q, x, y, z in zip(asked.tolist(), lm.weights(weight), lm.weights(left), lm.weights(bigram)):
        pair = pairs[q[0], q[1]]
        assert x == pytest.approx(held.get(tuple(q), 0) / (pair + lm.KAPPA[1]), rel=1e-3)
        assert y == pytest.approx(lm.KAPPA[1] / (pair + lm.KAPPA[1]), rel=1e-3)
        assert z == pytest.approx(firsts.get((q[0], q[2]), 0) / (of_v[q[0]] + lm.KAPPA[0]) if q[0] < 40 else 0, rel=1e-3)
