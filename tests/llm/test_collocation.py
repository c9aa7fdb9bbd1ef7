"""Phrases against plain counting; packing and filters against themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import collocation
from riskweave.llm.collocation import Packing, QuotientFilter, summed


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, top, longest=5):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    often = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    best = {}
    for (lang, words), a in often.items():
        if any(m == lang and b >= a and len(other) > len(words)
               and any(other[i:i + len(words)] == words for i in range(len(other)))
               for (m, other), b in often.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k,
                 counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, rank + 1, p.decode(), -a, left, right, totals[lang], -s)
            for lang, found in best.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top])}


def rows():
    r = random.Random(5)
    common = ["New York City", "state of the art", "é ü", "a a a a a a", "x", "of the", "in spite of the fact"]
    out = [(None, "en"), ("", None), ("  .,", "en")]
    for i in range(400):
        parts = [r.choice(common + ["z%d" % r.randint(0, 30)]) for _ in range(r.randint(1, 40))]
        text = "".join(p + r.choice([" ", "\t", ", ", ".", "\n", "  "]) for p in parts)
        out.append((text, r.choice(["en", "en", None, "und", "de"])))
    return out + out[5:9] * 3


@pytest.mark.parametrize("least,top,block", [(100, 2000, 1 << 20), (5, 7, 50)])
def test_against_counting(spark, monkeypatch, least, top, block):
    monkeypatch.setattr(collocation, "BLOCK_PHRASES", block)
    data = rows()
    docs = spark.createDataFrame([(t, lang, 1, "w", "s", 2) for t, lang in data],
                                 "text string, lang string, doc_id long, words string, shard string, n long").repartition(5)
    got = {tuple(r) for r in collocation.collocations(spark, docs, least=least, top=top).collect()}
    assert got == brute(data, least, top)


def test_tables_without_phrases(spark):
    for data in ([], [(None, None)], [("a b c", "en")] * 3, [("one.two", "en")] * 200):
        docs = spark.createDataFrame(data, "text string, lang string")
        assert collocation.collocations(spark, docs).collect() == []


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 9), (3, 21), (4, 17), (5, 22), (5, 38), (2, 40)])
def test_packing_is_invertible_and_filters_lossless(n, bits):
    r = np.random.default_rng(n * bits)
    ids = [r.integers(0, 1 << min(bits, 12), 3000) << max(0, bits - 12) for _ in range(n)]
    packing = Packing(n, bits)
    keys = packing.keys(ids)
    assert all((a == b.astype(np.int64)).all() for a, b in zip(ids, packing.ids(keys)))
    times = r.integers(1, 3, 3000) ** 12
    distinct, counts = summed(keys, times)
    want = Counter()
    for key, c in zip(zip(*[i.tolist() for i in ids]), times.tolist()):
        want[key] += c
    back, again = QuotientFilter.items(QuotientFilter.built(distinct, packing.widths, counts), packing.widths)
    got = dict(zip(zip(*[i.tolist() for i in packing.ids(back)]), again.tolist()))
    assert got == dict(want)
