"""Each operator on a small table with nulls, empty and long texts, ties,
repeated rows and clashing column names, on an empty table, and against brute
force or held-out accuracy."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.llm import (decontam, exact_dedup, langid, mixing, near_dedup, pii, quality, substring, toxicity,
                           warc)
from riskweave.llm.common import Tokens
from riskweave.scratch import Scratch

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, digest string, component string, "
        "entries string, shingles string")
rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(4000)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


BASE = prose(120, 1)
EDITED = " ".join(w if i != 60 else "changed" for i, w in enumerate(BASE.split()))
SHARED = prose(40, 2)
ROWS = [
    (1, BASE), (2, BASE.upper()), (3, EDITED), (4, BASE.replace(" ", "\n")), (5, prose(120, 5)),
    (6, prose(30, 6) + "\n" + SHARED + "\n" + prose(20, 7)), (7, prose(10, 8) + " " + SHARED),
    (8, None), (9, ""), (10, " \t\n"), (11, "one two"), (12, "one two"), (13, "12 34 !!"),
    (14, prose(30000, 9)), (None, "a row without an id"), (None, None), (5, prose(120, 5)),
    (15, "x@y.org " * 3000), (16, "é😀 ü"),
]


def table(spark, rows=ROWS):
    full = [(i, t, ("en", "de", None)[k % 3], ("a", "b", None)[k % 3], len(t or ""), "d", "c", "e", "s")
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


# -- exact dedup ----------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    return groups


def test_exact_dedup(spark):
    got = exact_dedup.ingest(spark, table(spark)).collect()
    assert len(got) == len(ROWS)
    groups = brute_exact(ROWS)
    for norm, members in groups.items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        assert len(mine) == len(members) and {r.group_size for r in mine} == {len(members)}
        assert {r.keep_id for r in mine} == {best[0]} and sum(r.kept for r in mine) == 1


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    kept = exact_dedup.drop_copies(spark, table(spark))
    assert kept.columns == table(spark).columns
    assert kept.count() == len(brute_exact(ROWS))


def test_exact_dedup_against_earlier_batches(spark):
    path = Scratch(spark, "test-index").path("index")
    first = exact_dedup.ingest(spark, table(spark, [(1, "a b"), (2, "c")]), path).collect()
    later = {r.doc_id: r for r in exact_dedup.ingest(spark, table(spark, [(3, "ab"), (4, "d"), (5, "d")]), path).collect()}
    assert all(r.kept for r in first)
    assert (later[3].kept, later[3].keep_id) == (False, 1)
    assert (later[4].kept, later[5].kept, later[5].keep_id) == (True, False, 4)


def test_exact_dedup_batch_that_is_repeated(spark):
    """A batch meets other batches' entries, not its own: a lost result is made again."""
    path = Scratch(spark, "test-index").path("index")
    docs = table(spark, [(1, "a b"), (2, "c"), (3, "a  b"), (None, "c"), (4, "a much longer text " * 9)])

    def run(batch, frame=docs):
        return sorted(map(str, exact_dedup.ingest(spark, frame, path, batch).collect()))
    first = run("monday")
    assert run("monday") == first and sum("kept=True" in x for x in first) == 3
    again = exact_dedup.ingest(spark, docs, path, "tuesday").collect()
    assert not any(x.kept for x in again) and {x.keep_id for x in again} == {2, 3, 4}
    assert run("monday") == first
    entries = spark.read.parquet(path)
    assert entries.count() == entries.select("digest").distinct().count() == 3


def test_exact_dedup_looks_shorter_texts_up_in_the_index(spark):
    """The second part of a batch meets the first one's entries."""
    path = Scratch(spark, "test-index").path("index")
    rows = [(i, prose(20, i)) for i in range(40)]
    docs = table(spark, rows + [(100 + i, t.replace(" ", "  ")) for i, t in rows[:30]])
    index = exact_dedup.DigestIndex(spark, path)
    made = exact_dedup.digests(docs)
    long, short = exact_dedup.parts(made)
    assert long.count() + short.count() == 70
    winners = exact_dedup.winners(long)
    index.append(winners, "b", 0)
    looked_up = exact_dedup.winners(short)
    unknown = index.unknown(looked_up, "b", 1)
    assert unknown.count() < looked_up.count()
    index.close()
    got = exact_dedup.ingest(spark, docs).collect()
    assert {x.doc_id for x in got if x.kept} == set(range(30, 40)) | set(range(100, 130))
    assert all(x.group_size == (1 if 30 <= x.doc_id < 40 else 2) for x in got)


# -- mixing ---------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, budget = {}, set(names), share * sum(sizes.values())
    while free:
        level = budget / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: most * sizes[s] for s in full}
        budget -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_mix_meets_targets(spark):
    r = random.Random(4)
    rows = [(i, prose(r.randint(0, 40), i)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, r.choice(["b", "a", "ä", None, "c"])) for i, t in rows],
                                 "doc_id long, text string, source string")
    got = mixing.mix(spark, docs).collect()
    sizes = Counter()
    for x in got:
        sizes[x.source] += x.size
    want = brute_targets(dict(sizes))
    for s in sizes:
        mine = [x for x in got if x.source == s]
        assert {round(x.target, 6) for x in mine} == {round(want[s], 6)} and {x.source_size for x in mine} == {sizes[s]}
        assert abs(sum(x.taken for x in mine) - want[s]) <= 1
    assert all(0 <= x.taken <= 2 * x.size for x in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(spark, docs).collect()))


def test_mix_edges(spark):
    assert mixing.mix(spark, table(spark)).count() == len(ROWS)
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert {(x.size, x.target, x.taken) for x in mixing.mix(spark, empty).collect()} == {(0, 0.0, 0)}


def test_mix_of_many_equal_rows_without_an_id(spark, monkeypatch):
    """A third of the rows agree in everything: they are cut one by one, and
    no cell holds more than its share."""
    monkeypatch.setattr("riskweave.llm.common.COPIES", 100)
    rows = [(i, prose(12, i), "ab"[i % 2]) for i in range(2000)] + [(None, "one two three", "a")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(spark, docs).collect()
    assert len(got) == 3000
    for s in "ab":
        mine = [x for x in got if x.source == s]
        assert sum(x.taken for x in mine) == round(mine[0].target)
        assert sum(0 < x.part < x.size for x in mine) <= 1
    assert sum(x.doc_id is None and x.size == 3 for x in got) == 1000
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(spark, docs.repartition(5)).collect()))
    sized = mixing.sized(docs).groupBy("source", "key", "doc_id", "size").count()
    cells = sized.where("source = 'a'").groupBy(F.floor(F.col("key") / F.lit(float(1 << 60)) * 45)).count()
    assert cells.agg(F.max("count")).first()[0] < 100


# -- personal data --------------------------------------------------------

BASE_PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                 ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                 ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_pii(text):
    spans = []
    for rank, (kind, pattern) in enumerate(BASE_PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and not (14 <= len(digits) <= 19 and brute_luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s[2] for s in sorted(spans))


def test_pii_against_regular_expressions(spark):
    r = random.Random(5)
    pieces = ["a", "B", "7", "0", "1", ".", ".", "@", "-", " ", "+", "_", "(", ")", "é", "😀", "\n", "1.2.3.4", "a@b.c",
              "4845168114407329", "+1 (702) 555-0742", "..", "x@", "256.1.1.1", "4111 1111 1111 1111"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "1 " * 20000, "a@" + "b." * 20000 + "c", "1." * 20000, "x" * 100000, "9" * 20000]
    got = pii.summary(pii.find_spans(table(spark, list(enumerate(texts))))).collect()
    assert len(got) == len(texts)
    for x in got:
        assert x.base_sha256 == hashlib.sha256(brute_pii(texts[x.doc_id] or "").encode()).hexdigest()


def test_pii_checksums_and_context(spark):
    rows = [(1, "iban GB82 WEST 1234 5698 7654 32."), (2, "GB83 WEST 1234 5698 7654 32"),
            (3, "ssn 123-45-6789"), (4, "123-45-6789")]
    got = {x.doc_id: x.spans for x in pii.find_spans(table(spark, rows)).collect()}
    assert [(s.kind, s.start, s.end, s.score, s.text) for s in got[1]] == \
        [("iban", 5, 32, 1.0, "GB82 WEST 1234 5698 7654 32")]
    assert got[2] == [] and got[4] == [] and got[3][0].kind == "ssn"


def test_drop_copies_deletes_what_is_read_no_more(spark, monkeypatch, tmp_path):
    """An index of its own goes with the run, one with a path stays."""
    made = []
    monkeypatch.setattr(exact_dedup, "Scratch", lambda *a: made.append(Scratch(*a)) or made[-1])
    rows = [(1, "a b"), (2, "ab"), (3, "c")]
    for path in (None, str(tmp_path / "index")):
        made.clear()
        kept = exact_dedup.drop_copies(spark, table(spark, rows), path)
        assert [sorted(x.names) for x in made if x.names] == [["kept"]]
        assert sum(os.path.exists(x.base.removeprefix("file:")) for x in made) == 1
        assert sorted(x.doc_id for x in kept.collect()) == [1, 3]
    assert os.listdir(tmp_path / "index")


# -- near duplicates ------------------------------------------------------

def shingle_set(text):
    w = words((text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def test_near_dedup(spark):
    got = {x.doc_id: x for x in near_dedup.classes(spark, table(spark)).collect() if x.doc_id is not None}
    assert {got[i].class_id for i in (1, 2, 3, 4)} == {1} and got[3].class_size == 4
    assert {got[i].class_id for i in (8, 9, 10)} == {8} and got[12].class_id == 11
    assert all(got[i].class_id == i for i in (5, 6, 7, 13, 14, 15, 16))
    kept = near_dedup.drop_near_copies(spark, table(spark))
    assert kept.columns == table(spark).columns
    assert sorted(x.doc_id for x in kept.select("doc_id").distinct().where("doc_id IS NOT NULL").collect()) == \
        [1, 5, 6, 7, 8, 11, 13, 14, 15, 16]


def test_near_dedup_group_against_all_pairs(spark):
    """One large group of edited copies: classes equal the components over all pairs."""
    r = random.Random(6)
    base = prose(146, 60).split()
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4, 6, 9])):
            w[r.randrange(len(w))] = r.choice(VOCABULARY[:40])
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark, table(spark, rows)).collect()}
    sequences = [near_dedup.shingle_sequence(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))
             if near_dedup.similarity(sequences[a], sequences[b]) >= 0.8]
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    lost = [(a, b) for a, b in links if got[a] != got[b]]
    assert not lost
    assert all(find(i) == got[i] for i in got)


def test_near_dedup_pair_of_two_outside_texts_in_overlapping_buckets(spark):
    """Text 4 lies outside in bucket 1, whose texts are all long, and inside in
    bucket 2, where the shorter text 5 (a part of it) lies outside."""
    r = random.Random(11)

    def fresh(n):
        return [f"w{r.getrandbits(48):x}" for _ in range(n)]
    a, head, tail = fresh(1004), fresh(100), fresh(910)
    p, x = head + a[100:], a[:104] + tail
    texts = {1: p, 2: p[:-2], 3: p[:-4], 4: a, 5: a[:854], -4: x, -3: x[:-1], -2: x[:-2], -1: x[:-3]}
    buckets = {1: [-4, -3, -2, -1, 4], 2: [1, 2, 3, 4, 5]}
    members = [(k, i, reps[0], len(texts[i]) - 4, (len(texts[reps[0]]) - 4) * 0.8) for k, reps in buckets.items() for i in reps]
    sequences = {i: near_dedup.shingle_sequence(" ".join(w)) for i, w in texts.items()}
    similar = {(i, j) for i in texts for j in texts if i < j and near_dedup.similarity(sequences[i], sequences[j]) >= 0.8}
    assert [c for c in similar if 5 in c] == [(4, 5)]
    search = near_dedup._links(
        Scratch(spark, "test-links"),
        spark.createDataFrame(members, "key long, rep long, pivot long, shingles int, least_shingles double"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "rep long, text string"), 0.8)
    assert {x.rep: x.component for x in search.roots.collect()} == \
        {-4: -4, -3: -4, -2: -4, -1: -4, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_near_dedup_of_repeated_ids(spark):
    """A row is classed and dropped by its own text, whatever its id."""
    a, b, c, d = prose(120, 20), prose(120, 21), prose(120, 22), prose(120, 23)
    near = {t: " ".join(t.split()[:-1]) for t in (a, b, c, d)}
    rows = [(5, a), (5, b), (5, c), (3, a), (7, near[b]), (8, near[c]), (5, d), (5, d), (5, d.upper())]
    got = near_dedup.classes(spark, table(spark, rows)).collect()
    assert Counter((x.doc_id, x.class_id, x.class_size, x.kept) for x in got) == Counter(
        [(5, 3, 2, False), (3, 3, 2, True), (5, 5, 2, True), (7, 5, 2, False), (5, 5, 2, True), (8, 5, 2, False),
         (5, 5, 3, True), (5, 5, 3, False), (5, 5, 3, False)])
    kept = [(x.doc_id, x.text.lower()) for x in near_dedup.drop_near_copies(spark, table(spark, rows)).collect()]
    assert sorted(kept) == sorted([(3, a), (5, b), (5, c), (5, d)])


def test_near_dedup_of_rows_without_an_id(spark):
    """They are classed by their texts, and come after any id."""
    a, b = prose(120, 30), prose(120, 31)
    rows = [(None, a), (None, a), (None, a.upper()), (None, a + " more"), (9, b), (None, b + " end"), (None, "alone"), (None, None)]
    got = near_dedup.classes(spark, table(spark, rows)).collect()
    assert Counter((x.doc_id, x.class_id, x.class_size, x.kept) for x in got) == Counter(
        [(None, None, 4, True)] + [(None, None, 4, False)] * 3 + [(9, 9, 2, True), (None, 9, 2, False)]
        + [(None, None, 1, True)] * 2)
    kept = [x.text for x in near_dedup.drop_near_copies(spark, table(spark, rows)).collect()]
    assert len(kept) == 4 and {b, "alone", None} < set(kept)


@pytest.mark.parametrize("task_links", [0, 1000])
def test_components_in_one_task_or_in_rounds(spark, task_links):
    links = spark.createDataFrame([(5, 3), (3, 9), (7, 8), (8, 7)], "a long, b long")
    got = near_dedup.components(links, Scratch(spark, "test-links"), task_links).collect()
    assert sorted(map(tuple, got)) == [(3, 3), (5, 3), (7, 7), (8, 7), (9, 3)]


def written(monkeypatch, cls=Scratch):
    """The names of the tables written from here on."""
    names, table = [], cls.table
    monkeypatch.setattr(cls, "table", lambda self, df, name: names.append(name) or table(self, df, name))
    return names


def test_links_in_many_small_files_are_joined_without_rounds(spark, monkeypatch):
    """Tasks follow the number of links: the links of 40 tasks fit in one, which
    leaves stars; links that repeat do not start another round."""
    pairs = [(i, i + 1) for i in range(0, 200)] + [(i + 1, i) for i in range(0, 200)] + [(900, 901)]
    links = Scratch(spark, "test-links").table(
        spark.createDataFrame(pairs, "a long, b long").repartition(40), "links")
    names = written(monkeypatch)
    got = {x.rep: x.component for x in near_dedup.components(links, Scratch(spark, "test-links"), 1000).collect()}
    assert got == {i: 0 for i in range(201)} | {900: 900, 901: 900}
    assert len(names) == 2
    rounds = {x.rep: x.component for x in near_dedup.components(links, Scratch(spark, "test-links"), 50).collect()}
    assert rounds == got and len(names) > 4


def test_near_dedup_deletes_what_is_read_no_more(spark, monkeypatch):
    """What the search writes is gone when the classes are known, and the
    filter keeps its list of rows only."""
    made = []
    monkeypatch.setattr(near_dedup, "Scratch", lambda *a: made.append(Scratch(*a)) or made[-1])
    a = prose(120, 41)
    rows = [(1, a), (2, a + " end"), (3, a + " more"), (4, prose(120, 42))]
    got = near_dedup.classes(spark, table(spark, rows))
    assert set().union(*(s.names for s in made)) == {"classed", "sizes"}
    assert {x.doc_id: x.class_id for x in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    made.clear()
    kept = near_dedup.drop_near_copies(spark, table(spark, rows))
    assert set().union(*(s.names for s in made)) == {"listed"}
    assert sorted(x.doc_id for x in kept.collect()) == [1, 4]


def test_alignment_is_longest_common_subsequence():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1 if x == y else 0)
        return row[-1]
    r = random.Random(7)
    for _ in range(200):
        a = [r.choice("abcd") for _ in range(r.randint(0, 30))]
        b = [r.choice("abcd") for _ in range(r.randint(0, 30))]
        assert near_dedup.aligned(a, b, 40) == lcs(a, b)


# -- language -------------------------------------------------------------

def language_rows(n):
    r = random.Random(8)
    vowels = {"en": "aei", "de": "oüu"}
    return [(i, " ".join("".join(r.choice("bdfg") + r.choice(vowels[lang]) for _ in range(r.randint(1, 3)))
                         for _ in range(60)), lang) for i in range(n) for lang in [("en", "de")[i % 2]]]


def test_language_of_held_out_documents_and_edges(spark):
    rows = language_rows(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, langid.training_rows(F.col("doc_id")))
    got = {x.doc_id: x for x in langid.label(docs, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    odd = {x.doc_id: x for x in langid.label(table(spark), model).collect() if x.doc_id}
    assert langid.label(table(spark), model).count() == len(ROWS)
    assert {odd[i].lang_pred for i in (8, 9, 10, 13)} == {"und"} and odd[8].score == 0.0
    assert all(0 <= x.score <= 1 for x in odd.values())
    mixed = spark.createDataFrame([(1, rows[0][1] + " " + rows[1][1] * 3)], "doc_id long, text string")
    shares = langid.label(mixed, model).first().shares
    assert 0.15 < shares["en"] < 0.35 and abs(sum(shares.values()) - 1) < 1e-6


def test_language_filter_keeps_code_switched_documents(spark):
    r = random.Random(12)
    vowels = {"de": "oüu", "en": "aei", "fr": "éèê"}

    def text(lang, n):
        return " ".join("".join(r.choice("bdfg") + r.choice(vowels[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(lang, 60), lang) for i in range(150) for lang in [("en", "de", "fr")[i % 3]]]
    rows += [(500, text("en", 80) + " " + text("de", 70) + " " + text("fr", 50), None),
             (501, text("en", 96) + " " + text("de", 94) + " " + text("fr", 10), None), (502, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, langid.training_rows(F.col("doc_id")))
    mixed = docs.where("doc_id >= 500")
    assert all(x.score < 0.5 for x in langid.label(mixed, model).collect())
    kept = langid.keep_identified(spark, docs)
    assert {x.doc_id for x in kept.where("doc_id >= 500").collect()} == {500, 501} and kept.count() == 152
    spans = {x.doc_id: [tuple(s) for s in x.spans] for x in langid.label_words(mixed, model).collect()}
    assert spans == {500: [("en", 0, 80), ("de", 80, 150), ("fr", 150, 200)],
                     501: [("en", 0, 96), ("de", 96, 190), ("fr", 190, 200)], 502: []}


def test_blocks_pass_exact_messages():
    import numpy as np
    r = np.random.default_rng(1)
    psi, move = r.random((1000, 3)) + 0.01, np.exp(r.random((3, 3)))
    ptr = np.array([0, 5, 5, 300, 1000])
    sums = langid.document_shares(psi, ptr, move, np.ones(1000))
    for d in (0, 2, 3):
        p, _ = langid._marginals(psi[None, ptr[d]:ptr[d + 1]], move)
        assert np.allclose(p[0].sum(axis=0), sums[d])


# -- toxicity and quality -------------------------------------------------

def test_toxicity_finds_held_out_documents(spark):
    r = random.Random(9)
    toxic = {i for i in range(600) if i % 5 == 0}
    rows = [(i, " ".join([prose(30, i), "vilewordx" if i in toxic else "plain", prose(5, -i)])) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(600)] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    docs = table(spark, rows)
    model = toxicity.fit(docs, labels, toxicity.training_rows(F.col("doc_id")))
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    assert sum(got[i].predicted == int(i in toxic) for i in got) >= 0.97 * len(rows)
    edges = toxicity.score(table(spark), model).collect()
    assert len(edges) == len(ROWS) and all(0 <= x.score <= 1 for x in edges)
    none = toxicity.fit(docs, labels.where("toxic = 0"), toxicity.training_rows(F.col("doc_id")))
    assert {x.score for x in toxicity.score(docs.limit(3), none).collect()} == {0.0}


def test_resampling_takes_exactly_the_largest_keys(spark):
    rows = [(i, prose(40, i) if i % 4 else " ".join(w + "###" for w in prose(40, i).split())) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(100)], "doc_id long, quality int")
    got = quality.resample(spark, table(spark, rows), labels, k=60).collect()
    best = sorted(got, key=lambda x: (-x.key, x.doc_id))[:60]
    assert {x.doc_id for x in got if x.selected} == {x.doc_id for x in best}
    assert all(x.doc_id % 4 for x in best)
    assert quality.resample(spark, table(spark), labels).count() == len(ROWS)


def test_resampling_draws_equal_rows_one_by_one(spark, monkeypatch):
    """A third of the rows agree in everything and have no id; keys differ all
    the same, and another partitioning draws the same sample."""
    monkeypatch.setattr("riskweave.llm.common.COPIES", 50)
    rows = [(i, prose(20, i)) for i in range(400)] + [(None, prose(20, 1))] * 150 + [(7, "same")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(300)], "doc_id long, quality int")  # all weights are 0
    got = quality.resample(spark, docs, labels, k=240).collect()
    assert len(got) == len({x.key for x in got}) == 600 and sum(x.selected for x in got) == 240
    lost = [x for x in got if x.doc_id is None]
    assert len(lost) == 150 and 0 < sum(x.selected for x in lost) < 150
    again = quality.resample(spark, docs.repartition(7), labels, k=240).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_ngram_weights_by_plain_counting(spark):
    """Log ratios equal those of counted n-grams, bucket by bucket."""
    rows = [(i, prose(30, i) if i % 3 else prose(30, i) + " !! zz") for i in range(60)]
    docs = spark.createDataFrame(rows + [(None, "zz zz"), (99, None)], "doc_id long, text string")
    good = {i for i, _ in rows if i % 3 == 0}
    raw, target = Counter(), Counter()
    for i, text in rows + [(None, "zz zz")]:
        t = Tokens(pa.array([text]), punctuation=True)
        buckets, _ = quality.ngram_buckets(t)
        w = re.findall(r"[!-/:-@\[-`{-~]+|[^\s!-/:-@\[-`{-~]+", text)
        assert len(buckets) == 2 * len(w) - 1
        raw.update(buckets.tolist())
        if i in good:
            target.update(buckets.tolist())
    got = quality.log_ratios(docs, spark.createDataFrame([(i,) for i in good], "doc_id long"))
    n, m = sum(target.values()) + quality.BUCKETS, sum(raw.values()) + quality.BUCKETS
    for b in range(quality.BUCKETS):
        assert abs(got[b] - (math.log((target[b] + 1) / n) - math.log((raw[b] + 1) / m))) < 1e-9


def test_target_model_counts_all_good_documents(spark):
    """Where every document is good, target and corpus are alike."""
    rows = [(i, f"w{i % 97} v{i % 89} u{i}") for i in range(21000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert not quality.log_ratios(docs, docs.select("doc_id")).any()
    got = quality.resample(spark, docs, docs.select("doc_id", F.lit(1).alias("quality")), k=10)
    assert got.where("log_weight <> 0").count() == 0 and got.where("selected").count() == 10


# -- decontamination ------------------------------------------------------

def brute_contaminated(rows, items):
    found = set()
    for i, text in rows:
        w = [re.sub(r"[!-/:-@\[-`{-~]", "", x) for x in words((text or "").lower())]
        w = [x for x in w if x]
        for item, passage in items:
            p = words(passage)
            bag = Counter(tuple(p[k:k + 5]) for k in range(max(1, len(p) - 4)))
            for a in range(max(1, len(w) - len(p) + 1)):
                x = w[a:a + len(p)]
                mine = Counter(tuple(x[k:k + 5]) for k in range(max(1, len(x) - 4)))
                shared = sum((bag & mine).values())
                if x and shared >= 0.8 * (sum(bag.values()) + sum(mine.values()) - shared):
                    found.add((i, item))
                    break
    return found


def test_decontamination_against_all_windows(spark):
    items = [(1, prose(25, 70)), (2, prose(40, 71)), (3, prose(3, 72)), (4, SHARED), (5, prose(60, 73))]
    long = words(items[4][1])
    rows = [(i, prose(200, 80 + i)) for i in range(20)]
    rows += [(30, prose(50, 1) + "\n" + items[0][1].upper().replace(" ", ", ") + "! " + prose(9, 2)),
             (31, " ".join(words(items[1][1])[1:]) + " " + prose(20, 3)), (32, items[2][1]),
             (33, prose(4, 5) + " " + items[2][1]), (34, " ".join(long[:30] + ["swapped"] + long[31:])),
             (35, " ".join(long[:30])), (36, None), (37, "")]
    benchmark = spark.createDataFrame(items + [(6, None), (7, ""), (8, "!!")], "item_id long, text string")
    got = decontam.contaminated(spark, table(spark, rows), benchmark).collect()
    assert {(x.doc_id, x.item_id) for x in got} == brute_contaminated(rows, items)
    assert decontam.clean(spark, table(spark), benchmark).count() == len(ROWS) - 2
    assert decontam.contaminated(spark, table(spark), benchmark.limit(0)).count() == 0


def edited(item, kind, r):
    """The item with a run of words replaced, or None if the kind does not fit."""
    w = list(item)
    n = max(1, int(len(w) * r.uniform(0.06, 0.11)))
    at = {"head": 0, "middle": r.randrange(1, len(w) - n), "tail": len(w) - n, "repeated": len(w) - n}[kind]
    if kind == "repeated":
        item[at:] = ["again"] * n
    w[at:at + n] = [f"new{r.getrandbits(30)}" for _ in range(n)]
    return w


@pytest.mark.parametrize("kind", ["head", "middle", "tail", "repeated"])
def test_decontamination_recall_of_edited_items(kind):
    """Items of 30 to 80 words with one edit that leaves a similarity of 0.8 to 0.86."""
    r = random.Random(5)
    items, texts = [], []
    while len(items) < 300:
        item = [f"w{r.getrandbits(30)}" for _ in range(r.randint(30, 80))]
        w = edited(item, kind, r)
        bags = [Counter(tuple(x[k:k + 5]) for k in range(len(x) - 4)) for x in (item, w)]
        if 0.8 <= decontam.similarity(*bags) <= 0.86:
            items.append((len(items), " ".join(item)))
            texts.append(f"{prose(30, len(items))} {' '.join(w)} {prose(30, -len(items))}")
    found = decontam.matches(pa.array(texts), decontam.ItemIndex(items))
    assert sum(d == i for d, i, *_ in found) >= 0.95 * len(items)


def test_fingerprints_of_labelled_shingles():
    """Sliding sums equal the fingerprint of each window by itself."""
    r = random.Random(8)
    text = " ".join(r.choice("abc") if r.random() < 0.7 else "x x x x x x x" for _ in range(300))
    t = Tokens(pa.array([text]))
    h = t.hashes()
    spans = [(a, a + n) for n in (1, 3, 4, 5, 6, 20, 77) for a in range(0, len(h) - n)]
    starts, ends = (np.array(x) for x in zip(*spans))
    got = decontam.fingerprints(h, starts, ends)
    for k, (a, b) in enumerate(spans):
        g = decontam.shingles(h[a:b])
        assert (got[k] == decontam._labelled_print(g)).all()


def test_decontamination_decides_row_by_row(spark, monkeypatch):
    """Neither a null id nor a repeated one takes clean rows along."""
    monkeypatch.setattr(decontam, "PASS_ITEMS", 1)
    items = [(1, prose(25, 70)), (2, prose(40, 71)), (3, prose(30, 72))]
    rows = [(None, prose(50, 1)), (None, items[0][1]), (4, prose(50, 2)), (4, prose(9, 3) + " " + items[1][1]),
            (4, items[2][1] + " " + prose(9, 4)), (None, None), (None, items[2][1])]
    docs = table(spark, rows)
    got = decontam.clean(spark, docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.schema == docs.schema
    assert Counter((x.doc_id, x.text) for x in got.collect()) == Counter(rows[i] for i in (0, 2, 5))


# -- WARC -----------------------------------------------------------------

PAGES = [(3, "http://a/é x", "<p>" + "é" * 100), (1, None, "<p>" + "é" * 100), (2, "u", ""), (4, "u", None),
         (5, "u", "short"), (6, "v\r\nWARC/1.1", "short"), (None, "w", "<p>" + "é" * 100), (7, "z", "q" * 300000),
         (1, None, "<p>" + "é" * 100)]


@pytest.mark.parametrize("range_bytes", [50, 1 << 20])
def test_warc_round_trip(spark, range_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    scratch = Scratch(spark, "test-warc")
    manifest = warc.write_archive(spark, pages, scratch.path("archive"), scratch)
    got = warc.read_archive(spark, manifest, scratch.path("archive"), range_bytes).collect()
    assert len(got) == len(PAGES)
    assert Counter((x.page_id, x.payload_digest) for x in got) == Counter(
        (i, hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in PAGES)
    by = {(x.page_id, x.record_type): x for x in got}
    assert by[3, "revisit"].refers_to == 1 and by[None, "revisit"].refers_to == 1
    assert sum(x.record_type == "response" for x in got) == 7
    assert by[7, "response"].payload.decode() == "q" * 300000 and by[3, "revisit"].payload_bytes == 203


# -- repeated passages ----------------------------------------------------

def brute_repeats(rows):
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k:k + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def test_repeated_passages_against_all_windows(spark):
    r = random.Random(10)
    passages = [prose(n, 90 + n) for n in (12, 13, 14, 20, 55)]
    rows = list(ROWS) + [(100 + i, " ".join(x for _ in range(3) for x in (prose(r.randint(0, 20), 500 + 7 * i),
                                                                         r.choice(passages)))) for i in range(80)]
    got = substring.remove_repeats(spark, table(spark, rows)).collect()
    assert Counter((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == Counter(brute_repeats(rows))


# -- empty tables ---------------------------------------------------------

def test_empty_tables(spark):
    docs = table(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    benchmark = spark.createDataFrame([(1, SHARED)], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    scratch = Scratch(spark, "test-empty")
    model = langid.fit(docs, langid.training_rows(F.col("doc_id")))
    manifest = warc.write_archive(spark, pages, scratch.path("archive"), scratch)
    for result in (exact_dedup.ingest(spark, docs), exact_dedup.drop_copies(spark, docs), mixing.mix(spark, docs),
                   near_dedup.classes(spark, docs), near_dedup.drop_near_copies(spark, docs),
                   langid.label(docs, model), langid.keep_identified(spark, docs),
                   toxicity.score(docs, toxicity.fit(docs, labels, toxicity.training_rows(F.col("doc_id")))),
                   quality.resample(spark, docs, labels), decontam.contaminated(spark, docs, benchmark),
                   pii.summary(pii.find_spans(docs)), substring.remove_repeats(spark, docs),
                   warc.read_archive(spark, manifest, scratch.path("archive"))):
        assert result.count() == 0
