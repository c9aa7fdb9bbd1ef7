"""Queries with SQL equal it over whole tables; the pipeline against brute force."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001
from riskweave.llm import queries
from riskweave.plans.verify import compare, duckdb_connection
from .test_operators import SHARED, brute_contaminated, prose, shingle_set


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, key):
    res = compare(spark, key, SF001, duckdb_connection(SF001))
    assert res["columns_match"] and res["values_match"], res


def test_every_operator_has_one_query():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    base = prose(80, 1)
    rows = [(1, base), (2, base + "  "), (3, base.replace(" ", "\n")), (4, base + " tail"), (5, "!! 12"), (6, None),
            (7, prose(30, 3) + " " + SHARED), (8, prose(70, 4)), (9, prose(3000, 5)), (10, "one two")]
    docs = spark.createDataFrame([(i, t, "en", "a" if i % 2 else None, len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(1, SHARED)], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    left = [(i, t) for i, t in rows if t and re.search("[a-z]", t)]
    best = {}
    for i, t in left:
        key = re.sub(r"\s", "", t)
        best[key] = min(best.get(key, (0, 10 ** 9)), (-len(t), i))
    left = [(i, t) for i, t in left if best[re.sub(r"\s", "", t)][1] == i]
    sets = {i: shingle_set(t) for i, t in left}
    left = [(i, t) for i, t in left
            if not any(j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j, _ in left)]
    dirty = {i for i, _ in brute_contaminated(left, [(1, SHARED)])}
    want = {i for i, _ in left if i not in dirty}
    got = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in got.collect()} == want
    totals = got.agg(F.sum("taken"), F.sum("size")).first()
    assert abs(totals[0] - 1.5 * totals[1]) <= 2
