"""write_all, clean-up of intermediates, log-round components, cyclic PageRank limits."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskweave.operators import graph, reports
from riskweave.operators.components import star_components
from riskweave.plans import catalog, context, results
from riskweave.scratch import Scratch
from riskweave.sources.fact import load_fact
from test_graph import make


def test_write_all_writes_each_result(spark, tmp_path):
    paths = results.write_all(spark, load_fact(spark, SF001), str(tmp_path))
    assert len(paths) == 45 and all(os.path.isdir(p) for p in paths.values())
    assert not [f for f in os.listdir(tmp_path) if f.startswith("_staging")]
    fact = spark.read.parquet(paths["processed_fact"])
    for name in results.REPORTS:
        got, want = (d.withColumns({c: F.round(c, 1) for c, t in d.dtypes if t == "double"})
                     for d in (spark.read.parquet(paths[name]), getattr(reports, name)(fact)))
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count(), name


def test_forget_deletes_tables(spark):
    df = context.shared_table(spark, "/x", "throwaway", lambda: spark.range(5).toDF("n"))
    folder = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    folder = "/" + folder.lstrip("/")
    assert os.path.isdir(folder)
    context.forget(spark, "/x")
    assert not os.path.isdir(folder)


@pytest.mark.parametrize("scrambled", [False, True])
def test_long_paths_need_few_rounds(spark, scrambled):
    ids = list(range(1000))
    if scrambled:
        random.Random(1).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(999)] + [(2000, 2000 + i) for i in range(1, 60)]
    rounds = []
    scratch = Scratch(spark, "test-paths")
    got = star_components(spark.createDataFrame(edges, "src long, dst long"), scratch, on_round=rounds.append).collect()
    assert {r.component for r in got if r.node < 1000} == {0} and {r.component for r in got if r.node >= 2000} == {2000}
    assert rounds[-1] <= 25 and len(scratch.names) == 1


def test_pagerank_that_needs_more_rounds_raises(spark):
    nodes, edges = make(spark, ["a", "b", "c", "d"], [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d")])
    with pytest.raises(RuntimeError):
        graph.pagerank(nodes, edges, max_iter=2)
