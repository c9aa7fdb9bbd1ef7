"""Reports from one scan, bounded top-k, edge state of batches, rejected CSV lines, safe replacement."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskweave.operators import network, report_pass, reports
from riskweave.plans import catalog
from riskweave.sources.tables import read_checked_csv, write_result
from test_features import fact_rows


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_scan_the_fact_once_and_reports_do_not(spark):
    fact = catalog.processed_fact(spark, SF001)
    assert physical(report_pass.report_groups(fact)).count("Scan parquet") == 1
    for key in report_pass.GROUPINGS:
        files = catalog.QUERIES[key](spark, SF001).inputFiles()
        assert files and all("/report_groups/" in f for f in files)


def test_report_groups_keep_null_groups_apart(spark):
    rows = [dict(order_id=i, order_region=r, Supplier_ID=s, Route_Risk_Level=None, Severity=None, sales=1.0)
            for i, (r, s) in enumerate([(None, None), (None, "S1"), ("EU", None), ("EU", "S1")])]
    fact = fact_rows(spark, rows)
    groups = report_pass.report_groups(fact)
    for key in report_pass.GROUPINGS:
        got, want = report_pass.report(groups, key), getattr(reports, key)(fact)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), key


def test_bound_is_pushed_and_keeps_ties(spark, tmp_path):
    rows = [dict(order_id=i, Supplier_Risk_Score=float(i % 50), late_delivery_risk=1, delivery_delay_days=i % 3) for i in range(500)]
    rows += [dict(order_id=900, Supplier_Risk_Score=None, late_delivery_risk=1),
             dict(order_id=901, Supplier_Risk_Score=float("nan"), late_delivery_risk=1)]
    fact_rows(spark, rows).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    top = reports.high_risk_records(fact, 15)
    text = physical(top)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(Supplier_Risk_Score,48.0)" in text
    want = sorted(rows, key=lambda r: (-(r["Supplier_Risk_Score"] if r["Supplier_Risk_Score"] == r["Supplier_Risk_Score"] else 1e9)
                                       if r["Supplier_Risk_Score"] is not None else 1e9,
                                       -r.get("delivery_delay_days", -1), r["order_id"]))
    assert [r.order_id for r in top.collect()] == [r["order_id"] for r in want[:15]]
    assert reports.high_risk_records(fact, 1000).count() == 502
    assert reports.leading_bound(fact, "Supplier_Risk_Score", 501) is None


@pytest.mark.parametrize("values", [[-5.0, -1e300, 3.0, 1e300, 0.0], [2.5] * 9])
def test_bound_is_reached_by_enough_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in range(1, len(values) + 1):
        bound = reports.leading_bound(df, "x", n)
        assert sum(v >= bound for v in values) >= n


def test_edge_state_of_two_halves_equals_the_whole(spark, tmp_path):
    fact = catalog.processed_fact(spark, SF001)
    path = str(tmp_path / "edges")
    first, second = (fact.where(F.col("order_id") % 2 == k) for k in (0, 1))
    network.update_edge_state(path, "a", first)
    network.update_edge_state(path, "b", second)
    network.update_edge_state(path, "b", second)  # run again: replaces itself
    got = network.edges_from_state(network.read_edge_state(spark, path))
    want = network.graph_edges(fact)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    none = network.edges_from_state(network.edge_state(fact_rows(spark, [dict(Supplier_ID="S", Warehouse_ID="W")]))).first()
    assert none.transaction_count == 1 and none.avg_delivery_delay is None


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b,c\n1,2,x\n1,zz,y\n3,4\n5,6,z,7\n,,\n")
    good, bad = read_checked_csv(spark, str(tmp_path / "raw.csv"), "a bigint, b int, c string")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2, "x"), (None, None, None)]
    assert good.select("c").count() == 2
    assert {r.raw_line for r in bad.collect()} == {"1,zz,y", "3,4", "5,6,z,7"}
    assert all(r.file.endswith("raw.csv") for r in bad.select("file").collect()) and bad.count() == 3


def test_failing_write_leaves_the_old_result(spark, tmp_path):
    base = str(tmp_path)
    path = write_result(spark.range(5), base, "result")
    with pytest.raises(Exception):
        write_result(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id")),
                     base, "result")
    assert spark.read.parquet(path).count() == 5 and os.listdir(base) == ["result"]
    # a result may be made from the one that it replaces
    write_result(spark.read.parquet(path).where("id > 2"), base, "result")
    assert spark.read.parquet(path).count() == 2 and os.listdir(base) == ["result"]


def test_observed_counts_and_a_lost_event(spark, monkeypatch):
    from riskweave import scratch
    made = scratch.Scratch(spark, "test-counted")
    table, seen = made.counted(spark.range(9), "a", n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert table.count() == 9 and seen == {"n": 9, "odd": 4}
    assert made.counted(spark.range(9).where("id > 20").limit(0), "b", n=F.count_if(F.col("id") > 1))[1] == {"n": 0}
    monkeypatch.setattr(scratch, "EVENT_SECONDS", -1)
    assert made.counted(spark.range(9), "c", n=F.count(F.lit(1)))[1] == {"n": 9}
    made.clear()
