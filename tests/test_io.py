"""Sources and sinks: permissive CSV, declared schema, Parquet sink round trip."""

import os
import tempfile

from riskweave.sources.tables import read_raw_csv, write_result


def test_permissive_csv_and_schema(spark):
    d = tempfile.mkdtemp(prefix="riskweave-csv-", dir="/tmp")
    path = os.path.join(d, "raw.csv")
    with open(path, "w") as f:
        f.write("order_id,Warehouse_Status,sales\n")
        f.write(",,\n")                   # fully empty row -> all NULL
        f.write("1,  ,2.5\n")             # whitespace-only string kept
        f.write("2, Active ,abc\n")       # malformed number -> NULL (PERMISSIVE)
    df = read_raw_csv(spark, path, "order_id bigint, Warehouse_Status string, sales double")
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert (None, None, None) in got
    assert (1, "  ", 2.5) in got
    assert (2, " Active ", None) in got
    inferred = read_raw_csv(spark, path)
    assert inferred.count() == 3


def test_parquet_sink_overwrites(spark):
    d = tempfile.mkdtemp(prefix="riskweave-sink-", dir="/tmp")
    df = spark.range(5)
    p = write_result(df, d, "result")
    write_result(spark.range(3), d, "result")
    assert spark.read.parquet(p).count() == 3


def test_register_fact_sql_matches_operator(spark):
    from conftest import SF01
    from riskweave.operators import reports
    from riskweave.plans.catalog import processed_fact
    from riskweave.sources.tables import register_fact
    fact = register_fact(processed_fact(spark, SF01))
    sql = spark.sql("""
        SELECT Supplier_ID, COUNT(*) AS total_orders,
               ROUND(AVG(Supplier_Risk_Score), 2) AS avg_supplier_risk
        FROM supply_chain WHERE Supplier_ID IS NOT NULL GROUP BY Supplier_ID""")
    op = reports.supplier_risk(fact).select("Supplier_ID", "total_orders", "avg_supplier_risk")
    assert sql.count() == op.count() == 100
    assert sql.exceptAll(op).count() == 0
