"""D1 from mergeable state."""

from conftest import SF001
from pyspark.sql import functions as F

from riskweave.operators import kpi_state, reports
from riskweave.plans import catalog
from test_features import fact_rows


def read(spark, path, *batches):
    return kpi_state.kpis_from_state(kpi_state.read_kpi_state(spark, path, list(batches) or None)).first()


def dictionary(spark, path):
    return spark.read.schema("column string, value string, number bigint").parquet(f"{path}/dictionary")


def test_batches_merged_equal_the_whole(spark, tmp_path):
    fact, path = catalog.processed_fact(spark, SF001), str(tmp_path / "kpi")
    halves = [fact.where(F.col("order_id") % 2 == k) for k in (0, 1)]
    for name, half in zip("ab", halves):
        kpi_state.update_kpi_state(path, name, half)
    want = reports.overall_kpi(fact).first()
    assert read(spark, path) == want
    assert read(spark, path, "a") == reports.overall_kpi(halves[0]).first()
    before = dictionary(spark, path).count()
    kpi_state.update_kpi_state(path, "a", halves[0])  # run again: replaces itself
    assert read(spark, path) == want and dictionary(spark, path).count() == before


def test_dictionary_numbers_are_distinct_and_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kpi_state, "SLOTS", 4)
    path = str(tmp_path / "kpi")
    for k in range(3):  # batches that overlap by half
        kpi_state.update_kpi_state(path, f"b{k}", fact_rows(
            spark, [dict(order_id=i, customer_id=i % 3) for i in range(50 * k, 50 * k + 100)]))
        seen = {(r.column, r.value): r.number for r in dictionary(spark, path).collect()}
        if k:
            assert all(seen[key] == n for key, n in old.items())
        old = seen
    orders = [n for (c, _), n in old.items() if c == "order_id"]
    assert len(orders) == len(set(orders)) == 200 and max(orders) < 4 * 200
    row = read(spark, path)
    assert (row.total_records, row.total_orders, row.total_customers) == (300, 200, 3)
    assert read(spark, path, "b0", "b2").total_orders == 200
    assert read(spark, path, "b0", "b1").total_orders == 150


def test_many_bitmaps(spark, tmp_path):
    path = str(tmp_path / "kpi")
    fact = fact_rows(spark, [dict(order_id=1)]).drop("order_id").crossJoin(
        spark.range(100_000).select((F.col("id") % 70_000).alias("order_id")))
    kpi_state.update_kpi_state(path, "a", fact)
    state = kpi_state.read_kpi_state(spark, path)
    assert state.where("column = 'order_id'").count() > 1
    assert read(spark, path).total_orders == 70_000


def test_nulls_empty_text_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "kpi")
    rows = fact_rows(spark, [dict(order_id=None, product_name=""), dict(order_id=None, product_name=None)])
    kpi_state.update_kpi_state(path, "none", rows.limit(0))
    row = read(spark, path)
    assert row.total_records == 0 and row.total_orders == 0 and row.total_sales is None
    kpi_state.update_kpi_state(path, "some", rows)
    assert read(spark, path) == reports.overall_kpi(rows).first()
    assert read(spark, path).total_products == 1 and read(spark, path).avg_order_quantity is None
