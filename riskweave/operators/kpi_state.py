"""Global KPIs (D1) that follow new fact files without reading the old ones.

Exact distinct counts do not add up, so each batch leaves bitmaps: a dictionary
numbers the values of the counted columns, and a batch keeps, for every column,
the set of its numbers as bitmaps of 32768 bits, next to its sums. Batches are
merged by OR-ing bitmaps and adding sums, in any order and any choice of
batches; the averages are derived and never merged.

The dictionary only grows. A value goes to a slot by its hash and gets the next
free number of that slot, so numbers stay dense, no task sees all values, and
what a batch adds lies together in few bitmaps. One batch is written at a time.

A NULL is not counted, as in ``count_distinct``. An empty batch leaves a row of
zero records. A batch that is written again replaces itself and finds its
values numbered already.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..sources.tables import write_result
from .reports import attach_row, r2

#: Counted column -> its KPI.
DISTINCTS = {"order_id": "total_orders", "customer_id": "total_customers", "product_name": "total_products",
             "Supplier_ID": "total_suppliers", "Warehouse_ID": "total_warehouses"}
#: Slots that values are numbered in, fixed for the life of a state.
SLOTS = 4096

_DICTIONARY = "column string, value string, number bigint"
_TOTALS = {"records": "count(1)", "sales": "sum(sales)", "profit": "sum(order_profit_per_order)",
           "quantity": "sum(order_item_quantity)", "quantity_rows": "count(order_item_quantity)",
           "delay": "sum(delivery_delay_days)", "delay_rows": "count(delivery_delay_days)"}


def column_values(fact: DataFrame) -> DataFrame:
    """The distinct values of the counted columns: one scan, combined before
    the shuffle, so a value that a third of the rows hold is sent once a task."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in DISTINCTS])
    return fact.select(F.inline(pairs)).where("value IS NOT NULL").distinct()


def numbered(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary rows for the values that the dictionary lacks."""
    slot = F.pmod(F.xxhash64("value"), F.lit(SLOTS))
    used = (dictionary.groupBy("column", F.pmod("number", F.lit(SLOTS)).alias("slot"))
            .agg((F.max(F.floor(F.col("number") / SLOTS)) + 1).alias("used")))
    fresh = values.join(dictionary, ["column", "value"], "left_anti").withColumn("slot", slot)
    nth = F.row_number().over(W.partitionBy("column", "slot").orderBy("value")) - 1
    return (fresh.withColumn("nth", nth).join(used, ["column", "slot"], "left")
            .select("column", "value",
                    ((F.coalesce("used", F.lit(0)) + F.col("nth")) * SLOTS + F.col("slot")).cast("long").alias("number")))


def value_bitmaps(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The values' numbers as bitmaps, one row per column and bitmap."""
    return (values.join(dictionary, ["column", "value"])
            .groupBy("column", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")))


def _dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DICTIONARY).parquet(f"{path}/dictionary").select("column", "value", "number")


def update_kpi_state(path: str, batch: str, fact: DataFrame) -> None:
    """Add a batch of fact rows to the state under ``path``. Of the fact only
    the batch's rows are read; bitmaps and sums are switched in together."""
    spark = fact.sparkSession
    scratch = Scratch(spark, "kpi-state")
    values = scratch.table(column_values(fact), "values")
    empty = spark.createDataFrame([], _DICTIONARY)
    write_result(empty, f"{path}/dictionary", "part=0")
    fresh = scratch.table(numbered(values, _dictionary(spark, path)), "fresh")
    if not fresh.isEmpty():
        write_result(fresh, f"{path}/dictionary", f"part={uuid.uuid4().hex}")
    bitmaps = value_bitmaps(values, _dictionary(spark, path))
    totals = fact.agg(*[F.expr(m).alias(c) for c, m in _TOTALS.items()])
    write_result(bitmaps.unionByName(totals, allowMissingColumns=True), f"{path}/state", f"batch={batch}")
    scratch.clear()


def read_kpi_state(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    """The state rows of all batches, or of those named."""
    state = spark.read.option("mergeSchema", "false").parquet(f"{path}/state")
    if batches is not None:
        state = state.where(F.col("batch").cast("string").isin(batches))
    return state.drop("batch")


def kpis_from_state(state: DataFrame) -> DataFrame:
    """D1 from the state rows of any number of batches, as one row."""
    sums = state.where("column IS NULL").agg(*[F.sum(c).alias(c) for c in _TOTALS])
    merged = (state.where("column IS NOT NULL").groupBy("column", "bucket")
              .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("values")))
    counts = merged.agg(*[F.coalesce(F.sum(F.when(F.col("column") == c, F.col("values"))), F.lit(0)).alias(name)
                          for c, name in DISTINCTS.items()])

    def mean(total: str) -> F.Column:
        return r2(F.col(total) / F.when(F.col(f"{total}_rows") > 0, F.col(f"{total}_rows")))

    return attach_row(sums, counts).select(
        F.coalesce("records", F.lit(0)).alias("total_records"), *DISTINCTS.values(),
        r2(F.col("sales")).alias("total_sales"), r2(F.col("profit")).alias("total_profit"),
        mean("quantity").alias("avg_order_quantity"), mean("delay").alias("avg_delivery_delay"))
