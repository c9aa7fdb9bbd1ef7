"""The supply-chain fact table and its contract.

The reference reads one wide CSV (one row per order line) that is not shipped.
``supply_chain_fact`` derives exactly that contract from the driver's TPC-H-like
tables with deterministic integer rules (see FIXTURES.md §2), so every query's
work grows with ``lineitem``.

Join order is chosen for scale: the small dimensions (customer → nation →
region) are attached to ``orders`` first, so the big ``lineitem`` side is
shuffled only twice (by order key, then by part key). ``nation``/``region`` are
bounded by the schema (25 / 5 rows) and broadcast automatically by size.
lineitem ⋈ orders is a fact-to-fact join and is always planned as a shuffle
(sort-merge) join: without column statistics Spark estimates a join's output
as the product of its inputs, which would otherwise make it broadcast the
*lineitem* side whenever that side is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

# Declared contract of the raw fact (reference domain columns, in order).
FACT_SCHEMA = StructType([
    StructField("order_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("product_name", StringType()),
    StructField("category_name", StringType()),
    StructField("order_region", StringType()),
    StructField("sales", DoubleType()),
    StructField("order_profit_per_order", DoubleType()),
    StructField("order_item_quantity", IntegerType()),
    StructField("delivery_delay_days", LongType()),
    StructField("late_delivery_risk", IntegerType()),
    StructField("delivery_status", StringType()),
    StructField("Supplier_ID", StringType()),
    StructField("Supplier_Performance_Score", DoubleType()),
    StructField("Supplier_Risk_Score", DoubleType()),
    StructField("Warehouse_ID", StringType()),
    StructField("Warehouse_Name", StringType()),
    StructField("Warehouse_City", StringType()),
    StructField("Warehouse_Capacity", LongType()),
    StructField("Current_Inventory", LongType()),
    StructField("Safety_Stock", LongType()),
    StructField("Warehouse_Status", StringType()),
    StructField("DC_ID", StringType()),
    StructField("DC_Name", StringType()),
    StructField("DC_City", StringType()),
    StructField("DC_Capacity", LongType()),
    StructField("Current_Load", LongType()),
    StructField("DC_Status", StringType()),
    StructField("Route_ID", StringType()),
    StructField("Source_Warehouse", StringType()),
    StructField("Destination_ID", StringType()),
    StructField("Distance_KM", DoubleType()),
    StructField("Transport_Mode", StringType()),
    StructField("Route_Risk_Level", StringType()),
    StructField("Event_Type", StringType()),
    StructField("Severity", StringType()),
    StructField("Duration_Days", LongType()),
])

FACT_COLUMNS = tuple(f.name for f in FACT_SCHEMA.fields)

# Fixture rule values (FIXTURES.md §2): multipliers indexed by key modulo.
INVENTORY_MULTIPLIERS = (9, 12, 14, 15, 20)
LOAD_MULTIPLIERS = (8, 10, 14, 15, 17, 18, 20, 24)
TRANSPORT_MODES = ("Road", "Rail", "Air", "Sea")
ROUTE_LEVELS = ("High", "Medium", "Low")
EVENT_TYPES = ("Port Strike", "Flood", "Customs Hold", "Cyber Attack")  # k%10 = 6..9
SEVERITIES = ("High", "Medium", "Low")


def _pick(values: tuple, index: Column) -> Column:
    """``values[index]`` as a lookup in a constant array (folded to a literal,
    so each row does one array access instead of a CASE chain)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _code(prefix: str, key: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def supply_chain_fact(tables: dict[str, DataFrame]) -> DataFrame:
    """Raw fact (contract of SURVEY §1.1) from the driver tables; one row per lineitem."""
    li = tables["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                   "l_quantity", "l_extendedprice", "l_discount")
    orders = tables["orders"].select("o_orderkey", "o_custkey")
    part = tables["part"].select("p_partkey", "p_name", "p_type")
    cust = tables["customer"].select("c_custkey", "c_nationkey")
    nation = tables["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = tables["region"].select("r_regionkey", "r_name")

    geo = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
               .join(region, nation.n_regionkey == region.r_regionkey)
               .select("c_custkey", "c_nationkey", "n_name", "r_name"))
    order_geo = orders.join(geo, orders.o_custkey == geo.c_custkey).drop("c_custkey")
    joined = (li.join(order_geo.hint("merge"), li.l_orderkey == order_geo.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))

    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    sk = F.col("l_suppkey")
    nk = F.col("c_nationkey")
    keyed = joined.select(
        "*",
        k.alias("_k"),
        (sk % 4).alias("_cl"),
        ((sk % 10 + F.col("l_partkey") % 3) % 10).alias("_slot"),
    ).select(
        "*",
        (F.col("_cl") * 10 + F.col("_slot")).alias("_wk"),
        (F.col("_cl") * 4 + (F.col("_slot") + nk % 2) % 4).alias("_dk"),
    ).select(
        "*",
        (F.col("_wk") * 25 + nk).alias("_rk"),
        F.when(F.col("_k") % 53 == 0, F.lit(None).cast("bigint")).otherwise(
            (F.col("l_orderkey") * 13 + F.col("l_partkey") + F.col("l_linenumber") * 5) % 12
            - 4 + sk % 5 + F.when(sk % 10 == 3, F.lit(12)).otherwise(F.lit(0))
        ).alias("_delay"),
        ((sk * 37 + F.col("_k") % 7) % 101).cast("double").alias("_risk"),
    )

    kk, wk, dk, rk, delay = (F.col(c) for c in ("_k", "_wk", "_dk", "_rk", "_delay"))
    has_event = kk % 10 >= 6
    wcode = _code("W", wk, 3)
    fact = keyed.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"),
        F.col("r_name").alias("order_region"),
        F.col("l_extendedprice").alias("sales"),
        (F.col("l_extendedprice") * (F.lit(0.06) - F.col("l_discount"))).alias("order_profit_per_order"),
        F.col("l_quantity").cast("int").alias("order_item_quantity"),
        delay.alias("delivery_delay_days"),
        F.when(delay > 0, 1).otherwise(0).alias("late_delivery_risk"),
        F.when(kk % 41 == 0, "Shipping canceled").when(delay > 0, "Late delivery")
         .when(delay == 0, "Shipping on time").otherwise("Advance shipping").alias("delivery_status"),
        F.when(kk % 97 != 0, _code("S", sk, 5)).alias("Supplier_ID"),
        (F.lit(100.0) - F.col("_risk")).alias("Supplier_Performance_Score"),
        F.col("_risk").alias("Supplier_Risk_Score"),
        F.when(kk % 89 != 0, wcode).alias("Warehouse_ID"),
        F.concat(F.lit("Warehouse "), wk.cast("string")).alias("Warehouse_Name"),
        F.concat(F.lit("City "), (wk % 11).cast("string")).alias("Warehouse_City"),
        F.when(wk % 13 == 0, F.lit(0).cast("bigint")).otherwise(wk * 50 + 1000).alias("Warehouse_Capacity"),
        ((wk + 20) * _pick(INVENTORY_MULTIPLIERS, wk % 5)).alias("Current_Inventory"),
        ((wk + 20) * 10).alias("Safety_Stock"),
        F.when(wk % 4 == 1, "Under Maintenance").when(wk % 4 == 2, " inactive ")
         .otherwise("Active").alias("Warehouse_Status"),
        F.when(kk % 83 != 0, _code("DC", dk, 3)).alias("DC_ID"),
        F.concat(F.lit("DC "), dk.cast("string")).alias("DC_Name"),
        F.concat(F.lit("City "), (dk % 7).cast("string")).alias("DC_City"),
        F.when(dk == 0, F.lit(0).cast("bigint")).otherwise((dk + 25) * 20).alias("DC_Capacity"),
        ((dk + 25) * _pick(LOAD_MULTIPLIERS, dk % 8)).alias("Current_Load"),
        F.when(dk % 5 == 0, "Congested").otherwise("Operational").alias("DC_Status"),
        _code("R", rk, 4).alias("Route_ID"),
        wcode.alias("Source_Warehouse"),
        F.when((kk % 79 != 0) & ((dk + nk) % 4 != 0),
               F.concat(F.col("n_name"), F.lit(" "), F.col("_cl").cast("string"))).alias("Destination_ID"),
        ((rk * 37) % 2000 + 50).cast("double").alias("Distance_KM"),
        _pick(TRANSPORT_MODES, rk % 4).alias("Transport_Mode"),
        F.when(rk % 31 != 0, _pick(ROUTE_LEVELS, rk % 3)).alias("Route_Risk_Level"),
        F.when(has_event, _pick(EVENT_TYPES, kk % 10 - 6)).alias("Event_Type"),
        F.when(has_event, _pick(SEVERITIES, kk % 3)).alias("Severity"),
        F.when(has_event, kk % 21 + 1).alias("Duration_Days"),
    )
    return fact


def load_fact(spark, sf_dir: str) -> DataFrame:
    from .tables import load_tables
    return supply_chain_fact(load_tables(spark, sf_dir))
