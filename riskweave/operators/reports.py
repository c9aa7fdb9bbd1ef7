"""Aggregate business reports over the processed fact (operators D1–D14).

Every report is one ``groupBy``/``agg`` (partial + final hash aggregation, so a
hot key is pre-combined map-side before the shuffle). Global totals are
computed as one-row aggregates and attached with a broadcast join of that
single row. The reference's presentation ``ORDER BY`` before a write is dropped;
sorting is kept only where a ``LIMIT`` makes it the feature (top-k), and every
top-k carries full tie-breakers so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.levels import dec, ratio_or_null


def r2(c: Column) -> Column:
    return F.round(c, 2)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row.

    The right side is a global aggregate, so it has exactly one row: broadcasting
    it is bounded regardless of data size.
    """
    return df.join(F.broadcast(one_row), how="inner")


def _delivery_measures() -> list[Column]:
    return [
        r2(F.avg("delivery_delay_days")).alias("avg_delivery_delay"),
        r2(F.avg("late_delivery_risk")).alias("avg_late_delivery_risk"),
    ]


def overall_kpi(fact: DataFrame) -> DataFrame:
    """Global KPIs. The five exact distinct counts are separate single-distinct
    aggregates (each a two-phase dedup on one column) instead of one ``Expand``
    that would replicate every fact row six times."""
    base = fact.agg(
        F.count(F.lit(1)).alias("total_records"),
        r2(F.sum("sales")).alias("total_sales"),
        r2(F.sum("order_profit_per_order")).alias("total_profit"),
        r2(F.avg("order_item_quantity")).alias("avg_order_quantity"),
        r2(F.avg("delivery_delay_days")).alias("avg_delivery_delay"),
    )
    distincts = [("order_id", "total_orders"), ("customer_id", "total_customers"),
                 ("product_name", "total_products"), ("Supplier_ID", "total_suppliers"),
                 ("Warehouse_ID", "total_warehouses")]
    out = base
    for col_name, alias in distincts:
        out = attach_row(out, fact.agg(F.count_distinct(col_name).alias(alias)))
    return out.select("total_records", "total_orders", "total_customers", "total_products",
                      "total_suppliers", "total_warehouses", "total_sales", "total_profit",
                      "avg_order_quantity", "avg_delivery_delay")


def delivery_performance(fact: DataFrame) -> DataFrame:
    """Shipments per status and share of all shipments (NULL status kept)."""
    grouped = fact.groupBy("delivery_status").agg(F.count(F.lit(1)).alias("total_shipments"))
    total = grouped.agg(F.sum("total_shipments").alias("_total"))
    share = F.round(F.col("total_shipments") * dec("100.0") / F.col("_total"), 2)
    return attach_row(grouped, total).select(
        "delivery_status", "total_shipments", share.cast("double").alias("percentage"))


def region_analysis(fact: DataFrame) -> DataFrame:
    """D3: per order region (NULL region kept as a group)."""
    return fact.groupBy("order_region").agg(
        F.count(F.lit(1)).alias("total_orders"),
        r2(F.sum("sales")).alias("total_sales"),
        r2(F.sum("order_profit_per_order")).alias("total_profit"),
        *_delivery_measures(),
    )


def _supplier_groups(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("Supplier_ID").isNotNull()).groupBy("Supplier_ID")


def supplier_risk(fact: DataFrame) -> DataFrame:
    """Per supplier."""
    return _supplier_groups(fact).agg(
        F.count(F.lit(1)).alias("total_orders"),
        r2(F.avg("Supplier_Performance_Score")).alias("avg_supplier_performance"),
        r2(F.avg("Supplier_Risk_Score")).alias("avg_supplier_risk"),
        r2(F.avg("late_delivery_risk")).alias("avg_late_delivery_risk"),
        r2(F.avg("delivery_delay_days")).alias("avg_delivery_delay"),
        r2(F.sum("sales")).alias("total_sales"),
    )


def top_high_risk_suppliers(fact: DataFrame, n: int = K.TOP_SUPPLIERS_N) -> DataFrame:
    """Top-n suppliers by rounded average risk (ties by id)."""
    grouped = _supplier_groups(fact).agg(
        r2(F.avg("Supplier_Performance_Score")).alias("supplier_performance"),
        r2(F.avg("Supplier_Risk_Score")).alias("supplier_risk"),
        F.count(F.lit(1)).alias("affected_orders"),
    )
    return grouped.orderBy(F.col("supplier_risk").desc_nulls_last(),
                           F.col("Supplier_ID").asc_nulls_last()).limit(n)


WAREHOUSE_ATTRS = ("Warehouse_ID", "Warehouse_Name", "Warehouse_City", "Warehouse_Capacity",
                   "Current_Inventory", "Safety_Stock", "Warehouse_Status")
DC_ATTRS = ("DC_ID", "DC_Name", "DC_City", "DC_Capacity", "Current_Load", "DC_Status")


def _percent_of(amount: Column, capacity: Column) -> Column:
    """round(amount * 100.0 / NULLIF(capacity, 0), 2) in exact decimal, as DOUBLE."""
    return F.round(ratio_or_null(amount * dec("100.0"), capacity), 2).cast("double")


def warehouse_inventory(fact: DataFrame) -> DataFrame:
    """One row per distinct warehouse attribute combination."""
    inv, safety = F.col("Current_Inventory"), F.col("Safety_Stock")
    f1, f2 = (dec(x) for x in K.WAREHOUSE_REPORT_FACTORS)
    l0, l1, l2 = K.WAREHOUSE_REPORT_LABELS
    risk = (F.when(inv < safety, l0).when(inv < safety * f1, l1)
             .when(inv < safety * f2, l2).otherwise(K.WAREHOUSE_REPORT_ELSE))
    distinct = (fact.where(F.col("Warehouse_ID").isNotNull())
                    .select(*WAREHOUSE_ATTRS).distinct())
    return distinct.select(
        *WAREHOUSE_ATTRS,
        _percent_of(inv, F.col("Warehouse_Capacity")).alias("inventory_utilization"),
        risk.alias("inventory_risk"),
    )


def distribution_center_load(fact: DataFrame) -> DataFrame:
    """One row per distinct DC attribute combination."""
    load, cap = F.col("Current_Load"), F.col("DC_Capacity")
    f1, f2 = (dec(x) for x in K.DC_REPORT_FACTORS)
    l0, l1, l2 = K.DC_REPORT_LABELS
    risk = (F.when(load >= cap, l0).when(load >= cap * f1, l1)
             .when(load >= cap * f2, l2).otherwise(K.DC_REPORT_ELSE))
    distinct = fact.where(F.col("DC_ID").isNotNull()).select(*DC_ATTRS).distinct()
    return distinct.select(
        *DC_ATTRS,
        _percent_of(load, cap).alias("dc_utilization"),
        risk.alias("load_risk"),
    )


def route_risk(fact: DataFrame) -> DataFrame:
    """Per (route, mode, level); route not NULL."""
    return (fact.where(F.col("Route_ID").isNotNull())
                .groupBy("Route_ID", "Transport_Mode", "Route_Risk_Level")
                .agg(r2(F.avg("Distance_KM")).alias("avg_distance_km"),
                     F.count(F.lit(1)).alias("total_shipments"),
                     *_delivery_measures()))


def transport_mode(fact: DataFrame) -> DataFrame:
    """Per transport mode; mode not NULL."""
    return (fact.where(F.col("Transport_Mode").isNotNull())
                .groupBy("Transport_Mode")
                .agg(F.count(F.lit(1)).alias("total_shipments"),
                     r2(F.avg("Distance_KM")).alias("avg_distance_km"),
                     *_delivery_measures(),
                     r2(F.sum("sales")).alias("total_sales")))


def _sales_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_orders"),
            r2(F.sum("sales")).alias("total_sales"),
            r2(F.sum("order_profit_per_order")).alias("total_profit"),
            *_delivery_measures()]


def product_performance(fact: DataFrame, n: int = K.TOP_PRODUCTS_N) -> DataFrame:
    """Top-n (product, category) by rounded sales; ties by name."""
    grouped = (fact.where(F.col("product_name").isNotNull())
                   .groupBy("product_name", "category_name").agg(*_sales_measures()))
    return grouped.orderBy(F.col("total_sales").desc_nulls_last(),
                           F.col("product_name").asc_nulls_last(),
                           F.col("category_name").asc_nulls_last()).limit(n)


def category_performance(fact: DataFrame) -> DataFrame:
    """Per category; category not NULL."""
    return (fact.where(F.col("category_name").isNotNull())
                .groupBy("category_name").agg(*_sales_measures()))


def disruption_events(fact: DataFrame) -> DataFrame:
    """Per (event type, severity); event not NULL."""
    return (fact.where(F.col("Event_Type").isNotNull())
                .groupBy("Event_Type", "Severity")
                .agg(F.count(F.lit(1)).alias("total_events"),
                     r2(F.avg("Duration_Days")).alias("avg_duration_days"),
                     F.max("Duration_Days").alias("max_duration_days")))


def overall_risk(fact: DataFrame) -> DataFrame:
    """Per (route level, severity), NULL groups kept."""
    return fact.groupBy("Route_Risk_Level", "Severity").agg(
        F.count(F.lit(1)).alias("total_records"),
        r2(F.avg("Supplier_Risk_Score")).alias("avg_supplier_risk"),
        r2(F.avg("late_delivery_risk")).alias("avg_delivery_risk"),
        r2(F.avg("delivery_delay_days")).alias("avg_delivery_delay"),
    )


HIGH_RISK_COLUMNS = ("order_id", "Supplier_ID", "Warehouse_ID", "DC_ID", "Route_ID",
                     "Supplier_Risk_Score", "late_delivery_risk", "delivery_delay_days",
                     "Route_Risk_Level", "Severity", "Event_Type")


#: Buckets of the first merge level of a top-k.
TOP_K_BUCKETS = 64


def two_level_top_k(df: DataFrame, order: list, n: int, buckets: int = TOP_K_BUCKETS) -> DataFrame:
    """The first n rows in ``order``: every input task keeps its first n (the
    group limit below the exchange), ``buckets`` tasks merge those, and one task
    merges buckets x n rows. The scan keeps all its splits."""
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(*order))
    return (df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(buckets)))
            .withColumn("_place", place).where(F.col("_place") <= n)
            .drop("_bucket", "_place").orderBy(*order).limit(n))


#: Histogram bins per unit of asinh(key): about 5,400 for keys from 0 to 100, at
#: most 1.5 million for any doubles.
BINS = 1024


def leading_bound(df: DataFrame, key: str, n: int) -> float | None:
    """A value of ``key`` that at least n rows reach, close to the n-th largest;
    None if fewer rows have one. One scan of the key's column, combined into the
    bins of a histogram before the shuffle; the smallest value of the bin that
    completes n rows is the bound."""
    value = F.col(key).cast("double")
    bins = (df.where(value.isNotNull() & ~F.isnan(value)).groupBy(F.floor(F.asinh(value) * BINS).alias("bin"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low")))
    above = F.sum("rows").over(W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0))
    reached = bins.withColumn("above", above).where(F.col("above") - F.col("rows") < n)
    got = reached.agg(F.min("low").alias("low"), F.max("above").alias("above")).first()
    return got.low if got.above is not None and got.above >= n else None


def high_risk_records(fact: DataFrame, n: int = K.HIGH_RISK_RECORDS_N) -> DataFrame:
    """Rows meeting any risk condition (three-valued OR), top-n by supplier
    risk then delay, every output column as a further tie-breaker.

    A histogram of the leading key gives a value that n rows reach. Rows below
    it cannot be among the first n; the scan skips their row groups, and only
    the rest is sorted. Rows that tie with the bound are all kept."""
    cond = ((F.col("Supplier_Risk_Score") >= K.HIGH_RISK_SUPPLIER_CUT)
            | (F.col("late_delivery_risk") == 1)
            | (F.col("Route_Risk_Level") == "High")
            | (F.col("Severity") == "High"))
    rest = [c for c in HIGH_RISK_COLUMNS if c not in ("Supplier_Risk_Score", "delivery_delay_days")]
    order = [F.col("Supplier_Risk_Score").desc_nulls_last(), F.col("delivery_delay_days").desc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in rest]]
    risky = fact.where(cond)
    bound = leading_bound(risky, "Supplier_Risk_Score", n)
    if bound is not None:
        risky = risky.where(F.col("Supplier_Risk_Score") >= F.lit(bound))
    return two_level_top_k(risky.select(*HIGH_RISK_COLUMNS), order, n)
