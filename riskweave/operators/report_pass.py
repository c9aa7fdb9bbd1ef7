"""The grouped reports (D2-D13) from one pass over the fact.

One aggregation over grouping sets computes every grouping with all measures;
it is written partitioned by grouping, and each report is a projection of its
own part. The fact is read once for the eleven groupings instead of once a
report. Spark combines the groups of all sets before the shuffle, so a hot
supplier or product sends one row per task. The group table holds one row per
group, whatever the size of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.levels import dec
from ..scratch import Scratch
from . import reports
from .reports import DC_ATTRS, WAREHOUSE_ATTRS, attach_row, r2

#: Report -> its grouping columns; D4 and D5 share one.
GROUPINGS = {
    "delivery_performance": ("delivery_status",),
    "region_analysis": ("order_region",),
    "supplier_risk": ("Supplier_ID",),
    "top_high_risk_suppliers": ("Supplier_ID",),
    "warehouse_inventory": WAREHOUSE_ATTRS,
    "distribution_center_load": DC_ATTRS,
    "route_risk": ("Route_ID", "Transport_Mode", "Route_Risk_Level"),
    "transport_mode": ("Transport_Mode",),
    "product_performance": ("product_name", "category_name"),
    "category_performance": ("category_name",),
    "disruption_events": ("Event_Type", "Severity"),
    "overall_risk": ("Route_Risk_Level", "Severity"),
}

_SALES = {"total_orders": "n", "total_sales": "sales", "total_profit": "profit",
          "avg_delivery_delay": "delay", "avg_late_delivery_risk": "late"}
#: Report -> its measures by name, and the key that must not be NULL.
_MEASURES = {
    "region_analysis": (_SALES, None),
    "supplier_risk": ({"total_orders": "n", "avg_supplier_performance": "performance", "avg_supplier_risk": "risk",
                       "avg_late_delivery_risk": "late", "avg_delivery_delay": "delay", "total_sales": "sales"},
                      "Supplier_ID"),
    "top_high_risk_suppliers": ({"supplier_performance": "performance", "supplier_risk": "risk",
                                 "affected_orders": "n"}, "Supplier_ID"),
    "route_risk": ({"avg_distance_km": "distance", "total_shipments": "n", "avg_delivery_delay": "delay",
                    "avg_late_delivery_risk": "late"}, "Route_ID"),
    "transport_mode": ({"total_shipments": "n", "avg_distance_km": "distance", "avg_delivery_delay": "delay",
                        "avg_late_delivery_risk": "late", "total_sales": "sales"}, "Transport_Mode"),
    "product_performance": (_SALES, "product_name"),
    "category_performance": (_SALES, "category_name"),
    "disruption_events": ({"total_events": "n", "avg_duration_days": "duration", "max_duration_days": "longest"},
                          "Event_Type"),
    "overall_risk": ({"total_records": "n", "avg_supplier_risk": "risk", "avg_delivery_risk": "late",
                      "avg_delivery_delay": "delay"}, None),
}
_WHOLE = ("n", "longest")  # not rounded


def _name(keys: tuple[str, ...]) -> str:
    return "-".join(keys)


def report_groups(fact: DataFrame) -> DataFrame:
    """All groupings of the reports with all measures; ``grouping`` names the set."""
    sets = list(dict.fromkeys(GROUPINGS.values()))
    columns = list(dict.fromkeys(c for keys in sets for c in keys))

    def number(keys):  # grouping_id: a bit for each column that is not in the set
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)

    which = F.coalesce(*[F.when(F.grouping_id() == number(keys), F.lit(_name(keys))) for keys in sets])
    return fact.groupingSets([[F.col(c) for c in keys] for keys in sets], *columns).agg(
        which.alias("grouping"), F.count(F.lit(1)).alias("n"),
        F.sum("sales").alias("sales"), F.sum("order_profit_per_order").alias("profit"),
        F.avg("delivery_delay_days").alias("delay"), F.avg("late_delivery_risk").alias("late"),
        F.avg("Supplier_Performance_Score").alias("performance"), F.avg("Supplier_Risk_Score").alias("risk"),
        F.avg("Distance_KM").alias("distance"), F.avg("Duration_Days").alias("duration"),
        F.max("Duration_Days").alias("longest"))


def written_groups(groups: DataFrame, scratch: Scratch) -> DataFrame:
    """The groups as a table, one folder for each grouping."""
    path = scratch.path("report_groups")
    groups.write.mode("overwrite").partitionBy("grouping").parquet(path)
    scratch.names.add("report_groups")
    # one schema for all folders: a grouping may lack groups
    return scratch.spark.read.schema(groups.schema).parquet(path)


def report(groups: DataFrame, name: str) -> DataFrame:
    """One of D2-D13 from the groups; equal to the report of that name over the fact."""
    keys = GROUPINGS[name]
    mine = groups.where(F.col("grouping") == _name(keys))
    if name == "delivery_performance":
        counted = mine.select(*keys, F.col("n").alias("total_shipments"))
        total = counted.agg(F.sum("total_shipments").alias("_total"))
        share = F.round(F.col("total_shipments") * dec("100.0") / F.col("_total"), 2)
        return attach_row(counted, total).select(*keys, "total_shipments", share.cast("double").alias("percentage"))
    if name in ("warehouse_inventory", "distribution_center_load"):
        return getattr(reports, name)(mine)  # bands of the distinct attributes
    measures, required = _MEASURES[name]
    if required:
        mine = mine.where(F.col(required).isNotNull())
    out = mine.select(*keys, *[(F.col(m) if m in _WHOLE else r2(F.col(m))).alias(c) for c, m in measures.items()])
    if name == "top_high_risk_suppliers":
        return out.orderBy(F.col("supplier_risk").desc_nulls_last(), F.col("Supplier_ID")).limit(K.TOP_SUPPLIERS_N)
    if name == "product_performance":
        return out.orderBy(F.col("total_sales").desc_nulls_last(), F.col("product_name"),
                           F.col("category_name").asc_nulls_last()).limit(K.TOP_PRODUCTS_N)
    return out
