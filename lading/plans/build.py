"""End-to-end warehouse build: raw -> clean -> marts -> quality -> gate -> publish.

Every layer table is written once, under the build's own run folder
(``<out>/runs/<run>``), and read back by its consumers.  The quality gate runs
*before* anything is published: only then is the run appended to
``<out>/published`` (the newest entry is the current run) and exported.  A
failing build leaves the tables and exports of the last good one as they are.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.operators.layout import export_ordered_csv
from lading.operators.materialize import Materializer
from lading.plans.quality import build_summary, enforce_gate
from lading.plans.warehouse import Warehouse

CLEAN = ("dim_customer", "dim_supplier", "dim_product", "fct_order_line", "fct_shipment",
         "fct_inventory_snapshot", "fct_demand_forecast", "dim_date")
MARTS = ("mart_order_fulfillment", "mart_daily_service_level", "mart_carrier_performance",
         "mart_inventory_risk", "mart_forecast_accuracy")

# relation -> (export folder, order by)
EXPORTS = {
    "mart_order_fulfillment": ("mart_order_fulfillment.csv", ("customer_id", "order_date", "order_id")),
    "mart_daily_service_level": ("mart_daily_service_level.csv", ("order_date",)),
    "mart_carrier_performance": ("mart_carrier_performance.csv", ("carrier",)),
    "mart_inventory_risk": ("mart_inventory_risk.csv", ("snapshot_date", "warehouse", "sku")),
    "mart_forecast_accuracy": ("mart_forecast_accuracy.csv", ("forecast_month", "warehouse")),
    "data_quality_report": ("data_quality_report.csv", ("check_name",)),
}


def current_run(spark: SparkSession, out_dir: str) -> str:
    """The newest run that passed its gate (run names sort by start time)."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/published").agg(F.max("run")).first()[0]


def read_current(spark: SparkSession, out_dir: str, relation: str) -> DataFrame:
    """A layer table of the current run."""
    out = out_dir.rstrip("/")
    return spark.read.parquet(f"{out}/runs/{current_run(spark, out)}/{relation}")


def build_warehouse(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str,
                    publish: bool = True) -> dict:
    """Build all layers under ``out_dir``; raise ``QualityGateError`` on a
    failing check (nothing published, current run unchanged); return the build
    summary.  ``publish`` also writes the exports."""
    out = out_dir.rstrip("/")
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    wh = Warehouse(raw, Materializer(spark, f"{out}/runs/{run}"),
                   keep=set(CLEAN) | set(MARTS) | {"order_facts", "data_quality_report"})
    for name in CLEAN + MARTS:
        getattr(wh, name)
    report = wh.data_quality_report
    enforce_gate(report)
    (spark.range(1).select(F.lit(run).alias("run")).coalesce(1)
     .write.mode("append").parquet(f"{out}/published"))
    if publish:
        for relation, (folder, order_by) in EXPORTS.items():
            export_ordered_csv(getattr(wh, relation), f"{out}/exports/{folder}", order_by)
    row = build_summary(wh.mart_order_fulfillment).collect()[0]
    return row.asDict()
