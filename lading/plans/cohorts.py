"""Customer cohort revenue (monthly activity by first-order month)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.functions.exprs import month_boundaries, month_start


def customer_months(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("customer_id", month_start("order_date").alias("activity_month"))
            .agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue")))


def cohort_revenue(lines: DataFrame) -> DataFrame:
    """Active customers and revenue per (cohort month, months since first order).

    The cohort is ``min(activity_month)`` over the customer's partition of the
    *monthly* table: at most one row per calendar month per customer, so a
    customer's window partition is bounded by the calendar however many
    orders it has.  Month age counts month boundaries (BigQuery semantics).
    """
    cm = customer_months(lines)
    cohorts = cm.withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy("customer_id")))
    return (cohorts.groupBy("cohort_month",
                            month_boundaries("activity_month", "cohort_month").alias("months_since_first_order"))
            .agg(F.count_distinct("customer_id").alias("active_customers"),
                 F.sum("revenue").cast("decimal(38,2)").alias("cohort_revenue"))
            .orderBy("cohort_month", "months_since_first_order"))
