"""Inventory risk and forecast accuracy marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.functions.exprs import ratio
from lading.functions.joins import broadcast_if_small

# Fixed status thresholds in days of inventory, checked in this order:
# STOCKOUT (no stock, positive demand), CRITICAL < 7, WATCH < 14, EXCESS > 90, else HEALTHY.
CRITICAL_DAYS, WATCH_DAYS, EXCESS_DAYS = 7, 14, 90


def risk_status(on_hand, daily_demand, days) -> F.Column:
    return (F.when((on_hand == 0) & (daily_demand > 0), F.lit("STOCKOUT"))
            .when(days < CRITICAL_DAYS, F.lit("CRITICAL"))
            .when(days < WATCH_DAYS, F.lit("WATCH"))
            .when(days > EXCESS_DAYS, F.lit("EXCESS"))
            .otherwise(F.lit("HEALTHY")))


def mart_inventory_risk(inventory: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """One row per (snapshot date, warehouse, SKU) with days of inventory
    and a risk status.  Inner star join: SKUs without a product or supplier
    drop.  Dimensions are broadcast only under the size bound; the supplier
    dimension is joined to the product dimension first (dimension x
    dimension, small) so the fact is joined once; above the bound each task
    hashes its part of the dimension and streams the dense fact unsorted.
    """
    prod = products.select("sku", "product_category", "supplier_id")
    sup = suppliers.select("supplier_id", "supplier_risk_tier")
    dim = prod.join(broadcast_if_small(sup), "supplier_id")
    days = ratio("on_hand_units", "average_daily_demand")
    small = broadcast_if_small(dim)
    return (inventory.join(dim.hint("shuffle_hash") if small is dim else small, "sku")
            .select("snapshot_date", "warehouse", "sku", "product_category", "supplier_id",
                    "supplier_risk_tier", "on_hand_units", "average_daily_demand", "inventory_value",
                    days.alias("days_of_inventory"),
                    risk_status(F.col("on_hand_units"), F.col("average_daily_demand"), days)
                    .alias("inventory_risk_status")))


def mart_forecast_accuracy(forecasts: DataFrame) -> DataFrame:
    """WAPE, bias and accuracy per (month, warehouse) as ratios of sums."""
    actual = F.sum("actual_units")
    abs_err = F.sum(F.abs(F.col("actual_units") - F.col("forecast_units")))
    signed = F.sum(F.col("forecast_units") - F.col("actual_units"))
    return (forecasts.groupBy("forecast_month", "warehouse")
            .agg(F.sum("forecast_units").cast("bigint").alias("forecast_units"),
                 actual.cast("bigint").alias("actual_units"),
                 ratio(abs_err, actual).alias("wape"),
                 ratio(signed, actual).alias("forecast_bias"),
                 (F.lit(1.0) - ratio(abs_err, actual)).alias("forecast_accuracy")))
