"""Calendar dimension (date spine from first order to last delivery)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.functions.exprs import full_day_name
from lading.functions.joins import broadcast_if_small


def date_spine(lines: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per day from ``min(order_date)`` to ``max(delivery_date)``.

    The reference's recursive ``union all`` becomes ``explode(sequence(...))``
    over a one-row aggregate; the upper bound is an uncorrelated scalar
    subquery.  Row count is the calendar length, independent of data volume.
    Like the recursive form, a missing or inverted range yields the start day.
    """
    lo = F.col("lo")
    hi = shipments.select(F.max("delivery_date")).scalar()
    days = F.when(lo.isNull() | hi.isNull() | (lo > hi), F.array(lo)).otherwise(F.sequence(lo, hi))
    return (lines.agg(F.min("order_date").alias("lo"))
            .select(F.explode(days).alias("calendar_date")))


def dim_date(lines: DataFrame, shipments: DataFrame) -> DataFrame:
    d = F.col("calendar_date")
    return date_spine(lines, shipments).select(
        d,
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("calendar_week"),
        full_day_name(d).alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def revenue_by_day(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Lines and revenue on each of ``days`` (a filtered calendar).  Over a
    fact in folders by date, the filtered days are found first and only their
    folders are read (dynamic partition pruning)."""
    return (fact.join(broadcast_if_small(days.select("calendar_date", "day_name")), fact["order_date"] == F.col("calendar_date"))
            .groupBy("calendar_date", "day_name")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").cast("decimal(38,2)").alias("revenue")))
