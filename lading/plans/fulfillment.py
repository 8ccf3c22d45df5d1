"""Order fulfillment, daily service level and carrier performance marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.functions.exprs import flag, ratio, round6
from lading.functions.joins import broadcast_if_small
from lading.operators.running import global_positions, rolling_by_position, running_rank_and_sum

SHIPMENT_COLUMNS = ("order_id", "shipment_id", "carrier", "ship_date", "delivery_date",
                    "shipment_weight_kg", "freight_cost", "handling_cost", "exception_cost")


ORDER_KEY = ("order_id", "customer_id", "warehouse")


def _totals(revenue: str) -> list[Column]:
    """First order date, latest promise, unit and revenue sums of an order."""
    return [F.min("order_date").alias("order_date"), F.max("promised_date").alias("promised_date"),
            F.sum("units_ordered").cast("bigint").alias("units_ordered"),
            F.sum("units_shipped").cast("bigint").alias("units_shipped"),
            F.sum("revenue").cast("decimal(38,2)").alias(revenue)]


def order_rollup(lines: DataFrame) -> DataFrame:
    """Order-grain rollup of order lines (grouped by order, customer, warehouse).

    A hash aggregate with map-side partial aggregation: a hot order is
    combined per map task before the shuffle.
    """
    return lines.groupBy(*ORDER_KEY).agg(
        *_totals("recognized_revenue"),
        F.sum(F.col("units_shipped") * F.col("unit_weight_kg")).cast("decimal(38,3)").alias("calculated_shipped_weight_kg"),
        F.count(F.lit(1)).alias("order_line_count"))


def order_totals(lines: DataFrame) -> DataFrame:
    """The totals alone, for lines without a weight (the warehouse-style
    service mart and the gold job)."""
    return lines.groupBy(*ORDER_KEY).agg(*_totals("revenue"))


def service_flag_columns() -> dict:
    """Fill rate and complete / on-time / OTIF flags (NULL conditions score 0)."""
    complete = F.col("units_shipped") >= F.col("units_ordered")
    on_time = F.col("delivery_date") <= F.col("promised_date")
    return {
        "unit_fill_rate": ratio("units_shipped", "units_ordered"),
        "complete_order_flag": flag(complete),
        "on_time_flag": flag(on_time),
        "otif_flag": flag(complete & on_time),
    }


def service_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(service_flag_columns())


def order_facts(lines: DataFrame, customers: DataFrame, shipments: DataFrame) -> DataFrame:
    """J1 without customer history: one row per order with flags and costs.

    Join order: the order rollup meets shipments on ``order_id`` (left: keep
    unshipped orders), then customers on ``customer_id`` (inner: unknown
    customers drop their orders) — equal to the reference's order of joins
    since the inner condition is on the order side.  The customer dimension is
    broadcast only under the size bound.  Rollups over orders (daily,
    carrier, quality) read this directly: they use none of the history
    columns, and the history step keeps every row.
    """
    orders = order_rollup(lines)
    ship = shipments.select(*SHIPMENT_COLUMNS)
    cust = broadcast_if_small(customers.select("customer_id", "customer_segment", "region"))
    return with_measures(orders.join(ship, "order_id", "left").join(cust, "customer_id"))


def with_measures(joined: DataFrame) -> DataFrame:
    """Flags, lead time and cost measures of joined orders, row by row."""
    logistics = (F.col("freight_cost") + F.col("handling_cost") + F.col("exception_cost")).cast("decimal(38,2)")
    return joined.withColumns({
        **service_flag_columns(),
        "order_lead_time_days": F.datediff("delivery_date", "order_date").cast("bigint"),
        "freight_cost_per_kg": ratio("freight_cost", "shipment_weight_kg"),
        "logistics_cost": logistics,
        "logistics_cost_pct_revenue": ratio(logistics, "recognized_revenue"),
    })


def with_customer_history(facts: DataFrame) -> DataFrame:
    """Customer order number and lifetime revenue (running over the
    customer's orders by date, then id).  A prefix scan over ranges of
    (customer, date, order), so a customer with a large share of all orders is
    not one task; the facts are written once, in that order.  The measures of
    ``with_measures`` follow from the row's other columns: they are left out of
    the sort and the window and computed on the way out."""
    base = facts.select(*[c for c in facts.columns if c not in MEASURES])
    history = running_rank_and_sum(
        base, ["customer_id"], ["order_date", "order_id"], "recognized_revenue",
        "customer_order_number", "customer_lifetime_revenue")
    return with_measures(history).select(*[
        F.col(c).cast("bigint").alias(c) if c == "customer_order_number"
        else F.col(c).cast("decimal(38,2)").alias(c) if c == "customer_lifetime_revenue"
        else F.col(c)
        for c in MART_ORDER_COLUMNS])


def mart_order_fulfillment(lines: DataFrame, customers: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per order with service flags, costs and customer history."""
    return with_customer_history(order_facts(lines, customers, shipments))


def order_shipments(lines: DataFrame, shipments: DataFrame) -> DataFrame:
    """Units and revenue per shipped order with its carrier.  The rollup and
    the join are both on the order alone: over tables bucketed by it neither
    needs an exchange, and each bucket is joined as it lies on disk."""
    rolled = lines.groupBy("order_id").agg(
        F.sum("units_shipped").cast("bigint").alias("units_shipped"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
    ship = shipments.select("order_id", "carrier", "delivery_date", "freight_cost")
    return rolled.hint("merge").join(ship, "order_id")


# the columns of ``with_measures``
MEASURES = frozenset({"unit_fill_rate", "complete_order_flag", "on_time_flag", "otif_flag", "order_lead_time_days",
                      "freight_cost_per_kg", "logistics_cost", "logistics_cost_pct_revenue"})

MART_ORDER_COLUMNS = (
    "order_id", "customer_id", "warehouse", "order_date", "promised_date", "units_ordered",
    "units_shipped", "recognized_revenue", "calculated_shipped_weight_kg", "order_line_count",
    "customer_segment", "region", "shipment_id", "carrier", "ship_date", "delivery_date",
    "shipment_weight_kg", "freight_cost", "handling_cost", "exception_cost", "unit_fill_rate",
    "complete_order_flag", "on_time_flag", "order_lead_time_days", "freight_cost_per_kg",
    "logistics_cost", "customer_order_number", "customer_lifetime_revenue", "otif_flag",
    "logistics_cost_pct_revenue")


def daily_rollup(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("order_date")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum("units_ordered").cast("bigint").alias("units_ordered"),
                 F.sum("units_shipped").cast("bigint").alias("units_shipped"),
                 F.avg("complete_order_flag").alias("complete_order_rate"),
                 F.avg("on_time_flag").alias("on_time_delivery_rate"),
                 F.avg("otif_flag").alias("otif_rate"),
                 F.sum("recognized_revenue").cast("decimal(38,2)").alias("revenue"),
                 F.sum("logistics_cost").cast("decimal(38,2)").alias("logistics_cost")))


def mart_daily_service_level(orders: DataFrame) -> DataFrame:
    """One row per order date with lagged and 30-row rolling OTIF.

    The windows run over the *daily* table — one row per calendar day, so
    the single ordered partition is bounded by the calendar, not the data.
    "Rolling 30d" is 30 rows (days having orders), as in the reference.
    """
    daily = daily_rollup(orders)
    by_day = Window.orderBy(F.col("order_date").asc_nulls_last())
    last30 = by_day.rowsBetween(-29, 0)
    prior = F.lag("otif_rate").over(by_day)
    return daily.select(
        "*",
        prior.alias("prior_day_otif"),
        round6(F.avg("otif_rate").over(last30)).alias("rolling_30d_otif"),
        F.sum("revenue").over(last30).cast("decimal(38,2)").alias("rolling_30d_revenue"),
        ratio("units_shipped", "units_ordered").alias("unit_fill_rate"),
        (F.col("otif_rate") - prior).alias("day_over_day_otif_change"))


def carrier_metrics(orders: DataFrame) -> DataFrame:
    lead = F.col("order_lead_time_days")
    return (orders.filter(F.col("carrier").isNotNull())
            .groupBy("carrier")
            .agg(F.count(F.lit(1)).alias("shipments"),
                 F.avg("on_time_flag").alias("on_time_delivery_rate"),
                 F.avg("complete_order_flag").alias("complete_order_rate"),
                 F.avg("otif_flag").alias("otif_rate"),
                 round6(F.avg(lead)).alias("average_lead_time_days"),
                 round6(F.percentile(lead, 0.5)).alias("median_lead_time_days"),
                 round6(F.percentile(lead, 0.9)).alias("p90_lead_time_days"),
                 F.sum("freight_cost").cast("decimal(38,2)").alias("freight_cost"),
                 F.sum("shipment_weight_kg").cast("decimal(38,3)").alias("shipment_weight_kg"),
                 ratio(F.sum("freight_cost"), F.sum("shipment_weight_kg")).alias("freight_cost_per_kg"),
                 F.sum("exception_cost").cast("decimal(38,2)").alias("exception_cost")))


def mart_carrier_performance(orders: DataFrame) -> DataFrame:
    """One row per carrier, ranked on service and cost.

    ``percentile`` is exact and partially aggregated (a value -> count map
    per group), so a carrier holding most shipments is still combined map-side.
    Ranks are windows over the carrier table (one row per carrier).
    """
    m = carrier_metrics(orders)
    service_cost = Window.orderBy(F.col("otif_rate").desc_nulls_last(),
                                  F.col("freight_cost_per_kg").asc_nulls_last())
    lead = Window.orderBy(F.col("p90_lead_time_days").asc_nulls_last())
    return m.select("*", F.dense_rank().over(service_cost).cast("bigint").alias("service_cost_rank"),
                    F.percent_rank().over(lead).alias("lead_time_percentile"))


def service_mart_rolling(lines: DataFrame, shipments: DataFrame, block_rows: int = 10_000) -> DataFrame:
    """Warehouse-style service mart with a rolling 30-*order* OTIF.

    The reference orders the 30-row frame by order date only (ties are
    undefined); ties are broken by ``order_id`` here.  The frame runs over
    every order: the scored orders are written once in ranges of that order,
    their positions follow from the counts of the ranges, and the rolling
    average runs in blocks of positions with a halo
    (``lading.operators.running``) — no single-partition window over the orders.
    """
    ship = shipments.select("order_id", "carrier", "delivery_date", "freight_cost", "shipment_weight_kg")
    scored = service_flags(order_totals(lines).join(ship, "order_id", "left"))
    positioned = global_positions(scored, ["order_date", "order_id"])
    rolled = rolling_by_position(positioned, "_pos", "otif_flag", 29, "rolling_30_order_otif",
                                 block_rows=block_rows)
    return rolled.withColumns({
        "rolling_30_order_otif": round6("rolling_30_order_otif"),
        "freight_cost_per_kg": ratio("freight_cost", "shipment_weight_kg"),
    }).drop("_pos")
