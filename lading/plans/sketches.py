"""Mergeable quantile sketches of lead times.

A percentile per carrier needs every order again each time.  A sketch per
carrier and day is small, is computed once when the day lands, and sketches of
any days merge into one: weekly, monthly or all-time quantiles read sketches,
not orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_K = 200                  # rank error about 1.3 % for one quantile
QUANTILES = {"median_lead_time_days": 0.5, "p90_lead_time_days": 0.9}


def daily_lead_time_sketches(orders: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch per carrier and order date; orders without a lead time
    are not in it."""
    lead = F.col("order_lead_time_days").cast("bigint")
    return (orders.where("carrier is not null and order_lead_time_days is not null").groupBy("carrier", "order_date")
            .agg(F.kll_sketch_agg_bigint(lead, F.lit(k)).alias("sketch")))


def lead_time_quantiles(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Quantiles per carrier over all days of ``sketches``, with the number of
    orders behind them."""
    merged = sketches.groupBy("carrier").agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("s"))
    return merged.select("carrier", F.kll_sketch_get_n_bigint("s").alias("shipments"),
                         *[F.kll_sketch_get_quantile_bigint("s", F.lit(q)).alias(n) for n, q in QUANTILES.items()])
