"""Nested order items (ARRAY<STRUCT>) and semi-structured order events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.functions.joins import broadcast_if_small

# Fixed number of parts that every group's items are collected in before the
# parts of a group meet.
PARTS = 16


def nest_items(lines: DataFrame, keys: Sequence[str], item: Column, unique_col: str,
               items_name: str = "items", parts: int = PARTS, **per_group: Column) -> DataFrame:
    """``array_agg(item order by item) group by keys``: one row per group.

    Two levels, whatever the group's size: items are collected per (group,
    part) - the part is a hash of ``unique_col``, so the rows of a hot group
    are read by several tasks - and the parts of a group are then joined end
    to end and sorted once.  ``per_group`` names extra ``max`` aggregates.
    Only the finished array of a group is in one task: it is one row of the
    result.
    """
    keys = list(keys)
    part = F.pmod(F.xxhash64(F.col(unique_col)), F.lit(parts))
    # One struct grouping key: a partitioning on the group keys alone (left by
    # a shuffle join, or by the input) never satisfies it, so the parts of a
    # hot group are always shuffled apart.
    group = F.struct(*[F.col(k) for k in keys], part.alias("_part")).alias("_g")
    level = lines.groupBy(group).agg(F.collect_list(item).alias(items_name),
                                     *[F.max(c).alias(n) for n, c in per_group.items()])
    return (level.groupBy(*[F.col(f"_g.{k}").alias(k) for k in keys])
            .agg(F.array_sort(F.flatten(F.collect_list(items_name))).alias(items_name),
                 *[F.max(n).alias(n) for n in per_group]))


def nested_orders(lines: DataFrame) -> DataFrame:
    """Order header with ``items ARRAY<STRUCT<sku, quantity, extended_price>>``
    sorted by SKU (struct ordering is field by field, SKU first)."""
    item = F.struct(F.col("sku"), F.col("units_ordered").alias("quantity"),
                    F.col("revenue").alias("extended_price"))
    return nest_items(lines, ["order_id", "customer_id", "order_date"], item, "order_line_id")


def unnest_items(nested: DataFrame) -> DataFrame:
    """C4: lateral unnest; an empty or NULL array drops the row (inner)."""
    return nested.select("order_id", "customer_id", "order_date", F.inline("items"))


def nested_order_items(lines: DataFrame) -> DataFrame:
    """Nest then unnest (the BigQuery round trip)."""
    return unnest_items(nested_orders(lines))


# --- semi-structured events --------------------------------------------------
# Fixed rule for the derived event stream: an open order (TPC-H status 'O')
# emits 'order_created', any other status 'order_updated'.
CREATED, UPDATED = "order_created", "order_updated"
OPEN_STATUS = "O"


def order_events(lines: DataFrame, order_status: DataFrame) -> DataFrame:
    """One JSON ``event_payload`` per order, with order_id, event_timestamp (latest ingestion of its lines),
    event_type (from the order's status) and an items list."""
    item = F.struct(F.col("sku"), F.col("units_ordered").alias("quantity"),
                    F.col("revenue").alias("extended_price"))
    per_order = nest_items(lines, ["order_id"], item, "order_line_id",
                           event_timestamp=F.col("ingestion_timestamp"))
    kind = F.when(F.col("order_status") == OPEN_STATUS, F.lit(CREATED)).otherwise(F.lit(UPDATED))
    status = broadcast_if_small(order_status.select("order_id", kind.alias("event_type")))
    return (per_order.join(status, "order_id")
            .select(F.to_json(F.struct(
                F.col("order_id"), F.col("event_timestamp"), F.col("event_type"),
                F.col("items"))).alias("event_payload")))


def flatten_order_events(events: DataFrame, event_type: str = CREATED) -> DataFrame:
    """Parse the payload as VARIANT, keep one event type, flatten items.

    ``explode`` over the items array is the lateral flatten with outer off:
    an event without items yields no row.  Paths are typed with ``variant_get``.
    """
    return (events.select(F.parse_json("event_payload").alias("p"))
            .filter(F.variant_get("p", "$.event_type", "string") == F.lit(event_type))
            .select("p", F.explode(F.variant_get("p", "$.items", "array<variant>")).alias("item"))
            .select(F.variant_get("p", "$.order_id", "string").alias("order_id"),
                    F.variant_get("p", "$.event_timestamp", "timestamp_ntz").alias("event_timestamp"),
                    F.variant_get("item", "$.sku", "string").alias("sku"),
                    F.variant_get("item", "$.quantity", "decimal(38,0)").alias("quantity"),
                    F.variant_get("item", "$.extended_price", "decimal(18,2)").alias("extended_price")))
