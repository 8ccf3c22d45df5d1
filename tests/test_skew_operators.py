"""Block-decomposed windows and salted nesting equal their plain forms,
including with one key holding a third of all rows (brute force on a small
fixture)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def orders(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        cust = "HOT" if i % 3 == 0 else f"C{rnd.randrange(40):03d}"
        day = dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randrange(0, 3 if cust == "HOT" else 60))
        rev = None if rnd.random() < 0.02 else Decimal(rnd.randrange(0, 100000)) / 100
        flag = rnd.randrange(2)
        rows.append((f"O{i:09d}", cust, day, rev, flag))
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_date date, "
                                       "revenue decimal(18,2), otif_flag int").repartition(5)


def test_running_rank_and_sum_equals_plain_window(orders):
    from lading.operators.running import running_rank_and_sum
    got = running_rank_and_sum(orders, ["customer_id"], ["order_date", "order_id"], "revenue", "rn", "cum")
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    want = orders.select("order_id", F.row_number().over(w).alias("rn"),
                         F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    assert sorted(got.select("order_id", "rn", "cum").collect()) == sorted(want.collect())


@pytest.mark.parametrize("block_rows", [30, 97, 10_000])
def test_global_rolling_equals_plain_window(orders, block_rows):
    from lading.operators.running import global_positions, rolling_by_position
    pos = global_positions(orders, ["order_date", "order_id"])
    got = rolling_by_position(pos, "_pos", "otif_flag", 29, "r", block_rows=block_rows)
    w = Window.orderBy("order_date", "order_id")
    want = orders.select("order_id", F.row_number().over(w).alias("_pos"),
                         F.avg("otif_flag").over(w.rowsBetween(-29, 0)).alias("r"))
    assert sorted(got.select("order_id", "_pos", "r").collect()) == sorted(want.collect())


def test_nest_items_one_row_per_group_with_a_hot_one(spark):
    """A hot order (25,000 lines) is still one row with all its items, sorted."""
    from lading.plans.nested import nested_orders, unnest_items
    lines = spark.range(75_000).select(
        F.concat(F.lit("L"), "id").alias("order_line_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("O"), F.col("id") % 50)).alias("order_id"),
        F.lit("C1").alias("customer_id"), F.lit(dt.date(2025, 1, 1)).alias("order_date"),
        F.concat(F.lit("S"), F.col("id") % 17).alias("sku"), (F.col("id") % 9).cast("int").alias("units_ordered"),
        (F.col("id") / 10).cast("decimal(18,2)").alias("revenue"))
    nested = nested_orders(lines)
    rows = nested.select("order_id", F.size("items").alias("n"),
                         (F.col("items") == F.array_sort("items")).alias("in_order")).collect()
    sizes = {r["order_id"]: r["n"] for r in rows}
    assert len(rows) == len(sizes) == 51 and sizes["HOT"] == 25_000
    assert all(r["in_order"] for r in rows)
    flat = unnest_items(nested).select("order_id", "sku", "quantity", "extended_price")
    want = lines.select("order_id", "sku", F.col("units_ordered").alias("quantity"),
                        F.col("revenue").alias("extended_price"))
    assert flat.exceptAll(want).count() == 0 and flat.count() == 75_000


def test_keep_latest_reduces_before_shuffle(spark):
    from lading.operators.dedup import keep_latest
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    out = keep_latest(df, ["k"], ["ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(out.collect()) == [(0, 999), (1, 997), (2, 998)]


def test_hot_customer_is_spread_over_tasks(spark):
    """One customer with a third of all orders: the block-decomposed window
    spreads it, where a plain per-customer window puts it in one task."""
    from lading.operators.running import running_rank_and_sum
    rows = [(f"O{i:09d}", "HOT" if i % 3 == 0 else f"C{i % 97:03d}",
             dt.date(2025, 1, 1) + dt.timedelta(days=i % 40), Decimal(1)) for i in range(6000)]
    orders = spark.createDataFrame(rows, "order_id string, customer_id string, order_date date, revenue decimal(18,2)")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = running_rank_and_sum(orders, ["customer_id"], ["order_date", "order_id"], "revenue", "rn", "cum")
        # tag the task before filtering (a nondeterministic column stops the
        # filter from being pushed below the windows)
        def by_task(df):
            tagged = df.select("*", F.spark_partition_id().alias("p"))
            return (tagged.filter("customer_id = 'HOT'").groupBy("p")
                    .agg(F.count(F.lit(1)).alias("count"), F.max("rn").alias("top")).collect())
        hot_by_task = by_task(out)
        plain_by_task = by_task(orders.withColumn(
            "rn", F.row_number().over(Window.partitionBy("customer_id").orderBy("order_id"))))
    finally:
        spark.conf.set(key, old)
    assert len(plain_by_task) == 1                          # the plain window: one task holds the hot key
    assert len(hot_by_task) >= 4                            # blocks: spread over several tasks
    assert max(r["count"] for r in hot_by_task) < 2000 * 0.6
    assert sum(r["count"] for r in hot_by_task) == 2000


def test_order_mart_with_a_hot_customer_equals_plain_history(spark):
    """J1 end to end with one customer owning a third of all orders: the
    block-decomposed history equals the plain per-customer window."""
    from lading.plans.fulfillment import order_facts, with_customer_history
    from lading.plans.warehouse import Warehouse
    from tests.conftest import SF_SMALL
    wh = Warehouse.from_testdata(spark, SF_SMALL)
    hot_id = F.when(F.abs(F.xxhash64("order_id")) % 3 == 0, F.lit("C0000001")).otherwise(F.col("customer_id"))
    lines = wh.fct_order_line.withColumn("customer_id", hot_id)
    facts = order_facts(lines, wh.dim_customer, wh.fct_shipment)
    got = with_customer_history(facts).select("order_id", "customer_order_number", "customer_lifetime_revenue")
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    want = facts.select("order_id", F.row_number().over(w).cast("bigint").alias("customer_order_number"),
                        F.sum("recognized_revenue").over(w.rowsBetween(Window.unboundedPreceding, 0))
                        .cast("decimal(38,2)").alias("customer_lifetime_revenue"))
    hot = facts.filter("customer_id = 'C0000001'").count()
    assert hot * 4 > facts.count()                     # the hot customer holds about a third
    assert sorted(got.collect()) == sorted(want.collect())


def test_orders_without_a_date_come_last_and_stay(spark):
    from lading.operators.running import global_positions, running_rank_and_sum
    df = spark.createDataFrame([("O1", "C", None, 1), ("O2", "C", dt.date(2025, 1, 2), 2), ("O3", "C", dt.date(2025, 1, 1), 3),
                                ("O4", "C", None, 4)], "order_id string, customer_id string, order_date date, v long")
    pos = {r["order_id"]: r["_pos"] for r in global_positions(df, ["order_date", "order_id"]).collect()}
    assert pos == {"O3": 1, "O2": 2, "O1": 3, "O4": 4}
    run = running_rank_and_sum(df, ["customer_id"], ["order_date", "order_id"], "v", "rn", "s")
    assert {r["order_id"]: (r["rn"], r["s"]) for r in run.collect()} == {"O3": (1, 3), "O2": (2, 5), "O1": (3, 6), "O4": (4, 10)}


@pytest.mark.parametrize("order_id", ["concat('SAMEPREFIX-', lpad(id, 12, '0'))", "md5(string(id))"], ids=["constant prefix", "random"])
def test_ranges_do_not_depend_on_the_form_of_ids(spark, order_id):
    """A customer with a third of all orders, all on one day: ranges stay near
    their mean, and rank and sum equal the plain window."""
    from lading.operators.running import ordered_ranges, running_rank_and_sum
    orders = spark.range(12_000).selectExpr(f"{order_id} as order_id", "if(id % 3 = 0, 'HOT', concat('C', id % 500)) as customer_id",
                                            "date'2025-01-01' as order_date", "cast(id % 97 as decimal(18,2)) as revenue").repartition(6)
    held = ordered_ranges(orders, ["customer_id", "order_date", "order_id"], 24).groupBy("_range").count().collect()
    assert max(r["count"] for r in held) < 2 * 12_000 / 24
    got = running_rank_and_sum(orders, ["customer_id"], ["order_date", "order_id"], "revenue", "rn", "cum", ranges=24)
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    want = orders.select("order_id", F.row_number().over(w).alias("rn"),
                         F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    assert sorted(got.select("order_id", "rn", "cum").collect()) == sorted(want.collect())


def test_null_customers_are_one_partition(spark):
    from lading.operators.running import running_rank_and_sum
    orders = spark.range(300).selectExpr("concat('O', lpad(id, 5, '0')) as order_id", "if(id % 2 = 0, null, 'C') as customer_id",
                                         "if(id % 5 = 0, null, id) as v")
    rows = running_rank_and_sum(orders, ["customer_id"], ["order_id"], "v", "rn", "s", ranges=7).collect()
    for customer in (None, "C"):
        mine = sorted((r for r in rows if r["customer_id"] == customer), key=lambda r: r["order_id"])
        total, seen = 0, False
        for k, r in enumerate(mine):
            seen, total = seen or r["v"] is not None, total + (r["v"] or 0)
            assert (r["rn"], r["s"]) == (k + 1, total if seen else None)
