"""Forms that hold at scale: dense axes, one build per relation, reconciliation,
reproducible exports, file skipping, folder merges, mergeable sketches."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark):
    from lading.plans.warehouse import Warehouse
    return Warehouse.from_testdata(spark, SF_SMALL, materialize=True, keep={"dim_customer", "fct_shipment", "order_facts", "dim_date",
                                                                            "mart_order_fulfillment"})


def test_grid_and_activity_hold_a_month_without_orders(spark):
    """The axes are months x warehouses x SKUs even where a warehouse has no order."""
    from lading.sources.contract import SourceContract

    class Emptied(SourceContract):
        def table(self, name):
            df = super().table(name)
            if name == "orders":        # WH-NORTH has no order in May 1996
                df = df.where("not (o_orderkey * 37 % 103 < 35 and o_orderdate >= '1996-05-01' and o_orderdate < '1996-06-01')")
            return df

    c = Emptied(spark, SF_SMALL)
    months = c.order_headers.selectExpr("months_between(trunc(max(order_date), 'month'), trunc(min(order_date), 'month')) + 1 as n").first()["n"]
    skus = c.products.count()
    assert c.demand_grid.count() == months * 3 * skus
    hole = "snapshot_date = date'1996-05-01' and warehouse = 'WH-NORTH'"
    assert c.demand_grid.where(hole).agg(F.count("*").alias("n"), F.sum("monthly_demand").alias("s")).first()[:] == (skus, 0)
    activity = c.warehouse_activity
    assert activity.count() == months * 3
    empty = activity.where("activity_date = date'1996-05-01' and warehouse = 'WH-NORTH'").first()
    assert (empty["units_processed"], float(empty["labor_hours"])) == (0, 80.0)


def test_latest_by_equals_keep_latest_and_breaks_ties(spark):
    from lading.operators.dedup import keep_latest, latest_by
    df = spark.range(3000).selectExpr("id % 70 as k", "if(id % 11 = 0, null, id % 13) as ts", "id % 5 as tie", "id as v").repartition(5)
    got = latest_by(df, ["k"], ["ts", "tie"])
    assert got.columns == df.columns
    assert sorted(got.collect()) == sorted(keep_latest(df, ["k"], ["ts", "tie", "v"]).collect())
    assert sorted(latest_by(df.repartition(2), ["k"], ["ts", "tie"]).collect()) == sorted(got.collect())


def test_report_computes_every_relation_once(spark, warehouse):
    """The raw lines and the order facts are each scanned for one set of
    metrics (facts a second time below the carrier mart)."""
    report = warehouse.data_quality_report
    report.collect()
    plan = _plan(report).split("== Initial Plan ==")[0]
    assert "Union" not in plan
    facts = plan.count("/order_facts]") + plan.count("/order_facts,")
    assert facts <= 2, plan


def test_a_changed_line_is_located_by_bucket(spark, warehouse):
    from lading.plans.quality import differing_rows, reconcile
    lines = warehouse.fct_order_line
    one = lines.agg(F.min("order_line_id")).first()[0]
    changed = lines.withColumn("units_shipped", F.when(F.col("order_line_id") == one, F.lit(-1)).otherwise(F.col("units_shipped")))
    assert reconcile(lines, lines.repartition(7)).count() == 0
    found = reconcile(lines, changed)
    assert found.count() == 1
    rows = differing_rows(lines, changed, found).collect()
    assert {r["order_line_id"] for r in rows} == {one} and {r["side"] for r in rows} == {"source", "target"}
    lost = reconcile(lines, lines.where(F.col("order_line_id") != one)).first()
    assert lost["source_rows"] - lost["target_rows"] == 1
    assert reconcile(lines, lines.unionByName(lines.where(F.col("order_line_id") == one))).count() == 1


def _parts(path):
    return [open(os.path.join(path, f), "rb").read() for f in sorted(os.listdir(path)) if f.endswith(".csv")]


def test_two_exports_are_byte_equal(spark, warehouse, tmp_path):
    from lading.operators.layout import export_ordered_csv
    mart = warehouse.mart_order_fulfillment
    order = ("customer_id", "order_date")                     # with ties
    export_ordered_csv(mart, str(tmp_path / "a"), order, rows_per_file=300)
    export_ordered_csv(mart.repartition(5), str(tmp_path / "b"), order, rows_per_file=300)
    a, b = _parts(tmp_path / "a"), _parts(tmp_path / "b")
    assert a == b and len(a) == -(-mart.count() // 300)
    assert all(part.count(b"\n") == 301 for part in a[:-1])
    keys = [line.split(b",")[1] for part in a for line in part.splitlines()[1:]]
    assert keys == sorted(keys)
    export_ordered_csv(mart.limit(0), str(tmp_path / "none"), order)
    assert spark.read.schema(mart.schema).option("header", True).csv(str(tmp_path / "none")).count() == 0


def test_narrow_range_touches_few_files_of_the_clustered_mart(spark, warehouse, tmp_path):
    import pyarrow.parquet as pq
    from lading.operators.layout import write_clustered
    path = str(tmp_path / "mart")
    write_clustered(warehouse.mart_order_fulfillment, path, ["order_date", "warehouse"], tasks=16)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    spans = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index("order_date")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    day = sorted(spans)[len(spans) // 2][0]
    touched = sum(lo <= day <= hi for lo, hi in spans)
    assert len(files) == 16 and 1 <= touched <= 2
    df = spark.read.parquet(path).where(F.col("order_date") == F.lit(day))
    assert "PushedFilters: [IsNotNull(order_date), EqualTo(order_date" in _plan(df)
    assert df.select(F.input_file_name()).distinct().count() == touched


def test_bucketed_tables_join_without_exchange(spark, warehouse, tmp_path):
    from lading.operators.layout import write_bucketed
    from lading.plans.fulfillment import order_shipments
    names = []
    for frame in (warehouse.fct_order_line, warehouse.fct_shipment):
        names.append(f"b_{uuid.uuid4().hex[:8]}")
        write_bucketed(frame, names[-1], str(tmp_path / names[-1]), "order_id", buckets=4)
    joined = order_shipments(*[spark.table(n) for n in names])
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    want = order_shipments(warehouse.fct_order_line, warehouse.fct_shipment)
    assert sorted(joined.collect()) == sorted(want.collect())


def test_calendar_filter_prunes_the_fact_folders(spark, warehouse, tmp_path):
    from lading.operators.layout import read_partitioned_all, write_partitioned
    from lading.plans.calendar import revenue_by_day
    fact = warehouse.fct_order_line.where("order_date between date'1995-01-01' and date'1995-06-30'")
    path = str(tmp_path / "fact")
    write_partitioned(fact, path, "order_date")
    days = warehouse.dim_date.where("calendar_month = 2 and is_weekend and calendar_year = 1995")
    got = revenue_by_day(read_partitioned_all(spark, path, fact.schema), days)
    rows = got.collect()
    plan = _plan(got)
    assert "dynamicpruning" in plan
    scan = _find_scan(got._jdf.queryExecution().executedPlan(), "order_date")
    folders = sum(d.startswith("order_date=") for d in os.listdir(path))
    assert scan.metrics().apply("numPartitions").value() <= 8 < folders
    assert sum(r["lines"] for r in rows) == fact.where("month(order_date) = 2 and dayofweek(order_date) in (1, 7)").count()


def _find_scan(plan, column):
    leaves, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            leaves.append(node)
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return next(n for n in leaves if f"{column}#" in n.toString() and "dynamicpruning" in n.toString())


def test_folder_merge_replaces_only_touched_folders(spark, tmp_path):
    from lading.operators.merge import merge_folders, merge_into, write_folders
    target = spark.range(5000).selectExpr("concat('k', id) as k", "id as v", "id as w")
    source = spark.createDataFrame([("k3", 99, 0), ("k4", 4, 0), ("new", 1, 2)], "k string, v long, w long")
    path = str(tmp_path / "t")
    write_folders(target, path, "k", 32)
    before = {(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    touched = merge_folders(path, source, "k", ("k", "v", "w"), ("v",), True, 32)
    after = {(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert 1 <= len(touched) <= 3
    changed = {d.rsplit("part=", 1)[1] for d, _ in before ^ after}
    assert changed == {str(p) for p in touched}
    want = merge_into(target, source, "k", ("k", "v", "w"), ("v",), True).select("k", "v", "w")
    assert sorted(spark.read.parquet(path).select("k", "v", "w").collect()) == sorted(want.collect())
    assert merge_folders(path, source.limit(0), "k", ("k", "v", "w"), ("v",), True, 32) == []


def test_stream_version_keeps_untouched_folders(spark, tmp_path):
    from lading.streaming.incremental import apply_batch, latest_version, manifest
    root = str(tmp_path / "target")
    first = spark.range(1000).selectExpr("concat('k', id) as k", "id as v", "1 as ts")
    apply_batch(spark, first, 0, root, "k", ("k", "v"), ("v",), ("ts",))
    apply_batch(spark, spark.createDataFrame([("k5", 77, 2)], "k string, v long, ts int"), 1, root, "k", ("k", "v"), ("v",), ("ts",))
    versions = manifest(spark, root)
    assert sorted(versions.values()).count(1) == 1 and set(versions.values()) == {0, 1}
    now = {r["k"]: r["v"] for r in latest_version(spark, root).collect()}
    assert len(now) == 1000 and now["k5"] == 77 and now["k6"] == 6


def test_merged_sketches_have_a_small_rank_error(spark):
    from lading.plans.sketches import QUANTILES, daily_lead_time_sketches, lead_time_quantiles
    orders = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'A', 'B') as carrier", "date_add(date'2025-01-01', cast(id % 90 as int)) as order_date",
        "if(id % 50 = 0, null, cast(pow((id * 7919) % 1000, 2) as bigint)) as order_lead_time_days")
    got = {r["carrier"]: r for r in lead_time_quantiles(daily_lead_time_sketches(orders)).collect()}
    for carrier in ("A", "B"):
        values = sorted(r[0] for r in orders.where(f"carrier = '{carrier}' and order_lead_time_days is not null")
                        .select("order_lead_time_days").collect())
        assert got[carrier]["shipments"] == len(values)
        for name, q in QUANTILES.items():
            below = sum(v < got[carrier][name] for v in values) / len(values)
            upto = sum(v <= got[carrier][name] for v in values) / len(values)
            assert below - 0.03 <= q <= upto + 0.03
