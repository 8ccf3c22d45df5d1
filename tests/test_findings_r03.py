"""What the jobs of round 3 shuffle and write."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lading.plans import registry


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """Names and columns of the layer tables that a query writes."""
    from lading.operators import materialize
    seen = {}
    real = materialize.Materializer.__call__

    def call(self, name, df):
        seen.setdefault(name, df.columns)
        return real(self, name, df)
    monkeypatch.setattr(materialize.Materializer, "__call__", call)
    return seen


@pytest.mark.parametrize("name", ["demand_grid", "fct_inventory_snapshot", "fct_demand_forecast"])
def test_months_are_exploded_above_the_joins(spark, name):
    plan = optimized(registry.QUERIES[name](spark, SF_SMALL))
    assert plan.index("Generate explode(") < plan.index("Join ")


def test_grid_takes_repeated_products_and_lines_without_a_month(spark):
    from lading.sources.contract import SourceContract

    class Own(SourceContract):
        def table(self, name):
            if name == "part":
                return spark.sql("select * from values (1L, 'T', 2, 10D), (1L, 'T', 2, 12D), (2L, 'T', 3, 5D), (cast(null as bigint), 'T', 3, 5D) "
                                 "as t(p_partkey, p_type, p_size, p_retailprice)")
            if name == "orders":
                return spark.sql("select o_orderkey, 1L as o_custkey, 'O' as o_orderstatus, cast(d as timestamp_ntz) as o_orderdate from values "
                                 "(1L, '1995-01-05'), (2L, '1995-03-05'), (3L, null) as t(o_orderkey, d)")
            if name == "lineitem":
                return spark.sql("select l_orderkey, 1 as l_linenumber, l_partkey, 1L as l_suppkey, q as l_quantity, 1D as l_extendedprice, "
                                 "timestamp_ntz'1995-02-01' as l_shipdate from values (1L, 1L, 4D), (2L, 2L, 7D), (3L, 2L, 9D) as t(l_orderkey, l_partkey, q)")
            return super().table(name)
    grid = Own(spark, SF_SMALL).demand_grid.cache()
    warehouses = grid.select("warehouse").distinct().count()
    assert grid.count() == 4 * 3 * warehouses                  # four product rows, three months
    # both rows of product 1 meet each line twice, as the joined lines do
    assert [r[:] for r in grid.where("monthly_demand > 0").groupBy("sku").agg(F.count("*"), F.sum("monthly_demand")).orderBy("sku").collect()] == [
        ("SKU-0000001", 2, 16), ("SKU-0000002", 1, 7)]


def test_dense_fact_is_not_sorted_for_a_large_dimension(spark):
    from lading.plans.inventory import mart_inventory_risk
    from lading.plans.warehouse import Warehouse
    old = spark.conf.get("lading.broadcast.maxBytes", None)
    spark.conf.set("lading.broadcast.maxBytes", "1")
    try:
        wh = Warehouse.from_testdata(spark, SF_SMALL)
        plan = physical(mart_inventory_risk(wh.fct_inventory_snapshot, wh.dim_product, wh.dim_supplier))
    finally:
        spark.conf.unset("lading.broadcast.maxBytes") if old is None else spark.conf.set("lading.broadcast.maxBytes", old)
    assert "ShuffledHashJoin" in plan


def test_lines_are_joined_by_numbers(spark):
    from lading.sources.contract import SourceContract
    plan = optimized(SourceContract(spark, SF_SMALL).order_lines_bronze)
    assert "lpad(" not in plan[plan.index("Join "):]


@pytest.mark.parametrize("name", ["rolling_30_order_otif_staged", "export_order_mart", "mart_clustered_read"])
def test_lines_read_once_are_not_written(spark, written, name):
    registry.QUERIES[name](spark, SF_SMALL)
    assert written and all(n.startswith("ordered-") for n in written)


def test_measures_are_not_sorted_or_written(spark, written):
    from lading.plans.fulfillment import MEASURES
    mart = registry.QUERIES["mart_order_fulfillment"](spark, SF_SMALL)
    assert MEASURES <= set(mart.columns)
    assert not any(MEASURES & set(columns) for columns in written.values())


def test_gate_writes_the_extract_alone(spark, written):
    from lading.sources.contract import ORDER_LINE_COLUMNS
    registry.QUERIES["quality_gate"](spark, SF_SMALL)
    assert tuple(written["bronze_order_lines"]) == ORDER_LINE_COLUMNS


def test_a_merge_deals_each_side_once(spark, tmp_path):
    from lading.operators.merge import PART, folder_of, joined_by_folder, merge_into
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("concat('k', id) as k", "id as v").withColumn(PART, folder_of("k")).write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.read.parquet(path)
        plain = physical(merge_into(t, t, "k", ("k", "v"), ("v",), True))
        with joined_by_folder(spark):
            dealt = t.repartition(64, PART)
            by_folder = physical(merge_into(dealt, dealt, "k", ("k", "v"), ("v",), True, folder=PART))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"Exchange hashpartitioning", plain)) == 2
    assert len(re.findall(r"Exchange hashpartitioning", by_folder)) == 2


@pytest.mark.parametrize("name", ["quality_report", "quality_gate"])
def test_report_writes_the_columns_it_reads(spark, monkeypatch, name):
    from lading.operators import materialize
    kept = {}
    real = materialize.Materializer.__call__

    def call(self, table, df):
        back = real(self, table, df)
        kept[table] = set(back.columns)
        return back
    monkeypatch.setattr(materialize.Materializer, "__call__", call)
    registry.QUERIES[name](spark, SF_SMALL)
    assert not kept["order_facts"] & {"customer_id", "warehouse", "order_date", "recognized_revenue", "logistics_cost"}
    assert not kept["fct_shipment"] & {"warehouse", "promised_date", "source_on_time"}
    assert all("ingestion_timestamp" not in columns for columns in kept.values())


def test_a_table_kept_whole_keeps_its_columns(spark, tmp_path):
    from lading.operators.materialize import Materializer
    df = spark.sql("select 1 as a, 2 as b")
    m = Materializer(spark, str(tmp_path), columns={"narrow": ("b",)})
    assert (m("whole", df).columns, m("narrow", df).columns) == (["a", "b"], ["b"])
