"""Findings of round 4: a broadcast is bounded by its rows in memory."""

import pytest
from pyspark.sql import functions as F

from lading.functions.joins import broadcast_if_small, estimated_bytes, held_bytes
from lading.sources.contract import SourceContract
from tests.conftest import SF_SMALL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bound(spark):
    """Sets the bound of a broadcast for one test."""
    def put(n):
        spark.conf.set("lading.broadcast.maxBytes", str(n))
    old = spark.conf.get("lading.broadcast.maxBytes", None)
    yield put
    spark.conf.unset("lading.broadcast.maxBytes") if old is None else spark.conf.set("lading.broadcast.maxBytes", old)


def test_a_small_file_of_many_rows_is_not_broadcast(spark, tmp_path, bound):
    """Encoded, 100,000 rows are a small file; their rows are not small."""
    path = str(tmp_path / "dim")
    spark.range(100_000).selectExpr("id div 1000 as k", "'north' as v").coalesce(1).write.parquet(path)
    dim, facts = spark.read.parquet(path), spark.range(10).withColumnRenamed("id", "k")
    bound(1 << 20)
    assert estimated_bytes(dim) < 1 << 20 < 80 * 100_000 < held_bytes(dim)
    joined = facts.join(broadcast_if_small(dim), "k")
    assert "BroadcastHashJoin" not in physical(joined) and joined.count() == 10_000
    bound(16 << 20)
    joined = facts.join(broadcast_if_small(dim), "k")
    assert "BroadcastHashJoin" in physical(joined) and joined.count() == 10_000


def test_held_bytes_count_texts_nulls_and_equal_names(spark):
    t = spark.sql("select * from values ('abcd', 1L), (null, null) as t(a, b)")
    twice = t.join(t.select(F.col("a").alias("x"), "b").withColumnRenamed("x", "a"), F.lit(True), "cross")
    assert held_bytes(t) == 2 * (64 + 16) + 4 and held_bytes(t.limit(0)) == 0
    assert held_bytes(twice) == 4 * (64 + 32) + 16


def test_orders_of_many_rows_are_not_broadcast_to_the_lines(spark, tmp_path, bound):
    """The orders met the lines as a broadcast by the size of their file."""
    orders, lines = str(tmp_path / "orders"), str(tmp_path / "lines")
    (spark.range(50_000).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus", "0D as o_totalprice",
                                    "timestamp_ntz'1995-02-01' as o_orderdate", "'LOW' as o_orderpriority").coalesce(1).write.parquet(orders))
    (spark.range(100).selectExpr("id * 3 as l_orderkey", "1 as l_linenumber", "1L as l_partkey", "1L as l_suppkey", "2D as l_quantity",
                                 "1D as l_extendedprice", "timestamp_ntz'1995-02-01' as l_shipdate").write.parquet(lines))

    class Own(SourceContract):
        def table(self, name):
            return spark.read.parquet(orders if name == "orders" else lines) if name in ("orders", "lineitem") else super().table(name)

    bound(1 << 20)
    found = Own(spark, SF_SMALL).order_lines
    plan = physical(found)
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan       # the few parts alone
    assert found.count() == 100 and found.select("order_id").distinct().count() == 100
