"""Physical layouts: plan assertions on a written fixture."""

import uuid

import pytest

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fact(spark):
    from lading.plans.warehouse import Warehouse
    return Warehouse.from_testdata(spark, SF_SMALL, materialize=True).fct_order_line


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_and_pruned_read(spark, fact, tmp_path):
    from lading.operators.layout import read_partitioned, write_partitioned
    path = str(tmp_path / "fact")
    write_partitioned(fact, path, "order_date", ["warehouse", "customer_id", "sku"])
    whole = spark.read.schema(fact.schema).parquet(path)
    assert whole.count() == fact.count()
    pruned = read_partitioned(spark, path, fact.schema, "order_date", "1995-01-01", "1995-03-31")
    plan = _plan(pruned)
    assert "PartitionFilters: [isnotnull(order_date" in plan
    want = fact.filter("order_date between date'1995-01-01' and date'1995-03-31'")
    assert sorted(pruned.collect()) == sorted(want.collect())
    with pytest.raises(ValueError):
        read_partitioned(spark, path, fact.schema, "order_date", None, "1995-03-31")


def test_bucketed_rollup_has_no_shuffle_of_lines(spark, fact, tmp_path):
    from lading.operators.layout import write_bucketed
    from lading.plans.fulfillment import order_rollup
    name = f"fct_{uuid.uuid4().hex[:8]}"
    write_bucketed(fact, name, str(tmp_path / name), "order_id", ["order_date"], buckets=4)
    rolled = order_rollup(spark.table(name))
    plan = _plan(rolled)
    assert "Exchange" not in plan
    assert sorted(rolled.collect()) == sorted(order_rollup(fact).collect())


def test_ordered_export_round_trip(spark, tmp_path):
    from lading.operators.layout import export_ordered_csv, read_csv
    df = spark.range(500).selectExpr("cast(500 - id as int) k", "cast(id as string) v")
    path = str(tmp_path / "out.csv")
    export_ordered_csv(df, path, ["k"])
    back = read_csv(spark, path, df.schema).collect()
    assert [r["k"] for r in back] == sorted(r["k"] for r in back)


def test_extract_registry_fails_on_missing(spark, tmp_path):
    from lading.sources.extracts import read_extracts
    with pytest.raises(FileNotFoundError):
        read_extracts(spark, str(tmp_path / "nothing"))


def test_extract_inference_fallback_reads_the_same_rows(spark, tmp_path):
    """A1: full-file inference (``samplingRatio=1``) reads what the declared schema reads."""
    from lading.sources.contract import SourceContract
    from lading.sources.extracts import read_extract, write_extracts
    d = str(tmp_path / "src")
    write_extracts({"suppliers": SourceContract(spark, SF_SMALL).suppliers}, d)
    declared = read_extract(spark, d, "suppliers")
    inferred = read_extract(spark, d, "suppliers", infer=True)
    assert inferred.columns == declared.columns
    assert dict(inferred.dtypes)["base_lead_time_days"] == "int"
    assert sorted(map(tuple, inferred.collect())) == sorted(map(tuple, declared.collect()))


def test_partitioned_read_restores_listing_conf(spark, fact, tmp_path):
    from lading.operators.layout import read_partitioned_all, write_partitioned, write_tasks
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    path = str(tmp_path / "p")
    assert write_tasks(fact) >= spark.sparkContext.defaultParallelism
    part = fact.filter("order_date < date'1993-01-01'")
    write_partitioned(part, path, "order_date")
    assert read_partitioned_all(spark, path, fact.schema).count() == part.count()
    assert spark.conf.get(key, None) == before


def test_bucketed_write_makes_at_most_one_file_per_bucket(spark, fact, tmp_path):
    from lading.operators.layout import write_bucketed
    name = f"fct_{uuid.uuid4().hex[:8]}"
    write_bucketed(fact.repartition(8), name, str(tmp_path / name), "order_id", buckets=16)
    assert len(list((tmp_path / name).glob("*.parquet"))) <= 16
