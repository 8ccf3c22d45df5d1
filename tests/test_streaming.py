"""Streaming upserts equal the same merges applied batch by batch."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

COLUMNS = ("order_line_id", "order_id", "customer_id", "order_date", "promised_date", "sku",
           "units_ordered", "units_shipped", "revenue")
ORDER = ("ingestion_timestamp", "l_partkey", "l_suppkey", "l_extendedprice")


def test_stream_equals_sequential_batches(spark, tmp_path):
    from lading.sources.contract import SourceContract
    from lading.streaming.incremental import apply_batch, latest_version, start_upsert_stream
    bronze = SourceContract(spark, SF_SMALL).order_lines_bronze.select(*COLUMNS, *ORDER[1:],
                                                                        "ingestion_timestamp")
    cuts = ["1994-01-01", "1997-01-01"]
    parts = [bronze.filter(F.col("ingestion_timestamp") < F.lit(cuts[0]).cast("timestamp_ntz")),
             bronze.filter(F.col("ingestion_timestamp").between(F.lit(cuts[0]).cast("timestamp_ntz"),
                                                                F.lit(cuts[1]).cast("timestamp_ntz"))
                           & (F.col("ingestion_timestamp") != F.lit(cuts[1]).cast("timestamp_ntz"))),
             bronze.filter(F.col("ingestion_timestamp") >= F.lit(cuts[1]).cast("timestamp_ntz"))]
    landing = tmp_path / "landing"
    import os, time
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(str(landing / f"tmp{i}"))
        f = [x for x in os.listdir(landing / f"tmp{i}") if x.endswith(".parquet")][0]
        os.rename(landing / f"tmp{i}" / f, landing / f"part{i}.parquet")
        time.sleep(1.1)                                     # distinct modification times, landing order
    q = start_upsert_stream(spark, str(landing), bronze.schema, str(tmp_path / "target"),
                            str(tmp_path / "ckpt"), "order_line_id", COLUMNS, ("units_shipped", "revenue"),
                            ORDER, conditional=True, max_files_per_trigger=1)
    q.awaitTermination(300)
    streamed = latest_version(spark, str(tmp_path / "target"))
    for i, p in enumerate(parts):
        apply_batch(spark, p, i, str(tmp_path / "batch"), "order_line_id", COLUMNS,
                    ("units_shipped", "revenue"), ORDER, conditional=True)
    batched = latest_version(spark, str(tmp_path / "batch"))
    a = sorted(streamed.select(*COLUMNS).collect())
    b = sorted(batched.select(*COLUMNS).collect())
    assert len(a) == bronze.select("order_line_id").distinct().count()
    assert a == b


def test_replayed_epoch_rebuilds_the_same_version(spark, tmp_path):
    """A replayed micro-batch (after a failure) rewrites its version from the
    previous one, so the sink is idempotent."""
    from lading.sources.contract import SourceContract
    from lading.streaming.incremental import apply_batch, latest_version
    bronze = SourceContract(spark, SF_SMALL).order_lines_bronze
    first = bronze.filter(F.col("ingestion_timestamp") < F.lit("1995-01-01").cast("timestamp_ntz"))
    second = bronze.filter(F.col("ingestion_timestamp") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    root = str(tmp_path / "target")
    args = ("order_line_id", COLUMNS, ("units_shipped", "revenue"), ORDER)
    apply_batch(spark, first, 0, root, *args)
    apply_batch(spark, second, 1, root, *args)
    once = sorted(latest_version(spark, root).select(*COLUMNS).collect())
    apply_batch(spark, second, 1, root, *args)            # replay of epoch 1
    again = sorted(latest_version(spark, root).select(*COLUMNS).collect())
    assert once == again
