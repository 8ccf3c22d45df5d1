"""Physical layouts for published tables: ordered exports, date-partitioned
and clustered facts, hash-bucketed facts, and partition-pruned reads."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.functions.joins import estimated_bytes
from lading.operators.running import global_positions, range_count


ROWS_PER_FILE = 1_000_000


def export_ordered_csv(df: DataFrame, path: str, order_by: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """A5: ``copy (select ... order by ...) to csv`` (NULLs last).

    Part files are ordered and their concatenation is the ordered relation,
    whatever its size.  Split points are ranks (every ``rows_per_file`` rows),
    not sampled keys, and the other columns break ties, so two exports of the
    same rows have byte-equal part files.
    """
    total_order = [*order_by, *(c for c in df.columns if c not in order_by)]
    placed = global_positions(df, total_order, "_pos")
    files = placed.agg(F.max("_pos")).first()[0] or 1          # one number
    file_of = ((F.col("_pos") - 1) / rows_per_file).cast("int")
    (placed.repartitionById(-(-files // rows_per_file), file_of).sortWithinPartitions("_pos").drop("_pos")
     .write.mode("overwrite").option("header", True).csv(path))


def write_clustered(df: DataFrame, path: str, cluster_cols: Sequence[str], tasks: int | None = None) -> None:
    """``cluster by (...)`` without folders.

    Rows are range-partitioned and sorted on the cluster columns, so the
    Parquet min/max statistics of files and row groups are narrow and hardly
    overlap: a read with a range on the leading column skips the other files'
    row groups.  A hot value is cut by the columns after it."""
    keys = list(cluster_cols)
    (df.repartitionByRange(tasks or range_count(df), *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(path))


@contextmanager
def listing_parallelism(spark: SparkSession):
    """Size the partition-discovery job to the cluster's cores while a
    partitioned table is opened (the default, 10,000, launches one tiny task
    per folder on a years-long daily layout)."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(key, None)
    want = spark.sparkContext.defaultParallelism * 4
    if old is None or int(old) > want:
        spark.conf.set(key, str(want))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


TARGET_FILE_BYTES = 256 * 1024 * 1024


def write_tasks(df: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Writer tasks for a layout: every core at least, one per ``target_bytes``
    of estimated input beyond that.  Explicit, because AQE would otherwise
    coalesce a small range shuffle into one or two writer tasks.  The estimate
    of a join is the product of its inputs: pass a materialised frame (as the
    callers here do) or an explicit task count."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = estimated_bytes(df)
    by_size = -(-size // target_bytes) if size else 0
    return int(max(cores, by_size))


def write_partitioned(df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str] = (),
                      max_records_per_file: int = 5_000_000, tasks: int | None = None) -> None:
    """``partition by date cluster by (...)``.

    Rows are range-partitioned on (partition column, cluster columns) — a
    sampled range split, so one hot date is spread over several tasks instead
    of one — sorted within each task, and written with one folder per date.
    """
    keys = [partition_col, *cluster_cols]
    (df.repartitionByRange(tasks or write_tasks(df), *keys)
     .sortWithinPartitions(*keys)
     .write.mode("overwrite")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(partition_col)
     .parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, sort_cols: Sequence[str] = (),
                   buckets: int | None = None) -> None:
    """Hash distribution on ``key`` (``distkey`` / ``distribution=hash``).

    Bucketed Parquet: later joins and aggregations on ``key`` with the same
    bucket count need no shuffle of this side.  Rows are hashed on the key
    into as many tasks as buckets first, so each bucket is one file.  All
    rows of one key are one bucket: that is what bucketing means.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartition(n, key).write.mode("overwrite").option("path", path).bucketBy(n, key)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    w.saveAsTable(table)


def month_globs(start: str, end: str) -> list[str]:
    """``YYYY-MM-*`` patterns covering the date range [start, end]."""
    import datetime as dt
    a, b = dt.date.fromisoformat(str(start)[:10]), dt.date.fromisoformat(str(end)[:10])
    out, y, m = [], a.year, a.month
    while (y, m) <= (b.year, b.month):
        out.append(f"{y:04d}-{m:02d}-*")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _existing_globs(spark: SparkSession, patterns: list[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for pat in patterns:
        p = jvm.org.apache.hadoop.fs.Path(pat)
        found = p.getFileSystem(conf).globStatus(p)
        if found is not None and len(found) > 0:
            keep.append(pat)
    return keep


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, partition_col: str,
                     start, end) -> DataFrame:
    """Partition-filtered read; the date range is mandatory.

    Only the partition folders of the months covering the range are listed
    (month globs under ``basePath``), so a years-long daily layout is not
    enumerated for a one-quarter read; the exact range then applies as a
    PartitionFilter.
    """
    if start is None or end is None:
        raise ValueError(f"a {partition_col} range is required to read {path}")
    base = path.rstrip("/")
    globs = _existing_globs(spark, [f"{base}/{partition_col}={g}" for g in month_globs(start, end)])
    col: Column = F.col(partition_col)
    rng = col.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if not globs:
        return spark.createDataFrame([], schema)
    with listing_parallelism(spark):
        df = spark.read.schema(schema).option("basePath", base).parquet(*globs)
    return df.filter(rng).select(*schema.fieldNames())


def read_partitioned_all(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole partitioned table, in the table's column order."""
    with listing_parallelism(spark):
        df = spark.read.schema(schema).parquet(path)
    return df.select(*schema.fieldNames())
