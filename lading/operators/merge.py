"""Keyed incremental merges (MERGE INTO) as a full outer join.

Stock Spark cannot MERGE into a Parquet table, so a merge produces the next
*version* of the target: a full outer join on the key (both sides hash
partitioned by it, so each key meets its counterpart in one task), then a
per-row choice of the surviving values.  The caller writes the version to a
new location and swaps; the path being read is never overwritten.

A large target lies in folders by a hash of the key (``write_folders``).  A
merge then reads, joins and replaces only the folders that the source's keys
fall into (``merge_folders``); the others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lading.operators.materialize import Materializer

UPDATED, INSERTED, UNCHANGED = "updated", "inserted", "unchanged"


def _differs(a: Column, b: Column) -> Column:
    """``a <> b`` where NULL counts as *not* a change (as in the warehouses)."""
    return F.coalesce(a != b, F.lit(False))


def merge_into(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str],
               update_columns: Sequence[str], conditional: bool,
               run_ts: Column | None = None, folder: str | None = None) -> DataFrame:
    """Next version of ``target`` after merging ``source``.

    * matched and (not ``conditional`` or any update column differs):
      update ``update_columns`` and ``updated_at``;
    * matched otherwise, or target-only: keep the target row;
    * source-only: insert with ``updated_at``.
    ``merge_action`` tells which branch produced the row.  The source must be
    unique per key (deduplicate first): a repeated key fails the job when it
    runs.  The check counts rows per key on the partitioning that the join
    needs anyway, so it adds no shuffle.  ``folder`` names a column of both
    sides that follows from the key; it then is a key of the join as well.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in columns],
                      (F.col("updated_at") if "updated_at" in target.columns
                       else F.lit(None).cast("timestamp")).alias("t_updated_at"),
                      F.lit(True).alias("_in_t"), *([F.col(folder).alias("_t_folder")] if folder else []))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in columns], *([F.col(folder).alias("_s_folder")] if folder else []))
    own = F.col(f"s_{key}")                                    # the join's own name: window and join share one exchange
    repeated = (F.count(F.lit(1)).over(Window.partitionBy(*(["_s_folder"] if folder else []), own)) > 1) & own.isNotNull()
    failed = F.raise_error(F.concat(F.lit(f"merge source repeats {key}="), own.cast("string")))
    s = s.withColumn("_in_s", F.when(repeated, failed.cast("boolean")).otherwise(F.lit(True)))
    same = F.col(f"t_{key}") == F.col(f"s_{key}")
    j = t.join(s, (F.col("_t_folder") == F.col("_s_folder")) & same if folder else same, "full_outer")
    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    src_only = F.col("_in_t").isNull()
    if conditional:
        changed = F.lit(False)
        for c in update_columns:
            changed = changed | _differs(F.col(f"t_{c}"), F.col(f"s_{c}"))
    else:
        changed = F.lit(True)
    update = matched & changed
    out = []
    for c in columns:
        if c in update_columns:
            v = F.when(src_only | update, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        else:
            v = F.when(src_only, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        out.append(v.alias(c))
    action = F.when(src_only, F.lit(INSERTED)).when(update, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED))
    updated_at = F.when(src_only | update, ts).otherwise(F.col("t_updated_at"))
    if folder:
        out.append(F.coalesce("_t_folder", "_s_folder").alias(folder))
    return j.select(*out, updated_at.alias("updated_at"), action.alias("merge_action"))


FOLDERS = 64
PART = "part"


def folder_of(key: str, folders: int = FOLDERS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


def write_folders(df: DataFrame, path: str, key: str, folders: int = FOLDERS) -> None:
    """Write ``df`` to one folder per hash of the key."""
    _write(df.withColumn(PART, folder_of(key, folders)).repartition(folders, PART), path, "static")


def _write(df: DataFrame, path: str, overwritten: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", overwritten).option("compression", "zstd")
     .partitionBy(PART).parquet(path))


@contextmanager
def joined_by_folder(spark: SparkSession):
    """Let a join on (folder, key) take sides that are dealt by the folder
    alone; otherwise it deals both again by all its keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def touched_folders(source: DataFrame, key: str, folders: int = FOLDERS) -> list[int]:
    """The folders that the keys of ``source`` fall into (at most ``folders`` numbers)."""
    return sorted(r[0] for r in source.select(folder_of(key, folders)).distinct().collect())


def merge_folders(path: str, source: DataFrame, key: str, columns: Sequence[str], update_columns: Sequence[str],
                  conditional: bool, folders: int = FOLDERS, run_ts: Column | None = None) -> list[int]:
    """Merge ``source`` into the folders under ``path`` and return the folders
    that were replaced.

    The filter on the folder is a partition filter, so the others are neither
    listed for data nor read.  Both sides are dealt by folder once: the
    repeated-key check, the join and the write of the merged folders need no
    other shuffle.  They are first written to the shared folder and then
    swapped in, as they lie, by a dynamic partition overwrite: a job that fails
    before the swap leaves the target as it was, and the swap itself can be
    repeated from what was written.
    """
    spark = source.sparkSession
    keep = Materializer(spark)
    source = keep("source", source.select(*columns))           # read twice: for its folders and for its rows
    touched = touched_folders(source, key, folders)
    if not touched:
        return []
    target = spark.read.parquet(path).where(F.col(PART).isin(touched)).repartition(folders, PART)
    dealt = source.withColumn(PART, folder_of(key, folders)).repartition(folders, PART)
    staged = keep.path("merged")
    with joined_by_folder(spark):
        merged = merge_into(target, dealt, key, columns, update_columns, conditional, run_ts, PART)
        _write(merged.drop("merge_action"), staged, "static")
    _write(spark.read.parquet(staged), path, "dynamic")
    return touched


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their counts (``having count(*) > 1``)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def assert_unique_keys(df: DataFrame, key: str) -> None:
    """Raise if ``df`` repeats ``key``; reads at most one offending key."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"merge source repeats {key}={dup[0][key]!r}")
