"""Incremental upserts from landed bronze files (Structured Streaming).

An optional extension of the reference's batch MERGE patterns: a file
stream of bronze order lines; each micro-batch is deduplicated (keep-latest
per key) and merged into the target with the same ``merge_into`` as the
batch jobs.  The target lies in folders by a hash of the key.  A batch writes
only the folders its keys fall into, as version ``v=<epoch>``, and then a
manifest that names the version of every folder; folders it does not touch
keep their files and their version.  A version counts once its manifest is
written, and nothing that a manifest names is overwritten by a later epoch, so
a replayed epoch (after a failure) rebuilds the same version from the same
inputs: the sink is idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.operators.dedup import keep_latest
from lading.operators.merge import INSERTED, PART, merge_into, touched_folders, write_folders


def _versions(spark: SparkSession, root: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:08d}"


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def manifest(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """Version of every folder in the newest committed version (optionally
    older than ``before``); one small row per folder."""
    done = [v for v in _versions(spark, _manifests(root)) if before is None or v < before]
    if not done:
        return {}
    return {r["part"]: r["version"] for r in spark.read.parquet(version_path(_manifests(root), done[-1])).collect()}


def latest_version(spark: SparkSession, root: str, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame | None:
    """The newest committed version (optionally older than ``before``, and
    only the folders ``parts``)."""
    found = manifest(spark, root, before)
    paths = [f"{version_path(root, v)}/{PART}={p}" for p, v in sorted(found.items()) if parts is None or p in parts]
    return spark.read.parquet(*paths) if paths else None


def apply_batch(spark: SparkSession, batch: DataFrame, epoch: int, root: str, key: str,
                columns: Sequence[str], update_columns: Sequence[str], order_desc: Sequence[str],
                conditional: bool = True) -> None:
    """Merge one batch into version ``epoch`` of the target under ``root``."""
    latest = keep_latest(batch, [key], order_desc)
    touched = touched_folders(latest, key)
    prev = latest_version(spark, root, before=epoch, parts=touched)
    if prev is None:
        nxt = latest.select(*columns, F.current_timestamp().alias("updated_at"),
                            F.lit(INSERTED).alias("merge_action"))
    else:
        nxt = merge_into(prev, latest, key, columns, update_columns, conditional)
    write_folders(nxt.drop("merge_action"), version_path(root, epoch), key)
    versions = manifest(spark, root, before=epoch) | dict.fromkeys(touched, epoch)
    (spark.createDataFrame(sorted(versions.items()), "part int, version int").coalesce(1)
     .write.mode("overwrite").parquet(version_path(_manifests(root), epoch)))


def start_upsert_stream(spark: SparkSession, bronze_dir: str, schema: T.StructType, target_root: str,
                        checkpoint_location: str, key: str, columns: Sequence[str],
                        update_columns: Sequence[str], order_desc: Sequence[str],
                        conditional: bool = True, max_files_per_trigger: int | None = None,
                        available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(bronze_dir)

    def each(batch: DataFrame, epoch: int) -> None:
        apply_batch(spark, batch, epoch, target_root, key, columns, update_columns, order_desc, conditional)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
