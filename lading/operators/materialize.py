"""Materialise a layer table as Parquet in the shared checkpoint folder.

The reference builds each layer with ``create or replace table``; here a
table that several jobs (or several branches of one plan) read is written
once and read back.  That computes it once instead of once per consumer,
cuts the lineage (a lost executor recomputes from these files, not from the
sources), and gives the optimizer real file sizes for broadcast checks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from lading.session import scratch_path


class Materializer:
    def __init__(self, spark: SparkSession, root: str | None = None, columns: Mapping[str, Sequence[str]] | None = None):
        """``columns``: what the readers of a table use, where that is less
        than the whole; the others are neither computed nor written."""
        self.spark = spark
        self._columns = columns or {}
        self.root = (root or scratch_path(spark, f"run-{uuid.uuid4().hex[:12]}")).rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self._tables:
            if name in self._columns:
                df = df.select(*self._columns[name])
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]
