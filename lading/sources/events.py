"""Semi-structured order events landed as JSON lines (one payload per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_order_events(events: DataFrame, path: str) -> None:
    """Land ``event_payload`` strings as JSON-lines text files."""
    events.select("event_payload").write.mode("overwrite").text(path)


def read_order_events(spark: SparkSession, path: str) -> DataFrame:
    """The raw event source: one ``event_payload`` string per line, parsed
    downstream (``parse_json`` / ``variant_get``) so that unknown fields and
    shapes are kept, as a VARIANT column keeps them."""
    return spark.read.text(path).withColumnRenamed("value", "event_payload")
