"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bound for a broadcast side, in bytes of its rows in memory: the driver
# collects the table, builds it and keeps it with its serialised copy, next to
# the other tables of the query.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
CONF_KEY = "lading.broadcast.maxBytes"
ROW_BYTES = 64                  # of a row besides its columns: header and place in the hash table


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (None if unavailable, e.g. Connect)."""
    if not hasattr(df, "_jdf"):                               # Connect sessions expose no JVM plan
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(CONF_KEY, None)
    return int(value) if value else DEFAULT_BROADCAST_BYTES


def held_bytes(df: DataFrame) -> int:
    """What the rows of ``df`` take as a broadcast table: one aggregate over
    them (over a Parquet scan without texts, of the row counts in its footers)."""
    rows = df.toDF(*(str(i) for i in range(len(df.columns))))
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if isinstance(f.dataType, T.StringType | T.BinaryType)]
    n, text = rows.agg(F.count(F.lit(1)), F.sum(sum(texts, F.lit(0)).cast("bigint"))).first()
    return n * (ROW_BYTES + 8 * len(rows.columns)) + (text or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its size in memory is bounded.

    The optimizer's estimate comes from file sizes and projected row widths,
    and encoding makes files many times smaller than their rows: it only says
    which frames are worth counting.  Above the bound (or with no estimate) the
    frame is returned unchanged and the planner uses a shuffle join; AQE may
    still switch to a broadcast at runtime from measured shuffle sizes.  A frame
    counted above the bound is marked for a sort-merge join, or the planner
    would broadcast it by its file size.
    """
    limit = max_bytes if max_bytes is not None else broadcast_limit(df)
    size = estimated_bytes(df)
    if size is None or size > limit:
        return df
    return F.broadcast(df) if held_bytes(df) <= limit else df.hint("merge")
