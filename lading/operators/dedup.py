"""Keep-latest deduplication (QUALIFY row_number() = 1 and its DataFrame form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def key_struct(keys: Sequence[str]) -> Column:
    """The keys as one struct column: the dedup's partition expression.

    A partitioning on some of the keys (a preceding shuffle join on one of
    them, say) never satisfies a struct, so the dedup always gets its own
    exchange — with the partial limit in front of it.  Spread an input with
    ``repartition(n, key_struct(keys))`` to give it exactly that exchange.
    """
    return F.struct(*[F.col(k) for k in keys])


def keep_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence, rank_col: str = "_rn") -> DataFrame:
    """One row per ``keys``: the first by ``order_desc`` (descending, NULLs last).

    Planned as ``row_number() ... = 1``; Catalyst turns it into a
    WindowGroupLimit that keeps the top row per key *before* the shuffle
    (partial) and again after it (final), so a key holding a large share of
    the rows is reduced map-side instead of landing whole in one task.
    Callers pass an ordering that is total on the payload, so the surviving
    row does not depend on task order (ties on the timestamp alone exist).
    """
    w = Window.partitionBy(key_struct(keys)).orderBy(*[_desc(c) for c in order_desc])
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) == 1)
            .drop(rank_col))


def latest_by(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest by ``order_desc``, then by the other
    columns (NULLs least), as one aggregate.

    The row travels as a struct whose first fields are the order, so its
    maximum is the latest row and ties cannot depend on task order.  The
    aggregate combines map-side and has one plan at every size.
    """
    order = list(order_desc)
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*[F.col(c) if c in keys else F.col("_top")[c].alias(c) for c in df.columns])
