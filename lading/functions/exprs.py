"""Column expressions shared by the jobs (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator, denominator) -> Column:
    """``num / nullif(den, 0)`` as DOUBLE.

    Both sides are cast to double first so that decimal / decimal gives the
    same type as the DuckDB oracle (Spark would give decimal(38, x)).
    """
    den = col(denominator).cast("double")
    return col(numerator).cast("double") / F.nullif(den, F.lit(0.0))


def flag(condition: Column) -> Column:
    """``case when cond then 1 else 0 end``: a NULL condition gives 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def padded_id(prefix: str, key, width: int) -> Column:
    """``prefix || lpad(key, width, '0')`` that never truncates long keys."""
    s = col(key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0")))


def month_start(d) -> Column:
    """``date_trunc(d, month)`` returning DATE (Spark date_trunc gives TIMESTAMP)."""
    return F.trunc(col(d), "month")


def month_boundaries(later, earlier) -> Column:
    """Month boundaries crossed from ``earlier`` to ``later`` (BigQuery/DuckDB
    ``date_diff(..., month)``); Spark's months_between counts whole months."""
    return (F.year(col(later)) - F.year(col(earlier))) * 12 + (F.month(col(later)) - F.month(col(earlier)))


def full_day_name(d) -> Column:
    """``dayname`` with the full English name (Spark ``dayname`` gives 'Sun')."""
    return F.date_format(col(d), "EEEE")


def round6(c) -> Column:
    """Rounding used where summation order differs between engines."""
    return F.round(col(c), 6)
