"""Running and rolling window aggregates that stay parallel on hot keys.

A plain ``Window.partitionBy(k).orderBy(o)`` puts every row of one key in one
task; AQE cannot split window partitions.  With one customer (or the whole
table, for a global order) holding a third of all rows, that task becomes the
job.  The operators here are a distributed prefix scan:

1. the rows are sorted into ranges of the full order (sampled splitters, so a
   hot key is cut by what follows it in the order) and written once, each row
   with its range and its place there;
2. per range, counts and sums are one aggregate; what a range inherits from
   the ranges before it is a prefix over at most one row per range and key
   that crosses into it;
3. the window runs inside a range, plus that carry.

The size of a range does not depend on the values of the keys: constant
prefixes, random ids and hot keys are cut alike.  NULL order keys sort last,
as in the warehouses.  Results equal the plain window exactly (integer counts,
exact decimals).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.functions.joins import estimated_bytes
from lading.operators.materialize import Materializer

_PRE = Window.unboundedPreceding
RANGE_BYTES = 128 * 1024 * 1024
_RANGE, _NTH = "_range", "_nth"


def range_count(df: DataFrame) -> int:
    """Ranges of a sort: four per core, one per ``RANGE_BYTES`` of estimated
    input beyond that, at most the session's shuffle partitions (the estimate
    of a join is the product of its inputs)."""
    spark = df.sparkSession
    least = 4 * spark.sparkContext.defaultParallelism
    most = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(most, max(least, (estimated_bytes(df) or 0) // RANGE_BYTES))


def ordered_ranges(df: DataFrame, order_by: Sequence[str], ranges: int | None = None, keep: Materializer | None = None) -> DataFrame:
    """``df`` sorted into ranges and written once to the shared folder, with
    the number of the row's range and its place there, from 0.  The rank of a
    row is the number of rows in earlier ranges plus its place."""
    keys = [F.col(c).asc_nulls_last() for c in order_by]
    keep = keep or Materializer(df.sparkSession)
    rows = df.repartitionByRange(ranges or range_count(df), *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()                     # partition in the upper 31 bits, place in the lower 33
    written = keep(f"ordered-{uuid.uuid4().hex[:8]}", rows.withColumn("_at", at))
    return (written.withColumns({_RANGE: F.shiftright("_at", 33), _NTH: F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
            .drop("_at"))


def running_rank_and_sum(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                         value: str, rank_name: str, sum_name: str, ranges: int | None = None) -> DataFrame:
    """``row_number()`` and ``sum(value) rows unbounded preceding`` per partition.

    Only the key that a range begins with can have rows in earlier ranges, so
    the carries are at most one row per range (and the totals behind them at
    most two); they are broadcast.  Ties in ``order_by`` must not exist
    (callers end it with a unique id).
    """
    part = list(partition_by)
    rows = ordered_ranges(df, [*part, *order_by], ranges)
    names = {c: f"_of_{c}" for c in part}

    def same(left: DataFrame, right: DataFrame):
        out = F.lit(True)
        for c, n in names.items():
            out = out & left[c].eqNullSafe(right[n])
        return out

    heads = rows.where(F.col(_NTH) == 0).select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    total = (rows.join(F.broadcast(heads), same(rows, heads)).groupBy(_RANGE, *names.values())
             .agg(F.count(F.lit(1)).alias("_n"), F.count(value).alias("_nn"), F.sum(value).alias("_s")))
    prior = Window.partitionBy(*names.values()).orderBy(_RANGE).rowsBetween(_PRE, -1)
    carry = total.select(F.col(_RANGE).alias("_into"), *names.values(), F.sum("_n").over(prior).alias("_off_n"),
                         F.sum("_nn").over(prior).alias("_off_nn"), F.sum("_s").over(prior).alias("_off_s")).where("_off_n > 0")

    inside = Window.partitionBy(_RANGE, *part).orderBy(_NTH)
    running = inside.rowsBetween(_PRE, 0)
    joined = rows.join(F.broadcast(carry), (rows[_RANGE] == carry["_into"]) & same(rows, carry), "left")
    zero = F.lit(0)
    nn = F.coalesce("_off_nn", zero) + F.count(value).over(running)
    sums = F.coalesce("_off_s", zero) + F.coalesce(F.sum(value).over(running), zero)
    return (joined.withColumns({rank_name: F.coalesce("_off_n", zero) + F.row_number().over(inside),
                                sum_name: F.when(nn > 0, sums)})
            .drop(_RANGE, _NTH, "_into", *names.values(), "_off_n", "_off_nn", "_off_s"))


def global_positions(df: DataFrame, order_by: Sequence[str], pos_name: str = "_pos", ranges: int | None = None,
                     keep: Materializer | None = None) -> DataFrame:
    """1-based position of every row in ``order_by``, without a window over
    the rows: rows of earlier ranges (one broadcast row per range) plus the
    place in its own."""
    rows = ordered_ranges(df, order_by, ranges, keep)
    held = rows.groupBy(F.col(_RANGE).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = held.select("_of", F.coalesce(F.sum("_n").over(Window.orderBy("_of").rowsBetween(_PRE, -1)), F.lit(0)).alias("_off"))
    return (rows.join(F.broadcast(before), rows[_RANGE] == before["_of"])
            .withColumn(pos_name, F.col("_off") + F.col(_NTH) + 1).drop("_of", "_off", _RANGE, _NTH))


def rolling_by_position(df: DataFrame, pos: str, value: str, preceding: int, out: str,
                        agg=F.avg, block_rows: int = 10_000) -> DataFrame:
    """``agg(value) over (order by pos rows between preceding and current row)``.

    Rows are cut into blocks of ``block_rows`` consecutive positions; the last
    ``preceding`` rows of each block are copied into the next block as a halo,
    the window runs per block, and halo copies are dropped.  Work per task is
    bounded by the block size, never by the table.
    """
    if block_rows <= preceding:
        raise ValueError("block_rows must exceed the frame length")
    b = F.floor((F.col(pos) - 1) / block_rows)
    in_halo = (F.col(pos) - 1) % block_rows >= block_rows - preceding
    targets = F.when(in_halo, F.array(b, b + 1)).otherwise(F.array(b))
    expanded = (df.withColumn("_home", b)
                .withColumn("_blk", F.explode(targets)))
    w = Window.partitionBy("_blk").orderBy(pos).rowsBetween(-preceding, 0)
    return (expanded.withColumn(out, agg(F.col(value)).over(w))
            .filter(F.col("_blk") == F.col("_home"))
            .drop("_blk", "_home"))
