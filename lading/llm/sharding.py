"""Sharding by sampled splitters (operator 13): shards of near equal bytes.

Records are ordered by (text digest, id, row number), so equal texts stand
together and a hot text is still cut by id.  Of this order

1. a size-weighted sample of keys is drawn (every record on its own, with a
   probability in proportion to its bytes);
2. its quantiles are the boundaries of ``RANGES_PER_SHARD`` ranges per shard,
   found for a record by binary search;
3. ranges that hold too many records (many small ones) are overfull and are
   subdivided by the quantiles of a second sample, drawn inside them;
4. records are sorted inside their range; with the exact bytes of the ranges
   before it every record knows its place in bytes, and shard k takes the
   records whose middle lies in the k-th equal part of all bytes.

A group of equal texts of at most ``1 / WHOLE_GROUPS`` of a shard is placed by
its own middle and stays whole; larger groups are cut.  A shard therefore
differs from an equal part by at most one record, or one such group, at each
end.

The number of ranges does not depend on the data, so the tables of splitters
and of ranges are bounded (at most twice ``RANGES_PER_SHARD`` ranges per
shard); records pass only through sorts that spill.  All of it is DataFrame
code; only keys and sizes, never texts, are shuffled to place the records.

Defined results: null texts have no bytes and count as the empty text; null
ids come first within their text; rows equal in id and text are told apart by
their place in the input; an empty table gives no rows; ``write_shards`` keeps
all columns of the input, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.operators.materialize import Materializer
from lading.session import scratch_path

LAW = "bytes"
ROW_BYTES = 8                   # a record's size besides its text
RANGES_PER_SHARD = 128
SAMPLES_PER_RANGE = 16
WHOLE_GROUPS = 32
OVERFULL = 4                    # times the mean number of records of a range

_KEY = "struct(digest, id, row)"


def _draw(probability: Column, seed: int) -> Column:
    """True with this probability, decided by the record itself."""
    u = F.pmod(F.xxhash64("digest", "id", "row", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return u < probability


def _cuts(sample: DataFrame, by: list[str], pieces: Column) -> DataFrame:
    """The splitters of each group of a sample: one row per distinct key."""
    drawn = sample.groupBy(*by).agg(F.array_sort(F.collect_list(F.expr(_KEY))).alias("keys"), F.max(pieces).alias("pieces"))
    at = F.expr("transform(sequence(1, cast(pieces as int)), i -> element_at(keys, cast(1 + (i - 1) * size(keys) div pieces as int)))")
    return drawn.select(F.explode(F.array_distinct(at)).alias("k"))


def _table(cuts: DataFrame) -> DataFrame:
    """One row: the splitters in order.  The first splitter of a digest moves
    to the start of its group, so only groups with several are cut."""
    ranked = cuts.distinct().groupBy("k.digest").agg(F.array_sort(F.collect_list("k")).alias("ks"))
    moved = ranked.select(F.explode(F.expr(
        "transform(ks, (k, i) -> struct(k.digest as digest, if(i = 0, null, k.id) as id, if(i = 0, -1L, k.row) as row))")).alias("k"))
    return moved.agg(F.array_sort(F.collect_list("k")).alias("splitters"))


def _range_of(rows: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """Rows with the number of their range (0: before the first splitter) and
    the digest at which the range begins, by binary search."""
    steps = ",".join(str(1 << b) for b in reversed(range(most.bit_length())))
    found = rows.withColumn("splitters", table.scalar()).withColumn("range", F.expr(f"""
        aggregate(array({steps}), 0, (at, step) ->
            if(at + step <= size(splitters) and element_at(splitters, at + step) <= {_KEY}, at + step, at))"""))
    low = F.expr("if(range > 0, element_at(splitters, range).digest, '')")
    return found.withColumn("low", low).drop("splitters")


def _placed(slim: DataFrame, shards: int, keep: Materializer) -> DataFrame:
    ranges = shards * RANGES_PER_SHARD
    all_ = keep("totals", slim.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")))
    total, n = (all_.select(c).scalar() for c in ("bytes", "rows"))
    weighted = slim.where(_draw(F.col("size") * F.lit(float(ranges * SAMPLES_PER_RANGE)) / total, 1))
    coarse = keep("coarse", _cuts(weighted.withColumn("of", F.lit(0)), ["of"], F.lit(ranges)))
    # ranges with too many records: a second sample inside them
    ranged = _range_of(slim, _table(coarse), ranges)
    full = (ranged.groupBy("range").agg(F.count(F.lit(1)).alias("held"))
            .select("range", "held", F.ceil(F.col("held") * ranges / n).alias("pieces")).where(f"pieces > {OVERFULL}"))
    inside = ranged.join(F.broadcast(full), "range").where(
        _draw(F.col("pieces") * SAMPLES_PER_RANGE / F.col("held"), 2))
    fine = keep("fine", _cuts(inside, ["range"], F.col("pieces")))
    table = keep("splitters", _table(coarse.union(fine)))
    ranged = _range_of(slim, table, 2 * ranges + 1)

    per = ranged.groupBy("range").agg(F.first("low").alias("low"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                                      F.sum(F.when(F.col("digest") == F.col("low"), F.col("size")).otherwise(0)).alias("head"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("low")
    per = keep("ranges", per.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), "low", "head")
        .select("range", "bytes_before", "rows_before", F.sum("head").over(group).alias("low_bytes"),
                F.min("bytes_before").over(group).alias("low_at")))

    order = Window.partitionBy("range").orderBy("digest", F.col("id").asc_nulls_first(), "row")
    alike = Window.partitionBy("range", "digest")
    here = F.sum("size").over(order) - F.col("size")
    at = (ranged.withColumns({"at": here, "nth": F.row_number().over(order)})
          .withColumns({"g_at": F.min("at").over(alike), "g_bytes": F.sum("size").over(alike)})
          .join(F.broadcast(per), "range"))
    cut = F.col("digest") == F.col("low")                   # the range may begin inside this group
    at = at.select("id", "row", "size", "crc", (F.col("bytes_before") + F.col("at")).alias("at"),
                   (F.col("rows_before") + F.col("nth") - 1).alias("nth"),
                   F.when(cut, F.col("low_at")).otherwise(F.col("bytes_before") + F.col("g_at")).alias("g_at"),
                   F.when(cut, F.col("low_bytes")).otherwise(F.col("g_bytes")).alias("g_bytes"))
    whole = F.col("g_bytes") * (shards * WHOLE_GROUPS) <= total
    twice = F.when(whole, 2 * F.col("g_at") + F.col("g_bytes")).otherwise(2 * F.col("at") + F.col("size"))
    placed = keep("placed", at.withColumn("twice", twice).withColumn("total", total)
                  .select("id", "row", "size", "crc", "nth", F.expr(f"cast(twice * {shards} div (2 * total) as int)").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("nth").alias("first"))            # at most one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "id", "row", "size", "crc", "shard", (F.col("nth") - F.col("first")).alias("slot"))


def _records(docs: DataFrame, id_col: str, text_col: str, carry: bool, keep: Materializer) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")] if carry else []
    return keep("records", docs.select(
        F.md5(text).alias("digest"), F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("crc"), *row))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, CRC-32 of the text, shard and slot."""
    spark = docs.sparkSession
    keep = Materializer(spark, scratch_path(spark, f"sharding-{uuid.uuid4().hex[:12]}"))
    placed = _placed(_records(docs, id_col, text_col, False, keep), shards, keep)
    return placed.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` to ``path/shard=<k>``, in slot order inside
    every file and with files in slot order; a shard has as many files as its
    part of the sort has tasks."""
    spark = docs.sparkSession
    keep = Materializer(spark, scratch_path(spark, f"sharding-{uuid.uuid4().hex[:12]}"))
    records = _records(docs, id_col, text_col, True, keep)
    placed = _placed(records.drop("record"), shards, keep).select("row", "shard", "slot")
    (records.select("row", "record").join(placed, "row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("record", "slot", "shard").write.partitionBy("shard").parquet(path))
