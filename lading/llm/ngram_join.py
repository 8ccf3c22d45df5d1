"""N-gram Jaccard join (operator 2): a blocked sparse product of the document
by n-gram incidence matrix.

A document is its set of distinct ``size``-word shingles (64-bit hashes).
Two documents link when 100 * |intersection| >= ``percent`` * |union|.

* Equal sets are one node from the start, so copies are never paired.
* Column counts: each task counts the n-grams of its texts, the counts meet
  by column block.  Columns over ``HOT_DF`` rows are "hot"; the hot set is
  kept under ``MAX_HOT`` entries by raising the bound, so it can be
  broadcast at any input size.  Any hot set gives the same links; it only
  orders the columns.
* Rows are restricted to the columns that a link cannot avoid: with columns
  ordered rare to frequent, two linked rows of size n share one of the first
  ``n - ceil(percent n / 100) + 1`` columns of either.
* The restricted product is taken column block by column block.  A column
  gives its members a link candidate to one member (the leader), not all
  pairs.  Candidates outside the size bound, or whose parity bitmaps differ
  in more bits than the size-derived bound on the symmetric difference
  allows, are discarded.
* Overlaps of the remaining candidates are counted in blocks of one leader
  and at most ``BLOCK_ROWS`` rows: first over one eighth of the columns, which
  discards candidates whose remaining columns cannot reach the bound, then
  exactly.  After that, columns whose members
  are still in several components give their cross-component pairs, which go
  through the same bounds and counts, so no link that matters for the
  components is lost.

Rows are told apart by a row number, the place in the input, which is read
several times and must read the same each time (files do); ids only name the
components.

Defined results: null, empty and blank texts have no shingles and link with
nothing; repeated rows are equal sets; several texts under one id are rows
like any other; a null id is larger than all others, so a component has a null
name only if all its ids are null; an empty table gives an empty result; other
columns are ignored, and ``one_per_group`` keeps them whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.functions.joins import broadcast_if_small
from lading.llm.graph import components
from lading.llm.textcols import (distinct, distinct_counts, mix, release, row_cuts, shingle_sets, slices, span_hashes,
                                 word_spans)
from lading.operators.materialize import Materializer
from lading.session import scratch_path

SIZE = 4
PERCENT = 85
HOT_DF = 32
MAX_HOT = 1 << 21
ENTRIES_PER_BLOCK = 1 << 20
BLOCK_ROWS = 256
BITMAP_WORDS = 4
FLUSH = 1 << 19             # entries that a task holds before it sends them on
_LOW32 = np.uint64(0xFFFFFFFF)

RECORD = ("kind int, s long, k long, n int, r int, score int, doc_id long, row long, "
          + ", ".join(f"b{i} long" for i in range(BITMAP_WORDS)))


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for lo, hi, buf, off in slices(column):
        starts, ends, rows = word_spans(buf, off)
        yield from shingle_sets(span_hashes(buf, starts, ends), row_cuts(rows, hi - lo), size)


def _node(values: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = mix(values, 7).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(mix(np.array([total], dtype=np.uint64), 9).view(np.int64)[0])


def _parity(values: np.ndarray) -> np.ndarray:
    """Parity of the values that fall on each bit of a small bitmap: two
    bitmaps differ in at most as many bits as the sets differ in values."""
    bits = np.bincount((mix(values, 11) & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64),
                       minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _block_of(values: np.ndarray, blocks: int) -> np.ndarray:
    """Column block of each n-gram (from the upper half of its hash)."""
    return ((values >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _cut_by_block(block: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(blocks + 1))


def _hot_columns(docs: DataFrame, text_col: str, size: int, blocks: int, keep: Materializer) -> np.ndarray:
    """Names (block, lower hash half) of the most frequent columns, with
    their counts, at most ``MAX_HOT`` of them: uint64 array (name, count)."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, times = distinct_counts(np.concatenate(sets))
        order, cut = _cut_by_block(_block_of(values, blocks), blocks)
        low, times = (values[order] & _LOW32).astype(np.uint32), times[order].astype(np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array(range(blocks), pa.int32()),
            pa.array([low[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            pa.array([times[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
        ], ["block", "low", "times"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, held, n = set(), [], 0
            for values in _sets(batch.column(0), size):
                name = _node(values)
                if len(values) and name not in seen:
                    seen.add(name)
                    held.append(values)
                    n += len(values)
                if n >= FLUSH:
                    yield counted(held)
                    held, n = [], 0
            if held:
                yield counted(held)

    def frequent(table: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["low"]])
        times = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["times"]])
        order = np.argsort(low, kind="stable")
        low, times = low[order], times[order]
        at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
        total = np.add.reduceat(times.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        hot = total >= HOT_DF
        block = table["block"][0].as_py()
        return pa.table({"name": (low[at][hot].astype(np.int64) | (block << 32)), "df": total[hot]})

    found = keep("hot", docs.select(text_col).mapInArrow(count, "block int, low binary, times binary")
                 .groupBy("block").applyInArrow(frequent, "name long, df long"))
    sizes = {r["e"]: r["n"] for r in found.groupBy(F.floor(F.log2("df")).cast("int").alias("e"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}          # at most 64 rows
    least, total = 63, 0
    while least > 0 and total + sizes.get(least, 0) <= MAX_HOT:
        total += sizes.get(least, 0)
        least -= 1
    rows = found.where(F.col("df") >= 2 ** (least + 1)).toArrow()     # at most MAX_HOT rows
    names = rows["name"].to_numpy().astype(np.uint64)
    order = np.argsort(names)
    return np.stack([names[order], rows["df"].to_numpy().astype(np.uint64)[order]])


def _restricted(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, blocks: int,
                hot: np.ndarray, keep: Materializer) -> DataFrame:
    """Records: kind 0, one per document (node, size, bitmap); kind 1, one per
    entry of the restricted matrix whose column has several rows; kind 2,
    leader candidates of the columns that are not hot."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    fields = "block int, s binary, k binary, n binary, r binary, score binary, doc_id binary, bitmap binary"

    def packed(held: list[tuple]) -> list[tuple]:
        s, k, n, r, sc, is_hot = map(np.concatenate, zip(*held))
        block = _block_of(s, blocks)
        # a hot column needs no count: its rows pass through, spread by node
        block[is_hot] = blocks + (k[is_hot].view(np.uint64) % np.uint64(blocks)).astype(np.int64)
        order, cut = _cut_by_block(block, 2 * blocks)
        parts = [v[order] for v in (s, k, n, r, sc)]
        return [(b, *(v[x:y].tobytes() for v in parts), None, None)
                for b, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in rows], pa.int32()),
             *(pa.array([row[i] for row in rows], pa.binary()) for i in range(1, 8))],
            ["block", "s", "k", "n", "r", "score", "doc_id", "bitmap"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = shared.value
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[(names & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        turn = 0
        for batch in batches:
            ids = batch.column(1).cast(pa.int64())
            held, waiting = [], 0
            node, n_of, bitmap, seen = [], [], [], set()
            for values in _sets(batch.column(2), size):
                n = len(values)
                name = _node(values)
                node.append(name)
                n_of.append(n)
                bitmap.append(_parity(values))
                if n == 0 or name in seen:
                    continue
                seen.add(name)
                first = n - -(-percent * n // 100) + 1
                rank = np.zeros(n, dtype=np.uint64)
                look = np.flatnonzero(maybe[(values & np.uint64((1 << 20) - 1)).astype(np.int64)])
                if len(look) and len(names):
                    column = (_block_of(values[look], blocks).astype(np.uint64) << np.uint64(32)) | (values[look] & _LOW32)
                    at = np.minimum(np.searchsorted(names, column), len(names) - 1)
                    rank[look] = np.where(names[at] == column, counts[at], 0)
                n_hot = int(np.count_nonzero(rank))
                chosen = np.arange(first) if n_hot == 0 else np.argsort(rank, kind="stable")[:first]
                held.append((values[chosen], np.full(first, name, dtype=np.int64), np.full(first, n, dtype=np.int32),
                             np.arange(first, dtype=np.int32), np.full(first, 1000 * n_hot // n, dtype=np.int32),
                             rank[chosen] > 0))
                waiting += first
                if waiting >= FLUSH:
                    yield sent(packed(held))
                    held, waiting = [], 0
            if held:
                yield sent(packed(held))
            if node:
                turn += 1
                known = np.array([v is not None for v in ids.to_pylist()])
                names_of = np.stack([ids.fill_null(0).to_numpy(zero_copy_only=False), known.astype(np.int64),
                                     batch.column(0).to_numpy()])
                yield sent([(2 * blocks + (abs(node[0]) + turn) % blocks, b"", np.array(node, np.int64).tobytes(),
                             np.array(n_of, np.int32).tobytes(), b"", b"", names_of.tobytes(), np.stack(bitmap).tobytes())])

    def records(kind, s, k, n, r, score, doc_id=None, row=None, bitmap=None) -> pa.Table:
        m = len(k)
        cols = {"kind": pa.array(np.full(m, kind, np.int32)), "s": pa.array(s.view(np.int64)) if len(s) else pa.nulls(m, pa.int64()),
                "k": pa.array(k), "n": pa.array(n), "r": pa.array(r) if len(r) else pa.nulls(m, pa.int32()), "score": pa.array(score) if len(score) else pa.nulls(m, pa.int32()),
                "doc_id": doc_id if doc_id is not None else pa.nulls(m, pa.int64()),
                "row": row if row is not None else pa.nulls(m, pa.int64())}
        for i in range(BITMAP_WORDS):
            cols[f"b{i}"] = pa.array(np.ascontiguousarray(bitmap[:, i])) if bitmap is not None else pa.nulls(m, pa.int64())
        return pa.table(cols)

    def join(table: pa.Table, dtype, name) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_py(), dtype) for x in table[name]])

    def meet(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        if block >= 2 * blocks:                                 # the documents themselves
            ids = np.concatenate([np.frombuffer(x.as_py(), np.int64).reshape(3, -1) for x in table["doc_id"]], axis=1)
            bitmap = join(table, np.int64, "bitmap").reshape(-1, BITMAP_WORDS)
            return records(0, np.zeros(0, np.uint64), join(table, np.int64, "k"), join(table, np.int32, "n"),
                           np.zeros(0, np.int32), np.zeros(0, np.int32), pa.array(ids[0], mask=ids[1] == 0), pa.array(ids[2]), bitmap)
        s, k = join(table, np.uint64, "s"), join(table, np.int64, "k")
        n, r, score = (join(table, np.int32, c) for c in ("n", "r", "score"))
        if block >= blocks:
            return records(1, s, k, n, r, score)
        order = np.lexsort((k, s))
        s, k, n, r, score = s[order], k[order], n[order], r[order], score[order]
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])])
        s, k, n, r, score = s[new], k[new], n[new], r[new], score[new]
        start = np.concatenate([[True], s[1:] != s[:-1]])
        alone = start & np.concatenate([start[1:], [True]])
        s, k, n, r, score, start = (v[~alone] for v in (s, k, n, r, score, start))
        if not len(s):
            return records(1, s, k, n, r, score)
        lead = np.flatnonzero(start)[np.cumsum(start) - 1]      # the smallest node of each column
        small, large = np.minimum(n, n[lead]), np.maximum(n, n[lead])
        fit = ~start & (100 * small.astype(np.int64) >= percent * large.astype(np.int64))
        pairs = np.unique(np.stack([k[lead][fit], k[fit]], axis=1), axis=0) if fit.any() else np.zeros((0, 2), np.int64)
        led = records(2, pairs[:, 0].copy().view(np.uint64), pairs[:, 1].copy(), *[np.zeros(len(pairs), np.int32)] * 3)
        return pa.concat_tables([records(1, s, k, n, r, score), led])

    met = (docs.select("row", id_col, text_col).mapInArrow(entries, fields)
           .groupBy("block").applyInArrow(meet, RECORD))
    return keep("records", met)


def _within_bounds(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) that the sizes and parity bitmaps allow."""
    left = nodes.select(F.col("k").alias("a"), F.col("n").alias("na"), *[F.col(f"b{i}").alias(f"a{i}") for i in range(BITMAP_WORDS)])
    right = nodes.select(F.col("k").alias("b"), F.col("n").alias("nb"), *[F.col(f"b{i}").alias(f"c{i}") for i in range(BITMAP_WORDS)])
    differ = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"c{i}"))) for i in range(BITMAP_WORDS)), F.lit(0))
    most = F.expr(f"na + nb - 2 * ceil({percent} * (na + nb) / {100 + percent}.0D - 1e-9)")
    return (pairs.join(left, "a").join(right, "b")
            .where(F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")).where(differ <= most)
            .select("a", "b"))


def _counted(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int, part: int,
             keep: Materializer, name: str) -> DataFrame:
    """The candidates (a, b) that survive counting the overlap in the columns
    of the lowest 1/``part`` of the hash range.  The columns not counted add
    at most the smaller of the two rests; with ``part`` 1 the count is exact.
    ``a`` is the leader: a block holds one leader and at most about
    ``BLOCK_ROWS`` others, and each set is shuffled once per block."""
    pairs = keep(f"{name}_pairs", pairs)
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts"))
    dealt = (pairs.join(degree, "a")
             .select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("g")))
    wanted = keep(f"{name}_wanted", dealt.select("g", F.col("a").alias("k"))
                  .union(dealt.select("g", F.col("b").alias("k"))).distinct())
    firsts = keep(f"{name}_firsts", nodes.join(wanted.select("k").distinct(), "k", "left_semi")
                  .select(F.col("row").alias("first")))
    edge = np.uint64(((1 << 64) - 1) // part)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, sets = [], [], []
            for values in _sets(batch.column(0), size):
                names.append(_node(values))
                sizes.append(len(values))
                sets.append(values[:np.searchsorted(values, edge, side="right")].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(sets, pa.binary())], ["k", "n", "values"])
            del batch, sets
        release()

    sets = (docs.join(broadcast_if_small(firsts), docs["row"] == firsts["first"], "left_semi").select("text")
            .mapInArrow(cut, "k long, n long, values binary"))
    rows = (sets.join(broadcast_if_small(wanted), "k")
            .select("g", F.lit(0).alias("kind"), "k", F.col("n").alias("b"), "values")
            .union(dealt.select("g", F.lit(1), F.col("a"), "b", F.lit(None).cast("binary"))))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        for batch in batches:
            a_out, b_out = [], []
            for g, kind, k, b, values in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group:
                    group, held = g, {}
                if kind == 0:                       # b is the size of the whole set
                    held[k] = np.frombuffer(values, np.uint64), b
                    continue
                (x, nx), (y, ny) = held[k], held[b]
                both = 0
                if len(x) and len(y):
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    both = int(np.count_nonzero(x[at] == y))
                most = both + min(nx - len(x), ny - len(y))
                if 100 * most >= percent * (nx + ny - most):
                    a_out.append(k)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])
        release()

    return keep(f"{name}_left", rows.repartition("g").sortWithinPartitions("g", "kind").mapInArrow(verify, "a long, b long"))


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int,
           keep: Materializer, name: str) -> DataFrame:
    """The candidates that are links: counted over one eighth of the columns,
    which discards most, and the rest over all columns."""
    some = _counted(_within_bounds(pairs, nodes, percent), nodes, docs, size, percent, 8, keep, f"{name}_8")
    return _counted(some, nodes, docs, size, percent, 1, keep, f"{name}_1")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                       percent: int = PERCENT, keep: Materializer | None = None) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``node`` (name of its set),
    ``component_id`` (smallest id reachable over links, itself included), the
    row's number and ``first_row`` (the row of the component that comes first
    by id, then place; null without shingles)."""
    spark: SparkSession = docs.sparkSession
    keep = keep or Materializer(spark, scratch_path(spark, f"ngrams-{uuid.uuid4().hex[:12]}"))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    # about one distinct n-gram per six bytes of text: sizes the column blocks
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(8, int(total // 6 // ENTRIES_PER_BLOCK) + 1)
    hot = _hot_columns(docs, "text", size, blocks, keep)
    rec = _restricted(docs, "doc_id", "text", size, percent, blocks, hot, keep)
    rows = rec.where("kind = 0")
    nodes = keep("nodes", rows.where("n > 0").groupBy("k").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"), F.max("n").alias("n"), *[F.max(f"b{i}").alias(f"b{i}") for i in range(BITMAP_WORDS)]).withColumn("row", F.col("first.row")))
    entries = rec.where("kind = 1").select("s", "k", "n", "r", "score")
    # leaders of hot columns: the member with the largest hot share
    lead = entries.groupBy("s").agg(F.max(F.struct("score", "k", "n")).alias("lead"), F.count(F.lit(1)).alias("members"))
    starred = (entries.where("score > 0").join(lead.where(f"members > {HOT_DF} or lead.score > 0"), "s")
               .where(f"lead.k <> k and 100 * least(n, lead.n) >= {percent} * greatest(n, lead.n)")
               .select(F.col("lead.k").alias("a"), F.col("k").alias("b")))
    stars = rec.where("kind = 2").select(F.col("s").alias("a"), F.col("k").alias("b")).union(starred).distinct()
    first = _links(stars, nodes, docs, size, percent, keep, "star")
    comp = components(first, keep, "star_comp")
    # columns whose members are still apart: their cross-component pairs
    placed = (entries.select("s", "k", "n", "r").join(comp.withColumnRenamed("node", "k"), "k", "left")
              .select("s", "k", "n", "r", F.coalesce("label", "k").alias("c")))
    placed = keep("placed", placed)
    apart = placed.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s")
    open_ = placed.join(apart, "s", "left_semi")
    one, two = open_.alias("x"), open_.alias("y")
    # in the first column that two linked rows share, neither row has more
    # columns before it than the least overlap leaves room for
    room = f"ceil({percent} * (x.n + y.n) / {100 + percent}.0D - 1e-9) <= least(x.n - x.r, y.n - y.r)"
    cross = (one.join(two, F.expr(f"x.s = y.s and x.k < y.k and x.c <> y.c and {room} "
                                  f"and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"))
             .select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct())
    second = _links(cross, nodes, docs, size, percent, keep, "cross")
    links = first.union(second)
    comp = components(links, keep, "comp")
    labelled = nodes.join(comp.withColumnRenamed("node", "k"), "k", "left").select(
        "k", "first", F.coalesce("label", "k").alias("label"))
    lowest = labelled.groupBy("label").agg(F.min("first").alias("lowest"))
    named = labelled.select("k", "label").join(lowest, "label").select("k", "lowest")
    return (rows.join(named, "k", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("k").alias("node"),
                    F.when(F.col("n") > 0, F.col("lowest.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "row", F.when(F.col("n") > 0, F.col("lowest.row")).alias("first_row")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                  percent: int = PERCENT) -> DataFrame:
    """The rows without those that link, directly or over others, to a row
    with a smaller id, or the same id and an earlier place."""
    keep = Materializer(docs.sparkSession, scratch_path(docs.sparkSession, f"groups-{uuid.uuid4().hex[:12]}"))
    drop = keep("dropped", jaccard_components(docs, id_col, text_col, size, percent)
                .where("row <> first_row").select(F.col("row").alias("gone")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given"))
    return rows.join(broadcast_if_small(drop), F.col("row") == F.col("gone"), "left_anti").select("given.*")
