"""Substring dedup by line and sentence hashing (operator 5).

Units are the pieces of a text between newlines and sentence ends, so a
passage that repeats inside other lines is still found.  A unit is
normalised to its lower-cased words; its digest covers them in order.  A unit
of fewer than ``UNIT_WORDS`` words ("1.", "Mr.") counts together with the
units after it, or before it, until there are that many words, so it is a
repeat where it stands in a repeated passage and nowhere else.
Digests are grouped over all documents: the occurrence ranked first (id, then
row, then offset) stays, later ones are repeats.  Consecutive repeats of a row
that together have at least ``min_words`` words are removed.  Shorter ones are
left, since short sentences coincide by chance; with ``often_lines``, whole
lines all units of which occur ``OFTEN`` times or more go as well.

A task keeps only the first of equal units it holds ``OFTEN`` times and
reports the others at once, so a line that occurs in a third of all rows sends
a few entries per buffer, not one per row.

Rows are told apart by a row number, not by their id: repeated rows, several
texts under one id and null ids (ranked after all others) are occurrences like
any other, and the first keeps its text.  The number is the place in the
input, so the input must read the same when a lost task runs again (files do);
``deduplicated`` writes its numbered input first.

Defined results: null, empty and blank texts have no units, texts of fewer
than ``UNIT_WORDS`` words no repeats; an empty table gives no rows; other
columns are ignored by ``removed_spans`` and kept by ``deduplicated``, whose
added column takes a free name.  Spans are original character offsets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.llm.textcols import _powers, _U, mix, slices, span_hashes, word_spans
from lading.operators.materialize import Materializer
from lading.session import scratch_path

MIN_WORDS = 25
UNIT_WORDS = 3               # shorter units count together with their neighbours
OFTEN = 10                   # occurrences
FLUSH = 1 << 18
ENTRIES_PER_BLOCK = 1 << 20

NO_ID = (1 << 63) - 1         # stands for a null id, ranked last

REPEAT = "row long, doc_id long, unit int, start long, end long, words int, line int, line_units int, often boolean, first_doc_id long"


def units(buf: np.ndarray, off: np.ndarray):
    """Entries of a run of texts: row, unit's number in the row, start and end
    byte, word count, line in the row, units of that line and digest; a short
    unit has one entry with the units after it and one with those before."""
    starts, ends, rows = word_spans(buf, off)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z, z, z, z.astype(np.uint64)
    stop = (buf[ends - 1] == 46) | (buf[ends - 1] == 33) | (buf[ends - 1] == 63)     # . ! ?
    newline = np.concatenate([[0], np.cumsum(buf == 10)])
    last = np.ones(len(starts), dtype=bool)
    last[:-1] = stop[:-1] | (rows[1:] != rows[:-1]) | (newline[starts[1:]] > newline[ends[:-1]])
    b = np.flatnonzero(last) + 1
    a = np.concatenate([[0], b[:-1]])
    words = span_hashes(buf, starts, ends)
    power, inverse = _powers(len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * power, out=sums[1:])
    row = rows[a]
    number = np.arange(len(a)) - np.searchsorted(row, row)
    line = newline[starts[a]] - newline[off[row]]
    opens = np.concatenate([[True], (row[1:] != row[:-1]) | (line[1:] != line[:-1])])
    line_units = np.diff(np.append(np.flatnonzero(opens), len(a)))[np.cumsum(opens) - 1]
    # first and last unit, and kind, of what every entry's digest covers
    long, short = np.flatnonzero(b - a >= UNIT_WORDS), np.flatnonzero(b - a < UNIT_WORDS)
    after = np.searchsorted(b, a[short] + UNIT_WORDS)
    before = np.searchsorted(a, b[short] - UNIT_WORDS, side="right") - 1
    right = row[np.minimum(after, len(a) - 1)] == row[short]
    right &= after < len(a)
    left = (before >= 0) & (row[before] == row[short])
    unit = np.concatenate([long, short[right], short[left]])
    first = np.concatenate([long, short[right], before[left]])
    end = np.concatenate([long, after[right], short[left]])
    kind = np.repeat(np.array([5, 7, 9]), [len(long), int(right.sum()), int(left.sum())])
    digest = mix((sums[b[end]] - sums[a[first]]) * inverse[a[first]], 3)
    for k in (5, 7, 9):
        digest[kind == k] ^= mix((b[end] - a[first])[kind == k].astype(np.uint64), k)
    return (row[unit], number[unit], starts[a][unit], ends[b - 1][unit], (b - a)[unit], line[unit], line_units[unit], digest)


def _first_and_rest(digest, row, doc, unit):
    """Order by digest then rank, and which entries open a new digest."""
    order = np.lexsort((unit, row, doc, digest))
    d = digest[order]
    new = np.concatenate([[True], d[1:] != d[:-1]]) if len(d) else np.zeros(0, bool)
    return order, new


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def repeats(given: DataFrame) -> DataFrame:
    """One row per unit that occurs earlier (a short one may have two) in rows
    of (row, doc_id, text): its place, its line, whether it occurs often, and
    the document of an earlier occurrence."""
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(8, int(total // 64 // ENTRIES_PER_BLOCK) + 1)       # about one unit per 64 bytes
    names = ("digest", "row", "doc", "unit", "start", "end", "words", "line", "line_units")
    types = (np.uint64, np.int64, np.int64, np.int32, np.int64, np.int64, np.int32, np.int32, np.int32)

    def send(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held = [np.concatenate(x) for x in zip(*held)]
        order, new = _first_and_rest(*held[:4])
        cols = [x[order] for x in held]
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        times = np.diff(np.append(at, len(new)))
        lead = cols[2][at[group]]
        rest = ~new & (times[group] >= OFTEN)
        out = []
        if rest.any():
            # repeats inside this buffer are settled: dealt over the blocks as they are
            block = blocks + int(cols[0][0] % _U(blocks))
            out.append((block, *(c[rest].astype(t).tobytes() for c, t in zip(cols, types)), b"", lead[rest].tobytes()))
        kept = [c[~rest] for c in cols]
        stands = np.where(times[group] >= OFTEN, times[group], 1)[~rest].astype(np.int32)     # occurrences of an entry
        which = ((kept[0] >> _U(32)) * _U(blocks) >> _U(32)).astype(np.int64)      # digests are sorted, so blocks are
        cut = np.searchsorted(which, np.arange(blocks + 1))
        out += [(b, *(c[x:y].astype(t).tobytes() for c, t in zip(kept, types)), stands[x:y].tobytes(), b"")
                for b, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()),
                                          *(pa.array([r[i] for r in out], pa.binary()) for i in range(1, len(names) + 3))],
                                         ["block", *names, "stands", "lead"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            numbers, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, _, buf, off in slices(batch.column(2)):
                row, unit, start, end, words, line, line_units, digest = units(buf, off)
                points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                base = points[off[row]]
                held.append((digest, numbers[lo + row], ids[lo + row], unit, points[start] - base, points[end] - base, words, line, line_units))
                n += len(row)
                if n >= FLUSH:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    def meet(table: pa.Table) -> pa.Table:
        cols = [np.concatenate([np.frombuffer(x.as_py(), t) for x in table[c]]) for c, t in zip(names, types)]
        if table["block"][0].as_py() >= blocks:
            lead = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["lead"]])
            often, cols = np.ones(len(lead), dtype=bool), cols[1:]
        else:
            stands = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in table["stands"]])
            order, new = _first_and_rest(*cols[:4])
            group = np.cumsum(new) - 1
            lead = cols[2][order][np.flatnonzero(new)[group]][~new]
            often = (np.bincount(group, weights=stands[order]) >= OFTEN)[group][~new]
            cols = [c[order][~new] for c in cols[1:]]
        return pa.table(dict(zip(("row", "doc_id", *names[3:], "often", "first_doc_id"), [*cols, often, lead])))

    return (given.mapInArrow(emit, "block int, " + ", ".join(f"{n} binary" for n in (*names, "stands", "lead")))
            .groupBy("block").applyInArrow(meet, REPEAT))


def _spans(given: DataFrame, min_words: int, often_lines: bool) -> DataFrame:
    own = Window.partitionBy("row").orderBy("start", "unit")

    def numbered(found: DataFrame) -> DataFrame:
        opens = found.withColumn("opens", (F.col("unit") - F.lag("unit", 1, -2).over(own) > 1).cast("int"))
        return opens.withColumn("run", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))

    found = (repeats(given).repartition("row").groupBy("row", "unit", "line", "line_units")
             .agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("words").alias("words"),
                  F.max("often").alias("often"), F.min("first_doc_id").alias("first_doc_id")))
    goes = numbered(found).withColumn("n_words", F.sum("words").over(Window.partitionBy("row", "run")))
    kept = F.col("n_words") >= min_words
    if often_lines:
        goes = goes.withColumn("n_often", F.sum(F.col("often").cast("int")).over(Window.partitionBy("row", "line")))
        kept = kept | (F.col("n_often") == F.col("line_units"))
    runs = numbered(goes.where(kept))

    def shown(c: str):
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(c)

    spans = runs.groupBy("row", "run").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").cast("long").alias("n_words"),
        F.count(F.lit(1)).alias("n_units"), F.min_by("first_doc_id", "start").alias("first_doc_id"))
    return spans.select("row", shown("doc_id"), "start", "end", "n_words", "n_units", shown("first_doc_id"))


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  often_lines: bool = True) -> DataFrame:
    """Runs of consecutive repeated units with at least ``min_words`` words
    (and, with ``often_lines``, whole lines of units that occur often):
    document, character span, words, units, document of an earlier occurrence
    of the run's first unit."""
    return _spans(_numbered(docs, id_col, text_col), min_words, often_lines).drop("row")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                 often_lines: bool = True) -> DataFrame:
    """``docs`` with the removed spans cut out of the texts, and the spans with
    their original offsets in ``removed_spans`` (underscores are appended
    until the name is free)."""
    spark = docs.sparkSession
    keep = Materializer(spark, scratch_path(spark, f"dedup-{uuid.uuid4().hex[:12]}"))
    rows = keep("rows", docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given")))
    of = F.col("given")
    given = rows.select("row", F.coalesce(of[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"), of[text_col].cast("string").alias("text"))
    spans = (_spans(given, min_words, often_lines).groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    text = of[text_col].cast("string")
    cut = F.aggregate("spans", F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")), lambda s, r: F.struct(
        F.concat(s["text"], F.substring(text, (s["at"] + 1).cast("int"), (r["start"] - s["at"]).cast("int"))).alias("text"), r["end"].alias("at")),
        lambda s: F.concat(s["text"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    name = "removed_spans"
    while name in docs.columns:
        name += "_"
    new_text = F.when(F.col("spans").isNull(), of[text_col]).otherwise(cut).alias(text_col)
    return rows.join(spans, "row", "left").select(*[new_text if c == text_col else of[c].alias(c) for c in docs.columns],
                                                 F.col("spans").alias(name))
