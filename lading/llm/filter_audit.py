"""Filter interaction audit by a byte transducer (operator 11).

A text is read once by a table-driven finite-state transducer over its UTF-8
bytes: the byte's class and the state give the next state and the marks that
the byte emits (code point, capital, symbol, a word opens here).  The word
spans it opens go into an open-addressing hash table, where an entry counts as
the same word only if row, length and every byte agree, so the number of
distinct words does not rest on a hash.  From these counts come the failure
bits of the text filters.  Whether a text occurs under a smaller id is a fact
about the whole table and comes from a group-by of text digests.

Each row is then one pattern of failure bits.  Patterns are summed per part,
so the audit of all orders works on at most 2^filters rows per part and never
looks at rows again.

Defined results: null texts are empty, a null part is the empty string; words
are case-sensitive; a null id is never smaller than another and its row never
counts as a later copy; rows that repeat an id are each counted, and copies
under the same id are no later copies of each other; several labels of one id
count as good or toxic if any of them says so; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from lading.llm.rowmap import ROW, map_texts
from lading.llm.textcols import _U, mix, span_hashes
from lading.operators.materialize import Materializer
from lading.session import scratch_path

MEASURES = ("n_words", "n_distinct_words", "n_capitals", "n_points", "n_symbols")

#: filter letter -> SQL predicate over the measures that is true when it fails
TEXT_FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct_words < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_points",
    "D": "n_symbols > 0",
}
COPY_FILTER = "E"               # identical to the text of a smaller id

# --- the transducer --------------------------------------------------------
GAP, WORD = 0, 1
SPACE, CAPITAL, SYMBOL, TAIL, OTHER = range(5)          # byte classes; TAIL: 10xxxxxx
OPENS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8        # marks


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every byte, next state by class, marks by (state, class).
    Every class leads to one state from all states, which is what lets the
    states of a whole slice be looked up at once."""
    kind = np.full(256, OTHER, dtype=np.uint8)
    kind[[32, 9, 10, 11, 12, 13]] = SPACE
    kind[65:91] = CAPITAL
    kind[list(b"#$%&*|")] = SYMBOL
    kind[0x80:0xC0] = TAIL
    to = np.array([GAP, WORD, WORD, WORD, WORD], dtype=np.uint8)
    marks = np.zeros((2, 5), dtype=np.uint8)
    marks[:, [SPACE, CAPITAL, SYMBOL, OTHER]] |= POINT
    marks[:, CAPITAL] |= IS_CAPITAL
    marks[:, SYMBOL] |= IS_SYMBOL
    marks[GAP, [CAPITAL, SYMBOL, TAIL, OTHER]] |= OPENS
    return kind, to, marks


KIND, TO, MARKS = _tables()


def transduce(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after and marks of every byte; every text starts in a gap."""
    kind = KIND[buf]
    after = TO[kind]
    before = np.empty(len(buf), dtype=np.uint8)
    before[:1] = GAP
    before[1:] = after[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    before[first] = GAP
    return after, MARKS[before, kind]


def _same_bytes(words: np.ndarray, buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes at ``a`` and ``b`` agree byte for
    byte; ``words[i]`` are the eight bytes from i on."""
    same = np.ones(len(a), dtype=bool)
    for i in np.flatnonzero(size > 256).tolist():
        same[i] = np.array_equal(buf[a[i]:a[i] + size[i]], buf[b[i]:b[i] + size[i]])
    left = np.flatnonzero(size <= 256)
    at = 0
    while len(left):
        n = np.minimum(size[left] - at, 8).astype(np.uint64)
        differ = (words[a[left] + at] ^ words[b[left] + at]) << (_U(64) - n * _U(8)) != 0
        same[left[differ]] = False
        at += 8
        left = left[~differ & (size[left] > at)]
    return same


def first_in_row(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a word is the first of its row with these bytes: all spans go
    into one open-addressing table; an occupied slot holds the same word only
    if row, length and bytes agree, otherwise the next slot is tried."""
    n = len(starts)
    fresh = np.ones(n, dtype=bool)
    if n == 0:
        return fresh
    size = ends - starts
    key = span_hashes(buf, starts, ends, lower=False) ^ mix(rows.astype(np.uint64), 11)
    bits = int(2 * n).bit_length()
    slot = np.full(1 << bits, -1, dtype=np.int64)
    at = (mix(key) >> _U(64 - bits)).astype(np.int64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = np.arange(n)
    while len(left):
        free = left[slot[at[left]] < 0][::-1]               # of several, the earliest is written last
        slot[at[free]] = free
        holder = slot[at[left]]
        other = np.flatnonzero(holder != left)
        mine, theirs = left[other], holder[other]
        same = (rows[mine] == rows[theirs]) & (size[mine] == size[theirs]) & (key[mine] == key[theirs])
        check = np.flatnonzero(same)
        same[check] = _same_bytes(words, buf, starts[mine[check]], starts[theirs[check]], size[mine[check]])
        fresh[mine[same]] = False
        left = mine[~same]
        at[left] = (at[left] + 1) & ((1 << bits) - 1)
    return fresh


def measure(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The measures of each row of a run of texts."""
    n = len(off) - 1
    if len(buf) == 0:
        return [np.zeros(n, np.int64) for _ in MEASURES]
    after, marks = transduce(buf, off)
    starts = np.flatnonzero(marks & OPENS)
    rows = np.searchsorted(off[1:], starts, side="right")
    # a word closes before the next gap, or where its text ends
    gaps = np.flatnonzero(after == GAP)
    gap = np.append(gaps, len(buf))[np.searchsorted(gaps, starts)]
    ends = np.minimum(gap, off[rows + 1])
    fresh = first_in_row(buf, starts, ends, rows)

    def per_row(mark: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum((marks & mark) != 0)])
        return total[off[1:]] - total[off[:-1]]

    return [np.bincount(rows, minlength=n), np.bincount(rows[fresh], minlength=n), per_row(IS_CAPITAL), per_row(POINT),
            per_row(IS_SYMBOL)]


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as a struct column ``row`` with the measures of every text."""
    return map_texts(docs, text_col, [StructField(m, LongType()) for m in MEASURES], measure, [pa.int64()] * len(MEASURES))


def _bits(filters: dict[str, str]) -> Column:
    bits = F.lit(0)
    for k, failed in enumerate(filters.values()):
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << k)).otherwise(F.lit(0)))
    return bits


def patterns(docs: DataFrame, labels: DataFrame, part_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, bits) -> rows, of which labelled good and labelled toxic.

    Rows are first summed by (text digest, part, bits, id), which folds
    repeats before the shuffle, and written without the texts; a later copy is a row whose id is above the
    least id of its digest.  Rows with a null id are spread over the join with
    the labels by their digest.
    """
    part, text = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`").cast("string")
    given = docs.select(F.col(f"`{id_col}`").alias("id"), part.alias("part"),
                        F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("digest"), text.alias("text"))
    keep = Materializer(docs.sparkSession, scratch_path(docs.sparkSession, f"audit-{uuid.uuid4().hex[:12]}"))
    rows = keep("rows", measured(given).select(f"{ROW}.id", f"{ROW}.part", f"{ROW}.digest", _bits(TEXT_FILTERS).alias("bits"))
                .groupBy("digest", "part", "bits", "id").agg(F.count(F.lit(1)).alias("n")))
    marks = (labels.where(f"`{id_col}` is not null").groupBy(F.col(f"`{id_col}`").alias("id"))
             .agg(F.max(F.coalesce(F.expr("quality = 1"), F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.expr("toxic = 1"), F.lit(False))).alias("toxic"))
             .select(F.lit(False).alias("no_id"), F.xxhash64("id").alias("deal"), F.col("id").alias("label_id"), "good", "toxic"))
    known = rows.withColumns({"no_id": F.col("id").isNull(),
                              "deal": F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.xxhash64("id"))})
    joined = known.join(marks, (known.no_id == marks.no_id) & (known.deal == marks.deal) & (known.id == marks.label_id), "left")
    flag = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    cells = joined.select("digest", "part", "bits", "id", "n", *flag).groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(F.lit(0).cast("long"))).alias("n_null"))
    first = cells.groupBy(F.col("digest").alias("of")).agg(F.min("least").alias("first"))
    own = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(F.lit(0).cast("long"))
    copy_bit = 1 << len(TEXT_FILTERS)
    split = cells.join(first, cells.digest == first.of, "left").withColumn("own", own).select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct("bits", F.col("own").alias("n")),
            F.struct((F.col("bits") + copy_bit).alias("bits"), (F.col("n") - F.col("own")).alias("n")))))
    return split.where("n > 0").groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def interactions(sums: DataFrame, letters: str) -> DataFrame:
    """The audit of every order of the filters, from rows per (part, bits):
    bit k of ``bits`` says that ``letters[k]`` fails.

    A row that fails f filters is removed by each of them in f!/f of the
    relative orders of these, so by each in ``orders / f`` of all orders.
    """
    bit = {c: 1 << k for k, c in enumerate(letters)}
    steps = [{"filter_order": "".join(o), "step": k + 1, "own": bit[o[k]], "before": sum(bit[c] for c in o[:k])}
             for o in permutations(letters) for k in range(len(o))]
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, own int, before int>>")
    rows = sums.select("*", F.inline(table))
    fails, gone = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0

    def total(when: Column, value: str = "n") -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0)).cast("long")

    share = F.expr(f"n * {factorial(len(letters))} div greatest(1, bit_count(bits))")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order of the five filters and step."""
    return interactions(patterns(docs, labels, part_col, id_col, text_col), "".join(TEXT_FILTERS) + COPY_FILTER)
