"""Conversation structure repair by weighted interval parsing (operator 12).

A conversation is legal if its role initials read ``(s?(ua)+)?``.  Its rows
may be kept, given another role or deleted, and empty turns may be inserted;
blank and repeated rows must go.  The repair is the cheapest such edit, and of
several the one whose edit initials (Delete, Insert, Keep, Rerole) come first.

Grammar, in Chomsky normal form: a nonterminal [p,q] stands for the edits of a
span of rows that lead the pattern's automaton from state p to state q, with
[p,q] -> [p,r] [r,q], and [p,q] -> edit of one row.  A cell holds for every
nonterminal the least (cost, audit) of its span; insertion closure means that
the cell of one row also takes any insertions before and after the edit.
Cells are combined bottom-up by span length, each from its two halves: as
[p,q] may be split at any row, one split of a span yields all its
derivations, so the chart needs the dyadic spans alone, n cells instead of
n^2.  Keeping one audit per nonterminal is exact: two audits of a span name
every row once, so if one were a prefix of the other, the longer would have
only insertions more and cost more; among equal costs the order is therefore
decided inside both audits, whatever follows.

Rows are sorted by range, so a hot conversation lies in many partitions.  A
span of at most ``BLOCK`` rows travels as one string of row codes; spans meet
per conversation only as cells.  The repaired texts are hashed as a stream in
row order.  What one task must hold of a single conversation is its audit, at
most ten variants of it while cells are combined; the stream of one
conversation is one task, since its hash is one sequence.

Defined results: rows are ordered by turn (nulls first), then role and digest
of the text, so repeated rows are neighbours; a null id is a conversation of its own;
null roles and texts are one space; a role's initial is its first character;
conversations without rows are legal as they are; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.operators.materialize import Materializer
from lading.session import scratch_path

BLOCK_BITS = 14                     # rows of a span that travel as one string
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1     # costs
_BLANK = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"

# automaton of (s?(ua)+)?: states 0 (start), 1 (after s), 2 (after u), 3 (after a)
_MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPT = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: row codes: initial (other: any but s, u, a) by fault
_INITIALS, _FAULTS = "sua-", ("fine", "blank", "duplicate", "truncated")

Cell = dict[tuple[int, int], tuple[int, str]]


def code(initial: str, fault: str) -> str:
    return chr(65 + 4 * (_INITIALS.index(initial) if initial in tuple("sua") else 3) + _FAULTS.index(fault))


def _decode(c: str) -> tuple[str, str]:
    return _INITIALS[(ord(c) - 65) // 4], _FAULTS[(ord(c) - 65) % 4]


def join_cells(a: Cell, b: Cell) -> Cell:
    """[p,q] -> [p,r] [r,q], the least (cost, audit) of every nonterminal."""
    out: Cell = {}
    for (p, r), (cost, audit) in a.items():
        for q in range(4):
            right = b.get((r, q))
            if right is not None:
                found = (cost + right[0], audit + right[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _insertions() -> Cell:
    """Cell of the empty span: any number of insertions (a cheapest one never
    comes through a state twice)."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    step: Cell = {(p, q): (INSERT, "I") for (p, c), q in _MOVES.items() if c in ROLES}
    for _ in range(4):
        for pq, found in join_cells(cell, step).items():
            cell[pq] = min(found, cell.get(pq, found))
    return cell


_EMPTY = _insertions()


@lru_cache(maxsize=16)
def row_cell(c: str) -> Cell:
    """Cell of one row: its edits, closed under insertion on both sides."""
    initial, fault = _decode(c)
    cell: Cell = {}
    for p in range(4):
        edits = [(p, DELETE, "D")]
        if fault not in ("blank", "duplicate"):
            late = TRUNCATED if fault == "truncated" else 0
            edits.append((_MOVES.get((p, initial)), KEEP + late, "K"))
            edits += [(_MOVES.get((p, role)), REROLE + late, "R") for role in ROLES]
        for q, cost, letter in edits:
            if q is not None:
                cell[p, q] = min((cost, letter), cell.get((p, q), (cost, letter)))
    return join_cells(join_cells(_EMPTY, cell), _EMPTY)


@lru_cache(maxsize=1 << 14)
def _short(codes: str) -> Cell:
    return _combine([row_cell(c) for c in codes])


def _combine(cells: list[Cell]) -> Cell:
    """Neighbours in pairs, level by level of span length."""
    while len(cells) > 1:
        cells = [join_cells(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else _EMPTY


def span_cell(codes: str) -> Cell:
    """Cell of a span; the cells of runs of 8 rows are kept between spans."""
    return _combine([_short(codes[i:i + 8]) for i in range(0, len(codes), 8)])


def best(cell: Cell) -> tuple[int, str]:
    """Cheapest edits of a whole conversation, by (cost, audit)."""
    return min(cell[0, q] for q in _ACCEPT if (0, q) in cell)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The rows with planted faults by CRC-32 of ``conversation:turn`` modulo
    20 (0 drops, 1 empties, 2 takes sentence ends out, 3 repeats, 4 makes a
    user turn); a dropped row stays as one with ``copies`` 0."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col))) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown(text_col), "[.!?]", "")).otherwise(shown(text_col)))
    return rows.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                       F.when(kind == 4, "user").otherwise(shown(role_col)).alias("role"), text.alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def undamaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """Rows as they are, in the form that ``repair`` takes."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return rows.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                       shown(role_col).alias("role"), shown(text_col).alias("text"), F.lit(1).alias("copies"))


_ORDER = ("turn", "role", "digest", "copy")


def _copies(rows: DataFrame) -> DataFrame:
    """One row per copy, with the digest that orders and compares texts."""
    there = rows.where("copies > 0").withColumn("digest", F.unhex(F.md5("text")))
    return there.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copies")


def _solutions(rows: DataFrame, keep: Materializer) -> DataFrame:
    """Per conversation with rows: counts of faults, cost and audit."""
    last = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    facts = _copies(rows).select(
        "conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(_BLANK)).alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    keys = ["conv_id", *_ORDER]
    ordered = facts.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    facts = keep("rows", ordered.drop("copy", "turn"))
    # a row is a repeat unless it is the first of its conversation with this role and text
    first = facts.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = facts.alias("f").join(
        first.alias("g"), F.expr("f.conv_id <=> g.conv_id and f.role = g.role and f.digest = g.digest"), "left")
    fault = (F.when(F.col("f.blank"), 1).when(F.expr("f.pos > g.pos"), 2).when(F.col("f.truncated"), 3).otherwise(0))
    at = F.expr("coalesce(nullif(instr('sua', f.initial), 0), 4) - 1")
    at = F.when(F.col("f.initial") == "", 3).otherwise(at)
    coded = again.select("f.conv_id", "f.pos", F.shiftright("f.pos", BLOCK_BITS).alias("block"), F.char(65 + 4 * at + fault).alias("c"))
    spans = coded.groupBy("conv_id", "block").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"]), "").alias("codes"))

    fields = "conv_id {}, block long, first string, last string, blank long, duplicate long, truncated long, illegal long, cells {}"
    conv_type = facts.schema["conv_id"].dataType.simpleString()
    cells_type = "array<struct<p int, q int, cost long, audit string>>"
    entry = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("first", "last", "blank", "duplicate", "truncated", "illegal", "cells")}
            for codes in batch.column("codes").to_pylist():
                seen = [_decode(c) for c in codes]
                initials = [i for i, _ in seen]
                for k in ("blank", "duplicate", "truncated"):
                    out[k].append(sum(f == k for _, f in seen))
                out["illegal"].append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
                out["first"].append(initials[0])
                out["last"].append(initials[-1])
                out["cells"].append([{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in span_cell(codes).items()])
            names = ["first", "last", "blank", "duplicate", "truncated", "illegal"]
            types = [pa.string(), pa.string()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"), *(pa.array(out[k], t) for k, t in zip(names, types)),
                 pa.array(out["cells"], entry)], ["conv_id", "block", *names, "cells"])

    cells = spans.mapInArrow(parse, fields.format(conv_type, cells_type))
    per_conv = cells.groupBy("conv_id").agg(
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated", "illegal")],
        F.array_sort(F.collect_list(F.struct("block", "first", "last", "cells"))).alias("spans"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            illegal, costs, audits = [], [], []
            for between, spans_ in zip(batch.column("illegal").to_pylist(), batch.column("spans").to_pylist()):
                illegal.append(between + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(spans_, spans_[1:])))
                cost, audit = best(_combine([{(e["p"], e["q"]): (e["cost"], e["audit"]) for e in s["cells"]} for s in spans_]))
                costs.append(cost)
                audits.append(audit)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("conv_id", "blank", "duplicate", "truncated")), pa.array(illegal, pa.int64()),
                 pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return per_conv.mapInArrow(finish, f"conv_id {conv_type}, blank long, duplicate long, truncated long, illegal long, "
                                       "cost long, audit string")


class Writer:
    """Applies an audit to the rows of a conversation, one at a time, and
    yields the repaired (role, text) turns."""

    def __init__(self, audit: str):
        self.audit, self.at = audit, 0
        self.turn = "s" if (len(audit) - audit.count("D")) % 2 else "u"      # only a kept system row makes the length odd

    def _next_role(self) -> str:
        turn = self.turn
        self.turn = "a" if turn == "u" else "u"
        return ROLES.get(turn, "")

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._next_role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            new = self._next_role()
            yield (role if letter == "K" else new), text


def _stream(rows: DataFrame, keep: Materializer) -> tuple[DataFrame, str]:
    """Rows of every conversation in order behind a header with its result."""
    solved = keep("solved", _solutions(rows, keep))
    there = F.when(F.col("copies") > 0, F.col("turn"))
    stats = rows.groupBy("conv_id").agg(
        F.coalesce(F.max(there) - F.min(there) + 1 - F.count_distinct(there), F.lit(0)).cast("long").alias("gaps"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    header = (stats.alias("a").join(solved.alias("b"), F.expr("a.conv_id <=> b.conv_id"), "left")
              .select("a.conv_id", F.lit(0).alias("copy"), "gaps", *zero, F.coalesce("audit", F.lit("")).alias("audit")))
    both = header.unionByName(_copies(rows), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("copy") > 0, *_ORDER), rows.schema["conv_id"].dataType.simpleString()


def _keeper(rows: DataFrame) -> Materializer:
    spark = rows.sparkSession
    return Materializer(spark, scratch_path(spark, f"repair-{uuid.uuid4().hex[:12]}"))


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damage`` or ``undamaged``: counts, cost,
    audit and SHA-256 of the repaired turns."""
    ordered, conv_type = _stream(rows, _keeper(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []                # of the open conversation: header, writer, hash, whether turns were written

        def add(turns) -> None:
            for role, text in turns:
                state[2].update((("\n" if state[3] else "") + f"{role}:{text}").encode())
                state[3] = True

        def close() -> list:
            add(state[1].inserted())
            return [*state[0], state[2].hexdigest()]

        names = ["conv_id", *RESULT, "audit", "repaired_sha256"]
        types = [None] + [pa.int64()] * len(RESULT) + [pa.string()] * 2
        for batch in batches:
            types[0] = batch.schema.field("conv_id").type
            done = []
            columns = [batch.column(c).to_pylist() for c in ("copy", "role", "text", "conv_id", *RESULT, "audit")]
            for copy, role, text, *header in zip(*columns):
                if copy == 0:
                    if state:
                        done.append(close())
                    state = [header, Writer(header[-1]), hashlib.sha256(), False]
                else:
                    add(state[1].row(role, text))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), types)] if done
                                             else [pa.array([], t) for t in types], names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), types)], names)

    return ordered.mapInArrow(run, f"conv_id {conv_type}, " + ", ".join(f"{c} long" for c in RESULT)
                              + ", audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conversation, place from 0, role, text."""
    ordered, conv_type = _stream(rows, _keeper(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, writer, place = None, None, 0
        kind = None

        def packed(out: list) -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.string(), pa.string()))],
                                              ["conv_id", "place", "role", "text"])

        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            for copy, role, text, conv_id, audit in zip(*(batch.column(c).to_pylist() for c in ("copy", "role", "text", "conv_id", "audit"))):
                turns = (writer.inserted() if writer else ()) if copy == 0 else writer.row(role, text)
                for new in turns:
                    out.append((conv, place, *new))
                    place += 1
                if copy == 0:
                    conv, writer, place = conv_id, Writer(audit), 0
            yield packed(out)
        if writer:
            yield packed([(conv, place + k, *new) for k, new in enumerate(writer.inserted())])

    return ordered.mapInArrow(run, f"conv_id {conv_type}, place long, role string, text string")
