"""Variable-capacity best-fit packing (operator 3).

A document's length is its number of words plus one end token.  Documents
longer than the largest permitted sequence are cut into pieces.  Pieces are
dealt to shards of about ``SHARD_PIECES`` by a hash of their row number; a shard is packed by
best-fit decreasing over all permitted capacities at once: a piece goes to
the open bin with the least sufficient room; if there is none, the capacity
with the least cost per token it can expect to hold is opened; at the end
each bin shrinks to the smallest permitted capacity that holds its contents.

Shards bound the memory of a task; what they cost is at most one partly
filled bin of each size per shard.

Defined results: null, empty and blank texts have length 1 (the end token);
repeated rows are packed each; an empty table gives no rows; other columns
are ignored.  Nothing is dropped: the pieces of a document cover its tokens
exactly once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from lading.llm.rowmap import ROW, map_texts
from lading.llm.textcols import row_counts, word_spans

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SEQUENCE_COST = 64              # cost of a sequence besides its tokens
SHARD_PIECES = 1 << 16
RESULT = ("doc_id long, piece int, token_start long, length int, bin_id long, bin_offset int, "
          "capacity int, bin_used int")


def pack(lengths: np.ndarray, capacities: tuple[int, ...], sequence_cost: int = SEQUENCE_COST):
    """Best-fit decreasing over several capacities: per piece its bin and its
    offset there; per bin its final capacity and contents."""
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    # tokens of the pieces at and after position i (all pieces still unplaced)
    rest = np.concatenate([np.cumsum(size[::-1])[::-1], [0]])
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    cap: list[int] = []
    used: list[int] = []
    rooms = 0                               # bit r set: some open bin has room r
    by_room: dict[int, list[int]] = {}
    ascending = -size
    for at, piece in enumerate(order.tolist()):
        n = int(size[at])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            b, best = len(cap), None
            for c in capacities:
                if c < n:
                    continue
                # tokens that can still join: later pieces no longer than the room
                first = max(at + 1, int(np.searchsorted(ascending, -(c - n), side="left")))
                cost = (c + sequence_cost) / (n + min(c - n, int(rest[first])))
                if best is None or cost < best[0]:
                    best = (cost, c)
            cap.append(best[1])
            used.append(0)
        bin_of[piece], offset[piece] = b, used[b]
        used[b] += n
        room = cap[b] - used[b]
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    sizes = np.array(sorted(capacities))
    used_ = np.array(used, dtype=np.int64)
    final = sizes[np.searchsorted(sizes, used_)] if len(used_) else used_
    return bin_of, offset, final, used_


def packed_sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacities: tuple[int, ...] = CAPACITIES, sequence_cost: int = SEQUENCE_COST) -> DataFrame:
    """One row per piece: document, piece number, first token and length, bin,
    offset in the bin, the bin's capacity and contents."""
    largest = max(capacities)

    def lengths(buf, off):
        return [row_counts(word_spans(buf, off)[2], len(off) - 1) + 1]

    numbered = docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row_number"), F.col(f"`{text_col}`").alias("text"))
    sized = (map_texts(numbered, "text", [StructField("tokens", LongType())], lengths, [pa.int64()])
             .select(F.col(ROW)["id"].cast("long").alias("doc_id"), F.col(ROW)["row_number"].alias("row_number"), "tokens"))
    n = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    shards = int(n // SHARD_PIECES) + 1

    def fill(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        ids, tokens = table["doc_id"].combine_chunks(), table["tokens"].to_numpy()
        order = np.lexsort((ids.fill_null(-1).to_numpy(), tokens))
        ids, tokens = ids.take(pa.array(order)), tokens[order]
        pieces = -(-tokens // largest)
        doc = np.repeat(np.arange(len(tokens)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(tokens[doc] - piece * largest, largest)
        bin_of, offset, cap, used = pack(length, capacities, sequence_cost)
        return pa.table({"doc_id": ids.take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                         "token_start": pa.array(piece * largest), "length": pa.array(length, pa.int32()),
                         "bin_id": pa.array((shard << 40) + bin_of), "bin_offset": pa.array(offset, pa.int32()),
                         "capacity": pa.array(cap[bin_of], pa.int32()), "bin_used": pa.array(used[bin_of], pa.int32())})

    # the row number deals equal rows and null ids apart; the order inside a shard is by id and length
    dealt = sized.select(F.pmod(F.xxhash64("row_number"), F.lit(shards)).alias("shard"), "doc_id", "tokens")
    return dealt.groupBy("shard").applyInArrow(fill, RESULT)
