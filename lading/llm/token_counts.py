"""Token counts (operator 7): greedy longest-match word pieces in linear time.

A trie over the vocabulary's pieces gets failure links with the number of
pieces they pop: when the next byte has no edge, the match so far is cut into
its greedy pieces by one precomputed hop (count of pieces, node of the
unmatched rest) instead of a second look at the bytes.  Counting a word is
then one pass over its bytes and builds no pieces.  The distinct words of a
run of texts are advanced together, one byte per step; words of over
``LONG_WORD`` bytes one by one.

Word rule: a word is matched as word start mark + bytes; a byte that no piece
covers makes the whole word one unknown token.  The vocabulary comes from a
public tokenizer's file (path parameter); only its pieces are used.

Defined results: null, empty and blank texts have zero words and tokens;
repeated rows are counted each; an empty table gives no rows; other columns
are kept aside in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField

from lading.llm.rowmap import map_texts
from lading.llm.textcols import row_counts, span_hashes, word_spans

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
LONG_WORD = 256             # bytes; a step over few words costs as much as one over many


@dataclass
class Automaton:
    """Edges by (node, byte class), failure hops with popped counts, and for
    every node the pieces left to pop at the end of a word (-1: unknown)."""

    classes: np.ndarray         # byte -> class, 0 for bytes of no piece
    edges: np.ndarray           # node * n_classes + class -> node, -1 none
    fail: np.ndarray            # node -> node after popping, -1 none
    popped: np.ndarray          # node -> pieces popped by the hop
    n_classes: int
    start: int                  # node of the word start mark
    rest: int                   # root for what follows the first piece


def build(pieces: list[bytes]) -> Automaton:
    """Pieces that begin with MARK open a word, all others continue one; both
    live in one trie, whose root is used for the continuation."""
    used = sorted({b for p in pieces for b in p})
    classes = np.zeros(256, dtype=np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    child: list[dict[int, int]] = [{}]
    depth, is_piece, parent, via = [0], [False], [-1], [0]
    for p in pieces:
        node = 0
        for b in p:
            c = int(classes[b])
            nxt = child[node].get(c)
            if nxt is None:
                nxt = len(child)
                child[node][c] = nxt
                child.append({})
                depth.append(depth[node] + 1)
                is_piece.append(False)
                parent.append(node)
                via.append(c)
            node = nxt
        is_piece[node] = True
    n = len(child)
    fail, popped = [-1] * n, [0] * n
    for node in sorted(range(1, n), key=depth.__getitem__):
        if is_piece[node]:
            fail[node], popped[node] = 0, 1          # the match itself is one piece
            continue
        # the parent's hop, then on along the failure links until the last byte fits
        at, count = fail[parent[node]], popped[parent[node]]
        while at != -1 and via[node] not in child[at]:
            count += popped[at]
            at = fail[at]
        if at != -1:
            fail[node], popped[node] = child[at][via[node]], count
    edges = np.full(n * width, -1, dtype=np.int32)
    for node, out in enumerate(child):
        for c, nxt in out.items():
            edges[node * width + c] = nxt
    start = 0
    for b in MARK:
        start = child[start].get(int(classes[b]), -1) if start >= 0 else -1
    return Automaton(classes, edges, np.array(fail, np.int32), np.array(popped, np.int32), width, start, 0)


def count_long(a: Automaton, word: np.ndarray) -> int:
    """Pieces of one word, byte by byte."""
    if a.start < 0:
        return 1
    edges, fail, popped, width = memoryview(a.edges), memoryview(a.fail), memoryview(a.popped), a.n_classes
    node, total = a.start, 0
    for lo in range(0, len(word), 1 << 16):
        for c in a.classes[word[lo:lo + (1 << 16)]].tolist():
            to = edges[node * width + c]
            while to < 0:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                to = edges[node * width + c]
            node = to
    while node > 0:                                          # pop what is left
        total += popped[node]
        node = fail[node]
    return total if node == 0 else 1


def count_words(a: Automaton, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of each word; 1 (unknown) where a byte is covered by no piece."""
    long = np.flatnonzero(ends - starts > LONG_WORD)
    own = [count_long(a, buf[starts[i]:ends[i]]) for i in long.tolist()]
    ends = ends.copy()
    ends[long] = starts[long]
    n = len(starts)
    node = np.full(n, a.start, dtype=np.int64)
    total = np.zeros(n, dtype=np.int64)
    bad = node < 0
    node[bad] = 0
    longest = np.argsort(starts - ends, kind="stable")       # by length, longest first
    sizes = (starts - ends)[longest]                         # negative, rising
    for i in range(-int(sizes[0]) if n else 0):
        live = longest[:np.searchsorted(sizes, -i, side="left")]
        c = a.classes[buf[starts[live] + i]]
        while len(live):
            nxt = a.edges[node[live] * a.n_classes + c]
            stuck = nxt < 0
            node[live[~stuck]] = nxt[~stuck]
            live, c = live[stuck], c[stuck]
            hop = a.fail[node[live]]
            total[live] += a.popped[node[live]]
            bad[live[hop < 0]] = True
            node[live] = np.maximum(hop, 0)
            live, c = live[hop >= 0], c[hop >= 0]
    live = np.flatnonzero((node > 0) & ~bad)
    while len(live):                                         # pop what is left
        hop = a.fail[node[live]]
        total[live] += a.popped[node[live]]
        bad[live[hop < 0]] = True
        node[live] = np.maximum(hop, 0)
        live = live[hop > 0]
    total = np.where(bad, 1, total)
    total[long] = own
    return total


def vocabulary(path: str = TOKENIZER) -> list[bytes]:
    """Pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).encode() for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def token_counts(docs: DataFrame, text_col: str = "text", pieces: list[bytes] | None = None) -> DataFrame:
    """``row`` with ``n_words`` and ``n_tokens``."""
    spark: SparkSession = docs.sparkSession
    automaton = build(pieces if pieces is not None else vocabulary())
    shared = spark.sparkContext.broadcast(vars(automaton))   # size fixed by the vocabulary

    def measure(buf, off):
        n = len(off) - 1
        starts, ends, rows = word_spans(buf, off)
        _, first, back = np.unique(span_hashes(buf, starts, ends, lower=False), return_index=True, return_inverse=True)
        counts = count_words(Automaton(**shared.value), buf, starts[first], ends[first])
        return [row_counts(rows, n), np.bincount(rows, weights=counts[back], minlength=n).astype(np.int64)]

    return map_texts(docs, text_col, [StructField("n_words", LongType()), StructField("n_tokens", LongType())],
                     measure, [pa.int64(), pa.int64()])
