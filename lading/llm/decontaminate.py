"""Benchmark decontamination (operator 1): CGK embedding, bit sampling, exact
edit check.

A document is contaminated by an item when some stretch of its words is
within ``max_share`` of the item's word count in word edit distance
(insertions, deletions, substitutions).  Words here are runs of letters and
digits, lower-cased, so punctuation, bars and stars between words do not
hide a passage; in scripts without spaces (Chinese, Japanese, Thai, Lao,
Burmese, Khmer) every character is a word.

* Pieces: items of ``2 * PIECE_WORDS`` words and more are cut into pieces of
  ``PIECE_WORDS`` words and up.  Of the pieces of an item within the distance
  at least one is within the distance itself, so a found piece leads to the
  item and the share of found items is not below that of pieces.
* Windows: for a class of pieces of similar length L, a window of L words
  starts at every word.  A window with more words unknown to the class than
  edits are allowed cannot match and is not embedded.
* CGK: a walk of 2L steps over the window's words; at each step a random bit
  of the current word decides whether to move on.  Small edit distance
  becomes small Hamming distance between the two walks.
* Bit sampling: each repetition samples ``SAMPLED`` steps of its walk; the
  words seen there are the key.  Repetitions are added until the share of
  edited copies of the class's own pieces, at the largest allowed distance,
  that collide in one of them reaches ``target_recall``.
* Every candidate is checked exactly with a bit-parallel edit search around
  its window.
* Items of fewer than ``min_words`` words are matched exactly, by the hashes
  of the windows of their own length.

The benchmark is taken in blocks of about ``BLOCK_BYTES`` of text, so what
the tasks receive stays bounded whatever its size; the documents are scanned
once per block.

Defined results: null, empty and word-less texts match nothing; an item of
one word matches every document that holds the word; repeated
documents or items give a row each; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.textcols import mix, release, row_cuts, slices, span_hashes, window_hashes

MAX_SHARE = 0.2
MIN_WORDS = 8
TARGET_RECALL = 0.95
SAMPLED = 3
PIECE_WORDS = 24
LEAST_REPEATS = 4
BLOCK_BYTES = 16 << 20
CLASS_RATIO = 1.25
_SLICE = 1 << 20

# fixed values: code points written without spaces, and signs between them
UNSPACED = ((0xE01, 0xE4F), (0xE81, 0xECF), (0x1000, 0x1040), (0x1050, 0x10A0), (0x1780, 0x17D4), (0x3005, 0x3008),
            (0x3021, 0x3030), (0x3031, 0x3040), (0x3041, 0x30FB), (0x30FC, 0x3100), (0x31F0, 0x3200), (0x3400, 0x4DC0),
            (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x20000, 0x323B0))
SIGNS = ((0xE4F, 0xE50), (0xE5A, 0xE5C), (0x104A, 0x1050), (0x17D4, 0x17DB), (0x3000, 0x3005), (0x3008, 0x3021),
         (0x3030, 0x3031), (0x30FB, 0x30FC), (0xFF01, 0xFF10), (0xFF1A, 0xFF21), (0xFF3B, 0xFF41), (0xFF5B, 0xFF66))

RESULT = "doc_id long, item_id long, start long, end long, edits int, item_words int"


def _inside(codes: np.ndarray, ranges: tuple) -> np.ndarray:
    return np.searchsorted(np.ravel(ranges), codes, side="right") % 2 == 1


def _long_characters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of bytes and code point of the characters of three
    and four bytes."""
    at = np.flatnonzero(buf >= 0xE0)
    size = 3 + (buf[at] >= 0xF0)
    code = buf[at].astype(np.int64) & np.where(size == 4, 7, 15)
    for k in (1, 2, 3):
        code = np.where(k < size, code << 6 | buf[np.minimum(at + k, len(buf) - 1)] & 0x3F, code)
    return at, size, code


def plain_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows and hashes of the runs of letters and digits; a
    character of a script without spaces is a run of its own."""
    low = buf | np.where((buf >= 65) & (buf <= 90), 32, 0).astype(np.uint8)
    # two-byte capitals of Latin-1 (C3 80 .. C3 9E without the times sign)
    after = np.zeros(len(buf), dtype=bool)
    after[1:] = buf[:-1] == 0xC3
    low = np.where(after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97), buf + 0x20, low).astype(np.uint8)
    word = ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128)
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[off] = True
    at, size, code = _long_characters(buf)
    alone, sign = _inside(code, UNSPACED), _inside(code, SIGNS)
    edge[at[alone]] = edge[(at + size)[alone]] = True
    for k in range(4):
        word[(at + k)[sign & (k < size)]] = False
    before = np.concatenate([[False], word[:-1]]) if len(buf) else word
    after_ = np.concatenate([word[1:], [False]]) if len(buf) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after_ | edge[1:])) + 1
    rows = np.searchsorted(off[1:], starts, side="right")
    return starts, ends, rows, span_hashes(low, starts, ends, lower=False)


@dataclass
class ItemClass:
    """Pieces of similar length, their allowed edits and their LSH keys."""

    size: int
    edits: int
    vocabulary: np.ndarray
    keys: list = field(default_factory=list)     # per repetition: (sorted keys, piece numbers)


def walk_keys(words: np.ndarray, at: np.ndarray, stop: np.ndarray, size: int, repeat: int) -> np.ndarray:
    """Key of repetition ``repeat`` for the windows words[at : min(at + size,
    stop)]: the words under the sampled steps of the CGK walk."""
    steps = 2 * size
    rng = np.random.default_rng([size, repeat])
    sampled = set(rng.choice(steps * 3 // 4, min(SAMPLED, steps * 3 // 4), replace=False).tolist())
    odd = mix(np.arange(steps, dtype=np.uint64) + np.uint64(repeat * 4099), 21) | np.uint64(1)
    end = np.minimum(at + size, stop)
    words = np.append(words, np.uint64(0))
    here = at.copy()
    key = np.zeros(len(at), dtype=np.uint64)
    for step in range(max(sampled) + 1):
        word = words[here]
        word[here >= end] = 0
        if step in sampled:
            key = mix(key ^ word, step)
        here += ((word * odd[step]) >> np.uint64(63)).view(np.int64)
    return key


def edit_search(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(least edits, end): the stretch of ``text`` nearest to ``pattern`` in
    edit distance ends at ``end`` (the first such end).  Bit-parallel: one
    machine-word-like step per text word on integers of len(pattern) bits."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    rises, falls, score = full, 0, m
    best, where = m, 0
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        vertical = eq | falls
        across = (((eq & rises) + rises) ^ rises) | eq
        up = falls | (full & ~(across | rises))
        down = rises & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        rises = down | (full & ~(vertical | up))
        falls = up & vertical
        if score < best:
            best, where = score, j + 1
    return best, where


def _edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with ``edits`` random word edits."""
    out = words.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(1, len(out))))
        new = int(rng.integers(1 << 62))
        if kind == 0 and len(out) > 1:
            del out[at]
        elif kind == 1:
            out.insert(at, new)
        else:
            out[at] = new
    return np.array(out, dtype=np.uint64)


def item_pieces(items: list[np.ndarray], min_words: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The pieces the items of at least ``min_words`` words are found by, the
    item of each and its first word there."""
    pieces, item, first = [], [], []
    for i, words in enumerate(items):
        n = max(1, len(words) // PIECE_WORDS) if len(words) >= min_words else 0
        for k in range(n):
            a, b = k * len(words) // n, (k + 1) * len(words) // n
            pieces.append(words[a:b])
            item.append(i)
            first.append(a)
    return pieces, np.array(item, dtype=np.int64), np.array(first, dtype=np.int64)


def _own_keys(pieces: list[np.ndarray], size: int, repeat: int) -> np.ndarray:
    stop = np.cumsum([len(p) for p in pieces])
    return walk_keys(np.concatenate(pieces), stop - [len(p) for p in pieces], stop, size, repeat)


def _repeats_for(pieces: list[np.ndarray], size: int, share: float, recall: float, trials: int = 256) -> int:
    """Repetitions until the target share of edited copies, at the largest
    allowed number of edits, has met its piece's key."""
    rng = np.random.default_rng(size)
    own = [pieces[i % len(pieces)] for i in rng.permutation(max(trials, len(pieces)))[:trials]]
    edited = [_edited(p, int(share * len(p)), rng) for p in own]
    met, repeats = np.zeros(trials, dtype=bool), 0
    while met.mean() < recall:
        met |= _own_keys(own, size, repeats) == _own_keys(edited, size, repeats)
        repeats += 1
    return max(LEAST_REPEATS, repeats)


def item_classes(pieces: list[np.ndarray], share: float, recall: float) -> list[ItemClass]:
    """Classes of pieces whose lengths are within CLASS_RATIO, with the keys of
    as many repetitions as the target recall needs."""
    by_length = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    classes: list[ItemClass] = []
    while by_length:
        size = len(pieces[by_length[0]])
        members = [i for i in by_length if len(pieces[i]) <= size * CLASS_RATIO]
        by_length = by_length[len(members):]
        own = [pieces[i] for i in members]
        made = ItemClass(size, max(int(share * len(p)) for p in own), np.unique(np.concatenate(own)))
        for r in range(_repeats_for(own, size, share, recall)):
            keys = _own_keys(own, size, r)
            order = np.argsort(keys)
            made.keys.append((keys[order], np.array(members)[order]))
        classes.append(made)
    return classes


def exact_items(items: list[np.ndarray], numbers: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The given items by length: word count, sorted window hashes, item numbers."""
    out = []
    for n in sorted({len(items[i]) for i in numbers}):
        own = np.array([i for i in numbers if len(items[i]) == n])
        keys = np.concatenate([window_hashes(items[i], n) for i in own])
        order = np.argsort(keys, kind="stable")
        out.append((n, keys[order], own[order]))
    return out


def _exact(words: np.ndarray, rows: np.ndarray, short: list) -> np.ndarray:
    """(row, item number, word) of the first window of a row that equals a short item."""
    found = []
    for n, keys, numbers in short:
        mine = window_hashes(words, n)
        lo, hi = np.searchsorted(keys, mine, side="left"), np.searchsorted(keys, mine, side="right")
        hit = np.flatnonzero((hi > lo) & (rows[:len(mine)] == rows[n - 1:]))
        while len(hit):                              # items with equal words
            found.append(np.stack([rows[hit], numbers[lo[hit]], hit], axis=1))
            lo[hit] += 1
            hit = hit[lo[hit] < hi[hit]]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.unique(found[:, :2], axis=0, return_index=True)[1]]


def _candidates(words: np.ndarray, cuts: np.ndarray, classes: list[ItemClass]) -> np.ndarray:
    """(window start, piece number) pairs whose keys collide in some repetition."""
    found = []
    row_end = np.repeat(cuts[1:], np.diff(cuts))
    for c in classes:
        known = np.isin(words, c.vocabulary, kind="sort") if len(c.vocabulary) > 1 << 16 else _member(words, c.vocabulary)
        seen = np.concatenate([[0], np.cumsum(known)])
        at = np.arange(len(words))
        enough = seen[np.minimum(at + c.size, row_end)] - seen[at] >= c.size - c.edits
        at = at[enough]
        if not len(at):
            continue
        for r, (keys, numbers) in enumerate(c.keys):
            mine = walk_keys(words, at, row_end[at], c.size, r)
            lo, hi = np.searchsorted(keys, mine, side="left"), np.searchsorted(keys, mine, side="right")
            hit = np.flatnonzero(hi > lo)
            while len(hit):                          # pieces with equal keys
                found.append(np.stack([at[hit], numbers[lo[hit]]], axis=1))
                lo[hit] += 1
                hit = hit[lo[hit] < hi[hit]]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)


def _member(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Exact membership, most words settled by a small table."""
    table = np.zeros(1 << 16, dtype=bool)
    table[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(words & np.uint64(0xFFFF)).astype(np.int64)])
    out = np.zeros(len(words), dtype=bool)
    at = np.minimum(np.searchsorted(vocabulary, words[maybe]), len(vocabulary) - 1)
    out[maybe] = vocabulary[at] == words[maybe]
    return out


def _matches(buf, off, classes, items, ids, piece_item, piece_first, short, share):
    """Exactly checked matches of a run of texts: (row, item id, first and end
    character, edits, item words), the best one per row and item."""
    starts, ends, rows, words = plain_words(buf, off)
    cuts = row_cuts(rows, len(off) - 1)
    best: dict[tuple[int, int], tuple] = {}
    done: dict[tuple[int, int], int] = {}
    points = None
    for row, number, at in _exact(words, rows, short).tolist():
        best[(row, number)] = (0, at, at + len(items[number]) - 1)
    at, piece = _candidates(words, cuts, classes).T
    # where the item of the piece would start, in order for every row and item
    asked = np.unique(np.stack([rows[at], piece_item[piece], at - piece_first[piece]], axis=1), axis=0)
    for row, number, at in asked.tolist():
        item = items[number]
        m, slack = len(item), int(share * len(item))
        if done.get((row, number), at - 1) >= at:     # inside the stretch just searched
            continue
        lo = max(int(cuts[row]), at - 2 * slack - 1)
        hi = min(int(cuts[row + 1]), at + 2 * m + 2 * slack)
        done[(row, number)] = at + m
        text = words[lo:hi].tolist()
        edits, end = edit_search(item.tolist(), text)
        if edits > slack or edits >= best.get((row, number), (m + 1,))[0]:
            continue
        _, back = edit_search(item.tolist()[::-1], text[:end][::-1])
        best[(row, number)] = (edits, lo + end - max(back, 1), lo + end - 1)
    for (row, number), (edits, first, last) in best.items():
        if points is None:
            points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        base = points[off[row]]
        yield (row, ids[number], int(points[starts[first]] - base), int(points[ends[last]] - base), edits, len(items[number]))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", max_share: float = MAX_SHARE,
                  min_words: int = MIN_WORDS, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per (document row, item) within the distance: ids, the span in
    characters, the number of edits and the item's word count."""
    if not 0 <= max_share < 0.5:
        raise ValueError("max_share: the walks need most words of a passage unchanged")
    spark = docs.sparkSession
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], RESULT)
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow().combine_chunks()
        items, ids = [], []
        for batch in block.to_batches():
            for lo, hi, buf, off in slices(batch.column(1)):
                _, _, rows, words = plain_words(buf, off)
                cuts = row_cuts(rows, hi - lo)
                for i in range(hi - lo):
                    if cuts[i + 1] > cuts[i]:
                        items.append(words[cuts[i]:cuts[i + 1]])
                        ids.append(batch.column(0)[lo + i].as_py())
        if not items:
            continue
        short = exact_items(items, [i for i, words in enumerate(items) if len(words) < min_words])
        pieces, piece_item, piece_first = item_pieces(items, min_words)
        classes = [vars(c) for c in item_classes(pieces, max_share, target_recall)]
        asked_for = spark.sparkContext.broadcast((classes, items, ids, piece_item, piece_first, short))

        def search(batches: Iterator[pa.RecordBatch], asked_for=asked_for) -> Iterator[pa.RecordBatch]:
            classes, *asked = asked_for.value
            classes = [ItemClass(**c) for c in classes]
            for batch in batches:
                got = []
                for lo, hi, buf, off in slices(batch.column(1), _SLICE):
                    got += [(lo + m[0], *m[1:]) for m in _matches(buf, off, classes, *asked, max_share)]
                cols = list(zip(*got)) if got else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())),
                     *(pa.array(c, pa.int64()) for c in cols[1:4]), *(pa.array(c, pa.int32()) for c in cols[4:])],
                    ["doc_id", "item_id", "start", "end", "edits", "item_words"])
                batch = buf = off = None    # gone before the next one is read
                release()

        out = out.union(given.mapInArrow(search, RESULT))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without any benchmark match, with their columns."""
    found = contamination(docs, benchmark, id_col, **options).select(F.col("doc_id").alias("found_id")).distinct()
    return docs.join(found, docs[id_col] == found["found_id"], "left_anti")
