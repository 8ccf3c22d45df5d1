"""Quality rules: a ledger of failure bits, policies and ablations (operator 9).

Every rule is evaluated once per document.  The ledger keeps the measured
values and one ``failure_bits`` number (bit k = rule k failed), so a policy
is a set of bits, a new policy version needs no second look at the texts,
and an ablation is arithmetic on the few distinct bit patterns.

Defined results: a null, empty or blank text has zero words and fails
``too_short``; repeated rows are measured each on their own; an empty table
gives an empty ledger; columns of the input that carry names of the ledger
stay untouched in ``filter_documents`` and are left out of ``ledger``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from lading.llm.rowmap import ROW, map_texts
from lading.llm.textcols import _U, mix, row_counts, span_hashes, window_hashes, word_spans

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper_words", "n_bangs")

# fixed values: the characters that count as symbols
SYMBOLS = b"#*$%&|<>"

#: rule name -> SQL predicate over the measures that is true when the rule fails;
#: the position in this table is the rule's bit
RULES = {
    "too_short": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "shouting": "10 * n_upper_words > 4 * n_words",
    "repeated_lines": "10 * n_dup_lines > 4 * n_lines",
    "exclaiming": "10 * n_bangs > 3 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "short_words": "word_chars < 2 * n_words",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a document is kept if it fails none."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


POLICIES = {
    "base": Policy("base", 1, ("too_short", "repeated_words")),
    "default": Policy("default", 1, tuple(RULES)),
}


def _is_symbol(buf: np.ndarray) -> np.ndarray:
    hit = np.zeros(len(buf), dtype=bool)
    for b in SYMBOLS:
        hit |= buf == b
    return hit


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Flags summed within rows."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[off[1:]] - total[off[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is equal to another key, is equal to an earlier key)."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    any_, later = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def measure(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The measures of each row of a run of texts."""
    n = len(off) - 1
    starts, ends, rows = word_spans(buf, off)
    words = span_hashes(buf, starts, ends, lower=False)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    n_words = row_counts(rows, n)
    word_chars = np.bincount(rows, weights=points[ends] - points[starts], minlength=n).astype(np.int64)
    # lines: cut at every newline and at row boundaries; empty pieces hold no word
    cuts = np.unique(np.concatenate([off, np.flatnonzero(buf == 10), np.flatnonzero(buf == 10) + 1]))
    a, b = cuts[:-1], cuts[1:]
    has_word = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b = a[has_word], b[has_word]
    line_row = np.searchsorted(off[1:], a, side="right")
    line_key = mix(span_hashes(buf, a, b, lower=False) + line_row.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    _, dup = _repeats(line_key)
    # windows of three words, kept inside a row
    windows = window_hashes(words, 3)
    covered = np.zeros(len(words), dtype=bool)
    if len(windows):
        inside = np.flatnonzero(rows[:-2] == rows[2:])
        key = mix(windows[inside] + rows[inside].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        again, _ = _repeats(key)
        at = inside[again]
        for k in range(3):
            covered[at + k] = True
    upper = np.concatenate([[0], np.cumsum((buf >= 65) & (buf <= 90))])
    small = np.concatenate([[0], np.cumsum((buf >= 97) & (buf <= 122))])
    shout = ((upper[ends] - upper[starts]) > 1) & (small[ends] == small[starts])
    return [n_words, word_chars, _per_row(_is_symbol(buf), off), row_counts(line_row[dup], n),
            row_counts(rows[covered], n), row_counts(line_row, n), row_counts(rows[shout], n),
            _per_row(buf == 33, off)]


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    return map_texts(docs, text_col, [StructField(m, LongType()) for m in MEASURES], measure,
                     [pa.int64()] * len(MEASURES))


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, failed in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measures, ``failure_bits``."""
    return (_measured(docs.select(id_col, text_col), text_col)
            .select(F.col(ROW)[id_col].alias(id_col), *MEASURES, failure_bits().alias("failure_bits")))


def passes(policy: Policy, bits: str = "failure_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's verdict and its name and version."""
    return led.withColumns({"kept": passes(policy), "policy": F.lit(f"{policy.name}/{policy.version}")})


def filter_documents(docs: DataFrame, policy: Policy = POLICIES["default"], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their columns."""
    return (_measured(docs, text_col).withColumn("bits_of_rules", failure_bits())
            .where(passes(policy, "bits_of_rules")).select(f"{ROW}.*"))


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: rows failing it, rows failing only it, rows
    kept by the policy without it.  The ledger is first reduced to one row
    per bit pattern (at most 2^rules), so nothing else depends on its size."""
    patterns = led.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("failure_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"))
                                for r in policy.rules])).alias("r")
    rows = patterns.select("n", own.alias("own"), rules).select("n", "own", "r.rule", "r.bit")
    failed = F.col("own").bitwiseAND(F.col("bit")) != 0
    without = F.col("own").bitwiseAND(F.lit(policy.mask).cast("long") - F.col("bit"))
    return rows.groupBy("rule").agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("own") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_only"),
        F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("n_kept_without"))
