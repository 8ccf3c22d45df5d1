"""Quality classifier (operator 10): random Fourier features, ridge, isotonic.

Document statistics (the rule measures and a few shares of the text) are
scaled by fixed functions, mapped to random Fourier features of a Gaussian
kernel, and fitted to the labels by ridge regression.  Each task sums its
own normal equations; sums are added in two levels, so the driver receives
at most ``PARTS`` small matrices.  Raw scores are calibrated by isotonic
regression over at most ``BINS`` score bins.  All labelled training rows take
part; nothing is sampled.

Defined results: null, empty and blank texts have the statistics of an empty
text and get its score; labels other than 0 and 1 and null labels are left
out; a document with several labels counts once per label; without any
usable label every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from lading.llm import quality_rules as rules
from lading.llm.rowmap import ROW, map_texts
from lading.operators.materialize import Materializer
from lading.session import scratch_path

FEATURES = 192
WIDTH = 1.0                 # of the Gaussian kernel, in units of the scaled statistics
RIDGE = 1e-3                # per training row
BINS = 1024
PARTS = 16
SEED = 20


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Scaled document statistics, one row per text."""
    m = dict(zip(rules.MEASURES, (v.astype(float) for v in rules.measure(buf, off))))
    n, lines = np.maximum(m["n_words"], 1), np.maximum(m["n_lines"], 1)
    letters = rules._per_row(((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128), off)
    digits = rules._per_row((buf >= 48) & (buf <= 57), off)
    marks = rules._per_row((buf == 46) | (buf == 44), off)
    size = np.maximum(np.diff(off), 1)
    return np.stack([
        np.log1p(m["n_words"]) / 4, np.minimum(m["word_chars"] / n, 20) / 5, np.minimum(m["n_symbols"] / n, 3),
        2 * m["n_dup_lines"] / lines, 2 * m["n_repeat_words"] / n, np.log1p(n / lines) / 3,
        2 * m["n_upper_words"] / n, np.minimum(m["n_bangs"] / n, 3), 2 * letters / size,
        np.minimum(20 * digits / size, 3), np.minimum(10 * marks / n, 3)], axis=1)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ w + rng.uniform(0, 2 * np.pi, FEATURES)), np.ones((len(x), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of y over ascending x (pool adjacent violators)."""
    blocks: list[list[float]] = []          # mean, weight, first, last
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks.append([b, w, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, u, _, last = blocks.pop()
            top = blocks[-1]
            top[0] = (top[0] * top[1] + v * u) / (top[1] + u)
            top[1], top[3] = top[1] + u, last
    xs = [p for b in blocks for p in (b[2], b[3])]
    return np.array(xs), np.array([b[0] for b in blocks for _ in range(2)])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def stats(buf, off):
        return [pa.array(list(statistics(buf, off)), pa.list_(pa.float64()))]
    return (map_texts(docs.select(id_col, text_col), text_col, [StructField("x", ArrayType(DoubleType()))], stats,
                      [pa.list_(pa.float64())]).select(F.col(ROW)[id_col].alias("doc_id"), "x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 11))


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Weights and calibration curve from rows (x, y)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for batch in batches:
            z, y = fourier(_matrix(batch.column(0))), np.asarray(batch.column(1), dtype=float)
            zy = np.hstack([z, y[:, None]])
            total = zy.T @ zy if total is None else total + zy.T @ zy
            part += len(y)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part % PARTS], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             ["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table["sums"])
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(sums, "part int, sums binary").groupBy("part").applyInArrow(add, "sums binary").collect()
    if not parts:
        return None
    d = FEATURES + 1
    total = sum(np.frombuffer(p["sums"]).reshape(d + 1, d + 1) for p in parts)
    n = total[d - 1, d - 1]                                  # the constant's square sum: number of rows
    weights = np.linalg.solve(total[:d, :d] + RIDGE * n / FEATURES * np.eye(d), total[:d, d])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.clip(fourier(_matrix(batch.column(0))) @ weights, -0.5, 1.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.round((s + 0.5) / 2 * (BINS - 1)).astype(np.int32)), pa.array(s),
                                              pa.array(np.asarray(batch.column(1), dtype=float))], ["bin", "s", "y"])

    bins = (rows.mapInArrow(binned, "bin int, s double, y double").groupBy("bin")
            .agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect())
    xs, ys = isotonic(*(np.array([float(b[c]) for b in bins]) for c in ("s", "y", "n")))
    return weights, xs, ys


def scores(docs: DataFrame, labels: DataFrame, training: str, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality") -> DataFrame:
    """(id, score) per document row; ``training`` is an SQL predicate over the
    id that selects the rows whose labels may be learned from."""
    spark = docs.sparkSession
    keep = Materializer(spark, scratch_path(spark, f"quality-{uuid.uuid4().hex[:12]}"))
    stats = keep("statistics", document_statistics(docs, id_col, text_col))
    marked = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
              .where("y in (0, 1)").where(training.replace(id_col, "doc_id")))
    rows = keep("training", stats.join(marked, "doc_id").select("x", "y"))
    model = fit(rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                s = np.full(len(batch), 0.5)
            else:
                weights, xs, ys = model
                s = np.interp(fourier(_matrix(batch.column(1))) @ weights, xs, ys)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    return stats.mapInArrow(score, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
