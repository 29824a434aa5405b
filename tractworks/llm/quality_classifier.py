"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each text gives ``NAMES`` statistics, each put through a logarithm or left as a share. From the labelled rows of the
training folds Spark sums counts, vectors and outer products by class (one small row per class and cell of the matrix, summed
before they are shuffled; no rows are sampled). Class covariances are shrunk towards the pooled one and its mean variance,
Cholesky factors are taken once and kept in the model, and a text's score comes from the difference of its two
log-densities, Mahalanobis distance and log-determinant, put on a 0 to 1 scale by a logistic curve that is fitted to a
histogram of the training rows' differences.

Null texts count as empty and are scored; a row without an id is in the fold of the empty text and has no label; several
labels of one id count as the smallest; repeated rows are scored each; with labels of one class only, or none, scores are
the share of label 1 (0.5 without any); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import fold_of, lean, read, settle

NAMES = ("log_words", "log_word_length", "symbols", "marks", "stops", "commas", "bars", "capitals", "digits", "non_ascii", "distinct", "top_share", "stutter", "pair_repeats", "lines", "repeated_lines", "long_words", "brackets")
SHRINK_POOLED, SHRINK_ROUND = 0.1, 0.02
BINS, REACH = 4096, 64.0
_UP = bytes(range(65, 91))
_LOW = bytes(range(97, 123))
_HIGH = bytes(range(128, 256))


def statistics(text: bytes | None) -> list[float]:
    """The statistics of a text, in the order of ``NAMES``."""
    t = text or b""
    words = t.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    left = lambda chars: len(t) - len(t.translate(None, chars))
    counts = Counter(words)
    size = sum(map(len, words))
    upper, lower = left(_UP), left(_LOW)
    lines = [x for x in t.split(b"\n") if x.strip()]
    share = lambda x: log1p(10 * x / n)
    return [
        log1p(n),
        log1p(size / n),
        share(left(b"#*$%&<>~^=+")),
        share(left(b"!")),
        share(left(b".?")),
        share(left(b",;:")),
        share(left(b"|\\/_")),
        log1p(10 * upper / (upper + lower + 1)),
        log1p(20 * left(b"0123456789") / size),
        log1p(5 * left(_HIGH) / size),
        len(counts) / n,
        log1p(10 * max(counts.values()) / n),
        log1p(10 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n),
        1 - len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        log1p(10 * len(lines) / n),
        1 - len(set(lines)) / len(lines),
        share(sum(k for w, k in counts.items() if len(w) > 25)),
        share(left(b"()[]{}\"'")),
    ]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): per row its statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=[id_col, "x"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(lean(run), schema)


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Discriminant:
    """Means, cached Cholesky factors and the logistic scale."""

    def __init__(self, sums: dict[int, np.ndarray], pooled: float = SHRINK_POOLED, rounded: float = SHRINK_ROUND):
        d = len(NAMES)
        self.parts = []
        self.scale = None
        counts = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
        total = counts[0] + counts[1]
        self.share = (counts[1] / total) if total else 0.5
        if min(counts.values()) < 2:
            return
        within = {}
        means = {}
        for k in (0, 1):
            n, s, outer = counts[k], sums[k][1 : d + 1], sums[k][d + 1 :].reshape(d, d)
            means[k] = s / n
            within[k] = outer / n - np.outer(means[k], means[k])
        common = sum(counts[k] * within[k] for k in (0, 1)) / total
        floor = np.diag(np.maximum(np.diag(common), 1e-6))
        for k in (0, 1):
            cov = (1 - pooled) * within[k] + pooled * common
            cov = (1 - rounded) * cov + rounded * floor
            factor = np.linalg.cholesky(cov)
            self.parts.append((means[k], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(counts[k] / total)))

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included, on a signed logarithmic scale."""
        if not self.parts:
            return np.zeros(len(x))
        value = []
        for mean, inverse, log_det, prior in self.parts:
            z = (x - mean) @ inverse.T
            value.append(prior - 0.5 * (log_det + (z * z).sum(axis=1)))
        return np.arcsinh(value[1] - value[0])

    def fit_scale(self, at: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> None:
        """Logistic curve through a histogram of differences, by Newton steps with a weak ridge."""
        w = np.array([0.0, 1.0])
        x = np.stack([np.ones_like(at), at])
        n = ones + zeros
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(w @ x, -50, 50)))
            slope = x @ (ones - n * p) - 1e-3 * (w - [0, 1])
            bend = (x * (n * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
            step = np.linalg.solve(bend, slope)
            w = w + np.clip(step, -2, 2)
            if abs(step).max() < 1e-9:
                break
        self.scale = w

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.scale is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * self.difference(x), -500, 500)))


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """By label: count, sum and outer products of x."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            y, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            for k in (0, 1):
                z = x[y == k]
                if len(z):
                    sums[k] = sums.get(k, 0) + np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k, np.int32)), pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], names=["y", "cell", "v"])

    out: dict[int, np.ndarray] = {}
    for y, cell, v in rows.mapInArrow(run, "y int, cell int, v double").groupBy("y", "cell").agg(F.sum("v").alias("v")).collect():  # 2 (1 + d + d^2) rows
        out.setdefault(y, np.zeros(1 + d + d * d))[cell] = v
    return out


def train(rows: DataFrame, **options) -> Discriminant:
    """The model for rows of (y 0/1, x)."""
    model = Discriminant(moments(rows), **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = np.clip((model.difference(matrix(batch.column(1))) + REACH) * BINS / (2 * REACH), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d)], names=["y", "bin"])

    if model.parts:
        ones, zeros = np.zeros(BINS), np.zeros(BINS)
        for y, b, n in rows.mapInArrow(run, "y int, bin int").groupBy("y", "bin").count().collect():  # 2 BINS rows at most
            (ones if y else zeros)[b] = n
        model.fit_scale((np.arange(BINS) + 0.5) * 2 * REACH / BINS - REACH, ones, zeros)
    return model


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """Per row: id, held_out, score (0 to 1, higher: label 1 likelier), predicted."""
    rows = settle(with_statistics(docs, id_col, text_col))
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).cast("int").alias("y"))
    training = settle(rows.where(fold_of(id_col, folds) != held_fold).join(known, id_col).select("y", "x"))
    model = train(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(matrix(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=[id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(id_col, (fold_of(id_col, folds) == held_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
