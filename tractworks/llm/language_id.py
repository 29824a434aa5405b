"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

A text's letters, lower-cased, with one space for everything else, give its 1- to 3-grams, hashed to ``BUCKETS``. Document
frequencies are counted by Spark over all training texts. Weights are fitted by follow-the-regularised-leader with L1 and
L2 penalties, whose lazily kept sums leave most weights at zero, on at most ``PER_LANGUAGE`` texts of each language (the
smallest hashes of id and text among a hashed share of its texts), of which every fifth is kept out to choose the temperature that the final softmax
divides by. Every whole text is scored.

Null texts and texts without a letter are ``und`` with score 0; rows without a language are never learned from; a row
without an id is in the fold of the empty text; repeated rows are scored each; without any training text all is ``und``; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import fold_of, lean, read

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
PER_LANGUAGE = 500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_M = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of a text's n-grams, or None if it has no letter."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):  # fractions and Roman numerals are no letters
        return None
    c = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32)
    one = c * _M[0]
    two = one[:-1] * _M[1] + one[1:]
    three = two[:-1] * _M[2] + one[2:]
    h = np.concatenate([(g ^ (g >> np.uint32(15))) * _M[1] >> np.uint32(32 - BUCKET_BITS) for g in (one + np.uint32(1), two + np.uint32(2), three + np.uint32(3))])
    counts = np.bincount(h, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(grams: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and unit-length TF-IDF values."""
    at, counts = grams
    x = (1 + np.log(counts)) * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Texts with a letter, and in how many of them each bucket occurs; texts: one string column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                grams = gram_counts(t)
                if grams is not None:
                    seen[grams[0]] += 1
                    seen[BUCKETS] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for b, n in texts.mapInArrow(lean(run), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS + 1 rows at most
        out[b] = n
    return int(out[BUCKETS]), out[:BUCKETS]


class Regression:
    """The fitted weights (classes x buckets), temperature and IDF."""

    def __init__(self, names: list[str], idf: np.ndarray):
        self.names, self.idf, self.temperature = names, idf, 1.0
        self.bias = BUCKETS  # an always-on input
        self.z = np.zeros((len(names), BUCKETS + 1))
        self.n = np.zeros((len(names), BUCKETS + 1))
        self.w = None

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def inputs(self, grams) -> tuple[np.ndarray, np.ndarray]:
        at, x = vector(grams, self.idf)
        return np.append(at, self.bias), np.append(x, 0.1)

    def learn(self, grams, y: int) -> None:
        at, x = self.inputs(grams)
        w = self.weights(at)
        v = w @ x
        p = np.exp(v - v.max())
        p /= p.sum()
        p[y] -= 1
        g = p[:, None] * x
        n = self.n[:, at]
        new = n + g * g
        self.z[:, at] += g - (np.sqrt(new) - np.sqrt(n)) / ALPHA * w
        self.n[:, at] = new

    def finish(self) -> None:
        self.w = np.ascontiguousarray(self.weights(np.arange(BUCKETS + 1)).T)
        self.z = self.n = None

    def logits(self, grams) -> np.ndarray:
        at, x = self.inputs(grams)
        return x @ self.w[at]

    def calibrate(self, rows: list[tuple]) -> None:
        """The temperature with the smallest log-loss on held-out rows, on a logarithmic grid.

        Labels are smoothed by one wrong row in all, so that rows without an error don't call for certainty.
        """
        if not rows:
            return
        v = np.array([self.logits(g) for g, _ in rows])
        y = np.array([k for _, k in rows])

        def loss(t: float) -> float:
            s = v / t
            s -= s.max(1, keepdims=True)
            right = (1 - 1 / (len(y) + 2)) * s[np.arange(len(y)), y] + s.mean(1) / (len(y) + 2)
            return float((np.log(np.exp(s).sum(1)) - right).mean())

        self.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))

    def predict(self, grams) -> tuple[str, float]:
        v = self.logits(grams) / self.temperature
        p = np.exp(v - v.max())
        k = int(np.argmax(p))
        return self.names[k], float(p[k] / p.sum())


def train(rows: DataFrame, per_language: int = PER_LANGUAGE, epochs: int = EPOCHS) -> Regression | None:
    """The model for rows of (key, text, lang); key orders the bounded sample."""
    total, seen = document_frequencies(rows.select("text"))
    if not total:
        return None
    idf = np.log((1 + total) / (1 + seen)) + 1
    # a share of each language that holds the sample twice over, and of that the smallest keys
    shares = [x for lang, n in rows.groupBy("lang").count().collect() for x in (F.lit(lang), F.lit(min(1.0, 2 * per_language / n)))]
    few = rows.where(F.pmod("key", F.lit(1 << 30)) <= F.create_map(*shares)[F.col("lang")] * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    some = few.withColumn("rank", rank).where(F.col("rank") <= per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram_counts(t) or (np.empty(0, np.int64),) * 2 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in grams], pa.list_(pa.int32())), pa.array([g[1] for g in grams], pa.list_(pa.int32()))], names=["key", "lang", "at", "n"])

    # at most per_language sparse rows of each language, of at most BUCKETS numbers
    sample = some.select("key", "lang", "text").mapInArrow(lean(run), "key bigint, lang string, at array<int>, n array<int>").toArrow().sort_by([("key", "ascending"), ("lang", "ascending")])
    langs = sample.column("lang").to_pylist()
    names = sorted(set(langs))
    at, n = (sample.column(c).combine_chunks() for c in ("at", "n"))
    parts = [((a.values.to_numpy().astype(np.int64), b.values.to_numpy()), names.index(k)) for a, b, k in zip(at, n, langs, strict=True) if len(a)]
    model = Regression(names, idf)
    held = parts[::5] if len(parts) >= 50 else []
    used = [p for i, p in enumerate(parts) if i % 5 or not held]
    for e in range(epochs):
        for i in np.random.default_rng(e).permutation(len(used)):
            model.learn(*used[i])
    model.finish()
    model.calibrate(held)
    return model


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_fold: int = 2, **options) -> DataFrame:
    """Per row: id, held_out, lang_pred, score."""
    held = fold_of(id_col, folds) == held_fold
    training = docs.where(~held & F.col(lang_col).isNotNull()).select(F.xxhash64(F.lit("sample"), F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(training, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                grams = gram_counts(t)
                out.append((UNKNOWN, 0.0) if grams is None or model is None else model.predict(grams))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())], names=[id_col, "held_out", "lang_pred", "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(id_col), held.alias("held_out"), F.col(text_col)).mapInArrow(lean(run), schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))
