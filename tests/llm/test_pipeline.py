"""The pipeline against a plain version of all its stages."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tractworks.llm import quality_rules
from tractworks.llm.common import settle

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def expected(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    from tractworks.llm.sentencepiece_wfst import MODEL

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    judged = {i: quality_rules.judge(t and t.encode(), 3, 50) for i, t in rows.items()}
    rows = {i: b"\n".join(good).decode() for i, (row, good) in judged.items() if row[6]}
    groups = brute.components({i: brute.fingerprint(t) for i, t in rows.items()})
    rows = {i: t for i, t in sorted(rows.items()) if groups[i] == i}
    gone = dict(zip(rows, brute.removed_bytes(list(rows.values()), 200), strict=True))
    rows = {i: bytes(b for p, b in enumerate(t.encode()) if p not in gone[i]).decode(errors="ignore") for i, t in rows.items()}
    out = {}
    for i, t in rows.items():
        n, h, _ = brute.hits(t, items)
        if not (h and 20 * h >= n):
            out[i] = (t, library.encode(t))
    return out


def test_run(spark, expected):
    got = {r.doc_id: (r.text, list(r.piece_ids)) for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got == expected


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_odd_rows(spark):
    schema = spark.read.parquet(f"{DIR}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, None, "en", None, 3), (2, "", None, "s", None), (2, "", None, "s", None), (None, "a b", "x", "y", 9)]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, DIR).count() <= frame.count()


def test_stages_leave_names_of_their_own_alone(spark):
    """Extra columns come through all stages as they went in, whatever they are called; the other columns do not depend on them."""
    names = ["__key", "__tag", "__spans", "__root", "__KEY_", "__text", "row", "key", "tag", "spans", "found", "kept", "piece_id"]
    plain = spark.read.parquet(f"{DIR}/documents.parquet").limit(120)
    plain = spark.createDataFrame(plain.collect(), plain.schema)
    extra = plain.select("*", *(F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES:
        a, b = settle(stage(spark, plain, DIR)), settle(stage(spark, extra, DIR))
        assert b.columns == [*plain.columns, *names, *a.columns[len(plain.columns) :]], name
        rows = b.collect()
        assert all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
        assert sorted(map(str, b.select(*a.columns).collect())) == sorted(map(str, a.collect()))
        plain, extra = a, b
