"""A corpus cleaning pipeline made of five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``:

1. quality rules: lines that fail go, and documents that the rules reject;
2. SimHash near-dedup: of each group of near copies the document with the smallest id stays;
3. suffix-array dedup: byte strings of 200 that occur twice or more are cut out of all texts;
4. benchmark decontamination: documents of which hits cover a twentieth or more go;
5. SentencePiece encoding and decoding: piece ids and the round trip of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tractworks.llm.common import read, settle
from tractworks.llm.decontaminate import drop_contaminated
from tractworks.llm.quality_rules import keep_good
from tractworks.llm.sentencepiece_wfst import encode
from tractworks.llm.simhash import keep_one
from tractworks.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, with_decoded=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: SimHash and the piece model have no SQL form; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage returns is kept in the checkpoint folder before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs)
    return docs
