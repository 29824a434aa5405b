"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Texts are UTF-8 bytes; a suffix matters only through its first ``threshold`` bytes (200). Suffixes are not rows of their own:
a run of neighbouring suffixes is one row as long as all of them go into the same buckets. The passes, each a grouping in Spark:

1. The first digit is a ``digit``-byte string (64) that each suffix's first 200 bytes hold: of those 137 the one with the smallest
   hash, leftmost on ties. Equal strings of 200 bytes have it at the same distance, and neighbours mostly share one, so a run is
   the suffixes that share a digit. Buckets (digits) with one run are finished: nothing in them is repeated.
2. Runs of a bucket that agree on all bytes which their suffixes reach are one group: all of their suffixes are repeated. One of
   them stands for the group in the passes that follow; a bucket with one group is finished.
3. Each pass after that cuts what is left into runs of a fourth of the suffixes, at fixed distances from the digit. The bytes that
   all suffixes of such a part have in common, ever more of them (166, 192, 198 and in the last pass 200), split the bucket;
   buckets with one member are finished, parts that agree on all their bytes are groups, as before.

In the last pass a run is one suffix, its bucket is the suffix's first 200 bytes, and the equal groups are exactly the repeated
windows. Buckets and groups are told apart by two 64-bit hashes, so one of 128 bits would have to collide. A suffix's bytes are
compared from its digit outwards and not from its first byte, so that neighbours can share rows; the groups are the same.

All bytes in a repeated window go, wherever it starts. Null texts are empty; texts under ``threshold`` bytes stay whole;
a row without an id is a document too; repeated rows count as copies of each other; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import PrefixSums, free_name, in_blocks, lean, mixed, read, row_keys, settle, union_length

THRESHOLD = 200
DIGIT = 64
RADIX = 4
VALUES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)

#: A run: digit, hash of all its bytes, row, and in ``at`` the first suffix, its distance from the digit and the number of suffixes.
RUNS = T.StructType([T.StructField("c", T.LongType()), T.StructField("u", T.LongType()), T.StructField("key", T.LongType()), T.StructField("tag", T.IntegerType()), T.StructField("at", T.LongType())])
#: A run of pass 2 that is alone with its bytes in a bucket of several: its first suffix, its distance from the digit, the bytes.
SPELLED = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("key", T.LongType()), T.StructField("tag", T.IntegerType()), T.StructField("run", T.IntegerType()), T.StructField("lead", T.IntegerType()), T.StructField("content", T.BinaryType())])
#: A part of such a run: the hash of what has split it so far, that of all its bytes, and in ``at`` the run's first suffix, how many
#: suffixes of the run stand before the part, and how many are in it.
PARTS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("h", T.LongType()), T.StructField("key", T.LongType()), T.StructField("tag", T.IntegerType()), T.StructField("at", T.LongType())])


def skip_of(at: str) -> Column:
    return F.shiftright(at, 16).bitwiseAND(0xFFFF)


def n_of(at: str) -> Column:
    return F.col(at).bitwiseAND(0xFFFF)


def buckets(members: DataFrame, bucket: str, group: str) -> tuple[DataFrame, DataFrame]:
    """The groups with two members or more, and the buckets with two groups or more; kept, so that joins with them can be split where a key is hot."""
    twice = members.groupBy(bucket, group).agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(bucket, group)
    several = members.groupBy(bucket).agg(F.min(group).alias("least"), F.max(group).alias("most")).where("least <> most").select(bucket)
    return settle(twice), settle(several)


def runs_of(texts: list[bytes], threshold: int, digit: int) -> tuple[np.ndarray, ...]:
    """(text, c, u, first, n, lead) of the runs of several texts: text number, digit, hash of all bytes, first suffix, suffixes, distance."""
    texts = [t if len(t) >= threshold else b"" for t in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < threshold:
        return tuple(np.empty(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums = PrefixSums(VALUES[data])
    n = len(data) - threshold + 1
    h = sums.of(slice(None, len(data) - digit + 1), slice(digit, None))
    best = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size, window = 1, threshold - digit + 1
    while 2 * size <= window:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    best = np.minimum(best[:n], best[window - size : window - size + n])
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    inside = sizes > 0
    ends = (starts + sizes - threshold + 1)[inside]
    whole = np.zeros(n + 1, np.int32)  # suffixes that have threshold bytes
    whole[starts[inside]] += 1
    whole[ends] -= 1
    new = np.ones(n, bool)
    new[1:] = at[1:] != at[:-1]
    new[starts[inside]] = True
    new &= np.cumsum(whole[:-1]) > 0
    first = np.flatnonzero(new)
    after = np.append(first[1:], n)
    text = np.flatnonzero(inside)[np.searchsorted(starts[inside], first, "right") - 1]
    last = np.minimum(after, (starts + sizes - threshold + 1)[text])
    owned, lead = last - first, at[first] - first
    u = mixed(sums.of(first, last - 1 + threshold) ^ (owned.astype(np.uint64) << np.uint64(32)) ^ lead.astype(np.uint64))
    return text, h[at[first]], u, first - starts[text], owned, lead


def runs(rows: DataFrame, threshold: int, digit: int, most_bytes: int = 500_000) -> DataFrame:
    """RUNS of all rows (key, tag, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, tags, texts in in_blocks(batches, most_bytes):
            text, c, u, first, n, lead = runs_of(texts, threshold, digit)
            cols = [c.view(np.int64), u.view(np.int64), np.array(keys, np.int64)[text], np.array(tags, np.int32)[text], (first << 32) | (lead << 16) | n]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=RUNS.names)

    return rows.mapInArrow(lean(run), RUNS)


def batch_of(out: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BinaryType(): pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(zip(*out, strict=True), schema, strict=True)], names=schema.names)


def spelled(rows: DataFrame, chosen: DataFrame, threshold: int) -> DataFrame:
    """SPELLED of chosen runs (c, key, tag, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, tag, text, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for x in some:
                    first, lead, n = x["at"] >> 32, (x["at"] >> 16) & 0xFFFF, x["at"] & 0xFFFF
                    out.append((x["c"], key, tag, first, lead, text[first : first + n - 1 + threshold]))
                    if len(out) >= 8192:
                        yield batch_of(out, SPELLED)
                        out = []
            if out:
                yield batch_of(out, SPELLED)

    lists = chosen.groupBy("key", "tag").agg(F.collect_list(F.struct("c", "at")).alias("some"))  # of one row, so bounded by its text
    return rows.join(lists, ["key", "tag"]).select("key", "tag", "text", "some").mapInArrow(lean(run), SPELLED)


def parted(level: DataFrame, size: int, threshold: int) -> DataFrame:
    """PARTS of up to ``size`` suffixes of what is left of runs; level: key, tag, run, lead, content, some (bucket, skip, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = xxhash.xxh64_intdigest
        for batch in batches:
            out = []
            for key, tag, start, all_lead, content, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for x in some:
                    bucket, skip, n = x["bucket"], x["skip"], x["n"]
                    lead = all_lead - skip
                    for part in range((lead - n + 1) // size, lead // size + 1):
                        a, b = max(0, lead - part * size - size + 1), min(n - 1, lead - part * size)
                        shared = skip + lead - part * size
                        own = name(b"%d %d " % (bucket, part) + content[shared : shared - size + 1 + threshold])
                        h = name(content[skip + a : skip + b + threshold], seed=1)
                        out.append((own - (own >> 63 << 64), h - (h >> 63 << 64), key, tag, start << 32 | skip + a << 16 | b - a + 1))
                if len(out) >= 8192:
                    yield batch_of(out, PARTS)
                    out = []
            if out:
                yield batch_of(out, PARTS)

    return level.select("key", "tag", "run", "lead", "content", "some").mapInArrow(lean(run), PARTS)


def passes_after(threshold: int, digit: int, radix: int = RADIX) -> list[int]:
    """The suffixes in a part, pass by pass: fourths (rounded up) of what a digit can hold, down to one."""
    sizes = [threshold - digit + 1]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // radix))
    return sizes[1:]


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, digit: int = DIGIT) -> DataFrame:
    """(key, tag, spans of bytes to remove) of the rows that have any; key and tag as in :func:`row_keys`."""
    key, tag = row_keys(docs, id_col, text_col)
    rows = docs.select(key.alias("key"), tag.alias("tag"), F.col(text_col).cast("binary").alias("text"))
    found = runs(rows, threshold, digit)
    # kept copies: joins whose sides are plain exchanges can be split where a key is hot
    often = settle(found.groupBy("c").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("c"))
    kept = settle(found.join(often, "c", "left_semi"))
    begin = F.shiftright("at", 32).cast("int")
    twice, several = buckets(kept, "c", "u")
    spans = kept.join(twice, ["c", "u"])
    spans = spans.select("key", "tag", begin.alias("start"), (begin + F.col("at").bitwiseAND(0xFFFF).cast("int") - 1 + threshold).alias("stop"))
    one = [F.first(x).alias(x) for x in ("key", "tag", "at")]  # copies are one before they meet in a bucket
    left = settle(spelled(rows, kept.groupBy("c", "u").agg(*one).join(several, "c").select("c", "key", "tag", "at"), threshold))
    whole = F.array(F.struct("bucket", F.lit(0).cast("bigint").alias("skip"), (F.length("content") - threshold + 1).cast("bigint").alias("n")))
    level = left.withColumn("some", whole)
    for size in passes_after(threshold, digit):
        parts = settle(parted(level, size, threshold))
        twice, several = buckets(parts, "bucket", "h")
        start = F.shiftright("at", 32) + skip_of("at")
        spans = spans.union(parts.join(twice, ["bucket", "h"]).select("key", "tag", start.cast("int").alias("start"), (start + n_of("at") - 1 + threshold).cast("int").alias("stop")))
        one = [F.first(x).alias(x) for x in ("key", "tag", "at")]
        alone = parts.groupBy("bucket", "h").agg(*one).join(several, "bucket")
        part = F.struct("bucket", skip_of("at").alias("skip"), n_of("at").alias("n"))
        some = alone.groupBy("key", "tag", F.shiftright("at", 32).cast("int").alias("run")).agg(F.collect_list(part).alias("some"))  # of one run
        level = left.join(some, ["key", "tag", "run"])
    return settle(spans.groupBy("key", "tag").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))


def cut(text: bytes, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside the spans, and the spans as maximal runs."""
    runs = union_length((s["start"], s["stop"]) for s in spans or ())
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), runs


def with_spans(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``docs`` with one column more, the last: its spans."""
    key, tag = row_keys(docs, id_col, text_col)
    own = [free_name(n, docs) for n in ("__key", "__tag", "__spans")]
    spans = repeated_bytes(docs, id_col, text_col, **options).select("key", "tag", "spans").toDF(*own)
    return docs.join(spans, (key == F.col(own[0])) & (tag == F.col(own[1])), "left").drop(*own[:2])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    rows = with_spans(docs.select(id_col, text_col), id_col, text_col, **options)
    rows = rows.select(F.col(id_col), F.col(text_col).cast("binary"), rows.columns[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            some = [cut(t or b"", s) for t, s in zip(texts, lists, strict=True)]
            size = [len(t or b"") for t in texts]
            cols = [pa.array(size, pa.int64()), pa.array([n - len(k) for n, (k, _) in zip(size, some, strict=True)], pa.int64()), pa.array([len(r) for _, r in some], pa.int64()), pa.array([k for k, _ in some], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=out.names)

    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return rows.mapInArrow(lean(run), out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs``, with the repeated bytes cut out of the text.

    A character that a cut would halve goes with it. Null texts stay null. ``n_chars``, where there is one, follows.
    """
    rows = with_spans(docs, id_col, text_col, **options)
    names = docs.columns
    at, spans = names.index(text_col), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None or not s else cut(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(batch.column(at).to_pylist(), batch.column(spans).to_pylist(), strict=True)]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols[:spans] + cols[spans + 1 :], names=names)

    out = rows.mapInArrow(lean(run), docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, p, md5(substr(x, 2 * p + 1, 400)) AS s FROM (SELECT r, x, unnest(range(0, greatest(len(x) // 2 - 199, 0))) AS p FROM d)),
twice AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT r, p FROM w SEMI JOIN twice USING (s)),
runs AS (SELECT r, min(p) AS a, max(p) + 200 AS b FROM (SELECT r, p, sum(CASE WHEN p - q <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM hit)) GROUP BY r, g),
gaps AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM runs UNION ALL SELECT r, max(b), 1000000000 FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (r) GROUP BY r),
n AS (SELECT r, count(*) AS n, sum(b - a) AS m FROM runs GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(m, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, x))) AS kept_sha256 FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
