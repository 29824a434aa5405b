"""Benchmark decontamination by winnowing.

Words are the lower-cased runs of ASCII letters, digits and non-ASCII characters. Of each ``span - gram + 1`` neighbouring
word k-grams the smallest hash (rightmost on ties) is a fingerprint, so two texts that share ``span`` words share one at
the same place of the shared part. Fingerprints of documents and items are joined in Spark; a hit is then extended word by
word to both sides and counts if it reaches ``span`` words. Items of fewer words are matched whole, by length. A bitmap of
fixed size (``bitmap_bits``, one megabyte) made from the items' fingerprints goes to all tasks and holds back fingerprints
that no item has; it cannot lose one. The join itself is left to Spark, which broadcasts only what it has measured.

Null texts have no words; a row with a null id is judged like any other; repeated rows give a row each; items of equal id
are one item with the windows of all its rows; empty tables give no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import gram_hashes, lean, read, row_keys, settle, window_argmin

SPAN, GRAM = 13, 6
BITMAP_BITS = 1 << 23
#: ASCII letters and digits stay (lower-cased), other ASCII becomes a space, the rest stays.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
CACHE = 400_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, seed=7)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def fingerprint_places(ids: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed k-grams of a text of at least ``span`` words."""
    h = gram_hashes(ids, gram, 1)
    at = np.unique(window_argmin(h, span - gram + 1))
    return at, h[at]


def around(ids: np.ndarray, at: int, span: int, gram: int) -> tuple[int, bytes]:
    """The hashes of up to ``span - gram`` words on both sides of a k-gram, and how many of them stand before it."""
    first = max(0, at - (span - gram))
    return at - first, ids[first : at + span].tobytes()


CANDIDATE = T.StructType().add("fp", T.LongType()).add("len", T.IntegerType()).add("at", T.IntegerType()).add("before", T.IntegerType()).add("words", T.BinaryType())
_ARROW = pa.struct([("fp", pa.int64()), ("len", pa.int32()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.binary())])
#: An entry that is no candidate.
ROW = {"fp": 0, "len": 0, "at": 0, "before": 0, "words": b""}


def item_fingerprints(items: DataFrame, id_col: str, text_col: str, span: int, gram: int) -> DataFrame:
    """(item, fp, len, before, words): all fingerprints of the items; len is the item's words where fewer than ``span``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids_out, out = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = hashes.of(words_of(text))
                n = len(ids)
                if 0 < n < span:
                    ids_out.append(key)
                    out.append({"fp": int(gram_hashes(ids, n, 2).view(np.int64)[0]), "len": n, "at": 0, "before": 0, "words": ids.tobytes()})
                elif n:
                    for at, fp in zip(*fingerprint_places(ids, span, gram), strict=True):
                        before, words = around(ids, int(at), span, gram)
                        ids_out.append(key)
                        out.append({"fp": int(fp.view(np.int64)), "len": span, "at": int(at), "before": before, "words": words})
            yield pa.RecordBatch.from_arrays([pa.array(ids_out, batch.column(0).type), pa.array(out, _ARROW)], names=["item", "c"])

    schema = T.StructType([T.StructField("item", items.schema[id_col].dataType), T.StructField("c", CANDIDATE)])
    return items.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(lean(run), schema).select("item", "c.*")


def bitmap(found: DataFrame, bits: int) -> np.ndarray:
    """One bit per fingerprint, in ``bits`` bits whatever the number of items."""
    words = found.select(F.expr(f"cast((fp & {bits - 1}) >> 5 as int)").alias("w"), F.expr("shiftleft(1L, cast(fp & 31 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(bits // 32, np.uint32)
    for w, b in words.toLocalIterator():
        out[w] = b
    return out


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """Per row of ``docs``: id, n_words, spans of hit words (start, stop), items found.

    A row is known by a hash of its id and text, which a task that runs again gives it again; so rows of one id and text are worked on
    as one and counted, and each of them is in the result.
    """
    marks = settle(item_fingerprints(items, item_id, item_text, span, gram))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(marks, bitmap_bits))
    short = sorted(r[0] for r in marks.where(F.col("len") < span).select("len").distinct().collect())  # under ``span`` values

    def passes(h: np.ndarray) -> np.ndarray:
        low = h & np.uint64(bitmap_bits - 1)
        return (bits.value[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32)) & 1 > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, lists = [], []
            for text in batch.column(3).to_pylist():
                ids = hashes.of(words_of(text))
                counts.append(len(ids))
                out = [ROW]  # stands for the row itself
                if len(ids) >= span:
                    at, fp = fingerprint_places(ids, span, gram)
                    good = passes(fp)
                    for a, f in zip(at[good].tolist(), fp[good].view(np.int64).tolist(), strict=True):
                        before, words = around(ids, a, span, gram)
                        out.append({"fp": f, "len": span, "at": a, "before": before, "words": words})
                for n in short:
                    h = gram_hashes(ids, n, 2)
                    for a in np.flatnonzero(passes(h)).tolist():
                        out.append({"fp": int(h[a].view(np.int64)), "len": n, "at": a, "before": 0, "words": ids[a : a + n].tobytes()})
                lists.append(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(lists, pa.list_(_ARROW))], names=["key", "tag", "id", "n_words", "found"])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("tag", T.IntegerType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("found", T.ArrayType(CANDIDATE))])
    row = ["key", "tag"]
    seen = docs.select(*(c.alias(n) for c, n in zip(row_keys(docs, id_col, text_col), row, strict=True)), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(lean(run), schema)
    hits = seen.select(*row, "id", "n_words", F.explode("found").alias("c"))
    # what stands for a row has a key of its own, so that these don't meet in one task
    hits = hits.select(*row, "id", "n_words", "c.len", F.when(F.col("c.len") > 0, F.col("c.fp")).otherwise(F.xxhash64(*row)).alias("fp"), "c.at", "c.before", "c.words")
    # a passage that many items share is one context: documents meet it once, its items come in after the hits are verified
    context = F.xxhash64("fp", "len", "before", "words")
    theirs = marks.select("fp", "len", context.alias("context"), F.col("before").alias("item_before"), F.col("words").alias("item_words")).distinct()
    joined = hits.join(theirs, ["fp", "len"], "left").select(*row, "id", "n_words", "len", "at", "before", "words", "context", "item_before", "item_words")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            starts, stops, item = [], [], []
            for n, at, before, words, key, their_before, theirs in zip(*cols[4:], strict=True):
                start = stop = who = None
                if n > 0 and theirs is not None:
                    if n < span:
                        if words == theirs:
                            start, stop, who = at, at + n, key
                    else:
                        a, b = np.frombuffer(words, np.uint64), np.frombuffer(theirs, np.uint64)
                        left = min(before, their_before)
                        same = a[before - left : before + gram][: left + gram] == b[their_before - left : their_before + gram]
                        if same[left:].all():
                            back = left if same.all() else left - 1 - int(np.flatnonzero(~same)[-1])
                            x, y = a[before + gram :], b[their_before + gram :]
                            m = min(len(x), len(y))
                            differ = np.flatnonzero(x[:m] != y[:m])
                            ahead = int(differ[0]) if len(differ) else m
                            if back + gram + ahead >= span:
                                start, stop, who = at - back, at + gram + ahead, key
                starts.append(start)
                stops.append(stop)
                item.append(who)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(item, pa.int64())], names=["key", "tag", "id", "n_words", "len", "start", "stop", "context"])

    out = T.StructType([*schema.fields[:4], T.StructField("len", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("context", T.LongType())])
    hit = F.when(F.col("start").isNotNull(), F.struct("start", "stop"))
    found = joined.mapInArrow(lean(extend), out).groupBy(*row).agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.collect_set(hit).alias("spans"), F.collect_set("context").alias("contexts"), F.count(F.when(F.col("len") == 0, 1)).alias("copies"))
    # each context of a row meets its items once; rows without one have a key of their own
    whose = marks.select(context.alias("context"), "item").distinct()
    held = [c for c in found.columns if c not in (*row, "contexts")]
    each = found.select(*row, *held, F.explode_outer("contexts").alias("context")).withColumn("context", F.coalesce("context", F.xxhash64(F.lit("none"), *row)))
    rows = each.join(whose, "context", "left").groupBy(*row).agg(*(F.first(c).alias(c) for c in held), F.collect_set("item").alias("items"))
    return rows.select("id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).drop("copy")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_percent: int = 5, **options) -> DataFrame:
    """Per row: id, n_words, n_hit, items (sorted as text), contaminated (hit words are ``least_percent`` or more)."""
    found = matches(docs, items, id_col, text_col, **options)
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"] - 1))))).cast("long")
    out = found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= least_percent * F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that are not contaminated, all columns as they were; rows of one id and text go or stay together."""
    key = F.struct(*(c.alias(n) for c, n in zip(row_keys(docs, id_col, text_col), ("key", "tag"), strict=True)))
    keyed = docs.select(key.alias("__key"), F.col(text_col).alias("__text"))
    bad = decontaminate(keyed, items, "__key", "__text", **options).where("contaminated").select("__key").distinct()
    return docs.join(bad, key == bad["__key"], "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 13) AS k, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS s
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM bw WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
sw AS (SELECT r, k, i, array_to_string(ws[i : i + k - 1], ' ') AS s FROM (SELECT r, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, ks WHERE len(ws) >= k)),
hit AS (SELECT r, i, k, item_id FROM sw JOIN iw USING (k, s)),
hw AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
hi AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(hi.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hw.n, 0) > 0 AND 20 * coalesce(hw.n, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
