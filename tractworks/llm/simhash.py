"""SimHash near-duplicates found through an inverted index of the fingerprint's byte positions.

A fingerprint has eight positional bytes. Two that differ in ``most_bits`` <= 2 bits share at least six of them, so of the
four byte pairs at least two are equal: each fingerprint is posted under its six choices of two byte pairs. For the
pairs of a posting list the shared positional bytes are tallied, pairs below the guaranteed minimum of six go, and the
rest are verified bit by bit. Equal fingerprints are one entry of the index, so exact copies make no pairs. Lists of over
``long_list`` entries are split by further positions, two more bytes and then one more byte or two half bytes, so that in the end
a list has eight free bits and cannot hold more than 256 entries: the same index and the same tally at any density.

Null texts are empty (fingerprint zero); a null id keeps its row and is passed over as a component id; repeated rows share
a fingerprint and stay as rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import free_name, lean, read, row_keys, settle

#: The bits of an XXH64 with this seed.
_hash = partial(xxhash.xxh64_intdigest, seed=42)
LONG_LIST = 32
MIN_SHARED_BYTES = 6


def fingerprint(text: bytes | None, words_per_shingle: int = 3) -> int:
    """The 64-bit SimHash of a text as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        return _hash(b" ".join(words))
    n = len(words) - words_per_shingle + 1
    grams = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
    h = np.fromiter(map(_hash, grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = h[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(id, fp) per row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words_per_shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(lean(run), schema)


def signed(x: int) -> int:
    return x - (x >> 63 << 64)


def split_positions() -> list[dict[int, list[int]]]:
    """The positions under which fingerprints are posted: for each step, the masks that follow a mask of the step before.

    Two bits differ at most. So of four byte pairs two agree; of the four bytes outside them two agree as well; and of the two bytes
    left one agrees, or each has an equal half.
    """
    byte = [0xFF << 8 * i for i in range(8)]
    first = {0: [sum(byte[2 * i] | byte[2 * i + 1] for i in pairs) for pairs in combinations(range(4), 2)]}
    rest = lambda mask: [i for i in range(8) if not mask & byte[i]]
    second = {m: [m | byte[i] | byte[j] for i, j in combinations(rest(m), 2)] for m in first[0]}
    halves = (0x0F, 0xF0)
    third = {m: [m | byte[i] for i in rest(m)] + [m | a << 8 * rest(m)[0] | b << 8 * rest(m)[1] for a in halves for b in halves] for ms in second.values() for m in ms}
    return [{signed(m): list(map(signed, ms)) for m, ms in step.items()} for step in (first, second, third)]


def posted(rows: DataFrame, step: dict[int, list[int]]) -> DataFrame:
    """(mask, value, fp): each (fp, mask) under all positions that follow its mask, once."""
    masks = F.create_map(*(x for m, ms in step.items() for x in (F.lit(m).cast("long"), F.array(*(F.lit(y).cast("long") for y in ms)))))
    finer = rows.select("fp", F.explode(masks[F.col("mask")]).alias("mask"))
    return finer.distinct().select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def tallied(lists: DataFrame, most_bits: int) -> DataFrame:
    """(u, v): pairs of the posting lists that share the guaranteed number of positional bytes and are verified bit by bit."""
    a = lists.select("fps", F.posexplode("fps").alias("at", "u"))
    pairs = a.select("u", F.explode(F.expr("slice(fps, at + 2, size(fps))")).alias("v"))
    x = F.col("u").bitwiseXOR(F.col("v"))
    shared = sum((F.when(F.shiftrightunsigned(x, 8 * i).bitwiseAND(0xFF) == 0, 1).otherwise(0) for i in range(8)), F.lit(0))
    return pairs.where(shared >= MIN_SHARED_BYTES).where(F.bit_count(x) <= most_bits).select("u", "v")


def near_links(fps: DataFrame, most_bits: int = 2, long_list: int = LONG_LIST) -> DataFrame:
    """(u, v), u < v: all pairs of distinct fingerprints within ``most_bits``.

    A list of up to ``long_list`` entries is paired; a longer one is split by further positions, where its near pairs meet again. The
    last split leaves eight free bits at most, so its lists hold 256 entries at most and are all paired.
    """
    if not 0 <= most_bits <= 2:
        raise ValueError("the byte index guarantees its matches up to two differing bits")
    steps = split_positions()
    rows = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    found = None
    for i, step in enumerate(steps):
        entries = settle(posted(rows, step))
        sizes = settle(entries.groupBy("mask", "value").count().where("count > 1"))
        listed = entries.join(sizes, ["mask", "value"])
        last = i == len(steps) - 1
        short = listed if last else listed.where(F.col("count") <= long_list)
        pairs = tallied(short.groupBy("mask", "value").agg(F.sort_array(F.collect_list("fp")).alias("fps")), most_bits)
        found = pairs if found is None else found.union(pairs)
        if last or sizes.where(F.col("count") > long_list).isEmpty():
            break
        rows = listed.where(F.col("count") > long_list).select("fp", "mask")
    return found.distinct()


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by alternating large and small stars."""
    e = settle(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == mark:
            break
        mark = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        e = settle(small.distinct())
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """(id, fp, component): per row its fingerprint and the smallest id that links reach."""
    rows = settle(fingerprints(docs, id_col, text_col, words_per_shingle))
    classes = settle(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = connected(near_links(classes.select("fp"), most_bits))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = settle(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("fp", "component"))
    return rows.join(named, "fp").select(id_col, "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component: the one of the smallest id (rows without one come last) and, of rows of that id, the smallest key."""
    own = free_name("__key", docs)
    keyed = docs.withColumn(own, F.struct(*(c.alias(n) for c, n in zip(row_keys(docs, id_col, text_col), ("key", "tag"), strict=True))))
    rank = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(own).alias("key"))
    found = components(keyed.select(rank.alias("__rank"), F.col(text_col).alias("__text")), "__rank", "__text", **options)
    root = free_name("__root", keyed)
    roots = found.select(F.col("component.key").alias(root)).distinct()
    return keyed.join(roots, F.col(own) == F.col(root), "left_semi").dropDuplicates([own]).drop(own)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
