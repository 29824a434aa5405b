"""Repeated windows of long texts, judged by where they start first.

A window is a fixed number of neighbouring units (words). Each window of a text belongs to one anchor, chosen by
the window's content alone, so equal windows belong to anchors at the same offset with the same content around. An anchor
row has c (hash of the anchor's own content), u (hash of all content of the windows that it owns, and where they lie),
the text's key and order (its id), the first window it owns and how many. A text is known by id and hash together.

1. Anchors whose c occurs once own no repeated window and go.
2. Rows of equal (c, u) are a class: all their windows are the same. One row, the first, stands for the class.
3. Where a c has several classes, the classes may still share some windows. Up to ``TOGETHER`` of them meet in one row,
   with what their first rows' windows hold, and equal windows are found there.
4. First rows of more classes are dealt into parts of ``PART`` windows at fixed places from the anchor. All windows of a part
   hold its core, so parts are grouped by their core, much longer than the anchor: most groups fall apart. Equal parts
   become classes again, and of these up to four times as many meet in one row; of more, each window becomes a row of its own.

So copies cost one row per anchor, and windows are compared only at the borders of what is shared. Counts and minima are
combined before they are shuffled; the joins are plain equi-joins, which Spark splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import PrefixSums, in_blocks, lean, mixed, settle

LAST_ID = 2**63 - 1

ANCHORS = T.StructType([T.StructField(n, T.LongType()) for n in ("c", "u", "key", "ord", "at")])
#: Classes of one c that meet in one row, and windows in a part.
TOGETHER, PART = 64, 16
#: The low half of ``at``: windows that follow an equal one, or else the anchor's distance from the first window and the windows owned.
STEADY, OFFSET, OWNED = 1 << 31, 20, (1 << 20) - 1


def text_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """(key, ord): a hash of id and text, and the id, by which documents are ordered; rows without one come last."""
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError("documents are ordered by their ids, which must be integers")
    return F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col)), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, ord, text as bytes); rows of equal id and text share both."""
    key, order = text_keys(docs, id_col, text_col)
    return docs.select(key.alias("key"), order.alias("ord"), F.col(text_col).cast("binary").alias("text"))


class Units:
    """What the engine has to know of a kind of text: its anchors, and the values of its units.

    ``anchors(texts)`` gives (text number, c, u, first window, windows owned, distance of the anchor from the first window,
    whether all windows equal the one before the first) arrays; ``values(text)`` one number per unit, ``kind`` their type;
    ``spread(values)`` makes them 64-bit values for hashing.
    """

    width: int
    kind: type

    def anchors(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        raise NotImplementedError

    def values(self, text: bytes) -> np.ndarray:
        raise NotImplementedError

    def spread(self, values: np.ndarray) -> np.ndarray:
        return values


def anchor_rows(rows: DataFrame, units: Units, most_bytes: int = 500_000) -> DataFrame:
    """(c, u, key, ord, at) of all texts; at holds the first window in its high half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ords, texts in in_blocks(batches, most_bytes):
            text, c, u, first, owned, offset, steady = units.anchors(texts)
            at = (first << 32) | np.where(steady, STEADY | owned, (offset << OFFSET) | owned)
            cols = [c.view(np.int64), u.view(np.int64), np.array(keys, np.int64)[text], np.array(ords, np.int64)[text], at]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=ANCHORS.names)

    return rows.mapInArrow(lean(run), ANCHORS)


def window_places(first: np.ndarray, owned: np.ndarray) -> np.ndarray:
    """All windows of stretches, one after another."""
    return np.repeat(first, owned) + np.arange(owned.sum()) - np.repeat(np.cumsum(owned) - owned, owned)


LISTED = T.StructType([*(T.StructField(n, T.LongType()) for n in ("c", "h", "key", "ord", "at")), T.StructField("content", T.BinaryType())])


def parts_of(at: np.ndarray, c: np.ndarray, sums: PrefixSums, width: int) -> tuple[np.ndarray, ...]:
    """(row, c, h, at) of the parts of anchor rows: c from the part's core, h from its windows."""
    size = min(PART, width // 2)
    first, offset, owned = at >> 32, (at >> OFFSET) & 0x7FF, at & OWNED
    row = np.repeat(np.arange(len(at)), owned)
    p = window_places(first, owned)
    anchor = (first + offset)[row]
    q = (anchor - p) // size
    new = np.ones(len(p), bool)
    new[1:] = (row[1:] != row[:-1]) | (q[1:] != q[:-1])
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(p)))
    row, p, q, anchor = row[start], p[start], q[start], anchor[start]
    core = anchor - q * size
    own = mixed(sums.of(core, core - size + 1 + width) ^ c[row].view(np.uint64) ^ q.astype(np.uint64))
    h = mixed(sums.of(p, p + n - 1 + width) ^ (n.astype(np.uint64) << np.uint64(32)) ^ (anchor - p).astype(np.uint64)) | np.uint64(1)
    return row, own.view(np.int64), h.view(np.int64), (p << 32) | n


def compared(rows: DataFrame, firsts: DataFrame, units: Units) -> DataFrame:
    """Rows to compare, with their content: of small groups one for each first row, with h 0; of others one for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, order, text, few, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = units.values(text or b"")
                sums = PrefixSums(units.spread(values)) if many else None
                for i in range(0, max(len(few), len(many)), 4096):
                    c = np.array([a["c"] for a in few[i : i + 4096]], np.int64)
                    at = np.array([a["at"] for a in few[i : i + 4096]], np.int64)
                    h = np.zeros(len(c), np.int64)
                    at = (at >> 32 << 32) | (at & OWNED)
                    if many[i : i + 4096]:
                        _, c2, h2, at2 = parts_of(np.array([a["at"] for a in many[i : i + 4096]], np.int64), np.array([a["c"] for a in many[i : i + 4096]], np.int64), sums, units.width)
                        c, h, at = np.concatenate([c, c2]), np.concatenate([h, h2]), np.concatenate([at, at2])
                    parts = [values[x >> 32 : (x >> 32) + (x & OWNED) - 1 + units.width].tobytes() for x in at.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(h), pa.array(np.full(len(c), key)), pa.array(np.full(len(c), order)), pa.array(at), pa.array(parts, pa.binary())], names=LISTED.names)

    joined = rows.join(firsts, ["key", "ord"]).select("key", "ord", "text", "few", "many")
    return joined.mapInArrow(lean(run), LISTED)


def single_windows(classes: DataFrame, units: Units) -> DataFrame:
    """(c, h, key, ord, at) of each window of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, key, order, at = (batch.column(i).to_numpy() for i in range(4))
            contents = batch.column(4).to_pylist()
            for i in range(0, len(contents), 1024):
                values = np.frombuffer(b"".join(contents[i : i + 1024]), units.kind)
                sizes = np.array([len(x) for x in contents[i : i + 1024]], np.int64) // np.dtype(units.kind).itemsize
                one = at[i : i + 1024]
                owned = one & OWNED
                p = window_places(np.cumsum(sizes) - sizes, owned)
                h = PrefixSums(units.spread(values)).of(p, p + units.width)
                row = np.repeat(np.arange(len(one)), owned) + i
                yield pa.RecordBatch.from_arrays([pa.array(c[row]), pa.array(h.view(np.int64)), pa.array(key[row]), pa.array(order[row]), pa.array(window_places(one >> 32, owned) << 32 | 1)], names=LISTED.names[:5])

    return classes.select("c", "key", "ord", "at", "content").mapInArrow(lean(run), T.StructType(LISTED.fields[:5]))


def met(groups: DataFrame, units: Units) -> DataFrame:
    """(key, ord, start, stop) of the windows that have occurred before in a group's contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            group = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            key, order, at = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("key", "ord", "at"))
            contents = flat.field("content").to_pylist()
            by = np.lexsort((at, key, order, group))  # repeats of a row have come twice
            same = np.zeros(len(by), bool)
            same[1:] = (group[by][1:] == group[by][:-1]) & (key[by][1:] == key[by][:-1]) & (at[by][1:] == at[by][:-1])
            by = by[~same]
            group, key, order, at = group[by], key[by], order[by], at[by]
            contents = [contents[i] for i in by]
            values = np.frombuffer(b"".join(contents), units.kind)
            sizes = np.array([len(x) for x in contents], np.int64) // np.dtype(units.kind).itemsize
            owned = at & OWNED
            p = window_places(np.cumsum(sizes) - sizes, owned)
            h = PrefixSums(units.spread(values)).of(p, p + units.width)
            row = np.repeat(np.arange(len(at)), owned)
            where = window_places(at >> 32, owned)
            g = group[row]
            order_of = np.lexsort((np.arange(len(h)), h, g))  # rows are in the order of texts and places
            hs, gs = h[order_of], g[order_of]
            new = np.ones(len(hs), bool)
            new[1:] = (hs[1:] != hs[:-1]) | (gs[1:] != gs[:-1])
            hit = order_of[~new]
            k, o, w = key[row[hit]], order[row[hit]], where[hit]
            by = np.lexsort((w, o, k))
            k, o, w = k[by], o[by], w[by]
            first = np.ones(len(w), bool)
            first[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1]) | (w[1:] > w[:-1] + 1)
            end = np.append(first[1:], True) if len(w) else first
            yield pa.RecordBatch.from_arrays([pa.array(k[first]), pa.array(o[first]), pa.array(w[first].astype(np.int32)), pa.array((w[end] + units.width).astype(np.int32))], names=["key", "ord", "start", "stop"])

    return groups.mapInArrow(lean(run), "key bigint, ord bigint, start int, stop int")


def repeated_spans(rows: DataFrame, units: Units, together: int = TOGETHER) -> DataFrame:
    """(key, ord, spans): stretches (start, stop), in units, of the texts of :func:`text_rows`, covered by windows that also start earlier."""
    found = anchor_rows(rows, units)
    # a kept copy: joins whose sides are plain exchanges can be split where a key is hot
    often = settle(found.groupBy("c").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("c"))
    kept = settle(found.join(often, "c", "left_semi"))
    begin = F.shiftright("at", 32).cast("int")
    steady = F.col("at").bitwiseAND(STEADY) != 0
    following = kept.where(steady).select("key", "ord", begin.alias("start"), (begin + F.col("at").bitwiseAND(STEADY - 1).cast("int") - 1 + units.width).alias("stop"))
    stop = begin + F.col("at").bitwiseAND(OWNED).cast("int") - 1 + units.width
    place = F.struct("ord", "key", "at")

    def later(members: DataFrame, classes: DataFrame, by: list[str]) -> DataFrame:
        """Spans of the members of classes that have several, without the first."""
        return members.join(classes, by).where(place != F.col("first")).select("key", "ord", begin.alias("start"), stop.alias("stop"))

    shared = kept.where(~steady)
    classes = settle(shared.groupBy("c", "u").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    whole = later(shared, classes.where("n > 1").select("c", "u", "first"), ["c", "u"])

    several = classes.groupBy("c").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    a = F.struct("c", "first.at")
    firsts = classes.join(several, "c").groupBy("first.key", "first.ord").agg(F.collect_list(F.when(F.col("k") <= together, a)).alias("few"), F.collect_list(F.when(F.col("k") > together, a)).alias("many"))
    listed = settle(compared(rows, firsts, units))
    one = F.struct("key", "ord", "at", "content")
    few = listed.where("h = 0").groupBy("c").agg(F.collect_list(one).alias("list")).select("list")

    parts = listed.where("h <> 0")
    part_classes = settle(parts.groupBy("c", "h").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.any_value("content").alias("content")))
    whole_parts = later(parts.drop("content"), part_classes.where("first <> last").select("c", "h", "first"), ["c", "h"])
    counted = part_classes.join(part_classes.groupBy("c").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "c").select("c", "k", "first.*", "content")
    some = counted.where(F.col("k") <= 4 * together).groupBy("c").agg(F.collect_list(one).alias("list")).select("list")
    windows = single_windows(counted.where(F.col("k") > 4 * together), units)
    equal = settle(windows.groupBy("c", "h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("c", "h", "first"))
    single = later(windows, equal, ["c", "h"])

    spans = following.union(whole).union(whole_parts).union(single).union(met(few.union(some), units))
    return settle(spans.groupBy("key", "ord").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
