"""Exact removal of repeated word windows through recompression.

A text is a sequence of words, named by 64-bit hashes, and is rewritten in ``ROUNDS`` rounds. A round first names runs
of one symbol, then pairs of neighbours: one bit of a symbol's name puts it to the left or the right side, and a left
symbol followed by a right one becomes a symbol of its own. A name is a function of what it names, so it is the same in
every text and task: the globally shared names need no table. Each symbol carries the stretch of words that its making
looked at (itself, the word that ends a run, the neighbour that an unpaired symbol did not join), so a symbol whose
stretch lies inside a repeated window is found, with the same name and place, in each of its occurrences.

A window of ``width`` words (20) belongs to the symbol with the smallest name of those whose stretch it holds; a window
that holds none (in long runs) belongs to itself. Symbols, with their stretches, that occur once own no repeated window.
Shared ones are verified by :func:`repeats.repeated_spans` on all words of the windows.

A word goes if a window over it also starts earlier: in a smaller id, or before in the same text; windows are judged on
the input. Null texts have no words; texts under ``width`` words stay whole; rows without an id come after all others;
repeated rows (equal id and text) are one document and get equal results; rows of one id with other texts count as one
document's parts in order of a hash of id and text; ids must be integers, as they order the documents; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import MIX, PrefixSums, lean, mixed, read, union_length
from tractworks.llm.repeats import Units, repeated_spans, text_keys, text_rows

WIDTH = 20
ROUNDS = 2
VALUES = np.random.default_rng(12).integers(0, 2**64, 256, dtype=np.uint64)
SPACE = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
ONE = np.uint64(1)


def named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the words of all texts in a row, and the number of each text's words."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACE[data]
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = turn[::2], turn[1::2]
    name = mixed(PrefixSums(VALUES[data]).of(start, stop) + (stop - start).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return name, np.diff(np.searchsorted(start, ends, "left"), prepend=0)


def recompress(name: np.ndarray, text: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """(name, start, left, right): the symbols after ``rounds``, where they start and the words [left, right) looked at.

    ``text`` numbers the text of each word; symbols never cross texts, and at a text's ends ``left`` or ``right`` lie
    outside it.
    """
    n = len(name)
    start = np.arange(n)
    left, right = start.copy(), start + 1
    edge = np.ones(n + 1, bool)  # a text starts before this symbol
    edge[1:-1] = text[1:] != text[:-1]
    for step in range(rounds):
        # runs
        first = np.ones(len(name), bool)
        first[1:] = (name[1:] != name[:-1]) | edge[1:-1]
        at = np.flatnonzero(first)
        stop = np.append(at[1:], len(name))
        length = (stop - at).astype(np.uint64)
        before, after = np.maximum(at - 1, 0), np.minimum(stop, len(name) - 1)
        new_left = np.where(edge[at], left[at] - 1, left[before])
        new_right = np.where(edge[stop], right[stop - 1] + 1, right[after])
        name = np.where(length == ONE, name[at], mixed(name[at] * MIX[2 * step] + length))
        start, edge = start[at], np.append(edge[at], True)
        left, right = np.minimum(left[at], new_left), np.maximum(right[stop - 1], new_right)
        # pairs
        is_left = mixed(name + MIX[100 + step]) & ONE == ONE
        joined = np.zeros(len(name), bool)  # with the next one
        joined[:-1] = is_left[:-1] & ~is_left[1:] & ~edge[1:-1]
        gone = np.zeros(len(name), bool)
        gone[1:] = joined[:-1]
        last = np.arange(len(name)) + joined
        before, after = np.maximum(np.arange(len(name)) - 1, 0), np.minimum(np.arange(len(name)) + 1, len(name) - 1)
        ends = edge[1:]
        alone = ~joined & ~gone
        look_left = np.where(alone & ~is_left, np.where(edge[:-1], left - 1, left[before]), left)
        look_right = np.where(alone & is_left, np.where(ends, right + 1, right[after]), right[last])
        pair = mixed(name * MIX[2 * step + 1] + name[last] * MIX[200 + step])
        keep = ~gone
        name, start = np.where(joined, pair, name)[keep], start[keep]
        left, right = np.minimum(left, look_left)[keep], np.maximum(right, look_right)[keep]
        edge = np.append(edge[:-1][keep], True)
    return name, start, left, right


def alike_windows(words: np.ndarray, width: int) -> np.ndarray:
    """Whether the window of ``width`` words at each place equals the one before it, so that all its words are one word."""
    same = np.zeros(len(words) + 1, np.int64)
    same[2:] = np.cumsum(words[1:] == words[:-1])
    n = len(words) - width + 1
    out = np.zeros(n, bool)
    out[1:] = same[width + 1 : width + n] - same[1:n] == width
    return out


class Words(Units):
    """Word texts: anchors are symbols after some rounds of recompression."""

    kind = np.uint64

    def __init__(self, width: int, rounds: int):
        self.width, self.rounds = width, rounds

    def values(self, text: bytes) -> np.ndarray:
        return named([text])[0]

    def anchors(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        width, rounds = self.width, self.rounds
        words, sizes = named(texts)
        long = np.repeat(sizes >= width, sizes)
        words, sizes = words[long], np.where(sizes >= width, sizes, 0)
        total = len(words)
        if not total:
            return tuple(np.empty(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
        text = np.repeat(np.arange(len(sizes)), sizes)
        sums = PrefixSums(words)
        name, start, left, right = recompress(words, text, rounds)
        n = total - width + 1
        p = np.arange(n)
        # symbols' stretches are in order at both ends: count those that begin before p, and those that end by p + width
        lo = np.cumsum(np.bincount(np.maximum(left + 1, 0), minlength=total + 2)[: n])
        hi = np.cumsum(np.bincount(right, minlength=total + 2))[width : width + n]
        has = hi > lo
        # the smallest name of [lo, hi), leftmost on ties
        table = [(name & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(name), dtype=np.uint64)]
        while 2 << (len(table) - 1) <= width:
            t, s = table[-1], 1 << (len(table) - 1)
            table.append(np.append(np.minimum(t[:-s], t[s:]), t[max(len(t) - s, 0) :]) if len(t) > s else t)
        owner = np.full(n, -1, np.int64)
        count = hi - lo
        level = np.zeros(n, np.int64)
        level[has] = np.frexp(count[has])[1] - 1
        for k, t in enumerate(table):
            here = np.flatnonzero(has & (level == k))
            if len(here):
                best = np.minimum(t[lo[here]], t[hi[here] - (1 << k)])
                owner[here] = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        valid = np.zeros(n, bool)
        valid[:] = text[:n] == text[width - 1 :]
        new = np.ones(n, bool)
        new[1:] = (owner[1:] != owner[:-1]) | (owner[1:] < 0) | ~valid[:-1]
        # equal windows inside one long run: the first stands alone, the others follow as one row
        steady = np.zeros(n, bool)
        steady[1:] = alike_windows(words, width)[1:n] & valid[1:] & valid[:-1] & (owner[1:] < 0) & (owner[:-1] < 0)
        new[2:] &= ~(steady[2:] & steady[1:-1])
        new &= valid
        first = np.flatnonzero(new)
        stop = np.append(first[1:], n)
        # a stretch of windows ends with its text
        stop = np.minimum(stop, (starts + sizes)[text[first]] - width + 1)
        owned = stop - first
        who = owner[first]
        own = who < 0
        a, b = np.where(own, first, left[who]), np.where(own, first + width, right[who])
        place = np.where(own, 0, start[who] - a).astype(np.uint64)
        c = mixed(sums.of(a, b) ^ (place << np.uint64(8)) ^ (b - a).astype(np.uint64))
        u = mixed(sums.of(first, stop - 1 + width) ^ (owned.astype(np.uint64) << np.uint64(32)) ^ (a - first + 1024).astype(np.uint64))
        return text[first], c, u, first - starts[text[first]], owned, a - first, steady[first]


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(key, ord, spans of words to remove) of the rows that have any; key and ord as in :func:`repeats.text_rows`."""
    return repeated_spans(text_rows(docs, id_col, text_col), Words(width, rounds))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the remaining words joined by one space)."""
    key, order = text_keys(docs, id_col, text_col)
    spans = repeated_words(docs, id_col, text_col, **options).select(F.col("key").alias("__key"), F.col("ord").alias("__ord"), F.col("spans").alias("__spans"))
    rows = docs.select(id_col, text_col).join(spans, (key == spans["__key"]) & (order == spans["__ord"]), "left").select(F.col(id_col), F.col(text_col).cast("binary"), "__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n, removed, kept = [], [], []
            for t, s in zip(texts, lists, strict=True):
                words = (t or b"").split()
                runs = union_length((x["start"], x["stop"]) for x in s or ())
                n.append(len(words))
                removed.append(sum(b - a for a, b in runs))
                for a, b in reversed(runs):
                    del words[a:b]
                kept.append(b" ".join(words))
            cols = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=out.names)

    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return rows.mapInArrow(lean(run), out)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH every AS (SELECT doc_id, dense_rank() OVER (ORDER BY doc_id, text) AS r, coalesce(text, '') AS text FROM documents), -- repeated rows are one document
d AS (SELECT DISTINCT doc_id, r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM every),
w AS (SELECT doc_id, r, i, md5(array_to_string(ws[i : i + 19], ' ')) AS s FROM (SELECT doc_id, r, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM d)),
later AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 20)) AS p FROM later)),
g AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS k FROM (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT every.doc_id, len(ws)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM every JOIN d USING (r) LEFT JOIN g USING (r) LEFT JOIN kept USING (r)
"""
