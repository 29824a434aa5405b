"""Alignment of two tokenizers' tokens, by divide and conquer at shared cuts.

Both tokenizers write the same bytes, so a byte offset where tokens of both end cuts a text in two that can be aligned on their own. A
cut near the middle is located by bisecting one side's ends for the other's, and both halves are cut in the same way; an interval
without a cut is a group. All intervals of a batch of texts are cut at once, a level of the recursion at a time.

Tokens that end together are linked. As both end at one byte, the bytes of one are the last bytes of the other; so the pairs that can be
linked at all follow from the two vocabularies (:class:`Pairs`), and whatever counts pairs is bounded by these, not by the corpus.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm import tree_bpe
from tractworks.llm.common import lean, read, settle

#: A sentence-piece model that every node has.
MODEL = os.environ.get("TRACTWORKS_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Steps from the middle that all intervals take together; those that need more go on alone.
STEPS = 6


def piece_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each piece stands for: its text with the space mark as a space, or its byte; control pieces nothing."""
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else b"" if processor.is_control(i) or processor.is_unknown(i) else piece.replace("▁", " ").encode())
    return out


class Pairs:
    """The numbers of all pairs of ids of which one's bytes end with the other's: at most as many as both vocabularies have suffixes."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        of_a, of_b = defaultdict(list), defaultdict(list)
        for table, tokens in ((of_a, a), (of_b, b)):
            for i, t in enumerate(tokens):
                if t:
                    table[t].append(i)
        keys = {i << 32 | j for i, t in enumerate(a) for k in range(len(t)) for j in of_b.get(t[k:], ())}
        keys |= {i << 32 | j for j, t in enumerate(b) for k in range(1, len(t)) for i in of_a.get(t[k:], ())}
        self.keys = np.array(sorted(keys), np.int64)
        self.b = (self.keys & 0xFFFFFFFF).astype(np.int64)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a.astype(np.int64) << 32 | b).astype(np.int32)


class Both:
    """Both tokenizers and what their ids write."""

    def __init__(self, bpe_path: str, model_path: str):
        self.bpe = tree_bpe.loaded(bpe_path, False)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
        written = self.bpe.written, piece_bytes(self.pieces)
        self.bytes = [pa.array(w, pa.binary()) for w in written]
        self.sizes = [np.array([len(x) for x in w], np.int64) for w in written]
        self.pairs = Pairs(*written)
        # an id with what follows it: a comma or the other side in a group, a comma or the next group or nothing at the end
        n, m = (len(w) for w in written)
        self.shown = pa.array([f"{i}{s}" for i in range(n) for s in ",|"] + [f"{i}{s}" for i in range(m) for s in (",", ";", "")], pa.string())

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text with a space before it: byte-level ones and pieces (whose model adds the space itself)."""
        a = [np.frombuffer(x, np.int32) >> 1 for x in self.bpe.all_encoded([" " + t for t in texts])]
        return a, [np.array(x, np.int32) for x in self.pieces.encode(texts, out_type=int, num_threads=1)]

    def writes(self, side: int, ids: np.ndarray) -> bytes:
        taken = self.bytes[side].take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), taken), b"")[0].as_py()


_LOADED: dict[tuple[str, str], Both] = {}


def loaded(bpe_path: str, model_path: str) -> Both:
    if (bpe_path, model_path) not in _LOADED:
        _LOADED[bpe_path, model_path] = Both(bpe_path, model_path)
    return _LOADED[bpe_path, model_path]


def _alone(a: np.ndarray, b: np.ndarray, a0: int, a1: int) -> int:
    """The shared end nearest the middle of A's ends a0 .. a1 - 2, as its place in ``a``, or -1: ever wider stretches are looked at whole."""
    middle, w = (a0 + a1 - 1) // 2, 64
    while True:
        lo, hi = max(a0, middle - w), min(a1 - 1, middle + w)
        stretch = a[lo:hi]
        at = np.searchsorted(b, stretch)
        hits = lo + np.flatnonzero(b[np.minimum(at, len(b) - 1)] == stretch)
        if len(hits):
            return int(hits[np.abs(hits - middle).argmin()])
        if lo == a0 and hi == a1 - 1:
            return -1
        w *= 8


def cut_up(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of groups, in order, as counts of tokens of either side.

    ``a`` and ``b`` hold the byte ends of all tokens, ascending; interval k holds tokens a0[k] .. a1[k] - 1 and b0[k] .. b1[k] - 1, and its last
    tokens end together.
    """
    done_a, done_b = [], []
    while len(a0):
        # with one token on a side there is no cut
        leaf = (a1 - a0 < 2) | (b1 - b0 < 2)
        done_a.append(a1[leaf])
        done_b.append(b1[leaf])
        a0, a1, b0, b1 = a0[~leaf], a1[~leaf], b0[~leaf], b1[~leaf]
        cut = np.full(len(a0), -1)  # the place in a of a shared end before the last
        middle = np.minimum((a0 + a1 - 1) // 2, a1 - 2)
        open_, i = np.arange(len(a0)), middle
        for _ in range(STEPS):  # from the middle on
            j = np.searchsorted(b, a[i])
            same = b[j] == a[i]
            cut[open_[same]] = i[same]
            open_, i = open_[~same], np.searchsorted(a, b[j[~same]])
            inside = i < a1[open_] - 1
            cut[open_[~inside]] = -2
            open_, i = open_[inside], i[inside]
        far = [open_]
        open_ = np.flatnonzero(cut == -2)
        i = middle[open_] - 1
        open_, i = open_[i >= a0[open_]], i[i >= a0[open_]]
        for _ in range(STEPS):  # and back from it
            j = np.searchsorted(b, a[i], "right") - 1
            same = (j >= 0) & (b[j] == a[i])
            cut[open_[same]] = i[same]
            open_, j = open_[~same], j[~same]
            i = np.where(j < 0, -1, np.searchsorted(a, b[j], "right") - 1)
            inside = i >= a0[open_]
            open_, i = open_[inside], i[inside]
        for k in np.concatenate([*far, open_]):
            cut[k] = _alone(a, b, int(a0[k]), int(a1[k]))
        whole = cut < 0
        done_a.append(a1[whole])
        done_b.append(b1[whole])
        a0, a1, b0, b1, cut = a0[~whole], a1[~whole], b0[~whole], b1[~whole], cut[~whole]
        at = np.searchsorted(b, a[cut]) + 1
        a0, a1, b0, b1 = np.concatenate([a0, cut + 1]), np.concatenate([cut + 1, a1]), np.concatenate([b0, at]), np.concatenate([at, b1])
    ends_a, ends_b = np.concatenate(done_a or [[]]).astype(np.int64), np.concatenate(done_b or [[]]).astype(np.int64)
    return np.sort(ends_a), np.sort(ends_b)


def aligned(both: Both, texts: list[str | None]) -> dict[str, pa.Array]:
    """The columns of :func:`align` for a batch."""
    none = np.empty(0, np.int32)
    a, b = [none] * len(texts), [none] * len(texts)
    full = [k for k, t in enumerate(texts) if t]
    for k, x, y in zip(full, *both.ids([texts[k] for k in full]), strict=True):
        whole = (" " + texts[k]).encode()
        if both.writes(0, x) == whole and both.writes(1, y) == whole:
            a[k], b[k] = x, y
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    ids_a, ids_b = (np.concatenate([none, *side]) for side in (a, b))
    have = n_a > 0
    ends_a, ends_b = both.sizes[0][ids_a].cumsum(), both.sizes[1][ids_b].cumsum()
    group_a, group_b = cut_up(ends_a, ends_b, (stop_a - n_a)[have], stop_a[have], (stop_b - n_b)[have], stop_b[have])
    # groups of a text are those that end in it
    n_groups = np.diff(np.searchsorted(group_a, np.concatenate([[0], stop_a]), "right"))
    links = both.pairs.number(ids_a[group_a - 1], ids_b[group_b - 1])
    # A's tokens of a group stand behind B's of all groups before, B's behind A's of all groups up to theirs
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[group_a - 1] = 1
    last_b[group_b - 1] = 1
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    before_b, up_to_a = np.concatenate([[0], group_b]), np.concatenate([group_a, [0]])
    codes[np.arange(len(ids_a)) + before_b[np.cumsum(last_a) - last_a]] = 2 * ids_a.astype(np.int64) + last_a
    kind = last_b.copy()
    kind[stop_b[have] - 1] = 2
    codes[np.arange(len(ids_b)) + up_to_a[np.cumsum(last_b) - last_b]] = 2 * len(both.bytes[0]) + 3 * ids_b.astype(np.int64) + kind
    stops = np.concatenate([[0], stop_a + stop_b]).astype(np.int32)
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(stops), both.shown.take(pa.array(codes))), "")
    raw, ends = links.tobytes(), np.concatenate([[0], np.cumsum(n_groups)]) * 4
    return {
        "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups.astype(np.int64)), "n_links": pa.array(n_groups.astype(np.int64)),
        "groups": groups, "links": pa.array([raw[i:j] for i, j in zip(ends, ends[1:])], pa.binary()),
    }


ADDED = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "groups": T.StringType(), "links": T.BinaryType()}


def align(docs: DataFrame, text_col: str = "text", bpe_path: str = tree_bpe.TOKENIZER, model_path: str = MODEL) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups and links of each whole text.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of each group, A's and B's, in order. ``links`` are the numbers (:class:`Pairs`, 32 bits
    each) of the pairs that end together, one a group. A text that is null or empty, or that a tokenizer does not give back byte for
    byte, has no tokens: zeros, an empty string and no links. Columns of these names are replaced, no other name matters.
    """
    docs = docs.drop(*ADDED)
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = loaded(bpe_path, model_path)
        for batch in batches:
            new = aligned(both, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*names, *new])

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *(T.StructField(c, t) for c, t in ADDED.items())]))


def pair_counts(rows: DataFrame, bpe_path: str = tree_bpe.TOKENIZER, model_path: str = MODEL) -> DataFrame:
    """(pair, n): how often each pair is linked in all rows; summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(loaded(bpe_path, model_path).pairs.keys), np.int64)
        for batch in batches:
            raw = b"".join(x for x in batch.column(0).to_pylist() if x)
            total += np.bincount(np.frombuffer(raw, np.int32), minlength=len(total))
        used = np.flatnonzero(total)
        for k in range(0, len(used), 65536):
            part = used[k : k + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["pair", "n"])

    return rows.select("links").mapInArrow(lean(run), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def counted(rows: DataFrame, counts: DataFrame, bpe_path: str = tree_bpe.TOKENIZER, model_path: str = MODEL) -> DataFrame:
    """``rows`` with n_best (links whose pair is the most frequent one of its B id, ties included) and count_sum (of their pairs' counts).

    ``counts`` as :func:`pair_counts` gives them: no more rows than the vocabularies allow pairs, whatever the corpus; they come to
    the driver and go to all tasks as one array of that length.
    """
    pairs = loaded(bpe_path, model_path).pairs
    table = counts.select("pair", "n").toArrow()
    n = np.zeros(len(pairs.keys), np.int64)
    n[table["pair"].to_numpy()] = table["n"].to_numpy()
    most = np.zeros(int(pairs.b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, pairs.b, n)
    held = rows.sparkSession.sparkContext.broadcast((n, n == most[pairs.b]))
    rows = rows.drop("n_best", "count_sum")
    at, names = rows.columns.index("links"), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = held.value
        for batch in batches:
            lists = [np.frombuffer(x or b"", np.int32) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([int(best[x].sum()) for x in lists], pa.int64()), pa.array([int(n[x].sum()) for x in lists], pa.int64())], names=[*names, "n_best", "count_sum"])

    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    rows = align(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    written = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    kept = settle(rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", written.alias("groups_sha256"), "links"))
    out = counted(kept, pair_counts(kept))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
