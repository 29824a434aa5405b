"""Byte-level BPE encoding and decoding by tree concatenation.

A text of more than ``leaf_chars`` characters is halved until its parts are no longer than that. The parts are rows of their own,
encoded in parallel as if each were a whole text, and joined in pairs on the way up. At a join only a window around the cut is
encoded again; it grows until both sides agree with it:

* a window begins at a piece of the left part that no text behind the cut can change, so what it splits off is right from there on;
* it ends right as soon as it has the end of a piece in common with the right part, as splitting goes forward without memory;
* a piece that runs over the cut and is made of one piece of each side is joined in the same way by its tokens: the tokens around the
  cut are merged anew, ever more of them, until the outermost ones come out as they were. Merges have no memory beyond neighbours:
  a sequence is what merging makes of its bytes exactly if each two neighbours in it are.

Where splitting or merging is not settled by any window, the window ends up as all that there is; so results are exact always.
"""

from __future__ import annotations

import heapq
import json
import os
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import lean, read, row_keys

#: A tokenizer file that every node has.
TOKENIZER = os.environ.get("TRACTWORKS_BPE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: Characters of a text that are encoded in one go.
LEAF_CHARS = 16384
#: Parts that one task joins at a time, a power of two: a tree of 16**k parts takes k shuffles.
FAN = 16
#: Pieces of up to this many characters are remembered, so many of them at a time.
SHORT, REMEMBERED = 64, 300_000
#: Bits of an id, and what no rank reaches.
BITS, NONE = 24, 1 << 60

# The pattern of byte-level pre-tokenizers that split by it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as itself, the rest from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class Merges(dict):
    """piece -> its tokens as int32 bytes, each token twice its id, plus one where a piece starts."""

    def __init__(self, raw: bytes, special: bool):
        super().__init__()
        spec = json.loads(raw)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        self.written = [b""] * (1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in model["vocab"].items():
            self.written[i] = bytes(letters[c] for c in token)
        self.of_byte = [model["vocab"][c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        vocab = model["vocab"]
        # a pair of ids -> its rank and the id of both together, in one number
        self.pairs = {vocab[a] << BITS | vocab[b]: rank << BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.letters = np.array(self.of_byte, np.int64)
        self.special: dict[str, bytes] = {}
        for t in spec["added_tokens"]:
            self.written[t["id"]] = t["content"].encode()
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens with conditions")
            if special:
                self.special[t["content"]] = np.array([2 * t["id"] + 1], np.int32).tobytes()
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.split = regex.compile(PATTERN).findall
        #: Characters before a cut that text behind it may still regroup: a special token's, or an abbreviation's and a space.
        self.margin = max([3, *map(len, self.special)]) + 1
        self.tokens = pa.array(self.written, pa.binary())

    def __missing__(self, piece: str) -> bytes:
        ids = self.merged(list(map(self.of_byte.__getitem__, piece.encode())))
        out = array("i", [2 * ids[0] + 1, *(2 * i for i in ids[1:])]).tobytes()
        if len(piece) <= SHORT:
            self[piece] = out
        return out

    def merged(self, ids: list[int]) -> list[int]:
        """Neighbours merged by rank, the leftmost of equal ranks first, until no pair has a rank."""
        return self._few(ids) if len(ids) <= SHORT else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        get = self.pairs.get
        ranks = [get(a << BITS | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            i = ranks.index(best)
            ids[i] = new = best & (1 << BITS) - 1
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << BITS | new, NONE)
            if i < len(ranks):
                ranks[i] = get(new << BITS | ids[i + 1], NONE)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.pairs.get
        heap = [(rank, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := get(a << BITS | b, NONE)) != NONE]
        heapq.heapify(heap)
        after, before, ids = list(range(1, n + 1)), list(range(-1, n - 1)), list(ids)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank & (1 << BITS) - 1, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (rank := get(ids[x] << BITS | ids[y], NONE)) != NONE:
                    heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def pieces(self, text: str) -> list[str]:
        if self.cut is None:
            return self.split(text)
        parts = self.cut.split(text)
        if len(parts) == 1:
            return self.split(text)
        return [p for k, part in enumerate(parts) for p in ([part] if k % 2 else self.split(part))]

    def of_piece(self, piece: str) -> bytes:
        return self.special.get(piece) or self[piece]

    def encoded(self, text: str) -> bytes:
        """The tokens of a text that is encoded in one go."""
        return b"".join(map(self.of_piece, self.pieces(text)))

    def all_encoded(self, texts: list[str]) -> list[bytes]:
        """:meth:`encoded` of many texts; pieces not seen before are merged together."""
        if self.cut is not None and any(map(self.cut.search, texts)):
            split, of = list(map(self.pieces, texts)), self.of_piece
        else:
            split, of = list(map(self.split, texts)), self.__getitem__
        self.learn(set(chain.from_iterable(split)).difference(self))
        out = [b"".join(map(of, pieces)) for pieces in split]
        if len(self) > REMEMBERED:
            self.clear()
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Remembers the tokens of short pieces, merged a step at a time in all pieces of about one length."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            if len(raw) <= SHORT:
                by_size.setdefault(-(-len(raw) // 4), []).append((piece, raw))
        for size, group in by_size.items():
            for lo in range(0, len(group), 8192):
                part = group[lo : lo + 8192]
                ids = np.full((len(part), 4 * size + 1), -1, np.int64)
                lengths = np.array([len(raw) for _, raw in part])
                ids[np.arange(4 * size + 1) < lengths[:, None]] = self.letters[np.frombuffer(b"".join(raw for _, raw in part), np.uint8)]
                ids = self.merged_rows(ids)
                n = (ids >= 0).sum(1)
                ids *= 2
                ids[:, 0] += 1
                raw, ends = ids[ids >= 0].astype(np.int32).tobytes(), (np.cumsum(n) * 4).tolist()
                self.update({piece: raw[i:j] for (piece, _), i, j in zip(part, [0, *ends], ends)})

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What merging pairs of ids ranks and gives, ``NONE`` for pairs that do not merge or have no second id."""
        key = a << BITS | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.values[at], NONE)

    def merged_rows(self, ids: np.ndarray) -> np.ndarray:
        """:meth:`merged` of each row of a matrix that ends with -1."""
        out, rows, places = ids.copy(), np.arange(len(ids)), np.arange(ids.shape[1])
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(1)
            best = rank[np.arange(len(rank)), at]
            go = best != NONE
            if not go.all():
                out[rows[~go]] = ids[~go]
                rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
            if not len(rows):
                return out
            line = np.arange(len(rows))
            ids[line, at] = best & (1 << BITS) - 1
            # what stands behind the merged pair moves up
            ids = np.take_along_axis(ids, np.minimum(places + (places > at[:, None]), places[-1]), 1)
            rank = np.take_along_axis(rank, np.minimum(places[:-1] + (places[:-1] > at[:, None]), places[-2]), 1)
            ids[:, -1], rank[:, -1] = -1, NONE
            rank[line, at] = self.ranks(ids[line, at], ids[line, at + 1])
            before = np.maximum(at - 1, 0)
            rank[line, before] = self.ranks(ids[line, before], ids[line, before + 1])

    def bytes_of(self, marked: np.ndarray) -> bytes:
        return b"".join(map(self.written.__getitem__, (marked >> 1).tolist()))

    def of_both(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The tokens of one piece, given those of its halves."""
        a, b, w = (left >> 1).tolist(), (right >> 1).tolist(), 4
        while True:
            x, y = a[-w:], b[:w]
            new = self.merged([self.of_byte[c] for i in (*x, *y) for c in self.written[i]])
            if (w >= len(a) or new[0] == x[0]) and (w >= len(b) or new[-1] == y[-1]):
                break
            w *= 2
        ids = np.array([*a[: len(a) - len(x)], *new, *b[len(y) :]], np.int32) * 2
        ids[0] += 1
        return ids

    def joined(self, left: bytes, right: bytes) -> bytes:
        """The tokens of a text, given those of its two parts, each encoded as a whole text."""
        a, b = np.frombuffer(left, np.int32), np.frombuffer(right, np.int32)
        if not len(a) or not len(b):
            return left + right
        starts_a, starts_b = np.flatnonzero(a & 1), np.append(np.flatnonzero(b & 1), len(b))
        w = 8
        while True:
            na, nb = max(len(starts_a) - w, 0), min(w, len(starts_b) - 1)
            head, tail = a[starts_a[na] :], b[: starts_b[nb]]
            before, behind = self.bytes_of(head).decode(), self.bytes_of(tail).decode()
            if na and len(before) < self.margin:
                w *= 2
                continue
            whole = nb == len(starts_b) - 1
            out, at, cut = [], 0, len(before)
            # where pieces of the right part end: characters -> tokens
            ends, place, k = {cut: 0}, cut, 0
            for s in np.split(tail, starts_b[1:nb]):
                k += len(s)
                place += len(self.bytes_of(s).decode())
                ends[place] = k
            own = a[starts_a[-1] :]  # the left part's last piece
            last = cut - len(self.bytes_of(own).decode())
            agreed = None
            for piece in self.pieces(before + behind):
                stop = at + len(piece)
                if at == last < cut < stop and stop in ends and piece not in self.special and len(piece) > SHORT:
                    out.append(self.of_both(own, tail[: ends[stop]]).tobytes() if self._one(tail, ends[stop]) else self.of_piece(piece))
                else:
                    out.append(self.of_piece(piece))
                at = stop
                if at >= cut and at in ends and (whole or at <= len(before) + len(behind) - self.margin):
                    agreed = ends[at]
                    break
            if agreed is not None:
                return a[: starts_a[na]].tobytes() + b"".join(out) + b[agreed:].tobytes()
            w *= 2

    @staticmethod
    def _one(tail: np.ndarray, n: int) -> bool:
        """Whether the first ``n`` tokens are of one piece."""
        return not (tail[1:n] & 1).any()

    def texts_of(self, lists: pa.ListArray) -> pa.Array:
        """What lists of ids write, broken UTF-8 replaced; null stays null."""
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        words = self.tokens.take(lists.flatten().cast(pa.int32()))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), words), b"")
        try:
            texts = joined.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
        return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))


_LOADED: dict[tuple[str, bool], Merges] = {}


def loaded(path: str, special: bool = True) -> Merges:
    """The tokenizer of a file that every node has, read once per worker."""
    if (path, special) not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path, special] = Merges(f.read(), special)
    return _LOADED[path, special]


def id_lists(parts: list[bytes]) -> pa.ListArray:
    """Lists of ids from tokens as :class:`Merges` writes them."""
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32) >> 1))


def _whole(docs: DataFrame, text_col: str, path: str, special: bool) -> DataFrame:
    """``docs`` with token_ids, each text in one go."""
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = loaded(path, special)
        for batch in batches:
            parts = merges.all_encoded([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, id_lists(parts)], names=[*names, "token_ids"])

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType()))]))


def depth_of(n: int, leaf_chars: int) -> int:
    """How often ``n`` characters are halved."""
    return max(-(-n // leaf_chars) - 1, 0).bit_length()


def _leaves(texts: DataFrame, leaf_chars: int) -> DataFrame:
    """(key, tag, depth, node, part): texts halved into 2**depth parts of up to ``leaf_chars`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, tag, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(text)
                depth = depth_of(n, leaf_chars)
                for lo in range(0, 1 << depth, 64):
                    nodes = range(lo, min(lo + 64, 1 << depth))
                    parts = [text[n * k >> depth : n * (k + 1) >> depth] for k in nodes]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(parts), pa.int64()), pa.array([tag] * len(parts), pa.int32()), pa.array([depth] * len(parts), pa.int32()), pa.array(nodes, pa.int64()), pa.array(parts, pa.string())], names=["key", "tag", "depth", "node", "part"])

    return texts.select("key", "tag", "text").mapInArrow(lean(run), "key long, tag int, depth int, node long, part string")


def _tree(docs: DataFrame, text_col: str, path: str, special: bool, leaf_chars: int) -> DataFrame:
    """(key, tag, token_ids) of each different text of more than ``leaf_chars`` characters."""
    key, tag = docs["__key"], docs["__tag"]
    most = docs.agg(F.max(F.char_length(F.col(f"`{text_col}`")))).first()[0] or 0  # one number
    rounds = -(-max(depth_of(most, leaf_chars), 1) // (FAN.bit_length() - 1))
    parts = _leaves(docs.select(key.alias("key"), tag.alias("tag"), F.col(f"`{text_col}`").alias("text")), leaf_chars)
    # repeated rows become one here, and the parts of one text go to many tasks
    parts = parts.groupBy("key", "tag", "node").agg(F.first("depth").alias("depth"), F.first("part").alias("part"))

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = loaded(path, special)
        for batch in batches:
            coded = pa.array(merges.all_encoded(batch.column(4).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], coded], names=["key", "tag", "node", "depth", "coded"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = loaded(path, special)
        for batch in batches:
            joined = []
            for children in batch.column(3).to_pylist():
                nodes = [c["coded"] for c in children]
                while len(nodes) > 1:
                    nodes = [merges.joined(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
                joined.append(nodes[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(joined, pa.binary())], names=["key", "tag", "node", "coded"])

    nodes = parts.mapInArrow(lean(leaf), "key long, tag int, node long, depth int, coded binary").drop("depth")
    for _ in range(rounds):
        up = nodes.groupBy("key", "tag", F.expr(f"node div {FAN}").alias("parent")).agg(F.array_sort(F.collect_list(F.struct("node", "coded"))).alias("children"))
        nodes = up.mapInArrow(lean(join), "key long, tag int, node long, coded binary")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], id_lists(batch.column(2).to_pylist())], names=["__key", "__tag", "token_ids"])

    return nodes.select("key", "tag", "coded").mapInArrow(lean(ids), "__key long, __tag int, token_ids array<int>")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str = TOKENIZER, special: bool = True, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with token_ids, an array of the ids of each whole text; null and empty texts have none.

    Strings of special tokens are those tokens, or plain text with ``special=False``. Texts of more than ``leaf_chars`` characters
    are encoded by tree concatenation, with parts of one text in different tasks; a row is known by a hash of its id and text, so
    repeated rows are encoded once and all stay. A column token_ids of the input is replaced; no other name matters. Fails on
    tokenizer files that are no plain byte-level BPE (normalisers, prefix spaces, added tokens with conditions).
    """
    docs = docs.drop("token_ids")
    text = F.col(f"`{text_col}`")
    is_long = F.coalesce(F.char_length(text) > leaf_chars, F.lit(False))
    short = _whole(docs.where(~is_long), text_col, tokenizer_path, special)
    own = [f"__c{k}" for k in range(len(docs.columns))]  # no name of the input is used twice
    plain = docs.where(is_long).toDF(*own)
    key, tag = row_keys(plain, own[docs.columns.index(id_col)], own[docs.columns.index(text_col)])
    long = plain.withColumns({"__key": key, "__tag": tag})
    tree = _tree(long, own[docs.columns.index(text_col)], tokenizer_path, special, leaf_chars)
    back = long.join(tree, ["__key", "__tag"]).select(*own, "token_ids").toDF(*docs.columns, "token_ids")
    return short.unionByName(back)


def decode(rows: DataFrame, ids_col: str = "token_ids", to: str = "decoded", tokenizer_path: str = TOKENIZER) -> DataFrame:
    """``rows`` with the text that ``ids_col`` writes in ``to``: special tokens are written out, bytes that are no UTF-8 replaced; null stays null."""
    rows = rows.drop(to)
    at, names = rows.columns.index(ids_col), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = loaded(tokenizer_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, merges.texts_of(batch.column(at))], names=[*names, to])

    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())]))


def op11_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text (null: empty)."""
    rows = decode(encode(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "token_ids"))
    return rows.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
