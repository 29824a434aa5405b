"""SentencePiece encoding and decoding as weighted finite-state transduction.

The model file is compiled into machines whose weights are of the tropical semiring (they add along a path, the least wins):

* :class:`Normaliser` reads characters and writes a leading space (where the model asks for it) and the visible space ``▁`` for
  each space; where the model squeezes spaces, states remember whether the text has begun and whether a gap is open;
* :class:`Pieces` is a trie: an arc a character, and from each node at which a piece ends an arc back to the root that writes the
  piece's id. Characters that are no piece have byte arcs at the root, which write the ids of their UTF-8 bytes. For a unigram
  model an arc that writes weighs minus the piece's log probability (byte arcs more than any piece), for merging models nothing;
* :class:`History` reads ids, its states are the last piece. For merging models an arc weighs nothing if merging the joined text
  of both pieces leaves them as they are, and is infinite otherwise. A sequence of pieces is the result of byte-pair merging
  exactly if all its neighbours pass: a first merge across a border would also happen in the two neighbours alone. For unigram
  models it has one state and lets everything pass.

A text is composed with all three, and :func:`shortest_path` finds the tropical shortest path of the composition, which is made
lazily: arcs of the trie when a place is reached, weights of the history when an arc is up. Of equal weights the path that has
read most is continued. For merging models each prefix has one sequence of finite weight, so a place is a state of the composition
whatever the history is, as it is for unigram models.

No piece crosses from a non-space into ``▁``, nor from a Latin letter into what is none (both checked when compiling), so paths of
such segments can be found apart, and equal segments are solved once per task (twice ``CACHE`` of them are kept).

Null texts encode to null; empty texts to an empty list; very long texts go segment by segment; repeated rows are encoded
each on their own; an empty table gives an empty result; ``encode`` keeps all other columns, and replaces those of its own names.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush, heappushpop

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import lean, read

MODEL = os.environ.get("TRACTWORKS_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SPACE = "▁"
CACHE = 250_000
#: What a byte arc of a unigram model costs beyond the dearest piece.
BYTE_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
INFINITE = float("inf")
#: Latin letters, as a character class.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a serialised protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, raw[at : at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack_from("<f", raw, at)[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, struct.unpack_from("<d", raw, at)[0]
            at += 8
        else:
            raise ValueError("not a SentencePiece model")


class Normaliser:
    """Characters to normalised characters. Arcs: state -> {character (None: any other): (output, weight, next state)}; a None output is the input."""

    def __init__(self, prefix: bool, squeeze: bool):
        lead = SPACE if prefix else ""
        if squeeze:
            self.arcs = {
                "begin": {" ": ("", 0.0, "begin"), None: (lead, 0.0, "copy")},
                "copy": {" ": ("", 0.0, "gap"), None: (None, 0.0, "copy")},
                "gap": {" ": ("", 0.0, "gap"), None: (SPACE, 0.0, "copy")},
            }
        else:
            self.arcs = {"begin": {" ": (lead + SPACE, 0.0, "copy"), None: (lead, 0.0, "copy")}, "copy": {" ": (SPACE, 0.0, "copy"), None: (None, 0.0, "copy")}}
        loop = self.arcs["copy"]
        #: the arcs of a state that only leads to itself
        self.table = [(c, out) for c, (out, _, _) in loop.items() if c is not None] if all(to == "copy" for _, _, to in loop.values()) else None

    def transduce(self, text: str) -> str:
        """The output of the only path that reads ``text``."""
        state, out = "begin", []
        for at, c in enumerate(text):
            if state == "copy" and self.table is not None:
                rest = text[at:]
                for read, written in self.table:
                    rest = rest.replace(read, written)
                out.append(rest)
                break
            arcs = self.arcs[state]
            written, _, to = arcs.get(c) or arcs[None]
            out.append(c if written is None else written)
            if written is not None and c not in arcs:  # what it writes stands before the character
                out.append(c)
            state = to
        return "".join(out)


class Pieces:
    """Characters to ids. A node is (arcs by character, id written on the way back to the root or -1, its weight)."""

    def __init__(self, id_of: dict[str, int], weights: dict[str, float], byte_ids: dict[int, int], unknown: int, byte_weight: float):
        self.root: tuple[dict, int, float] = ({}, -1, 0.0)
        self.byte_ids, self.unknown, self.byte_weight, self.first_other = byte_ids, unknown, byte_weight, max(id_of.values(), default=0) + 1
        self.weighted = byte_weight > 0 or any(weights.values())
        for piece in sorted(id_of, key=len):
            arcs = self.root[0]
            for c in piece[:-1]:
                arcs = arcs.setdefault(c, ({}, -1, 0.0))[0]
            arcs[piece[-1]] = (arcs.get(piece[-1], ({},))[0], id_of[piece], weights[piece])

    def arcs(self, text: str, at: int) -> list[tuple[int, int, float]]:
        """(end, symbol, weight) of the ways from the root back to the root that begin at a place, the one to take first at the end.

        That is the lightest, the longest of equal ones. A byte arc's symbol stands for its character.
        """
        node = self.root[0].get(text[at])
        end = at + 1
        if node is None:
            return [(end, self.first_other + ord(text[at]), self.byte_weight)]
        arcs, symbol, weight = node
        out = [(end, symbol, weight) if symbol >= 0 else (end, self.first_other + ord(text[at]), self.byte_weight)]
        for c in text[end:]:
            node = arcs.get(c)
            if node is None:
                break
            end += 1
            arcs, symbol, weight = node
            if symbol >= 0:
                out.append((end, symbol, weight))
        if self.weighted:
            out.sort(key=lambda arc: (-arc[2], arc[0]))
        return out

    def written(self, symbol: int) -> list[int]:
        """The ids that an arc writes: a piece's own, or those of a character's bytes."""
        if symbol < self.first_other:
            return [symbol]
        return [self.byte_ids[b] for b in chr(symbol - self.first_other).encode("utf-8", "replace")] if self.byte_ids else [self.unknown]


class History:
    """Ids to ids. Arcs weigh 0 or, for merging models, are infinite where merging would not leave two neighbours as they are."""

    def __init__(self, id_of: dict[str, int], scores: list[float], names: list[str], first_other: int, merging: bool):
        self.id_of, self.scores, self.names, self.first_other, self.merging = id_of, scores, names, first_other, merging
        self.known: dict[tuple[int, int], float] = {}
        self.edges: dict[str, tuple[list, list] | None] = {}

    def name(self, symbol: int) -> str:
        return "" if symbol < 0 else self.names[symbol] if symbol < self.first_other else chr(symbol - self.first_other)

    def weight(self, before: int, after: int) -> float:
        """Of the arc from the state ``before`` (-1: the start) that reads ``after``."""
        found = self.known.get((before, after))
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[before, after] = 0.0 if not self.merging or self.accepts(self.name(before), self.name(after)) else INFINITE
        return found

    def merged(self, text: str) -> list[str]:
        """What merging by score, leftmost first, makes of a short text."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                k = self.id_of.get(parts[i] + parts[i + 1])
                if k is not None and self.scores[k] > best:
                    best, at = self.scores[k], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge_symbols(self, piece: str) -> tuple[list, list] | None:
        """The symbols at a piece's left and right edge while it is merged, each (symbol, from, until).

        Times are costs (minus scores), never falling: a merge made possible by a dearer one happens right after it. None
        if merging makes something else of the piece.
        """
        if piece in self.edges:
            return self.edges[piece]
        parts, now = list(piece), -INFINITE
        left, right = [[parts[0], now, INFINITE]], [[parts[-1], now, INFINITE]]
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                k = self.id_of.get(parts[i] + parts[i + 1])
                if k is not None and self.scores[k] > best:
                    best, at = self.scores[k], i
            if at < 0:
                break
            now = max(now, -best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left[-1][2] = now
                left.append([parts[0], now, INFINITE])
            if at == len(parts) - 1:
                right[-1][2] = now
                right.append([parts[-1], now, INFINITE])
        found = self.edges[piece] = (left, right) if len(parts) == 1 else None
        return found

    def accepts(self, before: str, after: str) -> bool:
        """Whether ``after`` may follow ``before``.

        It may not if, while both are merged, a symbol at the one's right edge and one at the other's left edge stand next
        to each other when their own merge is due. Where two merges are due at once the joined text decides.
        """
        theirs = self.edge_symbols(after)
        if theirs is None or not before:
            return theirs is not None
        ours = self.edge_symbols(before)
        if ours is None:
            return False
        a, b, i, j = ours[1], theirs[0], 0, 0
        while i < len(a) and j < len(b):
            x, x_from, x_until = a[i]
            y, y_from, y_until = b[j]
            until = min(x_until, y_until)
            k = self.id_of.get(x + y)
            if k is not None:
                due = max(-self.scores[k], x_from, y_from)
                if due < until:
                    return False
                if due == until:
                    return self.merged(before + after) == [before, after]
            if x_until == y_until and until < INFINITE:
                return self.merged(before + after) == [before, after]
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        return True


def shortest_path(text: str, pieces: Pieces, history: History) -> list[int]:
    """The ids on the tropical shortest path of a normalised text composed with both machines.

    The queue holds for each place reached its next arc: (weight with it, minus where it ends, history, symbol, way so far, weight
    so far, further arcs). An arc's history weight is looked up when it is up. A place is settled by the first arc that reaches it
    at finite weight.
    """
    n = len(text)
    if not n:
        return []
    arcs = pieces.arcs(text, 0)
    end, symbol, cost = arcs.pop()
    item: tuple = (cost, -end, -1, symbol, None, 0.0, arcs)
    queue: list[tuple] = []
    settled = {0}
    known = history.known.get
    while True:
        weight, place, before, symbol, so_far, base, arcs = item
        at = -place
        if at not in settled:
            more = known((before, symbol))
            if more is None:
                more = history.weight(before, symbol)
            if not more:  # else it is infinite
                way = (symbol, so_far)
                if at == n:
                    break
                settled.add(at)
                if arcs:
                    end, symbol_then, cost = arcs.pop()
                    heappush(queue, (base + cost, -end, before, symbol_then, so_far, base, arcs))
                arcs = pieces.arcs(text, at)
                end, symbol_then, cost = arcs.pop()
                item = heappushpop(queue, (weight + cost, -end, symbol, symbol_then, way, weight, arcs))
                continue
        if arcs:
            end, symbol, cost = arcs.pop()
            item = heappushpop(queue, (base + cost, -end, before, symbol, so_far, base, arcs))
        else:
            item = heappop(queue)
    symbols: list[int] = []
    while way is not None:
        symbols.append(way[0])
        way = way[1]
    ids: list[int] = []
    for symbol in reversed(symbols):
        if symbol < pieces.first_other:
            ids.append(symbol)
        else:
            found = pieces.written(symbol)
            ids += found if pieces.byte_ids or ids[-1:] != found else []  # neighbouring unknown characters are one
    return ids


class PieceTransducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.bpe, self.prefix, squeeze = False, True, True
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(piece.get(2, 0.0))
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
            elif field == 3:
                rule = dict(_fields(value))
                if rule.get(2):
                    raise ValueError("normalisation tables other than identity are not supported")
                self.prefix, squeeze = bool(rule.get(3, 1)), bool(rule.get(4, 1))
        if any(k in (USER_DEFINED, UNUSED) for k in self.kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        weights = {p: 0.0 if self.bpe else -self.scores[i] for p, i in self.id_of.items()}
        byte_weight = 0.0 if self.bpe else max(weights.values(), default=0.0) + BYTE_PENALTY
        if min(weights.values(), default=0.0) < 0:
            raise ValueError("scores of a unigram model are log probabilities")
        self.normaliser = Normaliser(self.prefix, squeeze)
        self.machine = Pieces(self.id_of, weights, self.byte_id, self.kinds.index(UNKNOWN), byte_weight)
        self.history = History(self.id_of, self.scores, self.pieces, self.machine.first_other, self.bpe)
        inside = re.compile(f"[^{SPACE}]{SPACE}")
        word_ends = re.compile(f"[{LETTERS}][^{LETTERS}]")
        if any(map(inside.search, self.id_of)):
            self.cut = None
        elif any(map(word_ends.search, self.id_of)):
            self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.cut = re.compile(f"{SPACE}*[^{SPACE}{LETTERS}]*[{LETTERS}]+|{SPACE}*[^{SPACE}{LETTERS}]+|{SPACE}+")
        if not self.byte_id:
            self.cut = None  # unknown characters join across segments
        self.solved: dict[str, bytes] = {}
        self.solved_before: dict[str, bytes] = {}
        #: what each id writes; the output side of the machines
        self.written = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() if k == NORMAL else " ⁇ ".encode() if k == UNKNOWN else b"" for p, k in zip(self.pieces, self.kinds, strict=True)]

    def segment(self, text: str) -> bytes:
        """The ids of a normalised segment as 32-bit numbers."""
        found = self.solved_before.get(text)
        if found is None:
            found = np.array(shortest_path(text, self.machine, self.history), np.int32).tobytes()
        if len(text) <= 64:
            if len(self.solved) >= CACHE:  # what is met again comes over from the full cache
                self.solved, self.solved_before = {}, self.solved
            self.solved[text] = found
        return found

    def encoded(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        text = self.normaliser.transduce(text)
        parts = [text] if self.cut is None else self.cut.findall(text)
        found = list(map(self.solved.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.solved.get(parts[i]) or self.segment(parts[i])
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def forget(self) -> None:
        """Drops solved segments and neighbours: a worker lives on after its task, for other stages."""
        self.solved.clear()
        self.solved_before.clear()
        self.history.known.clear()
        self.history.edges.clear()

    def text_of(self, ids: list[int]) -> str:
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    decode = text_of

    def texts_of(self, lists: pa.ListArray) -> pa.Array:
        """:meth:`text_of` of many lists at once: all that ids write, joined; lists that write broken UTF-8 one by one."""
        words = pa.array(self.written, pa.binary()).take(lists.flatten())
        offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), b"")
        try:
            texts = joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if ids is None else self.text_of(ids) for ids in lists.to_pylist()], pa.string())
        if self.prefix:
            texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
        return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))


_COMPILED: dict[str, PieceTransducer] = {}


def compiled(model_path: str) -> PieceTransducer:
    """The machines of a model file that every node has, compiled once per worker."""
    if model_path not in _COMPILED:
        with open(model_path, "rb") as f:
            _COMPILED[model_path] = PieceTransducer(f.read())
    return _COMPILED[model_path]


ADDED = (("n_pieces", T.LongType(), pa.int64()), ("n_byte_pieces", T.LongType(), pa.int64()), ("piece_ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("decoded", T.StringType(), pa.string()), ("round_trip", T.BooleanType(), pa.bool_()))


def encode(docs: DataFrame, text_col: str = "text", model_path: str = MODEL, with_decoded: bool = True) -> DataFrame:
    """``docs`` with n_pieces, n_byte_pieces, piece_ids, decoded and round_trip (decoded equals the text).

    ``with_decoded=False`` leaves the decoded text itself out; the round trip is judged all the same.
    """
    added = [a for a in ADDED if with_decoded or a[0] != "decoded"]
    docs = docs.drop(*(a[0] for a in added))
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model_path)
        is_byte = np.zeros(len(machine.pieces), bool)
        is_byte[list(machine.byte_id.values())] = True
        gc.disable()  # millions of small tuples, none of them in a cycle
        for batch in batches:
            texts = batch.column(at)
            parts = [b"" if t is None else machine.encoded(t) for t in texts.to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            ids = np.frombuffer(b"".join(parts), np.int32)
            null = texts.is_null()
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids), mask=null)
            none = null.to_numpy(zero_copy_only=False)
            n_bytes = np.diff(np.concatenate([[0], np.cumsum(is_byte[ids])])[ends])
            decoded = machine.texts_of(lists)
            values = {"n_pieces": pa.array(np.diff(ends).astype(np.int64), mask=none), "n_byte_pieces": pa.array(n_bytes.astype(np.int64), mask=none), "piece_ids": lists, "decoded": decoded, "round_trip": pc.equal(decoded, texts)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(values[a].cast(kind) for a, _, kind in added)], names=[*names, *(a[0] for a in added)])
        machine.forget()
        gc.enable()

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *(T.StructField(a, kind) for a, kind, _ in added)]))


def decode(rows: DataFrame, ids_col: str = "piece_ids", to: str = "decoded", model_path: str = MODEL) -> DataFrame:
    """``rows`` with the text of ``ids_col`` in ``to``; null stays null."""
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, machine.texts_of(batch.column(at))], names=[*batch.schema.names, to])

    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())]))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, piece_ids, decoded_sha256, round_trip of every whole text."""
    rows = encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_pieces", "n_byte_pieces", "piece_ids", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip")
