"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Multipliers of the rolling sums below (odd 64-bit numbers from a fixed generator).
MIX = np.random.default_rng(20240229).integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the reliable checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``; a local one is chosen only where that is unset and Spark runs in one
    process. On a cluster without the setting this fails, as executors would write to disks that others cannot read.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    # shuffle files go when the copy is complete; nothing reads them again
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return df.checkpoint()
    finally:
        conf.set(name, before) if before is not None else conf.unset(name)


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % folds


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """(key, tag): 64 and 32 bits that tell rows of different id or text apart; rows of equal id and text are repeats.

    An integer id is its own key, so only rows of one id could share both; other ids are hashed. Rows without an id have a hash of the text.
    """
    whole = isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    own = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(F.lit("row"), F.col(id_col)))
    return F.coalesce(own, F.xxhash64(F.lit("none"), F.col(text_col))), F.hash(F.col(text_col), F.col(id_col))


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no frame has a column of that name in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of a batch that are worked on at a time, and bytes after which freed memory goes back to the system.
SLICE_BYTES, TRIM_BYTES = 4 << 20, 64 << 20


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes or one row."""
    if batch.num_rows < 2 or batch.nbytes <= most:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), most)
        yield from slices(batch.slice(half), most)


def released() -> None:
    """Gives freed memory back: a Python worker lives on after its task and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with batches cut to ``SLICE_BYTES`` and memory given back during and after the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            for part in slices(batch):
                held += part.nbytes
                yield part
                if held > TRIM_BYTES:
                    released()
                    held = 0

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(cut(batches))
        finally:
            released()

    return over


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


class PrefixSums:
    """Polynomial hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(_BASE, len(values)), out=self.sums[1:])
        self.back = powers(_BACK, len(values) + 1)

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start])


def in_blocks(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Keys, orders (or tags) and texts of Arrow batches of three columns, about ``most_bytes`` of text at a time."""
    keys, ords, texts, held = [], [], [], 0
    for batch in batches:
        for key, order, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys.append(key)
            ords.append(order)
            texts.append(text or b"")
            held += len(texts[-1])
            if held >= most_bytes:
                yield keys, ords, texts
                keys, ords, texts, held = [], [], [], 0
    if keys:
        yield keys, ords, texts


def gram_hashes(ids: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` neighbours in a uint64 array."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, (salt * 0x9E3779B97F4A7C15 + k) & (2**64 - 1), np.uint64)
    for j in range(k):
        h += ids[j : j + n] * MIX[(salt * 67 + j) % len(MIX)]
    return mixed(h)


def window_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` neighbours the place of its smallest value, the rightmost on ties."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = h[:n].copy(), np.arange(n)
    for j in range(1, w):
        less = h[j : j + n] <= best
        best[less] = h[j : j + n][less]
        at[less] = np.flatnonzero(less) + j
    return at


def union_length(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans merged where they overlap or touch, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
