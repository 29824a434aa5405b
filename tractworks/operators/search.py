"""Nearest vectors: exact search of many queries over all vectors, block against block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vectors and queries in a block: a pair of blocks makes a matrix of this size in a task.
VECTORS, QUERIES = 4096, 512
#: Queries of a block whose distances are held at once, and pairs whose exact distances are.
ROWS, PAIRS = 128, 1 << 14


def packed(rows: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """(ids, n, data): the rows of each partition in blocks of up to ``size``, vectors as bytes of doubles; null vectors go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            for i in range(0, batch.num_rows, size):
                part = batch.slice(i, size)
                lists = part.column(1)
                data = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), pa.array([part.num_rows], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["ids", "n", "data"])

    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema[id_col].dataType)), T.StructField("n", T.IntegerType()), T.StructField("data", T.BinaryType())])
    return rows.select(id_col, vector_col).mapInArrow(run, schema)


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def distances(v: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Distances of all pairs by one matrix product; good to rounding errors."""
    if metric == "cosine":
        return 1 - q @ v.T
    return np.sqrt(np.maximum((q * q).sum(1)[:, None] + (v * v).sum(1)[None] - 2 * q @ v.T, 0))


def exact(v: np.ndarray, q: np.ndarray, at: np.ndarray, row: np.ndarray, metric: str) -> np.ndarray:
    """Distances of the vectors ``at`` to the queries ``row``, summed in the order of the dimensions, ``PAIRS`` at a time."""
    total = np.zeros(len(at))
    for lo in range(0, len(at) if v.shape[1] else 0, PAIRS):
        some = slice(lo, lo + PAIRS)
        parts = v[at[some]] * q[row[some]] if metric == "cosine" else (v[at[some]] - q[row[some]]) ** 2
        total[some] = np.cumsum(parts, axis=1)[:, -1]
    return 1 - total if metric == "cosine" else np.sqrt(total)


def at_length_one(x: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.cumsum(x * x, axis=1)[:, -1:]) if x.shape[1] else np.zeros((len(x), 1))
    return np.where(size > 0, x / np.where(size > 0, size, 1), x)


def best_of_blocks(pairs: DataFrame, k: int, metric: str, unit: bool, query_kind: T.DataType, id_kind: T.DataType, query_id: str, id_col: str) -> DataFrame:
    """(query, id, distance): the ``k`` nearest of each query in each pair of blocks (ids, n, data, qids, qn, qdata).

    A matrix product finds them with a margin for rounding; distances within it are computed again exactly. A task holds the distances
    of ``ROWS`` queries at a time, whatever number of vectors are equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, qn = batch.column(1)[i].as_py(), batch.column(4)[i].as_py()
                v = np.frombuffer(batch.column(2)[i].as_buffer()).reshape(n, -1)
                every = np.frombuffer(batch.column(5)[i].as_buffer()).reshape(qn, -1)
                if v.shape[1] != every.shape[1]:
                    raise ValueError("vectors and queries differ in length")
                v, every = (at_length_one(v), at_length_one(every)) if unit else (v, every)
                longest = np.sqrt((v * v).sum(1).max(initial=0))
                ids, qids = batch.column(0).slice(i, 1).flatten(), batch.column(3).slice(i, 1).flatten()
                place = np.empty(n, np.int64)
                place[pc.sort_indices(ids).to_numpy()] = np.arange(n)
                for lo in range(0, qn, ROWS):
                    q = every[lo : lo + ROWS]
                    far = distances(v, q, metric)
                    most = np.partition(far, min(k, n) - 1, axis=1)[:, min(k, n) - 1]
                    scale = longest + np.sqrt((q * q).sum(1)) + 1
                    row, at = np.nonzero(far <= (most + 1e-6 * scale)[:, None])
                    out = exact(v, q, at, row, metric)
                    by = np.lexsort((place[at], out, row))
                    row, at, out = row[by], at[by], out[by]
                    nth = np.arange(len(row)) - np.searchsorted(row, row)
                    row, at, out = row[nth < k], at[nth < k], out[nth < k]
                    yield pa.RecordBatch.from_arrays([qids.take(pa.array(row + lo)), ids.take(pa.array(at)), pa.array(out)], names=[query_id, id_col, "distance"])

    schema = T.StructType([T.StructField(query_id, query_kind), T.StructField(id_col, id_kind), T.StructField("distance", T.DoubleType())])
    return pairs.mapInArrow(run, schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2", normalise: bool = False, id_col: str = "vec_id", vector_col: str = "embedding", query_id: str = "qid", query_vector: str = "qvec") -> DataFrame:
    """Per query the ``k`` nearest vectors, ties by id: query id, id, distance, rank.

    Both sides are packed into blocks, and each block of vectors meets each block of queries: that is the whole search, a matrix
    product per pair, of which a task keeps the ``k`` best of each query (found with a margin for rounding, within which distances
    are computed again exactly). Blocks are shuffled before they meet, so that each is made once and no task that searches also runs
    the workers that pack. Spark broadcasts a side only if it has measured it as small.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError("metric is l2 or cosine")
    unit = normalise or metric == "cosine"
    blocks = packed(vectors, id_col, vector_col, VECTORS).toDF("ids", "n", "data").repartition(F.xxhash64("ids"))
    asked = packed(queries, query_id, query_vector, QUERIES).toDF("qids", "qn", "qdata").repartition(F.xxhash64("qids"))
    pairs = blocks.join(asked)
    best = best_of_blocks(pairs, k, metric, unit, queries.schema[query_id].dataType, vectors.schema[id_col].dataType, query_id, id_col)
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy("distance", id_col))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(query_id, id_col, "distance", "rank")
