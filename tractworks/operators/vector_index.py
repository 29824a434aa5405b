"""An inverted-file index over vectors: cells by distributed k-means, probed cell by cell, distances exact.

Centroids are fitted on a bounded sample and are the only thing that goes to all tasks (``cells`` times the length of a vector); every
vector is in the index, in the cell of its nearest centroid. A search takes the nearest cells of each query and computes exact
distances there. Searching for certain goes on to all cells that may still hold a nearer vector: by the triangle inequality those
whose centroid is no farther than the k-th best distance so far plus the radius of the cell.

Vectors of a cell lie in blocks; blocks of vectors and of queries meet by an equi-join on the cell, and a cell that holds a large part of
all vectors is many blocks, so no task gets a whole cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.operators.search import at_length_one, best_of_blocks, distances, matrix, nearest

#: Vectors at most that the number of probes is fitted on.
CALIBRATION = 256
#: Cells at most, sample vectors a cell that centroids are fitted on at most, rounds of k-means.
MOST_CELLS, SAMPLE, ROUNDS = 65536, 64, 8
#: Vectors and queries in a block.
VECTORS, QUERIES = 4096, 512


def _nearest_cells(v: np.ndarray, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` nearest centroids of each row and their distances, nearest first, ties by number; a block of rows at a time."""
    cells, far = [], []
    step = max(1, (1 << 21) // max(len(centroids), 1))
    for lo in range(0, len(v), step):
        d = distances(centroids, v[lo : lo + step], "l2")
        at = d.argmin(1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, :n]
        cells.append(at)
        far.append(np.take_along_axis(d, at, 1))
    return (np.concatenate(cells), np.concatenate(far)) if cells else (np.empty((0, n), np.int64), np.empty((0, n)))


def fit_cells(vectors: DataFrame, cells: int | None = None, unit: bool = False, sample: int = SAMPLE, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding") -> np.ndarray:
    """Centroids (a row each) by k-means on about ``cells * sample`` vectors, those with the smallest hashes of id and vector.

    The default number of cells is the square root of the number of vectors, ``MOST_CELLS`` at most; equal first centroids become one.
    Each round a task sends one sum and count per cell; cells that get no vector keep their centroid.
    """
    have = vectors.where(F.col(vector_col).isNotNull()).select(F.xxhash64(F.lit("sample"), id_col, vector_col).alias("h"), F.col(vector_col).cast("array<double>").alias("v"))
    n = have.count()
    k = max(1, min(cells or round(n**0.5), MOST_CELLS, n))
    first = have.orderBy("h", "v").limit(k).toArrow()["v"].to_pylist()
    if not first:
        return np.empty((0, 0))
    prepared = at_length_one if unit else (lambda x: x)
    centroids = np.unique(prepared(np.array(first)), axis=0)
    chosen = have.where(F.pmod("h", F.lit(1 << 32)) < min(1.0, k * sample / n) * (1 << 32)).select("v").persist()  # rounds read it again
    try:
        for _ in range(rounds):
            held = vectors.sparkSession.sparkContext.broadcast(centroids)

            def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                c = held.value
                total, count = np.zeros(c.shape), np.zeros(len(c), np.int64)
                for batch in batches:
                    v = prepared(matrix(batch.column(0)))
                    at = _nearest_cells(v, c, 1)[0][:, 0]
                    np.add.at(total, at, v)
                    count += np.bincount(at, minlength=len(c))
                used = np.flatnonzero(count)
                if len(used):
                    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.float64()))], names=["cell", "n", "total"])

            d = centroids.shape[1]
            parts = chosen.mapInArrow(sums, "cell long, n long, total array<double>").groupBy("cell").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i]) for i in range(d))).alias("total")).toArrow()
            new = centroids.copy()
            if parts.num_rows:
                new[parts["cell"].to_numpy()] = np.array(parts["total"].to_pylist()) / parts["n"].to_numpy()[:, None]
            if np.allclose(new, centroids):
                break
            centroids = prepared(new)
    finally:
        chosen.unpersist()
    return centroids


def build(vectors: DataFrame, centroids: np.ndarray, unit: bool = False, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(cell, ids, n, data, radius): every vector that is not null in its cell's blocks of up to ``VECTORS``, as bytes of doubles.

    ``radius`` is the largest distance of a block's vectors to the centroid. Vectors are dealt out by cell and hash of id, so a
    crowded cell goes to several tasks; the result can be written as a table and read back.
    """
    held = vectors.sparkSession.sparkContext.broadcast(centroids)
    prepared = at_length_one if unit else (lambda x: x)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, far = _nearest_cells(prepared(matrix(batch.column(1))), held.value, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at[:, 0]), pa.array(far[:, 0])], names=["id", "v", "cell", "far"])

    kind = vectors.schema[id_col].dataType
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.mapInArrow(assign, T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType()), T.StructField("far", T.DoubleType())]))
    dealt = rows.repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell", "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(2).to_numpy()
            starts = np.flatnonzero(np.diff(cells, prepend=cells[:1] - 1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(cells)]):
                for i in range(lo, hi, VECTORS):
                    part = batch.slice(i, min(VECTORS, hi - i))
                    data = matrix(part.column(1)).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([int(cells[i])]), pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), pa.array([part.num_rows], pa.int32()), pa.array([data], pa.binary()), pa.array([float(part.column(3).to_numpy().max())])], names=["cell", "ids", "n", "data", "radius"])

    schema = T.StructType([T.StructField("cell", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("n", T.IntegerType()), T.StructField("data", T.BinaryType()), T.StructField("radius", T.DoubleType())])
    return dealt.select("id", "v", "cell", "far").mapInArrow(pack, schema)


def save(index: DataFrame, centroids: np.ndarray, path: str) -> None:
    """Writes an index to a new folder: its blocks in the order of cells, so that a search of few cells skips files, and its centroids."""
    index.write.parquet(f"{path}/blocks")
    rows = [(i, c.tolist()) for i, c in enumerate(centroids)]
    index.sparkSession.createDataFrame(rows, "cell long, centroid array<double>").coalesce(1).write.parquet(f"{path}/centroids")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """The blocks and centroids of a saved index."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").toArrow()["centroid"].to_pylist()  # a row a cell
    return spark.read.parquet(f"{path}/blocks"), np.array(rows) if rows else np.empty((0, 0))


def append(spark: SparkSession, path: str, vectors: DataFrame, unit: bool = False, id_col: str = "vec_id", vector_col: str = "embedding") -> None:
    """Adds vectors to a saved index, in the cells that it has; nothing that is there is read or written again.

    Searches stay exact to their promise, as radii are taken over all blocks; only the spread of cells ages, until they are fitted anew.
    """
    centroids = load(spark, path)[1]
    if not len(centroids):
        raise ValueError("an index without cells cannot grow")
    build(vectors, centroids, unit, id_col, vector_col).write.mode("append").parquet(f"{path}/blocks")


def probes(queries: DataFrame, centroids: np.ndarray, n: int | None, unit: bool = False, query_id: str = "qid", query_vector: str = "qvec") -> DataFrame:
    """(qid, qvec, cell, far): the ``n`` nearest cells of each query (all with ``None``), nearest first."""
    held = queries.sparkSession.sparkContext.broadcast(centroids)
    prepared = at_length_one if unit else (lambda x: x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                v = matrix(part.column(1))
                if len(v) and v.shape[1] != held.value.shape[1]:
                    raise ValueError("vectors and queries differ in length")
                cells, far = _nearest_cells(prepared(v), held.value, n or len(held.value))
                row = np.repeat(np.arange(len(v)), cells.shape[1])
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells.ravel()), pa.array(far.ravel())], names=["qid", "qvec", "cell", "far"])

    rows = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("qid"), F.col(query_vector).cast("array<double>").alias("qvec"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType()), T.StructField("far", T.DoubleType())]))


def _in_cells(index: DataFrame, probed: DataFrame, k: int, metric: str) -> DataFrame:
    """(qid, id, distance): the ``k`` nearest of each query in each block of its probed cells."""
    kind = probed.schema["qid"].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.diff(cells, prepend=cells[:1] - 1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(cells)]):
                for i in range(lo, hi, QUERIES):
                    part = batch.slice(i, min(QUERIES, hi - i))
                    yield pa.RecordBatch.from_arrays([pa.array([int(cells[i])]), pa.array([part.column(1).to_pylist()], pa.list_(part.column(1).type)), pa.array([part.num_rows], pa.int32()), pa.array([matrix(part.column(2)).tobytes()], pa.binary())], names=["qcell", "qids", "qn", "qdata"])

    schema = T.StructType([T.StructField("qcell", T.LongType()), T.StructField("qids", T.ArrayType(kind)), T.StructField("qn", T.IntegerType()), T.StructField("qdata", T.BinaryType())])
    blocks = probed.repartitionByRange("cell", F.xxhash64("qid")).sortWithinPartitions("cell").select("cell", "qid", "qvec").mapInArrow(pack, schema)
    pairs = index.join(blocks, index["cell"] == blocks["qcell"]).select("ids", "n", "data", "qids", "qn", "qdata")
    return best_of_blocks(pairs, k, metric, metric == "cosine", kind, index.schema["ids"].dataType.elementType, "qid", "id")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int = 5, metric: str = "l2", n_probes: int = 8, certain: bool = False, id_col: str = "vec_id", query_id: str = "qid", query_vector: str = "qvec") -> DataFrame:
    """Per query its ``k`` nearest vectors in the ``n_probes`` nearest cells, ties by id: query id, id, distance, rank.

    ``certain=True`` gives the ``k`` nearest of all vectors: the ``k``-th best distance of the probes and the radii of cells say which other
    cells can hold a nearer one, and these are searched too. An index for the cosine metric is built with ``unit=True``. Queries without
    a vector have no rows.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError("metric is l2 or cosine")
    unit = metric == "cosine"
    names = lambda rows: rows.select(F.col("qid").alias(query_id), F.col("id").alias(id_col), "distance", "rank")
    if not len(centroids):
        none = F.lit(None)
        empty = queries.where("false").select(F.col(query_id).alias("qid"), none.cast(index.schema["ids"].dataType.elementType).alias("id"), none.cast("double").alias("distance"), none.cast("int").alias("rank"))
        return names(empty)
    near = probes(queries, centroids, n_probes, unit, query_id, query_vector)
    found = _in_cells(index, near, k, metric)
    if certain:
        found = _ranked(found, k)  # what this shuffles serves both uses below
        # distances between vectors of length one follow from their cosine distance
        last = F.sqrt(F.greatest(2 * F.col("distance"), F.lit(0.0))) if unit else F.col("distance")
        worst = found.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.max(last)).alias("worst"))
        radii = index.groupBy("cell").agg(F.max("radius").alias("radius"))
        rest = probes(queries, centroids, None, unit, query_id, query_vector)
        seen = near.select("qid", "cell")
        rest = rest.join(seen, ["qid", "cell"], "left_anti").join(worst, "qid", "left").join(radii, "cell")
        # a margin for rounding; queries with fewer than k results so far look everywhere
        rest = rest.where(F.col("worst").isNull() | (F.col("far") - F.col("radius") <= F.col("worst") * (1 + 1e-9) + 1e-6))
        found = found.drop("rank").unionByName(_in_cells(index, rest.select("qid", "qvec", "cell", "far"), k, metric))
    return names(_ranked(found, k))


def probes_for(vectors: DataFrame, index: DataFrame, centroids: np.ndarray, target: float = 0.97, k: int = 5, metric: str = "l2", id_col: str = "vec_id", vector_col: str = "embedding") -> int:
    """How many cells a query has to probe to find ``target`` of its ``k`` true neighbours.

    Taken from ``CALIBRATION`` vectors with the smallest hashes, whose neighbours the search without an index finds: where their cells
    stand in the order of probes. In data without clusters this is a large part of all cells.
    """
    unit = metric == "cosine"
    chosen = vectors.where(F.col(vector_col).isNotNull()).orderBy(F.xxhash64(F.lit("probes"), id_col, vector_col)).limit(CALIBRATION)
    asked = chosen.select(F.col(id_col).alias("qid"), F.col(vector_col).alias("qvec"))
    true = nearest(vectors, asked, k, metric, id_col=id_col, vector_col=vector_col).select("qid", F.col(id_col).alias("id"))
    cells = index.select("cell", F.explode("ids").alias("id")).join(true, "id")
    order = F.row_number().over(Window.partitionBy("qid").orderBy("far", "cell"))
    places = probes(asked, centroids, None, unit).select("qid", "cell", order.alias("place"))
    counts = cells.join(places, ["qid", "cell"]).groupBy("place").agg(F.count(F.lit(1)).alias("n")).orderBy("place").toArrow()  # a row a cell at most
    if not counts.num_rows:
        return 1
    reached = np.cumsum(counts["n"].to_numpy())
    return int(counts["place"].to_numpy()[np.searchsorted(reached, target * reached[-1])])


def work(index: DataFrame, probed: DataFrame) -> DataFrame:
    """One row (computed, pairs): distances that a search of these probes computes, and those that a search without an index does."""
    sizes = index.groupBy("cell").agg(F.sum("n").alias("n"))
    computed = probed.groupBy("cell").agg(F.count(F.lit(1)).alias("q")).join(sizes, "cell").agg(F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("computed"))
    pairs = index.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("vectors")).join(probed.agg(F.count_distinct("qid").alias("queries")))  # a row each
    return computed.join(pairs).select("computed", (F.col("vectors") * F.col("queries")).alias("pairs"))


def recall(found: DataFrame, true: DataFrame, id_col: str = "vec_id", query_id: str = "qid") -> DataFrame:
    """One row (hits, wanted, recall): the share of the true neighbours that are found."""
    keys = [query_id, id_col]
    both = true.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(1)), keys, "left")
    return both.agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("wanted")).withColumn("recall", F.try_divide(F.col("hits").cast("double"), F.col("wanted")))
