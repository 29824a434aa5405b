"""A pyramid kept up to date as tract files arrive, in a folder of batches that is compacted now and then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tractworks.operators.pyramid import age_columns, cell
from tractworks.sources import storage

#: Batches after which all that was written becomes one folder.
COMPACT_EVERY = 16


def tract_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def running_pyramid(tracts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of all sex-by-age columns per place over all files so far: one state row per place.

    Tract files carry no event time, so there is no watermark; the state has as many rows as there are places.
    """
    return tracts.groupBy(*keys).agg(*(F.sum(cell(n)).alias(f"{sex[0].lower()}_{k}") for n, sex, _, k in age_columns(tracts.columns)))


class LatestRows:
    """The latest row of each key over numbered batches, in a folder ``path``.

    Batch b is the folder ``part=b``. Every ``every`` batches the latest rows so far are written to ``base=b``; a base counts once Spark has
    marked it complete. Then what lies behind the base before it goes, so at most two bases and twice ``every`` batches are ever
    there, a reader of the older base still finds its files, and a batch that is done again finds all that it had before.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], every: int = COMPACT_EVERY):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), list(keys), every

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind, in order."""
        names = [n for n in storage.folders(self.spark, self.path) if n.startswith(f"{kind}=")]
        return sorted(int(n.partition("=")[2]) for n in names if storage.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _rows(self, until: int | None = None) -> DataFrame | None:
        """The latest row of each key, as of batch ``until``."""
        base = max((b for b in self._numbers("base") if until is None or b < until), default=-1)
        paths = [f"{self.path}/part={b}" for b in self._numbers("part") if b > base and (until is None or b <= until)]
        paths += [f"{self.path}/base={base}"] if base >= 0 else []
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        rest = [c for c in rows.columns if c not in (*self.keys, "__batch")]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "__batch"), "__batch").alias("__last"))
        return last.select(*self.keys, "__last.*")

    def put(self, rows: DataFrame, batch: int) -> None:
        """Writes a batch's changed rows; nothing goes through the driver."""
        rows.withColumn("__batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{self.path}/part={batch}")
        if (batch + 1) % self.every == 0:
            self.compact(batch)

    def compact(self, batch: int) -> None:
        """Writes the base of all batches up to ``batch`` and removes what the base before it has made superfluous."""
        self._rows(until=batch).write.mode("overwrite").parquet(f"{self.path}/base={batch}")
        before = [b for b in self._numbers("base") if b < batch]
        if before:
            for kind, stale in (("part", lambda n: n <= before[-1]), ("base", lambda n: n < before[-1])):
                for n in filter(stale, (int(x.partition("=")[2]) for x in storage.folders(self.spark, self.path) if x.startswith(f"{kind}="))):
                    storage.remove(self.spark, f"{self.path}/{kind}={n}")

    def current(self) -> DataFrame:
        """The latest row of each key as of the last complete batch; fails if there is none."""
        rows = self._rows()
        if rows is None:
            raise ValueError(f"nothing has been written to {self.path}")
        return rows.drop("__batch")


def start(pyramid: DataFrame, path: str, checkpoint: str, keys: Sequence[str], compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Runs until all files that are there are read. Each batch's changed places are written to ``path`` (:class:`LatestRows`).

    Batches that are done again overwrite their folder, so each counts once, also after a restart from ``checkpoint``.
    """
    table = LatestRows(pyramid.sparkSession, path, keys, compact_every)
    return pyramid.writeStream.outputMode("update").foreachBatch(table.put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The sums as of the last batch: of each place the row that was written last."""
    return LatestRows(spark, path, keys).current()
