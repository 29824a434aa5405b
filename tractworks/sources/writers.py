"""Sinks: catalog tables, CSV exports, lookups and profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractworks.operators import quality
from tractworks.sources import storage


def save_table(df: DataFrame, name: str, partition: str = "CD_UF", path: str | None = None) -> None:
    """Creates or replaces an external table partitioned by state, so that later scans prune it; below ``path``, or in the warehouse.

    The rows are written to a new folder and the table is pointed there when all are; until then readers see the old table whole, a
    failure leaves it as it was, and ``df`` may read the table that it replaces. The folder that was replaced stays for those who
    still read it, until the next replacement.
    """
    spark = df.sparkSession
    top = storage.qualified(spark, path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}.versions")
    old = (table_path(spark, name) or "").rstrip("/")
    new = f"{top}/version-{uuid.uuid4().hex}"
    df.write.partitionBy(partition).parquet(new)
    _point(spark, name, new)
    for version in storage.folders(spark, top):
        if version.startswith("version-") and f"{top}/{version}" not in (new, old):
            storage.remove(spark, f"{top}/{version}")


def _point(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def table_path(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog table, or None."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type


def reload_partitions(df: DataFrame, name: str, partition: str = "CD_UF") -> None:
    """Replaces those partitions of a saved table that ``df`` has rows of; the others are neither read nor written.

    ``df`` must not read what it replaces. Partitions that are new to the table are added.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    if path is None:
        raise ValueError(f"there is no table {name}")
    columns = spark.table(name).columns
    df.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Removes a saved table and its files."""
    path = table_path(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path is not None:
        storage.remove(spark, path)


def state_count(spark: SparkSession, name: str, state: str, partition: str = "CD_UF") -> DataFrame:
    return spark.table(name).where(F.col(partition) == state).agg(F.count(F.lit(1)).alias("n"))


def export_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """CSV files with a header; ``mark`` puts a byte-order mark before the first column's name."""
    if mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode("overwrite").option("header", True).csv(path)


def export_profile(profile: DataFrame, mapping: DataFrame, folder: str) -> dict[str, str]:
    """A column profile as CSV: the columns, those that a (parquet_column, app_equivalent) map leaves out, types, coverage. Returns the paths."""
    outputs = {
        "columns_map": profile,
        "columns_map_unmapped": quality.unmapped_columns(profile, mapping).select("column", "type"),
        "columns_types_summary": quality.type_summary(profile),
        "mapping_coverage": quality.mapping_coverage(profile, mapping),
    }
    for name, table in outputs.items():
        export_csv(table, f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in outputs}
