"""Reconciliation, coverage and column profiles."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.functions.codes import number
from tractworks.operators.normalize import canonical_renames
from tractworks.operators.pyramid import age_columns, cell
from tractworks.vocabulary import APP_TYPES, MEANINGS, SITUATIONS, TRACT_TYPES, VARIABLES


def reconcile(wide: DataFrame, keys: Sequence[str], declared: str = "V0001") -> DataFrame:
    """Counted people less declared ones, and percent of the declared (null if zero), in one pass."""
    counted = sum((cell(n) for n, _, _, _ in age_columns(wide.columns)), F.lit(0).cast("bigint"))
    sums = wide.groupBy(*keys).agg(F.sum(counted).alias("contado"), F.coalesce(F.sum(number(declared)), F.lit(0.0)).alias("declarado"))
    d = F.col("contado") - F.col("declarado")
    return sums.withColumn("diferenca", d).withColumn("diferenca_pct", F.try_divide(d, F.col("declarado")) * 100)


def declared_total(rows: DataFrame, keys: Sequence[str], declared: str = "V0001") -> DataFrame:
    """The one value on which a place's rows agree, else their sum."""
    v = number(declared)
    return rows.groupBy(*keys).agg(F.when(F.min(v) == F.max(v), F.max(v)).otherwise(F.coalesce(F.sum(v), F.lit(0.0))).alias("declarado"))


def missing_coverage(wide: DataFrame, keys: Sequence[str], tract: str = "CD_SETOR") -> DataFrame:
    """Tracts with any missing count, all tracts, and percent; judged before missing counts become zero."""
    missing = F.greatest(*(number(n).isNull() for n, _, _, _ in age_columns(wide.columns)), F.lit(False))
    tracts = wide.groupBy(*keys, tract).agg(F.bool_or(missing).alias("__missing"))
    counts = tracts.groupBy(*keys).agg(F.sum(F.col("__missing").cast("bigint")).alias("com_faltantes"), F.count(tract).alias("setores"))
    return counts.withColumn("pct", F.try_divide(F.col("com_faltantes").cast("double"), F.col("setores")) * 100)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, type, non_null, numeric, non_zero of each column, from one pass over the data.

    Numbers are counted as they are and texts if they can be read as numbers; columns of other types hold none.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    parts = []
    for c in columns or df.columns:
        value, kind = F.col(f"`{c}`"), kinds[c]
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            v = F.when(~F.isnan(value), value)
        elif isinstance(kind, T.NumericType):
            v = value
        else:
            v = number(value) if isinstance(kind, T.StringType) else None
        counts = (F.lit(0).cast("bigint"), F.lit(0).cast("bigint")) if v is None else (F.count(v), F.count(F.when(v != 0, 1)))
        parts.append(F.struct(F.lit(c).alias("column"), F.lit(kind.simpleString()).alias("type"), F.count(value).alias("non_null"), counts[0].alias("numeric"), counts[1].alias("non_zero")))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def column_attributes(spark: SparkSession, columns: Sequence[str], extra: dict[str, str] | None = None) -> DataFrame:
    """column, app_equivalent, human_alias, app_type, code_map of header names: one row each.

    The equivalent is the canonical name, null where the name stays as it is; the other attributes are the equivalent's.
    """

    def attributes(name: str | None) -> tuple:
        if name is None:
            return None, None, None
        variable = VARIABLES.get(name)
        table = SITUATIONS if name == "CD_SITUACAO" else TRACT_TYPES if name == "CD_TIPO" else {name: variable} if variable else None
        return variable or MEANINGS.get(name), APP_TYPES.get(name, "numeric" if variable else None), table and json.dumps(table, ensure_ascii=False)

    names = canonical_renames(columns, extra)
    return spark.createDataFrame([(c, names.get(c), *attributes(names.get(c))) for c in columns], "column string, app_equivalent string, human_alias string, app_type string, code_map string")


def described_profile(df: DataFrame, columns: Sequence[str] | None = None, extra: dict[str, str] | None = None) -> DataFrame:
    """:func:`column_profile` with :func:`column_attributes`."""
    return column_profile(df, columns).join(column_attributes(df.sparkSession, list(columns or df.columns), extra), "column")


def type_summary(profile: DataFrame) -> DataFrame:
    return profile.groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


def mapping_coverage(profile: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many columns a (parquet_column, app_equivalent) map covers, also weighted by non-null cells."""
    joined = profile.join(mapping, profile["column"] == mapping["parquet_column"], "left")
    mapped = F.coalesce(F.trim("app_equivalent") != "", F.lit(False))
    same = mapped & (F.col("app_equivalent") == F.col("column"))
    n = lambda c: F.sum(c.cast("bigint"))
    return joined.agg(F.count(F.lit(1)).alias("total"), n(mapped).alias("mapped"), n(~mapped).alias("unmapped"), n(same).alias("unchanged"), F.sum(F.when(mapped, F.col("non_null")).otherwise(0)).alias("mapped_cells"), F.sum("non_null").alias("cells"))


def unmapped_columns(profile: DataFrame, mapping: DataFrame) -> DataFrame:
    known = mapping.where("trim(app_equivalent) <> ''").select(F.col("parquet_column").alias("column"))
    return profile.join(known, "column", "left_anti")
