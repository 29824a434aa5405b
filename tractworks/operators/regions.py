"""Municipalities and the regions they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractworks.functions.codes import clean_label, municipality_code


def fill_from_lookup(df: DataFrame, lookup: DataFrame, column: str, code: str = "CD_MUN", overwrite: bool = False) -> DataFrame:
    """``column`` from a (CD_MUN, nome) lookup by seven-digit code: only where it is null, or everywhere with ``overwrite``.

    The lookup has one row per code; Spark broadcasts it by its measured size.
    """
    found = lookup.select(F.col("CD_MUN").alias("__code"), F.col("nome").alias("__name"))
    joined = df.join(found, municipality_code(code) == found["__code"], "left")
    old = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return joined.withColumn(column, F.col("__name") if overwrite else F.coalesce(old, "__name")).drop("__code", "__name")


def enriched(df: DataFrame, metropolitan: DataFrame | None, agglomeration: DataFrame | None) -> DataFrame:
    if metropolitan is not None:
        df = fill_from_lookup(df, metropolitan, "RM_NOME")
    if agglomeration is not None:
        df = fill_from_lookup(df, agglomeration, "AU_NOME")
    return unified(df)


def unified(df: DataFrame) -> DataFrame:
    """REGIAO_RM_AU, TIPO_RM_AU and NOME_RM_AU, each only where missing; a metropolitan region comes before an agglomeration."""
    rm = F.col("RM_NOME") if "RM_NOME" in df.columns else F.lit(None).cast("string")
    au = F.col("AU_NOME") if "AU_NOME" in df.columns else F.lit(None).cast("string")
    new = {"REGIAO_RM_AU": F.coalesce(rm, au), "TIPO_RM_AU": F.when(rm.isNotNull(), "RM").when(au.isNotNull(), "AU"), "NOME_RM_AU": F.coalesce(rm, au)}
    return df.withColumns({k: v for k, v in new.items() if k not in df.columns})


def region_map(metropolitan: DataFrame, agglomeration: DataFrame) -> DataFrame:
    """Full outer join of both compositions: CD_MUN, RM_NOME, AU_NOME."""
    return metropolitan.select("CD_MUN", F.col("nome").alias("RM_NOME")).join(agglomeration.select("CD_MUN", F.col("nome").alias("AU_NOME")), "CD_MUN", "full")


def municipality_lookup(df: DataFrame, regions: DataFrame) -> DataFrame:
    """CD_MUN, NM_MUN, RM_NOME, AU_NOME: one name (the smallest) per code of the region map."""
    names = df.select(municipality_code("CD_MUN").alias("CD_MUN"), "NM_MUN").groupBy("CD_MUN").agg(F.min("NM_MUN").alias("NM_MUN"))
    return regions.join(names, "CD_MUN", "left").select("CD_MUN", "NM_MUN", "RM_NOME", "AU_NOME")


def regions_of_municipalities(df: DataFrame) -> DataFrame:
    """One region pair (the smallest names) per municipality."""
    return df.groupBy("CD_MUN").agg(F.min("RM_NOME").alias("RM_NOME"), F.min("AU_NOME").alias("AU_NOME"))


def region_options(df: DataFrame) -> DataFrame:
    """tipo, nome, rotulo of all regions, cleaned and distinct."""
    both = df.select(F.lit("RM").alias("tipo"), clean_label("RM_NOME").alias("nome")).unionByName(df.select(F.lit("AU").alias("tipo"), clean_label("AU_NOME").alias("nome")))
    return both.dropna().distinct().withColumn("rotulo", F.concat_ws(" — ", "tipo", "nome"))
