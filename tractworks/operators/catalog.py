"""Lists of places and tracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractworks.functions.codes import clean_label
from tractworks.functions.text import name_with_code, place_label
from tractworks.operators.pyramid import ranked
from tractworks.vocabulary import WHOLE_STATE


def municipality_options(df: DataFrame) -> DataFrame:
    """Distinct municipalities by name and code, with their label."""
    return df.select("CD_MUN", clean_label("NM_MUN").alias("NM_MUN")).dropna().distinct().withColumn("rotulo", name_with_code("NM_MUN", "CD_MUN")).orderBy("NM_MUN", "CD_MUN")


def place_options(df: DataFrame, column: str) -> DataFrame:
    return df.select(clean_label(column).alias("place")).dropna().distinct().orderBy("place")


def level_options(df: DataFrame) -> DataFrame:
    """level, dentro, place, rotulo, posicao: what can be chosen on each level that the table has, in order, from one pass.

    Tracts are listed within their municipality (``dentro``), all others once; regions go by type and name, municipalities by name and
    code, the rest by name. Places without a name, or municipalities without a code, cannot be chosen.
    """
    null = F.lit(None).cast("string")
    row = lambda level, inside, place, label, *order: F.struct(F.lit(level).alias("level"), inside.alias("dentro"), place.alias("place"), label.alias("rotulo"), F.array(*order).alias("ordem"))
    has, clean = df.columns, lambda c: clean_label(c)
    rows = [row("state", null, F.lit("state"), F.lit(WHOLE_STATE), F.lit(""))]
    if {"TIPO_RM_AU", "REGIAO_RM_AU"} <= set(has):
        kind, name = F.upper(clean("TIPO_RM_AU")), clean("REGIAO_RM_AU")
        rows.append(row("region", null, name, F.concat(kind, F.lit(" — "), name), kind, name))
    rows += [row(level, null, clean(c), clean(c), clean(c)) for level, c in (("intermediate", "NM_RGINT"), ("immediate", "NM_RGI")) if c in has]
    if {"CD_MUN", "NM_MUN"} <= set(has):
        code, name = F.col("CD_MUN").cast("string"), clean("NM_MUN")
        rows.append(row("municipality", null, code, F.concat(code, F.lit(" — "), name), name, code))
        if "CD_SETOR" in has:
            tract = F.col("CD_SETOR").cast("string")
            rows.append(row("tract", code, tract, F.concat(F.lit("Setor "), tract), tract))
    listed = df.select(F.inline(F.array(*rows))).where("place is not null and rotulo is not null").distinct()
    return ranked(listed, ["level", "dentro"], ["ordem"]).drop("ordem")


TRACT_COLUMNS = ("CD_SETOR", "CD_MUN", "NM_MUN", "SITUACAO", "SITUACAO_DET_TXT", "TP_SETOR_TXT", "AREA_KM2", "V0001")


def tract_listing(df: DataFrame) -> DataFrame:
    """Distinct tracts of all municipalities with the listing columns that the table has."""
    return df.select(*(c for c in TRACT_COLUMNS if c in df.columns)).distinct().orderBy("CD_MUN", "CD_SETOR")


def scope_titles(df: DataFrame) -> DataFrame:
    """Each tract's titles at the tract, municipality and region levels."""
    return df.select("CD_SETOR", F.concat(F.lit("Setor "), place_label("CD_SETOR", "SITUACAO_DET_TXT", "TP_SETOR_TXT")).alias("setor"), place_label("CD_MUN", "NM_MUN").alias("municipio"), place_label("TIPO_RM_AU", "REGIAO_RM_AU").alias("regiao"), F.concat(F.lit("Região Imediata — "), clean_label("NM_RGI")).alias("imediata")).distinct()
