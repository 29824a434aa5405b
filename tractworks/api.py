"""The names that users of census scripts look for, in English and Portuguese, over the library's operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractworks.functions.codes import age_label as normalize_age_label
from tractworks.functions.codes import clean_label, variable_label
from tractworks.functions.codes import title as sanitize_title
from tractworks.functions.text import brazilian as fmt_br
from tractworks.operators import indicators, pyramid, regions
from tractworks.operators.normalize import normalized
from tractworks.sources.readers import read_tracts, region_composition
from tractworks.sources.writers import export_csv, save_table, state_count

get_variable_label = variable_label


def load_sp_age_sex_enriched(spark: SparkSession, path: str, limit: int | None = None, state: str = "35", metropolitan: DataFrame | None = None, agglomeration: DataFrame | None = None) -> DataFrame:
    """The normalised tract table of a state, with regions from composition tables where they are given."""
    wide = normalized(read_tracts(spark, path, state, limit))
    return regions.enriched(wide, metropolitan and region_composition(metropolitan, "RM"), agglomeration and region_composition(agglomeration, "AU"))


def wide_to_long_pyramid(wide: DataFrame) -> DataFrame:
    return pyramid.to_long(wide)


def aggregate_pyramid(df: DataFrame, group_by: Sequence[str] = (), pad: bool = True) -> DataFrame:
    """Sums by the keys that the table has, band and sex, in their order; wide tables are taken as they are."""
    keys = [k for k in group_by if k in df.columns]
    if "idade_grupo" not in df.columns:
        out = pyramid.pyramid(df, keys)
    elif pad:
        out = pyramid.padded(df, keys)
    else:
        out = pyramid.sum_by_sex_and_band(df, keys, drop_null=False).withColumn("ord", pyramid.label_order("idade_grupo"))
    return out.orderBy(*(F.asc_nulls_last(k) for k in keys), "ord", "sexo")


def pad_pyramid_categories(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return pyramid.padded(long, keys)


def aggregate_sex_age(long: DataFrame) -> DataFrame:
    return pyramid.sum_by_sex_and_band(long, [])


def build_abnt_demographic_table(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The band table with its TOTAL row, in band order."""
    return pyramid.with_total(pyramid.band_table(long, keys), keys).orderBy(*keys, "ordem", "idade_grupo")


def enrich_with_municipality_lookup(df: DataFrame, lookup: DataFrame, new_col: str, source_col: str = "CD_MUN", overwrite: bool = False) -> DataFrame:
    return regions.fill_from_lookup(df, lookup, new_col, source_col, overwrite)


def calcular_populacoes_agrupadas(df: DataFrame, idade_col: str = "idade", pop_col: str = "pop", group_cols: Sequence[str] = ()) -> DataFrame:
    return indicators.age_groups(df, group_cols, idade_col, pop_col)


def calcular_indicadores_demograficos(grupos: DataFrame) -> DataFrame:
    return indicators.with_indicators(grupos)


def gerar_flags_qualidade(grupos: DataFrame) -> DataFrame:
    return indicators.with_flags(grupos)


def calcular_indicadores_df(df: DataFrame, idade_col: str = "idade", pop_col: str = "pop", group_cols: Sequence[str] = ("CodIBGE", "Municipio")) -> DataFrame:
    return indicators.indicators(df, group_cols, idade_col, pop_col)


def export_table(table: DataFrame, folder: str, scope: str) -> str:
    """A table as CSV under a folder named by its scope's title; returns the path."""
    name = "".join(c if c.isalnum() else "_" for c in scope).strip("_") or "tabela"
    export_csv(table, f"{folder}/{name}")
    return f"{folder}/{name}"


def municipality_lookup_csv(wide: DataFrame, metropolitan: DataFrame, agglomeration: DataFrame, path: str) -> None:
    """CD_MUN, NM_MUN, RM_NOME, AU_NOME as CSV."""
    maps = regions.region_map(region_composition(metropolitan, "RM"), region_composition(agglomeration, "AU"))
    export_csv(regions.municipality_lookup(wide, maps), path, mark=False)


carregar_sp_idade_sexo_enriquecido = load_sp_age_sex_enriched
largura_para_longo_piramide = wide_to_long_pyramid
agregar_piramide = aggregate_pyramid
normalizar_rotulo_idade = normalize_age_label
preencher_categorias_piramide = pad_pyramid_categories
agregar_sexo_idade = aggregate_sex_age
montar_tabela_demografica_abnt = build_abnt_demographic_table
limpar_rotulo = clean_label
sanitizar_titulo = sanitize_title
formatar_br = fmt_br

__all__ = [
    "aggregate_pyramid", "aggregate_sex_age", "agregar_piramide", "agregar_sexo_idade", "build_abnt_demographic_table", "calcular_indicadores_demograficos", "calcular_indicadores_df",
    "calcular_populacoes_agrupadas", "carregar_sp_idade_sexo_enriquecido", "clean_label", "enrich_with_municipality_lookup", "export_table", "fmt_br", "formatar_br", "gerar_flags_qualidade",
    "get_variable_label", "largura_para_longo_piramide", "limpar_rotulo", "load_sp_age_sex_enriched", "montar_tabela_demografica_abnt", "municipality_lookup_csv", "normalizar_rotulo_idade",
    "normalize_age_label", "pad_pyramid_categories", "preencher_categorias_piramide", "sanitizar_titulo", "sanitize_title", "save_table", "state_count", "wide_to_long_pyramid",
]
