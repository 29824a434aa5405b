"""Fixed values of the census domain: labels, codes, aliases and groups that results must carry literally."""

from __future__ import annotations

# Canonical age bands in order.
BANDS = (
    "0 a 4 anos", "5 a 9 anos", "10 a 14 anos", "15 a 19 anos", "20 a 24 anos", "25 a 29 anos",
    "30 a 39 anos", "40 a 49 anos", "50 a 59 anos", "60 a 69 anos", "70 anos ou mais",
)
SEXES = ("Masculino", "Feminino")

# Five-year bands up to 100 and over.
FIVE_YEAR_BANDS = (*(f"{a} a {a + 4} anos" for a in range(0, 100, 5)), "100 anos ou mais")

# Detailed situation codes.
SITUATIONS = {
    1: "Área urbana de alta densidade de edificações de cidade ou vila",
    2: "Área urbana de baixa densidade de edificações de cidade ou vila",
    3: "Núcleo urbano",
    5: "Aglomerado rural - Povoado",
    6: "Aglomerado rural - Núcleo rural",
    7: "Aglomerado rural - Lugarejo",
    8: "Área rural (exclusive aglomerados)",
    9: "Massas de água",
}
URBAN_CODES = (1, 2, 3)

# Tract type codes.
TRACT_TYPES = {
    0: "Não especial",
    1: "Favela e Comunidade Urbana",
    2: "Quartel e base militar",
    3: "Alojamento / acampamento",
    4: "Setor com baixo patamar domiciliar",
    5: "Agrupamento indígena",
    6: "Unidade prisional",
    7: "Convento / hospital / ILPI / IACA",
    8: "Agrovila do PA",
    9: "Agrupamento quilombola",
}

# Labels of the base variables.
VARIABLES = {
    "V0001": "Total de pessoas",
    "V0002": "Total de Domicílios (DPPO + DPPV + DPPUO + DPIO + DCCM + DCSM)",
    "V0003": "Total de Domicílios Particulares (DPPO + DPPV + DPPUO + DPIO)",
    "V0004": "Total de Domicílios Coletivos (DCCM + DCSM)",
    "V0005": "Média de moradores em Domicílios Particulares Ocupados (Total pessoas em Domicílios Particulares Ocupados / DPPO + DPIO)",
    "V0006": "Percentual de Domicílios Particulares Ocupados Imputados (Total DPO imputados / Total DPO)",
    "V0007": "Total de Domicílios Particulares Ocupados (DPPO + DPIO)",
}

# Texts that stand for a missing label.
MISSING_LABELS = ("", "nan", "none", "undefined", "null", "-", "—")
WHOLE_STATE = "Estado de São Paulo"
# Columns whose labels are cleaned when a table is loaded.
LABELS = ("NOME_RM_AU", "TIPO_RM_AU", "RM_NOME", "AU_NOME", "NM_MUN", "NM_RGI", "NM_RGINT", "faixa_etaria")
# What canonical columns mean, and the type they get.
MEANINGS = {
    "SITUACAO": "Situação do Setor Censitário (macro: Urbana/Rural)",
    "CD_SITUACAO": "Código da Situação detalhada do Setor Censitário",
    "SITUACAO_DET_TXT": "Situação detalhada do Setor Censitário",
    "CD_TIPO": "Código do Tipo do Setor Censitário",
    "TP_SETOR_TXT": "Tipo do Setor Censitário",
    **{c: c for c in ("CD_SETOR", "CD_MUN", "NM_MUN", "CD_UF", "NM_UF", "RM_NOME", "AU_NOME", "NM_RGINT", "NM_RGI")},
}
APP_TYPES = {"V0005": "float64", "V0006": "float64", **{c: "categorical/int" for c in ("CD_SETOR", "CD_MUN", "CD_UF", "CD_SITUACAO", "CD_TIPO")}}

# Places from the widest to the narrowest level, and the column that names each.
LEVELS = {"state": None, "region": "REGIAO_RM_AU", "intermediate": "NM_RGINT", "immediate": "NM_RGI", "municipality": "CD_MUN", "tract": "CD_SETOR"}

# Header names that mean a canonical column, as normalised (no accents, upper case, underscores).
ALIASES = {
    "CD_SETOR": ("CD_SETOR", "GEOCODIGO_DE_SETOR_CENSITARIO", "GEOCODIGO_SETOR_CENSITARIO"),
    "CD_MUN": ("CD_MUN", "CODIGO_DO_MUNICIPIO", "COD_MUN"),
    "NM_MUN": ("NM_MUN", "NOME_DO_MUNICIPIO", "NOME_MUNICIPIO"),
    "CD_UF": ("CD_UF", "CODIGO_DA_UNIDADE_DA_FEDERACAO", "UF_CODIGO"),
    "NM_UF": ("NM_UF", "NOME_DA_UNIDADE_DA_FEDERACAO"),
    "CD_SITUACAO": ("CD_SITUACAO", "SITUACAO_DETALHADA_DO_SETOR_CENSITARIO_CODIGO", "COD_SITUACAO_DETALHADA", "CODIGO_DA_SITUACAO_DETALHADA_DO_SETOR_CENSITARIO"),
    "SITUACAO_DET_TXT": ("SITUACAO_DET_TXT", "SITUACAO_DETALHADA_DO_SETOR_CENSITARIO"),
    "CD_TIPO": ("CD_TIPO", "TIPO_DO_SETOR_CENSITARIO_CODIGO", "COD_TIPO_SETOR"),
    "TP_SETOR_TXT": ("TP_SETOR_TXT", "TIPO_DO_SETOR_CENSITARIO"),
    "SITUACAO": ("SITUACAO", "SITUACAO_DO_SETOR_CENSITARIO", "SIT_SETOR"),
    "RM_NOME": ("RM_NOME", "NOME_CATMETROPOL", "RM", "NOME_RM"),
    "AU_NOME": ("AU_NOME", "NOME_CATAU", "NOME_CATEU", "AU", "NOME_AU"),
    "NM_RGINT": ("NM_RGINT", "NOME_DA_REGIAO_GEOGRAFICA_INTERMEDIARIA"),
    "NM_RGI": ("NM_RGI", "NOME_DA_REGIAO_GEOGRAFICA_IMEDIATA"),
}
REGION_CODES = ("CODIGO_DO_MUNICIPIO", "COD_MUNICIPIO", "CD_GEOCODM", "CD_MUN", "COD_MUN")
REGION_NAMES = {"RM": ("NOME_CATMETROPOL", "RM_NOME", "RM", "NOME_RM"), "AU": ("NOME_CATAU", "AU_NOME", "AU", "NOME_AU")}

# Reference ranges of indicators (low below the first, high above the second; PSR the other way round).
RANGES = {"RDT": (45, 65), "RDJ": (25, 40), "RDI": (15, 25), "IE_65p": (30, 70), "PSR": (5, 10)}
