"""Tract tables in canonical form."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tractworks.functions import codes
from tractworks.vocabulary import ALIASES, LABELS

_VARIABLE = re.compile(r"v000([1-7])", re.I)


def canonical_renames(columns: Sequence[str], extra: dict[str, str] | None = None) -> dict[str, str]:
    """New names by an external map, then by alias (canonical name first, then listed order), then v0001..v0007 in upper case.

    A column is renamed if nothing has the canonical name yet; columns that keep their name are left out.
    """
    first = {k: v for k, v in (extra or {}).items() if k in columns and v not in columns}
    now = {c: first.get(c, c) for c in columns}
    taken = set(now.values())
    names: dict[str, str] = {}
    for old, new in now.items():
        names.setdefault(codes.normal_name(new), old)
    for canonical, aliases in ALIASES.items():
        found = next((names[a] for a in (canonical, *aliases) if a in names), None)
        if found is not None and now[found] != canonical and canonical not in taken:
            now[found] = canonical
    for old, new in now.items():
        if (m := _VARIABLE.fullmatch(new.strip())) and f"V000{m[1]}" not in taken:
            now[old] = f"V000{m[1]}"
    return {old: new for old, new in now.items() if old != new}


def canonical_names(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Columns renamed by :func:`canonical_renames`; only names change."""
    return df.withColumnsRenamed(canonical_renames(df.columns, extra))


def normal_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({c: codes.first_digits(c) for c in ("CD_SETOR", "CD_MUN", "CD_UF") if c in df.columns})


def decoded(df: DataFrame) -> DataFrame:
    """Situation and type as code and text; a column is made only where it is missing."""
    new = {}
    for code, text, to_text, to_code in (("CD_SITUACAO", "SITUACAO_DET_TXT", codes.situation_text, codes.situation_code), ("CD_TIPO", "TP_SETOR_TXT", codes.tract_type_text, codes.tract_type_code)):
        if code in df.columns and text not in df.columns:
            new[text] = to_text(code)
        elif text in df.columns and code not in df.columns:
            new[code] = to_code(text)
    return df.withColumns(new) if new else df


def with_urban_rural(df: DataFrame) -> DataFrame:
    """SITUACAO, where it is missing, from the situation's code or else its text."""
    if "SITUACAO" in df.columns:
        return df
    if "CD_SITUACAO" in df.columns:
        return df.withColumn("SITUACAO", codes.urban_rural("CD_SITUACAO"))
    return df.withColumn("SITUACAO", codes.urban_rural_of_text("SITUACAO_DET_TXT")) if "SITUACAO_DET_TXT" in df.columns else df


def numeric_variables(df: DataFrame) -> DataFrame:
    """V0001..V0007 as numbers: V0005 and V0006 doubles, the others longs."""
    return df.withColumns({c: codes.number(c) if c in ("V0005", "V0006") else codes.number(c).cast("bigint") for c in df.columns if re.fullmatch(r"V000[1-7]", c)})


def clean_labels(df: DataFrame, columns: Sequence[str] = LABELS) -> DataFrame:
    """Label columns trimmed, with the spellings of a missing value as null."""
    return df.withColumns({c: codes.clean_label(c) for c in columns if c in df.columns})


def normalized(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """All of the above in order."""
    return clean_labels(numeric_variables(with_urban_rural(decoded(normal_codes(canonical_names(df, extra))))))
