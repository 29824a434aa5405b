"""Codes, labels and ages as column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tractworks.vocabulary import MISSING_LABELS, SITUATIONS, TRACT_TYPES, URBAN_CODES, VARIABLES, WHOLE_STATE


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def normal_name(name: str) -> str:
    """A header name without accents, in upper case, with underscores for everything else (driver side)."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", str(name)) if not unicodedata.combining(c))
    return re.sub(r"[^A-Za-z0-9]+", "_", plain).strip("_").upper()


#: How a text that may be a number begins; only these are parsed.
NUMERIC = r"(?i)^[\x00-\x20]*[+-]?(\d|\.\d|inf|nan)"


def number(c: str | Column) -> Column:
    """A double; what is no number, and NaN, is null.

    A failing parse costs an exception a cell, so texts that do not begin like a number are not parsed; the guard falls away for
    columns that hold numbers, as their type is known when the plan is made.
    """
    x = col(c)
    d = F.when((F.typeof(x) != "string") | x.cast("string").rlike(NUMERIC), x.try_cast("double"))
    return F.nanvl(d, F.lit(None).cast("double"))


def whole(c: str | Column) -> Column:
    """An integer code from text, integer or float; fractions and texts are null."""
    d = number(c)
    return F.when(d == F.floor(d), d.cast("int"))


def first_digits(c: str | Column) -> Column:
    """The first run of digits of a code, or the code itself if it has none."""
    text = col(c).cast("string")
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")), text)


def municipality_code(c: str | Column) -> Column:
    """Digits only, padded with zeros to seven; longer codes stay, null stays null."""
    digits = F.regexp_replace(col(c).cast("string"), r"\D", "")
    return F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits)


def _decode(table: dict, key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


def situation_text(code: str | Column) -> Column:
    return _decode(SITUATIONS, whole(code))


def situation_code(text: str | Column) -> Column:
    return _decode({v: k for k, v in SITUATIONS.items()}, col(text))


def tract_type_text(code: str | Column) -> Column:
    return _decode(TRACT_TYPES, whole(code))


def tract_type_code(text: str | Column) -> Column:
    return _decode({v: k for k, v in TRACT_TYPES.items()}, col(text))


def urban_rural(code: str | Column) -> Column:
    """Urbana for the urban codes, Rural for any other integer, null if there is none."""
    k = whole(code)
    return F.when(k.isin(*URBAN_CODES), "Urbana").when(k.isNotNull(), "Rural")


def urban_rural_of_text(text: str | Column) -> Column:
    """Urbana for the three urban situations, Rural for any other text and for none."""
    return F.when(col(text).isin(*(SITUATIONS[k] for k in URBAN_CODES)), "Urbana").otherwise("Rural")


def variable_label(code: str | Column) -> Column:
    return _decode(VARIABLES, F.upper(F.trim(col(code))))


def clean_label(c: str | Column) -> Column:
    """Trimmed text; the usual spellings of a missing value are null."""
    text = F.trim(col(c).cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_LABELS), text)


def age_label(c: str | Column) -> Column:
    """Age bands in one spelling: ``a a b anos`` or ``n anos ou mais``."""
    raw = F.trim(F.regexp_replace(F.regexp_replace(F.trim(col(c).cast("string")), r"\s*[–—-]\s*", " a "), r"\s+", " "))
    text = F.lower(raw)
    low, high = (F.regexp_extract(text, r"^(\d+) a (\d+)( anos)?$", i).try_cast("int") for i in (1, 2))
    more = F.coalesce(*(F.regexp_extract(text, p, 1).try_cast("int") for p in (r"^(\d+) ?\+$", r"^(\d+)( anos)? ou mais$")))
    alone = F.regexp_extract(text, r"^(\d+)$", 1).try_cast("int")
    return (
        F.when(low.isNotNull(), F.concat(low.cast("string"), F.lit(" a "), high.cast("string"), F.lit(" anos")))
        .when(more.isNotNull(), F.concat(more.cast("string"), F.lit(" anos ou mais")))
        .when(alone >= 70, F.concat(alone.cast("string"), F.lit(" anos ou mais")))
        .otherwise(raw)
    )


def lower_bound(label: str | Column, none: int = 99999) -> Column:
    """The first number of an age label."""
    return F.coalesce(F.regexp_extract(col(label), r"(\d+)", 1).try_cast("int"), F.lit(none))


def title(c: str | Column) -> Column:
    """A title whose place is missing names the whole state; en dashes become em dashes."""
    text = F.trim(col(c).cast("string"))
    dash = F.when(text.contains("—"), F.lit("—")).when(text.contains("-"), F.lit("-"))
    right = F.lower(F.trim(F.element_at(F.split(text, dash, 2), 2)))
    bad = F.coalesce(F.lower(text).isin("", "undefined"), F.lit(True)) | F.coalesce(right.isin("", "undefined"), F.lit(False))
    return F.when(bad, WHOLE_STATE).otherwise(F.translate(text, "–", "—"))
