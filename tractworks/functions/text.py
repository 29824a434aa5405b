"""Numbers and places as Brazilian Portuguese text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tractworks.functions.codes import clean_label, col


def brazilian(c: str | Column, decimals: int = 0) -> Column:
    """Points between thousands, a comma before decimals, rounded half to even; null is an empty text."""
    return F.coalesce(F.translate(F.format_number(col(c).cast("double"), decimals), ",.", ".,"), F.lit(""))


def percent(c: str | Column) -> Column:
    return F.when(col(c).isNull(), "").otherwise(F.concat(brazilian(c, 1), F.lit("%")))


def delta(c: str | Column) -> Column:
    """An arrow and percentage points with one decimal; nothing for null, a dash for zero."""
    d = col(c)
    points = F.concat(brazilian(F.abs(d), 1), F.lit(" pp"))
    return F.when(d.isNull(), "").when(F.abs(d) < 1e-9, "—").when(d > 0, F.concat(F.lit("▲ +"), points)).otherwise(F.concat(F.lit("▼ "), points))


def place_label(*parts: str | Column) -> Column:
    """Cleaned parts joined by an em dash, missing ones left out."""
    return F.concat_ws(" — ", *(clean_label(p) for p in parts))


def name_with_code(name: str | Column, code: str | Column) -> Column:
    return F.concat(clean_label(name), F.lit(" ("), col(code).cast("string"), F.lit(")"))
