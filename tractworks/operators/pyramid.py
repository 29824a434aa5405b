"""Age pyramids: reshaping, aggregation, padding and tables.

Sums are taken before columns become rows wherever both orders give the same result, so a pyramid of any level shuffles
one row per place and task, not 22 rows per tract.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractworks.functions import codes
from tractworks.vocabulary import BANDS, FIVE_YEAR_BANDS, SEXES

# The columns that a tract's rows keep.
CONTEXT = (
    "CD_SETOR", "CD_MUN", "NM_MUN", "CD_UF", "NM_UF", "CD_SITUACAO", "SITUACAO", "SITUACAO_DET_TXT", "CD_TIPO", "TP_SETOR_TXT", "RM_NOME", "AU_NOME",
    "NM_RGINT", "NM_RGI", "REGIAO_RM_AU", "TIPO_RM_AU", "NOME_RM_AU", "AREA_KM2", "V0001",
)


def age_columns(names: Sequence[str]) -> list[tuple[str, str, str, int]]:
    """(column, sex, band, order) of the sex-by-age columns among header names; fails if there is none."""
    out = []
    for sex in SEXES:
        for k, band in enumerate(BANDS):
            pattern = re.compile(rf"\s*sexo\s+{sex.lower()}\s*,\s*{re.escape(band)}\s*(_\d+)?\s*", re.I)
            found = next((n for n in names if pattern.fullmatch(n)), None)
            if found is not None:
                out.append((found, sex, band, k))
    if not out:
        raise ValueError("no sex-by-age columns")
    return out


def cell(name: str) -> Column:
    """A count: fractions are cut off, null and what is no number count zero."""
    return F.coalesce(codes.number(name).cast("bigint"), F.lit(0).cast("bigint"))


def _rows(ids: list[Column], cells: list[tuple[Column, str, str, int]]) -> list[Column]:
    items = F.array(*(F.struct(v.alias("valor"), F.lit(s).alias("sexo"), F.lit(b).alias("idade_grupo"), F.lit(k).alias("ord")) for v, s, b, k in cells))
    return [*ids, F.inline(items)]


def to_long(wide: DataFrame) -> DataFrame:
    """One row per tract, sex and band, with the tract's context columns."""
    ids = [F.col(c) for c in CONTEXT if c in wide.columns]
    return wide.select(*_rows(ids, [(cell(n), s, b, k) for n, s, b, k in age_columns(wide.columns)]))


def pyramid(wide: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """keys, idade_grupo, ord, sexo, valor: all bands and sexes of every place of a wide table (null keys are a place)."""
    cells = age_columns(wide.columns)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    sums = wide.groupBy(*keys).agg(*(F.sum(cell(n)).alias(f"__{i}") for i, (n, _, _, _) in enumerate(cells)))
    names = [c for c in sums.columns if not c.startswith("__")]
    return sums.select(*_rows([F.col(f"`{c}`") for c in names], [(F.col(f"__{i}"), s, b, k) for i, (_, s, b, k) in enumerate(cells)]))


def by_levels(wide: DataFrame, places: dict[str, Column]) -> DataFrame:
    """level, place, idade_grupo, ord, sexo, valor: the pyramids of all levels from one pass over the tracts.

    A tract's row stands for its place on each level; tasks sum these before the one shuffle, so that what moves is a row per place,
    level and task. ``places`` names each level's place; null places are a place, as in :func:`pyramid`.
    """
    cells = age_columns(wide.columns)
    at = F.array(*(F.struct(F.lit(level).alias("level"), place.cast("string").alias("place")) for level, place in places.items()))
    rows = wide.select(*(cell(n).alias(f"__{i}") for i, (n, _, _, _) in enumerate(cells)), F.inline(at))
    sums = rows.groupBy("level", "place").agg(*(F.sum(f"__{i}").alias(f"__{i}") for i in range(len(cells))))
    return sums.select(*_rows([F.col("level"), F.col("place")], [(F.col(f"__{i}"), s, b, k) for i, (_, s, b, k) in enumerate(cells)]))


def sum_by_sex_and_band(long: DataFrame, keys: Sequence[str], drop_null: bool = True) -> DataFrame:
    """Long tables: sums by keys, band and sex; rows with a null key go, or are a place of their own."""
    by = [*keys, "idade_grupo", "sexo"]
    return (long.dropna(subset=by) if drop_null else long).groupBy(*by).agg(F.sum("valor").cast("bigint").alias("valor"))


def padded(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every place with all canonical bands and both sexes, zero where there is no row; other bands go.

    Each place's rows are summed into its 22 cells in one pass, so nothing is joined.
    """
    cells = [(s, b, k) for s in SEXES for k, b in enumerate(BANDS)]
    label = codes.age_label("idade_grupo")
    sums = long.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when((F.col("sexo") == s) & (label == b), F.col("valor"))), F.lit(0)).cast("bigint").alias(f"__{i}") for i, (s, b, _) in enumerate(cells)))
    return sums.select(*_rows([F.col(k) for k in keys], [(F.col(f"__{i}"), s, b, k) for i, (s, b, k) in enumerate(cells)]))


def series(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plot series: men to the left (negative), null counts zero, sex by its first letter."""
    value = F.coalesce(F.col("valor"), F.lit(0))
    return long.select(*keys, "idade_grupo", "sexo", F.when(F.lower("sexo").startswith("m"), -value).otherwise(value).alias("x"), label_order("idade_grupo").alias("ordem"))


def label_order(label: str) -> Column:
    """A band's index in the canonical order, else its lower bound, else 99999."""
    index = F.coalesce(*(F.when(F.col(label) == b, F.lit(k)) for k, b in enumerate(BANDS)))
    return F.coalesce(index, codes.lower_bound(label))


def chart_order(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, idade_grupo, ordem: the five-year order where all labels of a place are of it, else the canonical one, else lower bounds."""
    labels = long.select(*keys, "idade_grupo").distinct()
    w = Window.partitionBy(*keys)
    five = F.coalesce(*(F.when(F.col("idade_grupo") == b, F.lit(k)) for k, b in enumerate(FIVE_YEAR_BANDS)))
    ten = F.coalesce(*(F.when(F.col("idade_grupo") == b, F.lit(k)) for k, b in enumerate(BANDS)))
    order = F.when(F.min(five.isNotNull()).over(w), five).when(F.min(ten.isNotNull()).over(w), ten).otherwise(codes.lower_bound("idade_grupo"))
    return labels.withColumn("ordem", order)


def ranked(rows: DataFrame, keys: Sequence[str], by: Sequence[str | Column], name: str = "posicao") -> DataFrame:
    """``rows`` with each one's position at its place in the order of ``by``, nulls last."""
    order = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in by]
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def share(part: Column, total: Column, decimals: int | None = 1) -> Column:
    """Percent, zero where the total is; rounded half to even."""
    value = F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))
    return value if decimals is None else F.bround(value, decimals)


def band_table(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per place and band: masculino, feminino, total and the shares of each sex."""
    by_sex = [F.coalesce(F.sum(F.when(F.col("sexo") == s, F.col("valor"))), F.lit(0)).cast("bigint").alias(s.lower()) for s in SEXES]
    table = long.groupBy(*keys, "idade_grupo").agg(*by_sex).withColumn("total", F.col("masculino") + F.col("feminino"))
    return table.select(*keys, "idade_grupo", "masculino", "feminino", "total", share(F.col("masculino"), F.col("total")).alias("pct_masculino"), share(F.col("feminino"), F.col("total")).alias("pct_feminino"), label_order("idade_grupo").alias("ordem"))


def with_total(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A band table with a TOTAL row per place."""
    sums = table.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("masculino", "feminino", "total")))
    total = sums.select(*keys, F.lit("TOTAL").alias("idade_grupo"), "masculino", "feminino", "total", share(F.col("masculino"), F.col("total")).alias("pct_masculino"), share(F.col("feminino"), F.col("total")).alias("pct_feminino"), F.lit(100000).alias("ordem"))
    return table.unionByName(total)


def with_share(table: DataFrame, keys: Sequence[str], decimals: int | None = 1) -> DataFrame:
    """pct_do_total: each band's share of its place; TOTAL rows have 100."""
    bands = F.sum(F.when(F.col("idade_grupo") != "TOTAL", F.col("total"))).over(Window.partitionBy(*keys))
    return table.withColumn("pct_do_total", F.when(F.col("idade_grupo") == "TOTAL", F.lit(100.0)).otherwise(share(F.col("total"), bands, decimals)))


def sex_summary(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    men, women = (F.coalesce(F.sum(F.when(F.col("sexo") == s, F.col("valor"))), F.lit(0)).cast("bigint") for s in SEXES)
    sums = long.groupBy(*keys).agg(men.alias("masculino"), women.alias("feminino")).withColumn("total", F.col("masculino") + F.col("feminino"))
    return sums.select("*", share(F.col("masculino"), F.col("total")).alias("pct_masculino"), share(F.col("feminino"), F.col("total")).alias("pct_feminino"))


def five_year_to_canonical(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Five-year bands summed into the canonical ones; labels of neither list go."""
    low = codes.lower_bound(codes.age_label("idade_grupo"))
    k = F.when(low < 30, F.floor(low / 5)).when(low < 70, F.floor(low / 10) + 3).otherwise(F.lit(10)).cast("int")
    canonical = F.element_at(F.array(*map(F.lit, BANDS)), k + 1)
    known = codes.age_label("idade_grupo").isin(*FIVE_YEAR_BANDS, *BANDS)
    return long.where(known).groupBy(*keys, "sexo", canonical.alias("idade_grupo")).agg(F.sum("valor").cast("bigint").alias("valor"))
