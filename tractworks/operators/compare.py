"""Places compared with the region they belong to.

A municipality's comparator is its metropolitan region, else its urban agglomeration, else its immediate region, else the whole
state; it holds all tracts of that region, whatever the comparators of their municipalities are. Everything comes from one row of
sums per municipality, with a part for each set of regions its tracts name, so the tracts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractworks.operators.pyramid import age_columns, cell, share
from tractworks.vocabulary import BANDS, SEXES, WHOLE_STATE


def comparator(rm: Column, au: Column, immediate: Column) -> Column:
    return F.coalesce(*regions(rm, au, immediate))


def regions(rm: Column, au: Column, immediate: Column) -> list[Column]:
    """The regions of which a municipality is a part: RM or else AU, immediate region, state; null where it has none."""
    return [F.coalesce(F.concat(F.lit("RM — "), rm), F.concat(F.lit("AU — "), au)), F.concat(F.lit("Região Imediata — "), immediate), F.lit(WHOLE_STATE)]


def municipal(wide: DataFrame) -> DataFrame:
    """CD_MUN, comparador, masculino, feminino, partes: per municipality its people by band, in band order, and its parts.

    A part is (regioes, masculino, feminino): the tracts of the municipality that name the same regions. Mostly there is one; where tracts
    of a municipality name different regions, each region gets the people of its own tracts. The comparator is by the smallest names.
    """
    columns = {(sex, k): name for name, sex, _, k in age_columns(wide.columns)}
    sums = {(s, k): F.sum(cell(columns[s, k])).alias(f"__{s[0]}{k}") for s in SEXES for k in range(len(BANDS)) if (s, k) in columns}
    label = lambda c, name: (F.col(c).cast("string") if c in wide.columns else F.lit(None).cast("string")).alias(name)
    labels = ("__rm", "__au", "__rgi")
    one = wide.groupBy("CD_MUN", *map(label, ("RM_NOME", "AU_NOME", "NM_RGI"), labels)).agg(*sums.values())
    bands = lambda s: F.array(*(F.col(f"__{s[0]}{k}") if (s, k) in sums else F.lit(0).cast("bigint") for k in range(len(BANDS)))).alias(s.lower())
    parts = one.select("CD_MUN", *labels, F.array_compact(F.array(*regions(*map(F.col, labels)))).alias("regioes"), *map(bands, SEXES))
    total = lambda s: F.array(*(F.sum(F.col(s.lower())[k]) for k in range(len(BANDS)))).alias(s.lower())
    whole = parts.groupBy("CD_MUN").agg(*map(total, SEXES), *(F.min(c).alias(c) for c in labels), F.collect_list(F.struct("regioes", *(s.lower() for s in SEXES))).alias("partes"))
    return whole.select("CD_MUN", comparator(*map(F.col, labels)).alias("comparador"), *(s.lower() for s in SEXES), "partes")


def comparator_keys(wide: DataFrame) -> DataFrame:
    return municipal(wide).select("CD_MUN", "comparador")


def region_sums(places: DataFrame) -> DataFrame:
    """comparador, totals: people by band of every region that a part of :func:`municipal` names."""
    total = F.zip_with("p.masculino", "p.feminino", lambda m, f: m + f)
    rows = places.select(F.explode("partes").alias("p")).select(F.explode("p.regioes").alias("comparador"), total.alias("t"))
    sums = rows.groupBy("comparador").agg(*(F.sum(F.col("t")[k]).alias(f"__{k}") for k in range(len(BANDS))))
    return sums.select("comparador", F.array(*(F.col(f"__{k}") for k in range(len(BANDS)))).alias("totals"))


def _all(counts: str | Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def comparator_bands(places: DataFrame) -> DataFrame:
    """comparador, idade_grupo, total, pct: bands of the regions that are some municipality's comparator."""
    used = region_sums(places).join(places.select("comparador").distinct(), "comparador", "left_semi")
    row = lambda k: F.struct(F.lit(BANDS[k]).alias("idade_grupo"), F.col("totals")[k].alias("total"), share(F.col("totals")[k], _all("totals"), None).alias("pct"))
    return used.select("comparador", F.inline(F.array(*map(row, range(len(BANDS))))))


def band_table_with_delta(places: DataFrame) -> DataFrame:
    """The band table of every municipality with shares and their difference, in points, to the comparator's."""
    theirs = region_sums(places)
    m, f, people = F.col("masculino"), F.col("feminino"), F.zip_with("masculino", "feminino", lambda a, b: a + b)

    def row(band: str, order: int, men: Column, women: Column, of_total: Column, theirs: Column) -> Column:
        both = men + women
        delta = of_total - theirs
        return F.struct(F.lit(band).alias("idade_grupo"), men.alias("masculino"), women.alias("feminino"), both.alias("total"), share(men, both).alias("pct_masculino"), share(women, both).alias("pct_feminino"), F.lit(order).alias("ordem"), of_total.alias("pct_do_total"), theirs.alias("pct_comparador"), delta.alias("delta_pp"))

    rows = [row(b, k, m[k], f[k], share(m[k] + f[k], _all(people)), F.bround(share(F.col("totals")[k], _all("totals"), None), 1)) for k, b in enumerate(BANDS)]
    rows.append(row("TOTAL", 100000, _all(m), _all(f), F.lit(100.0), F.lit(None).cast("double")))
    # the left side's rows are municipalities, the right side's regions: Spark broadcasts by measured size
    return places.where("CD_MUN is not null").join(theirs, "comparador", "left").select("CD_MUN", "comparador", F.inline(F.array(*rows)))
