"""Dependency, ageing and support indicators."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractworks.functions.codes import number
from tractworks.vocabulary import RANGES

RATIOS = {
    "RDT": ("pop_0_14 + pop_65p", "pop_15_64", 100), "RDJ": ("pop_0_14", "pop_15_64", 100), "RDI": ("pop_65p", "pop_15_64", 100), "OADR": ("pop_65p", "pop_20_64", 100), "PSR": ("pop_20_64", "pop_65p", 1),
    "IE_60p": ("pop_60p", "pop_0_14", 100), "IE_65p": ("pop_65p", "pop_0_14", 100), "Prop_80p": ("pop_80p", "pop_total", 100), "TBN_proxy": ("pop_idade0", "pop_total", 1000),
}


def group_sums(age: Column, pop: Column, within: Column | None = None, suffix: str = "") -> list[Column]:
    """Sums of the population by age group, on request only of rows ``within``; ages that are no number count only in the total."""

    def total(name: str, when: Column | None = None) -> Column:
        conditions = [c for c in (when, within) if c is not None]
        value = pop if not conditions else F.when(reduce(Column.__and__, conditions), pop)
        return F.coalesce(F.sum(value), F.lit(0.0)).alias(name + suffix)

    return [
        total("pop_0_14", age.between(0, 14)), total("pop_15_64", age.between(15, 64)), total("pop_20_64", age.between(20, 64)), total("pop_60p", age >= 60),
        total("pop_65p", age >= 65), total("pop_80p", age >= 80), total("pop_total"), total("pop_idade0", age == 0),
    ]


def age_groups(df: DataFrame, keys: Sequence[str], age: str = "idade", pop: str = "pop") -> DataFrame:
    """Population of the age groups per place, in one pass."""
    return df.groupBy(*keys).agg(*group_sums(number(age), number(pop)))


def ratio(name: str, suffix: str = "") -> Column:
    """An indicator from group sums; null where the denominator is zero."""
    a, b, k = RATIOS[name]
    return F.try_divide(F.expr(re.sub(r"pop_\w+", lambda m: m[0] + suffix, a)), F.col(b + suffix)) * F.lit(float(k))


def with_indicators(groups: DataFrame) -> DataFrame:
    """The ratios; null where a denominator is zero."""
    return groups.withColumns({n: ratio(n) for n in RATIOS})


def with_flags(groups: DataFrame, least: float = 500) -> DataFrame:
    return groups.withColumn("denominador_pequeno", F.col("pop_15_64") < least)


def indicators(df: DataFrame, keys: Sequence[str], age: str = "idade", pop: str = "pop") -> DataFrame:
    """Groups, indicators and flags per place; rows with a null key go."""
    return with_flags(with_indicators(age_groups(df.dropna(subset=list(keys)), keys, age, pop)))


def level_of(name: str) -> Column:
    """low, medium or high by the reference range; for the support ratio few supporters are a high value of pressure."""
    low, high = RANGES[name]
    v = F.col(name)
    if name == "PSR":
        return F.when(v > high, "baixo").when(v >= low, "médio").when(v.isNotNull(), "alto")
    return F.when(v < low, "baixo").when(v <= high, "médio").when(v.isNotNull(), "alto")


def with_levels(table: DataFrame) -> DataFrame:
    return table.withColumns({f"nivel_{n}": level_of(n) for n in RANGES})


def profile() -> Column:
    """Jovem, Envelhecido or Intermediário."""
    young = (F.col("RDJ") > RANGES["RDJ"][1]) & (F.col("IE_65p") < RANGES["IE_65p"][0])
    old = (F.col("RDI") > RANGES["RDI"][1]) & (F.col("IE_65p") > RANGES["IE_65p"][1])
    return F.when(young, "Jovem").when(old, "Envelhecido").otherwise("Intermediário")


def change(df: DataFrame, keys: Sequence[str], year: str, before: int, after: int, names: Sequence[str] = ("RDT", "IE_65p"), age: str = "idade", pop: str = "pop") -> DataFrame:
    """Indicators of two years side by side and their difference, of places that have rows of both years; one pass over the data."""
    rows = df.dropna(subset=list(keys)).where(F.col(year).isin(before, after))
    years = {"_antes": F.col(year) == before, "_depois": F.col(year) == after}
    sums = [c for suffix, within in years.items() for c in (*group_sums(number(age), number(pop), within, suffix), F.count(F.when(within, 1)).alias(f"__n{suffix}"))]
    both = rows.groupBy(*keys).agg(*sums).where("__n_antes > 0 and __n_depois > 0")
    both = both.select(*keys, *(ratio(n, suffix).alias(n + suffix) for suffix in years for n in names))
    return both.select("*", *((F.col(f"{n}_depois") - F.col(f"{n}_antes")).alias(f"{n}_dif") for n in names))
