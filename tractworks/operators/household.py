"""Household categories: totals and shares by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tractworks.functions.codes import number
from tractworks.household_groups import HOUSEHOLD_GROUPS
from tractworks.operators.pyramid import ranked


def group_table(spark: SparkSession, groups: Sequence[tuple] = HOUSEHOLD_GROUPS) -> DataFrame:
    """group_id, title, chart, column_name, pos; a column may belong to several groups."""
    rows = [(g, t, k, c, i) for g, t, k, cols in groups for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "group_id string, title string, chart string, column_name string, pos int")


def category_totals(df: DataFrame, keys: Sequence[str], groups: Sequence[tuple] = HOUSEHOLD_GROUPS) -> DataFrame:
    """keys, group_id, title, chart, column_name, valor: positive totals of the columns that the table has.

    All columns are summed in one pass per place, then one row per place becomes one per group and column.
    """
    there = [(g, t, k, c) for g, t, k, cols in groups for c in cols if c in df.columns]
    distinct = list(dict.fromkeys(c for _, _, _, c in there))
    sums = df.groupBy(*keys).agg(*(F.sum(number(c)).alias(f"__{i}") for i, c in enumerate(distinct)))
    items = F.array(*(F.struct(F.lit(g).alias("group_id"), F.lit(t).alias("title"), F.lit(k).alias("chart"), F.lit(c).alias("column_name"), F.col(f"__{distinct.index(c)}").alias("valor")) for g, t, k, c in there))
    return sums.select(*keys, F.inline(items)).where("valor > 0")


def with_group_share(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each category's part of its group at its place."""
    return totals.withColumn("share", F.col("valor") / F.sum("valor").over(Window.partitionBy(*keys, "group_id")))


def bar_series(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Categories with their place in a bar chart (``posicao``): ascending by value, equal values by column name."""
    return ranked(totals, [*keys, "group_id"], ["valor", "column_name"])


def state_and_places(df: DataFrame, key: str, groups: Sequence[tuple] = HOUSEHOLD_GROUPS) -> DataFrame:
    """Totals of every place with the whole table's beside them."""
    places = category_totals(df, [key], groups)
    state = category_totals(df, [], groups).select("group_id", "column_name", F.col("valor").alias("valor_estado"))
    return places.join(state, ["group_id", "column_name"])
