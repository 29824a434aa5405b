"""Sources: tract tables, pyramid CSV files, saved statistics responses, region compositions, column maps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.functions.codes import municipality_code, normal_name, number
from tractworks.vocabulary import REGION_CODES, REGION_NAMES

_STATE = re.compile(r"^(CD_UF|CODIGO_DA_UNIDADE_DA_FEDERACAO|UF_CODIGO)$", re.I)


def of_state(tracts: DataFrame, state: str = "35", limit: int | None = None) -> DataFrame:
    """Rows of one state, by the first column that holds state codes; all rows if there is none. ``limit`` has no order."""
    named = next((c for c in tracts.columns if _STATE.match(c)), None)
    if named is not None:
        tracts = tracts.where(F.col(f"`{named}`").cast("string") == state)
    return tracts if limit is None else tracts.limit(limit)


def read_tracts(spark: SparkSession, path: str, state: str = "35", limit: int | None = None) -> DataFrame:
    """A tract table in Parquet, filtered by state in the scan; a missing path fails."""
    return of_state(spark.read.parquet(path), state, limit)


PYRAMID_NAMES = {"idade": "idade_grupo", "grupo_idade": "idade_grupo", "sexo_cat": "sexo", "quantidade": "valor", "populacao": "valor"}


def pyramid_columns(table: DataFrame) -> DataFrame:
    """Synonyms renamed, ``cod`` and ``nome`` added where missing; fails without the three needed columns."""
    table = table.withColumnsRenamed({old: new for old, new in PYRAMID_NAMES.items() if old in table.columns and new not in table.columns})
    missing = [c for c in ("idade_grupo", "sexo", "valor") if c not in table.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    for c in ("cod", "nome"):
        if c not in table.columns:
            table = table.withColumn(c, F.lit(None).cast("string"))
    return table


def read_pyramid(spark: SparkSession, path: str) -> DataFrame:
    table = pyramid_columns(spark.read.csv(path, header=True))
    return table.withColumn("valor", F.col("valor").try_cast("bigint"))


_ITEM = T.MapType(T.StringType(), T.StringType())


def _reshaped(items: DataFrame) -> DataFrame:
    """Objects in a map column ``r`` as rows sexo, idade_grupo, valor, cod, nome.

    Without an age dimension (no D3N and no D4N) sex is ``Total`` and D2N is the age band.
    """
    r = lambda k: F.col("r")[k]
    age = F.coalesce(r("D3N"), r("D4N"))
    return items.select(
        F.when(age.isNull(), F.lit("Total")).otherwise(r("D2N")).alias("sexo"),
        F.coalesce(age, r("D2N")).alias("idade_grupo"),
        number(r("V")).alias("valor"),
        r("D1C").alias("cod"),
        r("D1N").alias("nome"),
    )


def reshape_statistics(raw: DataFrame, json_col: str = "value") -> DataFrame:
    """Saved API responses (one JSON array of objects a row, the first one a header) as rows sexo, idade_grupo, valor, cod, nome."""
    items = F.from_json(json_col, T.ArrayType(_ITEM))
    return _reshaped(raw.select(F.explode(F.slice(items, 2, 1_000_000_000)).alias("r")))


def array_elements(spark: SparkSession, path: str, skip_first: bool = True) -> DataFrame:
    """(value): the objects of JSON arrays in files, a row each, without the first of each array (its header).

    Files are cut at closing braces by Spark's text source, so many tasks read one file and no row holds a whole array. A brace
    inside a text leaves an odd number of quotes before it; where a file has such braces, the running parity of quotes (per part of a
    file, then over its parts) tells which pieces belong together. Objects are flat, with values of any simple kind; an array may span
    lines, and a file may hold several.
    """
    raw = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    bare = F.regexp_replace("value", r"\\.", "")
    rows = raw.withColumn("odd", (F.length(bare) - F.length(F.replace(bare, F.lit('"')))) % 2)
    if rows.agg(F.max("odd")).first()[0]:  # one number
        before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        here = Window.partitionBy("f", "b").orderBy("seq")
        rows = rows.withColumn("seq", F.monotonically_increasing_id())

        def ahead(counts: DataFrame, c: str) -> DataFrame:
            """Each part of a file with the sum of ``c`` over the parts before it."""
            return counts.groupBy("f", "b").agg(F.sum(c).alias("n")).select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

        parity = F.col("ahead") + F.sum("odd").over(here.rowsBetween(Window.unboundedPreceding, 0))
        ended = rows.join(ahead(rows, "odd"), ["f", "b"]).withColumn("end", (parity + 1) % 2).drop("ahead")
        nth = F.col("ahead") + F.coalesce(F.sum("end").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = ended.join(ahead(ended, "end"), ["f", "b"]).withColumn("nth", nth)
        pieces = F.array_sort(F.collect_list(F.struct("b", "seq", "value")))
        rows = placed.groupBy("f", "nth").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "}").alias("value"))
    lead = F.regexp_extract("value", r"^[\s\ufeff,\[\]]*", 0)
    kept = rows.where(~lead.contains("[")) if skip_first else rows
    text = F.substring(F.col("value"), F.length(lead) + 1, F.length("value"))
    return kept.where(text.startswith("{")).select(F.concat(text, F.lit("}")).alias("value"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Saved API responses in files of any length, element by element, reshaped."""
    return _reshaped(array_elements(spark, path).select(F.from_json("value", _ITEM).alias("r")))


def region_composition(table: DataFrame, kind: str, state: str | None = "SP") -> DataFrame:
    """(CD_MUN, name) of metropolitan regions (``RM``) or urban agglomerations (``AU``) from a composition table.

    Column names are matched without accents and case. The state filter applies where the three exact columns exist. Of
    several names of one code the greatest is taken.
    """
    names = {normal_name(c): c for c in table.columns}
    code = next((names[c] for c in ("COD_MUN", *REGION_CODES) if c in names), None)
    exact = {"COD_MUN", "NOME_CATMETROPOL", "SIGLA_UF"} <= names.keys()
    label = names["NOME_CATMETROPOL"] if exact else next((names[c] for c in REGION_NAMES[kind] if c in names), None)
    if code is None or label is None:
        raise ValueError("no code and name columns are recognised")
    if exact and state is not None:
        table = table.where(F.col(f"`{names['SIGLA_UF']}`") == state)
    out = table.select(municipality_code(code).alias("CD_MUN"), F.col(f"`{label}`").alias("nome")).dropna()
    return out.groupBy("CD_MUN").agg(F.max("nome").alias("nome"))


def column_map(table: DataFrame, columns: Sequence[str], old: str = "parquet_column", new: str = "app_equivalent") -> dict[str, str]:
    """Renames of a file's columns from a mapping table: both names there and different; of several new names the greatest.

    At most one row for each of ``columns`` comes to the driver, however long the mapping is.
    """
    rows = table.select(F.trim(old).alias("old"), F.trim(new).alias("new")).where(F.col("old").isin(*columns)).where("old <> '' and new <> '' and old <> new")
    return {r.old: r.new for r in rows.groupBy("old").agg(F.max("new").alias("new")).orderBy("old").collect()}
