"""Census-shaped tables derived from the star-schema tables, and the same derivation in SQL.

A line item is a cell of people: its supplier is the tract, the supplier's nation the municipality, its status the sex, its
part's size the age and its quantity the number of people.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractworks.household_groups import HOUSEHOLD_GROUPS
from tractworks.operators.normalize import normalized
from tractworks.operators.regions import unified
from tractworks.vocabulary import BANDS, SEXES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD_SETOR, CD_MUN, NM_MUN, region, sexo, idade, pop, ano: one row per cell."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linestatus", "l_quantity", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    tracts = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name", "n_regionkey")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(tracts, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").cast("string").alias("CD_SETOR"),
        F.lpad(F.col("s_nationkey").cast("string"), 7, "0").alias("CD_MUN"),
        F.col("n_name").alias("NM_MUN"),
        F.col("n_regionkey").alias("regiao"),
        F.when(F.col("l_linestatus") == "O", "Masculino").otherwise("Feminino").alias("sexo"),
        ((F.col("p_size") - 1) * 2).alias("idade"),
        F.col("l_quantity").alias("pop"),
        F.year("l_shipdate").alias("ano"),
    )


def band_number(age: Column) -> Column:
    return F.when(age < 30, F.floor(age / 5)).when(age < 70, F.floor(age / 10) + 3).otherwise(10).cast("int")


def raw_tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide tract table with headers as files have them; every seventh tract lacks its first count.

    Missing labels are spelled in several ways, and the immediate region holds municipalities of metropolitan regions and agglomerations too.
    """
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linestatus", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    cells = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "l_linestatus", "l_quantity", band_number((F.col("p_size") - 1) * 2).alias("k"))
    sums = [
        F.coalesce(F.sum(F.when((F.col("l_linestatus") == ("O" if s == "Masculino" else "F")) & (F.col("k") == i), F.col("l_quantity"))), F.lit(0.0)).cast("bigint").alias(f"Sexo {s.lower()}, {b}")
        for s in SEXES
        for i, b in enumerate(BANDS)
    ]
    wide = cells.groupBy("l_suppkey").agg(*sums, F.sum("l_quantity").cast("bigint").alias("__people"))
    first = f"Sexo masculino, {BANDS[0]}"
    wide = wide.withColumn(first, F.when(F.col("l_suppkey") % 7 != 3, F.col(f"`{first}`")))
    tracts = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key, region = F.col("s_suppkey"), F.col("n_regionkey")
    attributes = tracts.select(
        key.alias("__key"),
        F.concat(F.lit("S"), key.cast("string")).alias("GEOCODIGO_SETOR_CENSITARIO"),
        F.lpad(F.col("s_nationkey").cast("string"), 7, "0").alias("COD_MUN"),
        F.col("n_name").alias("Nome do Município"),
        F.when(key % 13 == 12, "33").otherwise("35").alias("UF_CODIGO"),
        (key % 10).cast("string").alias("COD_SITUACAO_DETALHADA"),
        (key % 11).cast("double").alias("COD_TIPO_SETOR"),
        F.when(region == 2, "RM Asia").when(region == 3, " RM Europa").when(region == 1, "undefined").alias("RM_NOME"),
        F.when(region == 0, "AU Africa").when((region == 3) & (F.col("s_nationkey") % 2 == 0), "AU Europa").when(region == 1, "—").alias("AU_NOME"),
        F.concat(F.lit("Int "), region.cast("string")).alias("NM_RGINT"),
        F.when((region == 4) | (region.isin(0, 2) & (F.col("s_nationkey") % 2 == 0)), "Imediata Oriente").otherwise(" NaN ").alias("NM_RGI"),
        (F.col("s_acctbal")).alias("AREA_KM2"),
    )
    return attributes.join(wide, attributes["__key"] == wide["l_suppkey"]).withColumn("v0001", F.col("__people") + F.col("__key") % 3 - 1).drop("l_suppkey", "__people", "__key")


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table in canonical form with unified regions."""
    return unified(normalized(raw_tracts(spark, sf_dir)))


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD_MUN and one column per order priority and status: orders of the customers of a nation, by customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = lambda c, v: F.sum(F.when(F.col(c) == v, 1).otherwise(0)).cast("bigint").alias(v)
    counts = orders.groupBy("o_custkey").agg(*(n("o_orderpriority", p) for p in PRIORITIES), *(n("o_orderstatus", s) for s in STATUSES))
    return counts.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(F.lpad(F.col("c_nationkey").cast("string"), 7, "0").alias("CD_MUN"), *(F.col(f"`{c}`") for c in (*PRIORITIES, *STATUSES)))


def wide_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CD_MUN and all household columns of the groups: orders of a customer, the n-th column those whose key leaves the remainder n."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    counts = orders.groupBy("o_custkey").agg(*(F.sum(F.when(F.col("o_orderkey") % len(HOUSEHOLD_COLUMNS) == i, 1).otherwise(0)).cast("bigint").alias(c) for i, c in enumerate(HOUSEHOLD_COLUMNS)))
    return counts.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(F.lpad(F.col("c_nationkey").cast("string"), 7, "0").alias("CD_MUN"), *(F.col(f"`{c}`") for c in HOUSEHOLD_COLUMNS))


HOUSEHOLD_COLUMNS = tuple(dict.fromkeys(c for _, _, _, columns in HOUSEHOLD_GROUPS for c in columns))
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")
GROUPS = (("prioridade", "Prioridade", "bar", PRIORITIES), ("estado", "Estado", "pie", STATUSES), ("urgentes", "Urgentes", "bar", PRIORITIES[:2]))


_BAND_ROWS = ", ".join(f"({i}, '{b}')" for i, b in enumerate(BANDS))
SQL_PEOPLE = """
people AS (SELECT l_suppkey::VARCHAR AS cd_setor, l_suppkey AS sup, lpad(s_nationkey::VARCHAR, 7, '0') AS cd_mun, n_name AS nm_mun, n_regionkey AS rk, s_nationkey AS nk,
  CASE l_linestatus WHEN 'O' THEN 'Masculino' ELSE 'Feminino' END AS sexo, (p_size - 1) * 2 AS idade, l_quantity AS pop, year(l_shipdate) AS ano
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
SQL_TRACTS = f"""{SQL_PEOPLE},
bands(ord, band) AS (VALUES {_BAND_ROWS}), sexes(sexo) AS (VALUES ('Masculino'), ('Feminino')),
tr AS (SELECT s_suppkey AS sup, s_suppkey::VARCHAR AS cd_setor, lpad(s_nationkey::VARCHAR, 7, '0') AS cd_mun, n_name AS nm_mun, CASE WHEN s_suppkey % 13 = 12 THEN '33' ELSE '35' END AS uf,
  (s_suppkey % 10)::INTEGER AS sit, (s_suppkey % 11)::INTEGER AS tipo, CASE WHEN s_suppkey % 10 IN (1, 2, 3) THEN 'Urbana' ELSE 'Rural' END AS situacao,
  CASE n_regionkey WHEN 2 THEN 'RM Asia' WHEN 3 THEN 'RM Europa' END AS rm, CASE WHEN n_regionkey = 0 THEN 'AU Africa' WHEN n_regionkey = 3 AND s_nationkey % 2 = 0 THEN 'AU Europa' END AS au,
  'Int ' || n_regionkey AS rgint, CASE WHEN n_regionkey = 4 OR (n_regionkey IN (0, 2) AND s_nationkey % 2 = 0) THEN 'Imediata Oriente' END AS rgi, s_acctbal AS area FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)),
t AS (SELECT tr.*, coalesce(rm, au) AS reg, CASE WHEN rm IS NOT NULL THEN 'RM' WHEN au IS NOT NULL THEN 'AU' END AS treg, v.v0001 FROM tr JOIN (SELECT sup, sum(pop)::BIGINT + sup % 3 - 1 AS v0001 FROM people GROUP BY sup) v USING (sup)),
cell AS (SELECT sup, sexo, CASE WHEN idade < 30 THEN idade // 5 WHEN idade < 70 THEN idade // 10 + 3 ELSE 10 END AS ord, sum(pop) AS n FROM people GROUP BY ALL),
l AS (SELECT t.*, s.sexo, b.ord, b.band, CASE WHEN t.sup % 7 = 3 AND b.ord = 0 AND s.sexo = 'Masculino' THEN 0 ELSE coalesce(c.n, 0) END::BIGINT AS valor
  FROM t CROSS JOIN bands b CROSS JOIN sexes s LEFT JOIN cell c ON c.sup = t.sup AND c.ord = b.ord AND c.sexo = s.sexo)"""
