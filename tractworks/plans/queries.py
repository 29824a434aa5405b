"""Registered queries: each operator over tables derived from the given ones, with its SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractworks import api
from tractworks.functions import codes, text
from tractworks.household_groups import HOUSEHOLD_GROUPS
from tractworks.operators import catalog, compare, filters, household, indicators, normalize, pyramid, quality, regions, search, vector_index
from tractworks.plans.views import GROUPS, HOUSEHOLD_COLUMNS, SQL_PEOPLE, SQL_TRACTS, households, people, raw_tracts, table, tracts, wide_households
from tractworks.sources import storage
from tractworks.sources.readers import column_map, of_state, pyramid_columns, read_statistics, region_composition, reshape_statistics
from tractworks.sources.storage import scratch
from tractworks.sources.writers import drop_table, export_profile, reload_partitions, save_table
from tractworks.streaming import live
from tractworks.vocabulary import BANDS, SITUATIONS, TRACT_TYPES, VARIABLES, WHOLE_STATE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in mapping.items()) + " END"


T = f"WITH {SQL_TRACTS} "
P = f"WITH {SQL_PEOPLE} "
SITUATION, TYPE = _case("sit", SITUATIONS), _case("tipo", TRACT_TYPES)


# --- sources and normalisation -----------------------------------------------------------------------------------------


@query(T + "SELECT cd_mun AS \"CD_MUN\", count(*)::BIGINT AS setores, sum(v0001)::BIGINT AS pessoas FROM t WHERE uf = '35' GROUP BY 1")
def scan_state_filter(spark, d):
    wide = normalize.normalized(of_state(raw_tracts(spark, d), "35"))
    return wide.groupBy("CD_MUN").agg(F.count(F.lit(1)).alias("setores"), F.sum("V0001").alias("pessoas"))


@query(T + "SELECT s AS \"CD_UF\", least(count(uf), n)::BIGINT AS setores FROM (VALUES ('35', 40), ('33', 3), ('99', 5)) x(s, n) LEFT JOIN t ON uf = s GROUP BY s, n")
def scan_state_limit(spark, d):
    """Rows of each state, limited as asked; which rows is open, how many is not."""
    raw = raw_tracts(spark, d)
    counts = [of_state(raw, state, n).agg(F.lit(state).alias("CD_UF"), F.count(F.lit(1)).alias("setores")) for state, n in (("35", 40), ("33", 3), ("99", 5))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(T + "SELECT uf AS \"CD_UF\", count(*)::BIGINT AS n FROM t GROUP BY 1")
def state_counts(spark, d):
    return tracts(spark, d).groupBy("CD_UF").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN 'abc' END AS setor, CASE WHEN c_custkey % 5 <> 0 THEN lpad(c_custkey::VARCHAR, 7, '0') END AS municipio FROM customer")
def geo_code_normalise(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    key, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 4
    raw = c.select("c_custkey", F.when(k == 0, key).when(k == 1, F.concat(F.lit("x"), key, F.lit(".0"))).when(k == 2, F.lit("abc")).alias("raw"), F.when(F.col("c_custkey") % 5 != 0, F.concat(key, F.lit("-"))).alias("mun"))
    return raw.select("c_custkey", codes.first_digits("raw").alias("setor"), codes.municipality_code("mun").alias("municipio"))


@query(T + f"SELECT cd_setor AS \"CD_SETOR\", {SITUATION} AS situacao_txt, {TYPE} AS tipo_txt, CASE WHEN sit NOT IN (0, 4) THEN sit END AS situacao_cod, CASE WHEN tipo < 10 THEN tipo END AS tipo_cod FROM t")
def decode_codes(spark, d):
    wide = normalize.normalized(raw_tracts(spark, d)).select("CD_SETOR", "SITUACAO_DET_TXT", "TP_SETOR_TXT")
    return wide.select("CD_SETOR", F.col("SITUACAO_DET_TXT").alias("situacao_txt"), F.col("TP_SETOR_TXT").alias("tipo_txt"), codes.situation_code("SITUACAO_DET_TXT").alias("situacao_cod"), codes.tract_type_code("TP_SETOR_TXT").alias("tipo_cod"))


@query(
    "SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 5 THEN NULL WHEN s_suppkey % 10 IN (1, 2, 3) THEN 'Urbana' ELSE 'Rural' END AS do_codigo, CASE WHEN s_suppkey % 10 IN (1, 2, 3) THEN 'Urbana' ELSE 'Rural' END AS do_texto FROM supplier"
)
def urban_rural(spark, d):
    key = F.col("s_suppkey")
    raw = F.when(key % 6 == 5, "x").when(key % 6 == 4, F.concat((key % 10).cast("string"), F.lit(".0"))).otherwise((key % 10).cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", codes.urban_rural(raw).alias("do_codigo"), codes.urban_rural_of_text(codes.situation_text((key % 10).cast("string"))).alias("do_texto"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 THEN c_acctbal END AS v5, CASE WHEN c_custkey % 3 <> 1 THEN c_custkey END AS v1 FROM customer")
def numeric_coercion(spark, d):
    key = F.col("c_custkey")
    bad = key % 3 == 1
    raw = table(spark, d, "customer").select("c_custkey", F.when(bad, "n/d").otherwise(F.col("c_acctbal").cast("string")).alias("V0005"), F.when(bad, "NaN").otherwise(key.cast("string")).alias("V0001"))
    return normalize.numeric_variables(raw).select("c_custkey", F.col("V0005").alias("v5"), F.col("V0001").alias("v1"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE source END AS rotulo FROM documents")
def label_clean(spark, d):
    k = F.col("doc_id") % 5
    raw = F.when(k == 1, " NaN ").when(k == 2, "undefined").when(k == 3, "—").when(k == 4, F.concat(F.lit("  "), "source", F.lit(" "))).otherwise(F.col("source"))
    return table(spark, d, "documents").select("doc_id", codes.clean_label(raw).alias("rotulo"))


@query(
    "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_size || ' a ' || (p_size + 4) || ' anos' WHEN 1 THEN p_size || ' anos ou mais' WHEN 2 THEN p_size || ' anos ou mais' "
    "WHEN 3 THEN p_size || ' a ' || (p_size + 4) || ' anos' WHEN 4 THEN (p_size + 60)::VARCHAR || CASE WHEN p_size + 60 >= 70 THEN ' anos ou mais' ELSE '' END ELSE 'Total geral' END AS faixa, "
    "CASE WHEN p_partkey % 6 = 4 THEN p_size + 60 WHEN p_partkey % 6 = 5 THEN 99999 ELSE p_size END::INTEGER AS menor FROM part"
)
def age_label_normalise(spark, d):
    k, n = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    high = (F.col("p_size") + 4).cast("string")
    raw = F.when(k == 0, F.concat(n, F.lit("-"), high)).when(k == 1, F.concat(n, F.lit("+"))).when(k == 2, F.concat(n, F.lit(" ou mais"))).when(k == 3, F.concat(n, F.lit(" – "), high, F.lit(" anos"))).when(k == 4, (F.col("p_size") + 60).cast("string")).otherwise("Total geral")
    return table(spark, d, "part").select("p_partkey", codes.age_label(raw).alias("faixa"), codes.lower_bound(codes.age_label(raw)).alias("menor"))


@query(
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Pirâmide — ' || o_orderpriority || ' — x' ELSE '" + WHOLE_STATE + "' END AS titulo, " + _case("'V000' || (o_orderkey % 8)", VARIABLES) + " AS variavel FROM orders"
)
def titles_and_variables(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.lit(" Pirâmide – "), "o_orderpriority", F.lit(" — x"))).when(k == 1, "Pirâmide — undefined").when(k == 2, " ").otherwise("Pirâmide - ")
    return table(spark, d, "orders").select("o_orderkey", codes.title(raw).alias("titulo"), codes.variable_label(F.concat(F.lit(" v000"), (F.col("o_orderkey") % 8).cast("string"))).alias("variavel"))


@query(
    f"WITH {SQL_PEOPLE} SELECT sexo, idade_grupo, sum(valor)::BIGINT AS valor FROM (SELECT sexo, (idade // 5 * 5) || ' a ' || (idade // 5 * 5 + 4) || ' anos' AS idade_grupo, pop AS valor FROM people) GROUP BY 1, 2"
)
def pyramid_csv_columns(spark, d):
    low = F.floor(F.col("idade") / 5) * 5
    raw = people(spark, d).select(F.col("sexo").alias("sexo_cat"), F.concat(low.cast("string"), F.lit(" a "), (low + 4).cast("string"), F.lit(" anos")).alias("grupo_idade"), F.col("pop").alias("quantidade"))
    return pyramid.sum_by_sex_and_band(pyramid_columns(raw), [])


_STATISTICS = "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'Homens' ELSE 'Total' END AS sexo, CASE WHEN c_custkey % 2 = 0 THEN '0 a 4 anos' ELSE 'Homens' END AS idade_grupo, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey::DOUBLE END AS valor, c_custkey::VARCHAR AS cod, {nome} AS nome FROM customer"


def _responses(spark, d, name):
    """Responses of up to a thousand customers, each a header and an item a customer."""
    key = F.col("c_custkey")
    item = F.struct(key.cast("string").alias("D1C"), name.alias("D1N"), F.lit("Homens").alias("D2N"), F.when(key % 2 == 0, "0 a 4 anos").alias("D3N"), F.when(key % 3 == 0, "...").otherwise(key.cast("string")).alias("V"))
    header = F.struct(F.lit("Cod").alias("D1C"), F.lit("Nome").alias("D1N"), F.lit("Sexo").alias("D2N"), F.lit("Idade").alias("D3N"), F.lit("Valor").alias("V"))
    responses = table(spark, d, "customer").groupBy(F.floor(key / 1000).alias("response")).agg(F.collect_list(item).alias("items"))
    return responses.select(F.to_json(F.concat(F.array(header), "items")).alias("value"))


@query(_STATISTICS.format(nome="c_name"))
def statistics_reshape(spark, d):
    return reshape_statistics(_responses(spark, d, F.col("c_name")))


@query(_STATISTICS.format(nome="CASE WHEN c_custkey % 50 = 7 THEN c_name || '}, {\"' ELSE c_name END"))
def statistics_elements(spark, d):
    """Responses in files, read element by element; some names hold what stands between elements."""
    path = scratch(spark)
    name = F.when(F.col("c_custkey") % 50 == 7, F.concat("c_name", F.lit('}, {"'))).otherwise(F.col("c_name"))
    _responses(spark, d, name).write.text(path)
    return read_statistics(spark, path)


# --- regions -----------------------------------------------------------------------------------------------------------


def _compositions(spark, d):
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))  # a row per tract: names repeat
    key, region = F.col("n_nationkey").cast("string"), F.col("n_regionkey")
    state = F.when(F.col("n_nationkey") == 7, "RJ").otherwise("SP").alias("Sigla UF")
    rm = n.where(region.isin(2, 3)).select(key.alias("Cod Mun"), F.when(region == 2, "RM Asia").otherwise("RM Europa").alias("NOME_CATMETROPOL"), state)
    au = n.where((region == 0) | ((region == 3) & (F.col("n_nationkey") % 2 == 0))).select(key.alias("COD_MUN"), F.when(region == 0, "AU Africa").otherwise("AU Europa").alias("NOME_CATMETROPOL"), state.alias("SIGLA_UF"))
    return region_composition(rm, "RM"), region_composition(au, "AU")


_MAPS = """WITH n AS (SELECT lpad(n_nationkey::VARCHAR, 7, '0') AS cd, n_name, n_regionkey AS rk, n_nationkey AS nk FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)),
rm AS (SELECT cd, CASE rk WHEN 2 THEN 'RM Asia' ELSE 'RM Europa' END AS nome FROM n WHERE rk IN (2, 3) AND nk <> 7),
au AS (SELECT cd, CASE rk WHEN 0 THEN 'AU Africa' ELSE 'AU Europa' END AS nome FROM n WHERE (rk = 0 OR (rk = 3 AND nk % 2 = 0)) AND nk <> 7) """


@query(_MAPS + 'SELECT coalesce(rm.cd, au.cd) AS "CD_MUN", rm.nome AS "RM_NOME", au.nome AS "AU_NOME" FROM rm FULL JOIN au ON rm.cd = au.cd')
def rm_au_full_outer(spark, d):
    return regions.region_map(*_compositions(spark, d))


@query(_MAPS + 'SELECT coalesce(rm.cd, au.cd) AS "CD_MUN", n_name AS "NM_MUN", rm.nome AS "RM_NOME", au.nome AS "AU_NOME" FROM rm FULL JOIN au ON rm.cd = au.cd LEFT JOIN (SELECT DISTINCT cd, n_name FROM n JOIN supplier ON s_nationkey = nk JOIN lineitem ON l_suppkey = s_suppkey) n ON n.cd = coalesce(rm.cd, au.cd)')
def municipality_lookup(spark, d):
    return regions.municipality_lookup(tracts(spark, d), regions.region_map(*_compositions(spark, d)))


@query(_MAPS + 'SELECT s_suppkey::VARCHAR AS "CD_SETOR", rm.nome AS "RM_NOME", au.nome AS "AU_NOME", coalesce(rm.nome, au.nome) AS "REGIAO_RM_AU", CASE WHEN rm.nome IS NOT NULL THEN \'RM\' WHEN au.nome IS NOT NULL THEN \'AU\' END AS "TIPO_RM_AU" FROM supplier JOIN n ON s_nationkey = nk LEFT JOIN rm ON rm.cd = n.cd LEFT JOIN au ON au.cd = n.cd WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)')
def region_enrich(spark, d):
    base = normalize.normalized(raw_tracts(spark, d)).drop("RM_NOME", "AU_NOME")
    return regions.enriched(base, *_compositions(spark, d)).select("CD_SETOR", "RM_NOME", "AU_NOME", "REGIAO_RM_AU", "TIPO_RM_AU")


@query(T + 'SELECT cd_mun AS "CD_MUN", min(rm) AS "RM_NOME", min(au) AS "AU_NOME" FROM t GROUP BY 1')
def regions_by_municipality(spark, d):
    return regions.regions_of_municipalities(tracts(spark, d))


@query(T + "SELECT DISTINCT tipo, nome, tipo || ' — ' || nome AS rotulo FROM (SELECT 'RM' AS tipo, rm AS nome FROM t UNION ALL SELECT 'AU', au FROM t) WHERE nome IS NOT NULL")
def region_options(spark, d):
    return regions.region_options(tracts(spark, d))


# --- pyramids ----------------------------------------------------------------------------------------------------------


@query(
    T + f'''SELECT cd_setor AS "CD_SETOR", cd_mun AS "CD_MUN", nm_mun AS "NM_MUN", uf AS "CD_UF", sit::VARCHAR AS "CD_SITUACAO", situacao AS "SITUACAO", {SITUATION} AS "SITUACAO_DET_TXT", tipo::DOUBLE AS "CD_TIPO", {TYPE} AS "TP_SETOR_TXT",
rm AS "RM_NOME", au AS "AU_NOME", rgint AS "NM_RGINT", rgi AS "NM_RGI", reg AS "REGIAO_RM_AU", treg AS "TIPO_RM_AU", reg AS "NOME_RM_AU", area AS "AREA_KM2", v0001 AS "V0001", sexo, band AS idade_grupo, ord, valor FROM l'''
)
def wide_to_long(spark, d):
    """All context columns of the tracts with their cells."""
    return pyramid.to_long(tracts(spark, d))


_LEVEL_SQL = {"state": "'state'", "region": "reg", "intermediate": "rgint", "immediate": "rgi", "municipality": "cd_mun", "tract": "cd_setor"}


def _pyramid_of(level):
    def run(spark, d):
        return pyramid.pyramid(tracts(spark, d), [filters.place_key(level).alias("place")])

    run.__name__ = f"pyramid_by_{level}"
    return run


for _level, _key in _LEVEL_SQL.items():
    query(T + f"SELECT {_key} AS place, sexo, band AS idade_grupo, ord, sum(valor)::BIGINT AS valor FROM l GROUP BY ALL")(_pyramid_of(_level))


@query(T + " UNION ALL ".join(f"SELECT '{level}' AS level, {key} AS place, sexo, band AS idade_grupo, ord, sum(valor)::BIGINT AS valor FROM l GROUP BY ALL" for level, key in _LEVEL_SQL.items()))
def pyramid_all_levels(spark, d):
    """The pyramids of all levels in one job with one scan."""
    return pyramid.by_levels(tracts(spark, d), {level: filters.place_key(level) for level in _LEVEL_SQL})


@query(P + "SELECT cd_mun AS \"CD_MUN\", sexo, CASE WHEN idade < 30 THEN (idade // 5 * 5) || ' a ' || (idade // 5 * 5 + 4) || ' anos' WHEN idade < 70 THEN (idade // 10 * 10) || ' a ' || (idade // 10 * 10 + 9) || ' anos' ELSE '70 anos ou mais' END AS idade_grupo, sum(pop)::BIGINT AS valor FROM people GROUP BY ALL")
def band_rollup_5y(spark, d):
    low = F.floor(F.col("idade") / 5) * 5
    label = F.when(low >= 100, "100+").otherwise(F.concat(low.cast("string"), F.lit("-"), (low + 4).cast("string")))
    return pyramid.five_year_to_canonical(people(spark, d).select("CD_MUN", "sexo", label.alias("idade_grupo"), F.col("pop").alias("valor")), ["CD_MUN"])


@query(T + "SELECT cd_mun AS \"CD_MUN\", sexo, band AS idade_grupo, ord, sum(CASE WHEN sexo = 'Masculino' AND ord > 2 THEN 0 ELSE valor END)::BIGINT AS valor FROM l GROUP BY ALL")
def pyramid_padded(spark, d):
    long = pyramid.to_long(tracts(spark, d)).where("sexo = 'Feminino' or ord <= 2")
    return pyramid.padded(long, ["CD_MUN"])


@query(T + "SELECT cd_mun AS \"CD_MUN\", band AS idade_grupo, sexo, sum(CASE sexo WHEN 'Masculino' THEN -valor ELSE valor END)::BIGINT AS x, ord AS ordem FROM l GROUP BY ALL")
def pyramid_series(spark, d):
    return pyramid.series(pyramid.pyramid(tracts(spark, d), ["CD_MUN"]), ["CD_MUN"])


@query(
    P + "SELECT DISTINCT cd_mun AS \"CD_MUN\", CASE nk % 3 WHEN 0 THEN (idade // 5 * 5) || ' a ' || (idade // 5 * 5 + 4) || ' anos' WHEN 1 THEN CASE WHEN idade < 30 THEN (idade // 5 * 5) || ' a ' || (idade // 5 * 5 + 4) || ' anos' "
    "WHEN idade < 70 THEN (idade // 10 * 10) || ' a ' || (idade // 10 * 10 + 9) || ' anos' ELSE '70 anos ou mais' END ELSE idade || ' anos' END AS idade_grupo, "
    "CASE nk % 3 WHEN 0 THEN idade // 5 WHEN 1 THEN CASE WHEN idade < 30 THEN idade // 5 WHEN idade < 70 THEN idade // 10 + 3 ELSE 10 END ELSE idade END::INTEGER AS ordem FROM people"
)
def chart_band_order(spark, d):
    """Municipalities with five-year bands, with canonical bands and with single ages."""
    five, ten, text_of = F.floor(F.col("idade") / 5) * 5, F.floor(F.col("idade") / 10) * 10, lambda x: x.cast("string")
    five_year = F.concat(text_of(five), F.lit(" a "), text_of(five + 4), F.lit(" anos"))
    canonical = F.when(F.col("idade") < 30, five_year).when(F.col("idade") < 70, F.concat(text_of(ten), F.lit(" a "), text_of(ten + 9), F.lit(" anos"))).otherwise("70 anos ou mais")
    k = F.col("CD_MUN").cast("int") % 3
    label = F.when(k == 0, five_year).when(k == 1, canonical).otherwise(F.concat(text_of(F.col("idade")), F.lit(" anos")))
    return pyramid.chart_order(people(spark, d).select("CD_MUN", label.alias("idade_grupo")), ["CD_MUN"])


_BAND = """, b AS (SELECT {k} AS place, band AS idade_grupo, ord AS ordem, sum(CASE sexo WHEN 'Masculino' THEN valor ELSE 0 END)::BIGINT AS masculino, sum(CASE sexo WHEN 'Feminino' THEN valor ELSE 0 END)::BIGINT AS feminino FROM l {w} GROUP BY ALL),
bt AS (SELECT *, masculino + feminino AS total FROM b), tot AS (SELECT place, 'TOTAL' AS idade_grupo, 100000 AS ordem, sum(masculino)::BIGINT AS masculino, sum(feminino)::BIGINT AS feminino, sum(total)::BIGINT AS total FROM bt GROUP BY place),
u AS (SELECT * FROM bt UNION ALL SELECT * FROM tot), s AS (SELECT *, CASE WHEN total > 0 THEN round_even(masculino::DOUBLE / total * 100, 1) ELSE 0 END AS pct_masculino, CASE WHEN total > 0 THEN round_even(feminino::DOUBLE / total * 100, 1) ELSE 0 END AS pct_feminino,
CASE WHEN idade_grupo = 'TOTAL' THEN 100.0::DOUBLE WHEN (sum(total) FILTER (idade_grupo <> 'TOTAL') OVER (PARTITION BY place)) > 0 THEN round_even(total::DOUBLE / (sum(total) FILTER (idade_grupo <> 'TOTAL') OVER (PARTITION BY place)) * 100, 1) ELSE 0 END AS pct_do_total FROM u) """
_BAND_MUN = T + _BAND.format(k="cd_mun", w="")


@query(_BAND_MUN + "SELECT place AS \"CD_MUN\", idade_grupo, masculino, feminino, total, pct_masculino, pct_feminino, ordem FROM s WHERE idade_grupo <> 'TOTAL'")
def band_table(spark, d):
    return pyramid.band_table(pyramid.pyramid(tracts(spark, d), ["CD_MUN"]), ["CD_MUN"])


@query(_BAND_MUN + 'SELECT place AS "CD_MUN", idade_grupo, masculino, feminino, total, pct_masculino, pct_feminino, ordem FROM s')
def band_table_total(spark, d):
    return pyramid.with_total(pyramid.band_table(pyramid.pyramid(tracts(spark, d), ["CD_MUN"]), ["CD_MUN"]), ["CD_MUN"])


@query(_BAND_MUN + 'SELECT place AS "CD_MUN", idade_grupo, total, pct_do_total FROM s')
def share_of_total(spark, d):
    table_ = pyramid.with_total(pyramid.band_table(pyramid.pyramid(tracts(spark, d), ["CD_MUN"]), ["CD_MUN"]), ["CD_MUN"])
    return pyramid.with_share(table_, ["CD_MUN"]).select("CD_MUN", "idade_grupo", "total", "pct_do_total")


@query(T + _BAND.format(k="reg", w="") + "SELECT place AS \"REGIAO_RM_AU\", masculino, feminino, total, pct_masculino, pct_feminino FROM s WHERE idade_grupo = 'TOTAL'")
def sex_summary(spark, d):
    return pyramid.sex_summary(pyramid.pyramid(tracts(spark, d), ["REGIAO_RM_AU"]), ["REGIAO_RM_AU"])


# --- comparison --------------------------------------------------------------------------------------------------------

# a comparator holds all tracts of its region, whatever the comparators of their municipalities are
_KEYS = ", ck AS (SELECT cd_mun, coalesce('RM — ' || min(rm), 'AU — ' || min(au), 'Região Imediata — ' || min(rgi), 'Estado de São Paulo') AS comparador FROM t GROUP BY 1) "
_COMP = _KEYS + """, ms AS (SELECT treg || ' — ' || reg AS comparador, sup FROM t WHERE reg IS NOT NULL UNION ALL SELECT 'Região Imediata — ' || rgi, sup FROM t WHERE rgi IS NOT NULL UNION ALL SELECT 'Estado de São Paulo', sup FROM t),
cb AS (SELECT comparador, band AS idade_grupo, sum(valor)::BIGINT AS total FROM l JOIN ms USING (sup) WHERE comparador IN (SELECT comparador FROM ck) GROUP BY ALL),
cp AS (SELECT *, CASE WHEN sum(total) OVER (PARTITION BY comparador) > 0 THEN total::DOUBLE / sum(total) OVER (PARTITION BY comparador) * 100 ELSE 0 END AS pct FROM cb) """


def _by_municipality(spark, d, situations=None):
    wide = tracts(spark, d)
    if situations is not None:
        wide = filters.by_situation(wide, situations)
    return compare.municipal(wide)


@query(T + _KEYS + 'SELECT cd_mun AS "CD_MUN", comparador FROM ck')
def comparator_key(spark, d):
    return compare.comparator_keys(tracts(spark, d))


@query(T + _COMP + "SELECT comparador, idade_grupo, total, pct FROM cp")
def comparator_pct(spark, d):
    return compare.comparator_bands(_by_municipality(spark, d))


_DELTA = "SELECT place AS \"CD_MUN\", comparador, s.idade_grupo, masculino, feminino, s.total, pct_masculino, pct_feminino, ordem, pct_do_total, round_even(pct, 1) AS pct_comparador, pct_do_total - round_even(pct, 1) AS delta_pp FROM s JOIN ck ON ck.cd_mun = place LEFT JOIN cp USING (comparador, idade_grupo)"


@query(_BAND_MUN + _COMP + _DELTA)
def band_table_delta(spark, d):
    return compare.band_table_with_delta(_by_municipality(spark, d))


@query((T + _BAND.format(k="cd_mun", w="") + _COMP + _DELTA).replace("l AS (SELECT t.*", "l AS (SELECT t.*").replace("FROM t CROSS JOIN bands b", "FROM (SELECT * FROM t WHERE situacao = 'Urbana') t CROSS JOIN bands b").replace("FROM t GROUP BY 1)", "FROM t WHERE situacao = 'Urbana' GROUP BY 1)"))
def band_table_delta_urban(spark, d):
    return compare.band_table_with_delta(_by_municipality(spark, d, ["Urbana"]))


_SPLIT = "CASE n_regionkey WHEN 2 THEN 'RM Asia' WHEN 3 THEN 'RM Europa' END AS rm"


@query((_BAND_MUN + _COMP + _DELTA).replace(_SPLIT, f"CASE WHEN s_suppkey % 5 = 0 THEN 'RM Dividida' ELSE {_SPLIT[:-6]} END AS rm"))
def band_table_delta_split(spark, d):
    """Every fifth tract names a region of its own, so municipalities are divided between regions."""
    raw = raw_tracts(spark, d)
    tract = F.substring("GEOCODIGO_SETOR_CENSITARIO", 2, 20).cast("bigint")
    raw = raw.withColumn("RM_NOME", F.when(tract % 5 == 0, "RM Dividida").otherwise(F.col("RM_NOME")))
    return compare.band_table_with_delta(compare.municipal(regions.unified(normalize.normalized(raw))))


# --- filters -----------------------------------------------------------------------------------------------------------


@query(T + "SELECT cd_mun AS \"CD_MUN\", count(*)::BIGINT AS n FROM t WHERE situacao = 'Rural' AND tipo IN (0, 1, 2) AND sit IN (5, 6, 7, 8) GROUP BY 1")
def filter_situation_type(spark, d):
    rows = filters.by_tract_type(filters.by_situation_code(filters.by_situation(tracts(spark, d), ["Rural"]), [5, 6, 7, 8]), [0, 1, 2])
    return rows.groupBy("CD_MUN").agg(F.count(F.lit(1)).alias("n"))


@query(T + "SELECT treg AS \"TIPO_RM_AU\", reg AS \"REGIAO_RM_AU\", count(*)::BIGINT AS n FROM t WHERE (treg, reg) IN (('RM', 'RM Asia'), ('AU', 'AU Africa')) GROUP BY 1, 2")
def filter_region_pairs(spark, d):
    return filters.by_regions(tracts(spark, d), ["RM — RM Asia", "au: AU Africa"]).groupBy("TIPO_RM_AU", "REGIAO_RM_AU").agg(F.count(F.lit(1)).alias("n"))


@query(T + "SELECT cd_mun AS \"CD_MUN\", count(*)::BIGINT AS n FROM t WHERE cd_mun IN (SELECT cd_mun FROM t WHERE tipo = 3) GROUP BY 1")
def scope_widening(spark, d):
    wide = tracts(spark, d)
    return filters.widened(wide, filters.by_tract_type(wide, [3])).groupBy("CD_MUN").agg(F.count(F.lit(1)).alias("n"))


@query(T + "SELECT cd_mun AS \"CD_MUN\", count(*)::BIGINT AS n FROM t WHERE cd_setor = (SELECT cd_setor FROM t ORDER BY sup LIMIT 1) GROUP BY 1")
def scope_widening_tract(spark, d):
    """A scope of one tract stays that tract."""
    wide = tracts(spark, d)
    first = wide.agg(F.min(F.col("CD_SETOR").cast("bigint")).cast("string").alias("CD_SETOR"))
    return filters.widened(wide, wide.join(first, "CD_SETOR", "left_semi")).groupBy("CD_MUN").agg(F.count(F.lit(1)).alias("n"))


@query(T + "SELECT treg AS \"TIPO_RM_AU\", reg AS \"NOME_RM_AU\", count(*)::BIGINT AS n FROM t WHERE (treg, reg) IN (SELECT treg, reg FROM t WHERE tipo IN (0, 3) AND reg IS NOT NULL) GROUP BY 1, 2")
def scope_widening_region(spark, d):
    """A scope without municipality codes widens by its region pairs."""
    wide = tracts(spark, d)
    scope = filters.by_tract_type(wide, [0, 3]).withColumn("CD_MUN", F.lit(None).cast("string"))
    return filters.widened(wide, scope).groupBy("TIPO_RM_AU", "NOME_RM_AU").agg(F.count(F.lit(1)).alias("n"))


@query(T + "SELECT rgi AS \"NM_RGI\", count(*)::BIGINT AS n FROM t GROUP BY 1")
def scope_widening_none(spark, d):
    """A scope whose keys are all null gives all rows."""
    wide = tracts(spark, d)
    scope = wide.withColumns({c: F.lit(None).cast("string") for k in filters.WIDENING for c in k})
    return filters.widened(wide, scope).groupBy("NM_RGI").agg(F.count(F.lit(1)).alias("n"))


@query(P + "SELECT cd_mun AS \"CD_MUN\", idade_grupo, sum(pop)::BIGINT AS valor FROM (SELECT *, (idade // 5 * 5) || ' a ' || (idade // 5 * 5 + 4) || ' anos' AS idade_grupo FROM people) WHERE idade < 30 GROUP BY 1, 2")
def canonical_bands_only(spark, d):
    """Of five-year labels only those that are canonical bands stay."""
    low = F.floor(F.col("idade") / 5) * 5
    rows = people(spark, d).select("CD_MUN", F.concat(low.cast("string"), F.lit(" a "), (low + 4).cast("string"), F.lit(" anos")).alias("idade_grupo"), "pop")
    return filters.canonical_bands(rows).groupBy("CD_MUN", "idade_grupo").agg(F.sum("pop").cast("bigint").alias("valor"))


@query(T + f"""SELECT cd_mun AS "CD_MUN", coalesce(list_sort(list(DISTINCT x) FILTER (k)), []::VARCHAR[]) AS included, coalesce(list_sort(list(DISTINCT x) FILTER (NOT k)), []::VARCHAR[]) AS excluded, bool_or(NOT k) AS is_subset
FROM (SELECT cd_mun, x, bool_or(tipo < 5) OVER (PARTITION BY cd_mun, x) AS k FROM (SELECT cd_mun, {TYPE} AS x, tipo FROM t) WHERE x IS NOT NULL) GROUP BY 1""")
def included_excluded(spark, d):
    return filters.included_excluded(tracts(spark, d), codes.whole("CD_TIPO").isin(0, 1, 2, 3, 4), "CD_TIPO", TRACT_TYPES)


@query(T + "SELECT level, n_places::BIGINT AS n_places FROM (SELECT 'state' AS level, 1 AS n_places UNION ALL SELECT 'region', count(DISTINCT reg) FROM t UNION ALL SELECT 'intermediate', count(DISTINCT rgint) FROM t UNION ALL SELECT 'immediate', count(DISTINCT rgi) FROM t UNION ALL SELECT 'municipality', count(DISTINCT cd_mun) FROM t UNION ALL SELECT 'tract', count(DISTINCT cd_setor) FROM t) WHERE n_places > 0")
def available_levels(spark, d):
    return filters.available_levels(tracts(spark, d))


# --- indicators --------------------------------------------------------------------------------------------------------

_GROUPS = ", ".join(
    f"coalesce(sum(pop) FILTER ({w}), 0)::DOUBLE AS {n}"
    for n, w in {"pop_0_14": "idade BETWEEN 0 AND 14", "pop_15_64": "idade BETWEEN 15 AND 64", "pop_20_64": "idade BETWEEN 20 AND 64", "pop_60p": "idade >= 60", "pop_65p": "idade >= 65", "pop_80p": "idade >= 80", "pop_total": "true", "pop_idade0": "idade = 0"}.items()
)
_RATIOS = ", ".join(f"({a}) / nullif({b}, 0) * {k} AS \"{n}\"" for n, (a, b, k) in indicators.RATIOS.items())
_NAMES = ", ".join(f'"{n}"' for n in indicators.RATIOS)


@query(P + f'SELECT cd_mun AS "CD_MUN", {_GROUPS} FROM people GROUP BY 1')
def age_groups(spark, d):
    return indicators.age_groups(people(spark, d), ["CD_MUN"])


@query(P + f'SELECT *, {_RATIOS}, pop_15_64 < 500 AS denominador_pequeno FROM (SELECT cd_mun AS "CD_MUN", nm_mun AS "NM_MUN", {_GROUPS} FROM people GROUP BY 1, 2)')
def indicators_by_municipality(spark, d):
    return indicators.indicators(people(spark, d), ["CD_MUN", "NM_MUN"])


@query(P + f"SELECT *, {_RATIOS}, pop_15_64 < 500 AS denominador_pequeno FROM (SELECT rk AS regiao, {_GROUPS} FROM people GROUP BY 1)")
def indicators_by_region(spark, d):
    return indicators.indicators(people(spark, d), ["regiao"])


@query(P + 'SELECT cd_setor AS "CD_SETOR", pop_15_64, pop_15_64 < 9200 AS denominador_pequeno FROM (SELECT cd_setor, coalesce(sum(pop) FILTER (idade BETWEEN 15 AND 64), 0)::DOUBLE AS pop_15_64 FROM people GROUP BY 1)')
def small_denominator_flag(spark, d):
    return indicators.with_flags(indicators.age_groups(people(spark, d), ["CD_SETOR"]), 9200).select("CD_SETOR", "pop_15_64", "denominador_pequeno")


def _level_sql(n):
    a, b = indicators.RANGES[n]
    if n == "PSR":
        return f"CASE WHEN \"{n}\" > {b} THEN 'baixo' WHEN \"{n}\" >= {a} THEN 'médio' WHEN \"{n}\" IS NOT NULL THEN 'alto' END AS \"nivel_{n}\""
    return f"CASE WHEN \"{n}\" < {a} THEN 'baixo' WHEN \"{n}\" <= {b} THEN 'médio' WHEN \"{n}\" IS NOT NULL THEN 'alto' END AS \"nivel_{n}\""


@query(P + f'SELECT "CD_SETOR", {", ".join(map(_level_sql, indicators.RANGES))}, CASE WHEN "RDJ" > 40 AND "IE_65p" < 30 THEN \'Jovem\' WHEN "RDI" > 25 AND "IE_65p" > 70 THEN \'Envelhecido\' ELSE \'Intermediário\' END AS perfil FROM (SELECT *, {_RATIOS} FROM (SELECT cd_setor AS "CD_SETOR", {_GROUPS} FROM people GROUP BY 1))')
def indicator_levels(spark, d):
    rows = indicators.with_levels(indicators.indicators(people(spark, d), ["CD_SETOR"]))
    return rows.select("CD_SETOR", *(f"nivel_{n}" for n in indicators.RANGES), indicators.profile().alias("perfil"))


@query(P + f""", y AS (SELECT *, {_RATIOS} FROM (SELECT cd_mun AS "CD_MUN", ano, {_GROUPS} FROM people WHERE ano IN (1995, 1997) GROUP BY 1, 2))
SELECT a."CD_MUN", a."RDT" AS "RDT_antes", a."IE_65p" AS "IE_65p_antes", b."RDT" AS "RDT_depois", b."IE_65p" AS "IE_65p_depois", b."RDT" - a."RDT" AS "RDT_dif", b."IE_65p" - a."IE_65p" AS "IE_65p_dif" FROM y a JOIN y b ON a."CD_MUN" = b."CD_MUN" AND a.ano = 1995 AND b.ano = 1997""")
def indicator_change(spark, d):
    return indicators.change(people(spark, d), ["CD_MUN"], "ano", 1995, 1997)


# --- quality -----------------------------------------------------------------------------------------------------------

_RECONCILE = "contado, declarado, contado - declarado AS diferenca, (contado - declarado) / nullif(declarado, 0) * 100 AS diferenca_pct FROM (SELECT {k} AS place, sum(c)::BIGINT AS contado, sum(v0001)::DOUBLE AS declarado FROM (SELECT sup, any_value({k}) AS {k}, any_value(v0001) AS v0001, sum(valor) AS c FROM l GROUP BY sup) GROUP BY 1)"


@query(T + 'SELECT place AS "CD_MUN", ' + _RECONCILE.format(k="cd_mun"))
def reconcile_municipality(spark, d):
    return quality.reconcile(tracts(spark, d), ["CD_MUN"])


@query(T + 'SELECT place AS "CD_SETOR", ' + _RECONCILE.format(k="cd_setor"))
def reconcile_tract(spark, d):
    return quality.reconcile(tracts(spark, d), ["CD_SETOR"])


@query(T + 'SELECT cd_mun AS "CD_MUN", CASE WHEN count(DISTINCT v0001) = 1 THEN max(v0001) ELSE sum(v0001) END::DOUBLE AS declarado FROM t GROUP BY 1')
def declared_totals(spark, d):
    return quality.declared_total(tracts(spark, d), ["CD_MUN"])


@query(T + "SELECT cd_mun AS \"CD_MUN\", sum((sup % 7 = 3)::BIGINT)::BIGINT AS com_faltantes, count(*)::BIGINT AS setores, sum((sup % 7 = 3)::BIGINT)::DOUBLE / count(*) * 100 AS pct FROM t GROUP BY 1")
def missing_coverage(spark, d):
    return quality.missing_coverage(tracts(spark, d), ["CD_MUN"])


def _profile_sql(columns, source):
    """SQL of a profile; columns: name -> (type, expression, numeric expression or None)."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count({x})::BIGINT AS non_null, " + (f"count({v})::BIGINT AS numeric, count(*) FILTER ({v} <> 0)::BIGINT AS non_zero" if v else "0::BIGINT AS numeric, 0::BIGINT AS non_zero") + f" FROM {source}"
        for c, (kind, x, v) in columns.items()
    )


_LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
_PROFILE = _profile_sql({c: (k, c, None if k.startswith("timestamp") else f"try_cast({c} AS DOUBLE)" if k == "string" else c) for c, k in _LINEITEM.items()}, "lineitem")


@query(_PROFILE)
def column_profile(spark, d):
    return quality.column_profile(table(spark, d, "lineitem"))


@query(f"SELECT type, count(*)::BIGINT AS n FROM ({_PROFILE}) GROUP BY 1")
def type_summary(spark, d):
    return quality.type_summary(column_profile(spark, d))


_MAPPING = [("l_orderkey", "PEDIDO"), ("l_quantity", "l_quantity"), ("l_discount", " ")]


def _mapping(spark):
    return spark.createDataFrame(_MAPPING, "parquet_column string, app_equivalent string")


@query(f"SELECT \"column\", type, non_null, numeric, non_zero FROM ({_PROFILE}) WHERE \"column\" NOT IN ('l_orderkey', 'l_quantity')")
def unmapped_columns(spark, d):
    return quality.unmapped_columns(column_profile(spark, d), _mapping(spark))


_COVERAGE = f"SELECT count(*)::BIGINT AS total, 2::BIGINT AS mapped, {len(_LINEITEM) - 2}::BIGINT AS unmapped, 1::BIGINT AS unchanged, (sum(non_null) FILTER (\"column\" IN ('l_orderkey', 'l_quantity')))::BIGINT AS mapped_cells, sum(non_null)::BIGINT AS cells FROM ({_PROFILE})"


@query(_COVERAGE)
def mapping_coverage(spark, d):
    return quality.mapping_coverage(column_profile(spark, d), _mapping(spark))


_HEADERS = {
    "GEOCODIGO_SETOR_CENSITARIO": ("string", "cd_setor", None, "CD_SETOR", "CD_SETOR", "categorical/int", None),
    "COD_MUN": ("string", "cd_mun", "try_cast(cd_mun AS DOUBLE)", "CD_MUN", "CD_MUN", "categorical/int", None),
    "Nome do Município": ("string", "nm_mun", None, "NM_MUN", "NM_MUN", None, None),
    "UF_CODIGO": ("string", "uf", "try_cast(uf AS DOUBLE)", "CD_UF", "CD_UF", "categorical/int", None),
    "COD_SITUACAO_DETALHADA": ("string", "sit", "sit", "CD_SITUACAO", "Código da Situação detalhada do Setor Censitário", "categorical/int", json.dumps(SITUATIONS, ensure_ascii=False)),
    "COD_TIPO_SETOR": ("double", "tipo", "tipo", "CD_TIPO", "Código do Tipo do Setor Censitário", "categorical/int", json.dumps(TRACT_TYPES, ensure_ascii=False)),
    "AREA_KM2": ("double", "area", "area", None, None, None, None),
    "v0001": ("bigint", "v0001", "v0001", "V0001", VARIABLES["V0001"], "numeric", json.dumps({"V0001": VARIABLES["V0001"]}, ensure_ascii=False)),
}
_HEADER_VALUES = ", ".join("(" + ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in (c, *v[3:])) + ")" for c, v in _HEADERS.items())


@query(T + f'SELECT p.*, app_equivalent, human_alias, app_type, code_map FROM ({_profile_sql({c: v[:3] for c, v in _HEADERS.items()}, "t")}) p JOIN (VALUES {_HEADER_VALUES}) a("column", app_equivalent, human_alias, app_type, code_map) USING ("column")')
def described_profile(spark, d):
    """Headers as files have them, with what they mean."""
    return quality.described_profile(raw_tracts(spark, d), list(_HEADERS))


@query(
    f"SELECT 'columns_map' AS output, \"column\" AS name, non_null AS n FROM ({_PROFILE}) UNION ALL SELECT 'columns_map_unmapped', \"column\", NULL FROM ({_PROFILE}) WHERE \"column\" NOT IN ('l_orderkey', 'l_quantity') "
    f"UNION ALL SELECT 'columns_types_summary', type, count(*)::BIGINT FROM ({_PROFILE}) GROUP BY type UNION ALL SELECT 'mapping_coverage', 'mapped_cells', mapped_cells FROM ({_COVERAGE})"
)
def profile_outputs(spark, d):
    """The profile's CSV files, written and read back."""
    paths = export_profile(column_profile(spark, d), _mapping(spark), scratch(spark))
    back = {name: spark.read.csv(path, header=True) for name, path in paths.items()}
    whole = back["columns_map"].toDF("name", "type", "n", "numeric", "non_zero").select("name", "n")
    unmapped = back["columns_map_unmapped"].toDF("name", "type").select("name", F.lit(None).alias("n"))
    coverage = back["mapping_coverage"].select(F.lit("mapped_cells").alias("name"), F.col("mapped_cells").alias("n"))
    parts = {"columns_map": whole, "columns_map_unmapped": unmapped, "columns_types_summary": back["columns_types_summary"].toDF("name", "n"), "mapping_coverage": coverage}
    rows = [t.select(F.lit(name).alias("output"), "name", F.col("n").cast("bigint").alias("n")) for name, t in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


# --- written and read back ---------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS codigo, c_name AS nome, c_nationkey AS c_nationkey FROM customer")
def external_column_map(spark, d):
    """A mapping table renames columns: entries that are blank, unchanged or of other files have no effect."""
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = [(" c_custkey ", "codigo"), ("c_name", "nome "), ("c_name", " "), ("c_nationkey", "c_nationkey"), ("other", "x")]
    renames = column_map(spark.createDataFrame(rows, "parquet_column string, app_equivalent string"), customers.columns)
    return customers.withColumnsRenamed(renames)


def _read_back(spark, name, rows):
    """``rows`` (read from a saved table) written to a folder of their own, so that the table can be dropped."""
    path = scratch(spark)
    rows.write.parquet(path)
    drop_table(spark, name)
    return spark.read.parquet(path)


@query(T + "SELECT uf AS \"CD_UF\", cd_mun AS \"CD_MUN\", count(*)::BIGINT AS setores FROM t WHERE uf = '35' GROUP BY 1, 2")
def saved_table(spark, d):
    """The tract table saved by state in the catalog, each time under a new name; one state's partition read back, the table dropped."""
    path = scratch(spark)
    name = "tracts_" + path.rpartition("-")[2]
    save_table(tracts(spark, d).select("CD_SETOR", "CD_MUN", "CD_UF", "V0001"), name, path=path)
    rows = spark.table(name).where("CD_UF = '35'")
    return _read_back(spark, name, rows.groupBy(F.col("CD_UF").cast("string").alias("CD_UF"), "CD_MUN").agg(F.count(F.lit(1)).alias("setores")))


@query(T + "SELECT uf AS \"CD_UF\", cd_mun AS \"CD_MUN\", count(*)::BIGINT AS setores, sum(CASE WHEN uf = '33' THEN v0001 + 1000 ELSE v0001 END)::BIGINT AS pessoas FROM t WHERE uf = '35' OR sup % 2 = 0 GROUP BY 1, 2")
def reloaded_state(spark, d):
    """A saved tract table of which one state is loaded again, with fewer tracts and other counts; the others stay as they are."""
    path = scratch(spark)
    name = "tracts_" + path.rpartition("-")[2]
    wide = tracts(spark, d).select("CD_SETOR", "CD_MUN", "CD_UF", "V0001")
    save_table(wide, name, path=path)
    again = wide.where("CD_UF = '33' and cast(CD_SETOR as bigint) % 2 = 0").withColumn("V0001", F.col("V0001") + 1000)
    reload_partitions(again, name)
    rows = spark.table(name).groupBy(F.col("CD_UF").cast("string").alias("CD_UF"), "CD_MUN").agg(F.count(F.lit(1)).alias("setores"), F.sum("V0001").alias("pessoas"))
    return _read_back(spark, name, rows)


@query(_BAND_MUN + 'SELECT place AS "CD_MUN", idade_grupo, masculino, feminino, total, pct_masculino, pct_feminino, ordem FROM s')
def table_export(spark, d):
    """The band tables as a CSV export, read back."""
    rows = band_table_total(spark, d)
    path = api.export_table(rows, scratch(spark), "Estado de São Paulo")
    return spark.read.schema(rows.schema).csv(path, header=True, enforceSchema=True)


@query(_MAPS + 'SELECT coalesce(rm.cd, au.cd) AS "CD_MUN", n_name AS "NM_MUN", rm.nome AS "RM_NOME", au.nome AS "AU_NOME" FROM rm FULL JOIN au ON rm.cd = au.cd LEFT JOIN (SELECT DISTINCT cd, n_name FROM n JOIN supplier ON s_nationkey = nk JOIN lineitem ON l_suppkey = s_suppkey) n ON n.cd = coalesce(rm.cd, au.cd)')
def municipality_lookup_export(spark, d):
    """The municipality lookup as a CSV export, read back."""
    path = scratch(spark)
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    region = F.col("n_regionkey")
    code, state = F.col("n_nationkey").cast("string").alias("COD_MUN"), F.when(F.col("n_nationkey") == 7, "RJ").otherwise("SP").alias("SIGLA_UF")
    rm = n.where(region.isin(2, 3)).select(code, F.when(region == 2, "RM Asia").otherwise("RM Europa").alias("NOME_CATMETROPOL"), state)
    au = n.where((region == 0) | ((region == 3) & (F.col("n_nationkey") % 2 == 0))).select(code, F.when(region == 0, "AU Africa").otherwise("AU Europa").alias("NOME_CATMETROPOL"), state)
    api.municipality_lookup_csv(tracts(spark, d), rm, au, path)
    return spark.read.csv(path, header=True, schema="CD_MUN string, NM_MUN string, RM_NOME string, AU_NOME string")


@query(T + 'SELECT cd_mun AS "CD_MUN", ' + ", ".join(f"sum(CASE WHEN sexo = '{s}' AND ord = {k} THEN valor ELSE 0 END)::BIGINT AS {s[0].lower()}_{k}" for s in ("Masculino", "Feminino") for k in range(len(BANDS))) + " FROM l GROUP BY 1")
def streamed_pyramid(spark, d):
    """Tract files read as a stream, a file a batch, compacted on the way; the sums after the last file are those of the whole table."""
    top = scratch(spark)
    tracts(spark, d).repartition(5).write.parquet(f"{top}/tracts")
    stream = live.tract_stream(spark, f"{top}/tracts", spark.read.parquet(f"{top}/tracts").schema, files_per_trigger=1)
    live.start(live.running_pyramid(stream, ["CD_MUN"]), f"{top}/pyramid", f"{top}/state", ["CD_MUN"], compact_every=2).awaitTermination()
    for done in ("tracts", "state"):
        storage.remove(spark, f"{top}/{done}")
    return live.current(spark, f"{top}/pyramid", ["CD_MUN"])


@query(T + 'SELECT cd_mun AS "CD_MUN", band AS idade_grupo, sexo, sum(valor)::BIGINT AS valor, row_number() OVER (PARTITION BY cd_mun ORDER BY ord, sexo)::INTEGER AS posicao FROM l GROUP BY cd_mun, band, sexo, ord')
def pyramid_order(spark, d):
    """Aggregated pyramids in the order of bands and sexes."""
    return pyramid.ranked(pyramid.pyramid(tracts(spark, d), ["CD_MUN"]), ["CD_MUN"], ["ord", "sexo"]).drop("ord")


@query(_BAND_MUN + 'SELECT place AS "CD_MUN", idade_grupo, total, row_number() OVER (PARTITION BY place ORDER BY ordem, idade_grupo)::INTEGER AS posicao FROM s')
def band_table_order(spark, d):
    """Band tables in their order, the total last."""
    return pyramid.ranked(band_table_total(spark, d), ["CD_MUN"], ["ordem", "idade_grupo"]).select("CD_MUN", "idade_grupo", "total", "posicao")


# --- households --------------------------------------------------------------------------------------------------------

_CATEGORY = """WITH o AS (SELECT lpad(c_nationkey::VARCHAR, 7, '0') AS cd, o_orderpriority AS p, o_orderstatus AS s FROM orders JOIN customer ON o_custkey = c_custkey),
c AS (SELECT cd, 'prioridade' AS group_id, 'Prioridade' AS title, 'bar' AS chart, p AS column_name FROM o UNION ALL SELECT cd, 'estado', 'Estado', 'pie', s FROM o
UNION ALL SELECT cd, 'urgentes', 'Urgentes', 'bar', p FROM o WHERE p IN ('1-URGENT', '2-HIGH')),
k AS (SELECT cd AS "CD_MUN", group_id, title, chart, column_name, count(*)::DOUBLE AS valor FROM c GROUP BY ALL) """


@query(_CATEGORY + "SELECT * FROM k")
def household_totals(spark, d):
    return household.category_totals(households(spark, d), ["CD_MUN"], GROUPS)


@query(_CATEGORY + 'SELECT *, valor / sum(valor) OVER (PARTITION BY "CD_MUN", group_id) AS share FROM k')
def household_shares(spark, d):
    return household.with_group_share(household.category_totals(households(spark, d), ["CD_MUN"], GROUPS), ["CD_MUN"])


@query(_CATEGORY + "SELECT k.*, e.valor_estado FROM k JOIN (SELECT group_id, column_name, sum(valor) AS valor_estado FROM k GROUP BY 1, 2) e USING (group_id, column_name)")
def household_state_vs_place(spark, d):
    return household.state_and_places(households(spark, d), "CD_MUN", GROUPS)


@query(_CATEGORY + 'SELECT *, row_number() OVER (PARTITION BY "CD_MUN", group_id ORDER BY valor, column_name)::INTEGER AS posicao FROM k')
def household_series(spark, d):
    return household.bar_series(household.category_totals(households(spark, d), ["CD_MUN"], GROUPS), ["CD_MUN"])


_WIDE_GROUPS = ", ".join(f"('{g}', '{t}', '{k}', '{c}', {HOUSEHOLD_COLUMNS.index(c)})" for g, t, k, columns in HOUSEHOLD_GROUPS for c in columns)
_WIDE_CATEGORY = f"""WITH g(group_id, title, chart, column_name, n) AS (VALUES {_WIDE_GROUPS}),
o AS (SELECT lpad(c_nationkey::VARCHAR, 7, '0') AS cd, o_orderkey % {len(HOUSEHOLD_COLUMNS)} AS n FROM orders JOIN customer ON o_custkey = c_custkey),
k AS (SELECT cd AS "CD_MUN", group_id, title, chart, column_name, count(*)::DOUBLE AS valor FROM o JOIN g USING (n) GROUP BY ALL) """


@query(_WIDE_CATEGORY + 'SELECT *, valor / sum(valor) OVER (PARTITION BY "CD_MUN", group_id) AS share FROM k')
def household_all_groups(spark, d):
    """All household columns in all their groups."""
    return household.with_group_share(household.category_totals(wide_households(spark, d), ["CD_MUN"]), ["CD_MUN"])


# --- lists and texts ---------------------------------------------------------------------------------------------------


@query(T + f'SELECT cd_setor AS "CD_SETOR", cd_mun AS "CD_MUN", nm_mun AS "NM_MUN", situacao AS "SITUACAO", {SITUATION} AS "SITUACAO_DET_TXT", {TYPE} AS "TP_SETOR_TXT", area AS "AREA_KM2", v0001 AS "V0001" FROM t')
def tract_listing(spark, d):
    return catalog.tract_listing(tracts(spark, d))


@query(T + "SELECT DISTINCT cd_mun AS \"CD_MUN\", nm_mun AS \"NM_MUN\", nm_mun || ' (' || cd_mun || ')' AS rotulo FROM t")
def municipality_options(spark, d):
    return catalog.municipality_options(tracts(spark, d))


@query(T + "SELECT DISTINCT rgi AS place FROM t WHERE rgi IS NOT NULL")
def place_options(spark, d):
    return catalog.place_options(tracts(spark, d), "NM_RGI")


@query(
    T + ", o AS (SELECT DISTINCT * FROM (" + " UNION ALL ".join(
        f"SELECT '{level}' AS level, {inside} AS dentro, {place} AS place, {label} AS rotulo, {order} AS ordem FROM t"
        for level, inside, place, label, order in (
            ("state", "NULL", "'state'", f"'{WHOLE_STATE}'", "['']"), ("region", "NULL", "reg", "treg || ' — ' || reg", "[treg, reg]"), ("intermediate", "NULL", "rgint", "rgint", "[rgint]"),
            ("immediate", "NULL", "rgi", "rgi", "[rgi]"), ("municipality", "NULL", "cd_mun", "cd_mun || ' — ' || nm_mun", "[nm_mun, cd_mun]"), ("tract", "cd_mun", "cd_setor", "'Setor ' || cd_setor", "[cd_setor]"),
        )
    ) + ") WHERE place IS NOT NULL) SELECT level, dentro, place, rotulo, row_number() OVER (PARTITION BY level, dentro ORDER BY ordem)::INTEGER AS posicao FROM o"
)
def level_options(spark, d):
    """What can be chosen on each level, with its position in the list."""
    return catalog.level_options(tracts(spark, d))


@query(T + f"SELECT DISTINCT cd_setor AS \"CD_SETOR\", 'Setor ' || concat_ws(' — ', cd_setor, {SITUATION}, {TYPE}) AS setor, concat_ws(' — ', cd_mun, nm_mun) AS municipio, concat_ws(' — ', treg, reg) AS regiao, 'Região Imediata — ' || rgi AS imediata FROM t")
def scope_title(spark, d):
    return catalog.scope_titles(tracts(spark, d))


@query("SELECT o_orderkey, translate(format('{:,}', round_even(o_totalprice, 0)::BIGINT), ',', '.') AS inteiro, translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS decimais, translate(format('{:.1f}', o_totalprice % 97), '.', ',') || '%' AS pct FROM orders")
def ptbr_text(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.brazilian("o_totalprice").alias("inteiro"), text.brazilian("o_totalprice", 2).alias("decimais"), text.percent(F.col("o_totalprice") % 97).alias("pct"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN x IS NULL THEN '' WHEN x = 0 THEN '—' WHEN x > 0 THEN '▲ +' || replace(format('{:.1f}', x), '.', ',') || ' pp' ELSE '▼ ' || replace(format('{:.1f}', -x), '.', ',') || ' pp' END AS delta FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 5 THEN (l_quantity - 25) / 2 END AS x FROM lineitem)")
def delta_text(spark, d):
    x = F.when(F.col("l_linenumber") != 5, (F.col("l_quantity") - 25) / 2)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.delta(x).alias("delta"))


# --- vectors -----------------------------------------------------------------------------------------------------------


def _nearest_sql(distance):
    return f"SELECT qid, vec_id, distance, rank FROM (SELECT q.vec_id AS qid, v.vec_id, {distance} AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY {distance}, v.vec_id)::INTEGER AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0) WHERE rank <= 5"


def _queries(spark, d):
    v = table(spark, d, "embeddings")
    return v, v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))


@query(_nearest_sql("list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"))
def vector_topk_l2(spark, d):
    return search.nearest(*_queries(spark, d), metric="l2")


@query(_nearest_sql("list_cosine_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"))
def vector_topk_cosine(spark, d):
    return search.nearest(*_queries(spark, d), metric="cosine")


def _index_of(spark, d, metric):
    v, q = _queries(spark, d)
    unit = metric == "cosine"
    centroids = vector_index.fit_cells(v, unit=unit)
    return vector_index.build(v, centroids, unit), centroids, q


@query(_nearest_sql("list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"))
def vector_index_l2(spark, d):
    """The nearest of all vectors for certain, by way of the index: cells that cannot hold any are left out."""
    index, centroids, q = _index_of(spark, d, "l2")
    return vector_index.search(index, centroids, q, metric="l2", certain=True)


@query(_nearest_sql("list_cosine_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"))
def vector_index_cosine(spark, d):
    index, centroids, q = _index_of(spark, d, "cosine")
    return vector_index.search(index, centroids, q, metric="cosine", certain=True)


@query("SELECT sum(least(5, n))::BIGINT AS wanted, true AS recall_ok FROM (SELECT q.vec_id, (SELECT count(*) FROM embeddings) AS n FROM embeddings q WHERE q.vec_id % 100 = 0)")
def vector_index_recall(spark, d):
    """Whether the probed cells of each query hold nine tenths of the true neighbours, found by the search without an index."""
    index, centroids, q = _index_of(spark, d, "l2")
    n = vector_index.probes_for(table(spark, d, "embeddings"), index, centroids)
    found = vector_index.search(index, centroids, q, metric="l2", n_probes=n)
    return vector_index.recall(found, vector_topk_l2(spark, d)).select("wanted", (F.col("recall") >= 0.9).alias("recall_ok"))


@query(_nearest_sql("list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"))
def vector_index_appended(spark, d):
    """An index of every second vector, saved, the others added to it; searched for certain after it is read back."""
    v, q = _queries(spark, d)
    half = v.where("vec_id % 2 = 0")
    centroids = vector_index.fit_cells(half)
    path = scratch(spark)
    vector_index.save(vector_index.build(half, centroids), centroids, path)
    vector_index.append(spark, path, v.where("vec_id % 2 = 1"))
    index, centroids = vector_index.load(spark, path)
    return vector_index.search(index, centroids, q, metric="l2", certain=True)
