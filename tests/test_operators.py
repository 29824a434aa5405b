"""Edge rules of the census operators on small frames."""

from __future__ import annotations

import json
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.functions import codes, text
from tractworks.operators import catalog, compare, filters, household, indicators, normalize, pyramid, quality, regions, search
from tractworks.sources import readers, writers
from tractworks.streaming import live
from tractworks.vocabulary import BANDS, SITUATIONS, WHOLE_STATE


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f("v").alias("out")).collect()]


def wide(spark, rows):
    """rows: (tract, municipality, {column: value})."""
    names = [f"Sexo {s}, {b}" for s in ("masculino", "feminino") for b in BANDS]
    schema = T.StructType([T.StructField("CD_SETOR", T.StringType()), T.StructField("CD_MUN", T.StringType()), *(T.StructField(n, T.StringType()) for n in names)])
    return spark.createDataFrame([(a, m, *(c.get(n, "1") for n in names)) for a, m, c in rows], schema)


def test_codes(spark):
    assert one(spark, ["x12y3", "abc", None, "7"], codes.first_digits) == ["12", "abc", None, "7"]
    assert one(spark, ["355", "35-5", "355030855", None], codes.municipality_code) == ["0000355", "0000355", "355030855", None]
    assert one(spark, ["1", "1.0", "4", "9", "x", None, "2.5", "NaN"], codes.urban_rural) == ["Urbana", "Urbana", "Rural", "Rural", None, None, None, None]
    assert one(spark, [1.0, 3.0, 8.0, float("nan"), None], codes.urban_rural, "double") == ["Urbana", "Urbana", "Rural", None, None]
    assert one(spark, ["1", "4", "x"], codes.situation_text) == [SITUATIONS[1], None, None]
    assert one(spark, [SITUATIONS[3], SITUATIONS[9], None], codes.urban_rural_of_text) == ["Urbana", "Rural", "Rural"]
    assert one(spark, [" v0001", "V0009", None], codes.variable_label)[1:] == [None, None]


def test_labels(spark):
    assert one(spark, [" a ", "NaN", "undefined", "-", "—", "", None], codes.clean_label) == ["a", None, None, None, None, None, None]
    got = one(spark, ["0-4", "0–4 anos", "30 a 34", "70+", "70 ou mais", "085", "12", " x ", None], codes.age_label)
    assert got == ["0 a 4 anos", "0 a 4 anos", "30 a 34 anos", "70 anos ou mais", "70 anos ou mais", "85 anos ou mais", "12", "x", None]
    titles = one(spark, ["A – B — C", "A — undefined", "A - ", "", None, "A", "A — B - C"], codes.title)
    assert titles == ["A — B — C", WHOLE_STATE, WHOLE_STATE, WHOLE_STATE, WHOLE_STATE, "A", "A — B - C"]


def test_numbers_as_text(spark):
    assert one(spark, [1234567.0, 0.5, 1.5, None], text.brazilian, "double") == ["1.234.567", "0", "2", ""]
    assert one(spark, [12.25, None], text.percent, "double") == ["12,2%", ""]
    assert one(spark, [1.26, -1.26, 0.0, None], text.delta, "double") == ["▲ +1,3 pp", "▼ 1,3 pp", "—", ""]


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Código do Município", "UF_CODIGO", "v0001", "COD_MUN"])
    assert normalize.canonical_names(df).columns == ["CD_MUN", "CD_UF", "V0001", "COD_MUN"]
    assert normalize.canonical_names(df, {"v0001": "pessoas"}).columns[2] == "pessoas"


def test_decode_only_where_missing(spark):
    df = spark.createDataFrame([("1", "kept", SITUATIONS[5])], "CD_TIPO string, TP_SETOR_TXT string, SITUACAO_DET_TXT string")
    row = normalize.decoded(df).first()
    assert (row.TP_SETOR_TXT, row.CD_SITUACAO) == ("kept", 5)


def test_long_and_aggregate_agree(spark):
    df = wide(spark, [("a", "m", {"Sexo masculino, 0 a 4 anos": "3.9"}), ("b", "m", {"Sexo masculino, 0 a 4 anos": None, "Sexo feminino, 5 a 9 anos": "x"}), ("c", None, {})])
    long = pyramid.to_long(df)
    assert long.count() == 66
    assert long.where("CD_SETOR = 'a' and ord = 0 and sexo = 'Masculino'").first().valor == 3
    first = {tuple(r) for r in pyramid.pyramid(df, ["CD_MUN"]).select("CD_MUN", "sexo", "idade_grupo", "valor").collect()}
    then = {tuple(r) for r in pyramid.sum_by_sex_and_band(long, ["CD_MUN"], drop_null=False).select("CD_MUN", "sexo", "idade_grupo", "valor").collect()}
    assert first == then and len(first) == 44
    assert pyramid.sum_by_sex_and_band(long, ["CD_MUN"]).count() == 22


def test_age_columns_fail_and_match_variants():
    with pytest.raises(ValueError):
        pyramid.age_columns(["a"])
    assert len(pyramid.age_columns(["sexo MASCULINO ,  0 a 4 anos_2", "Sexo feminino, 70 anos ou mais"])) == 2


def test_padding_is_idempotent_and_totals_hold(spark):
    long = spark.createDataFrame([("p", "0-4", "Masculino", 3), ("p", "70+", "Feminino", 5), ("p", "80 a 84", "Feminino", 9), ("q", None, "Masculino", 1)], "k string, idade_grupo string, sexo string, valor long")
    once = pyramid.padded(long, ["k"])
    assert once.count() == 44
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in pyramid.padded(once, ["k"]).collect()}
    table = pyramid.with_share(pyramid.with_total(pyramid.band_table(once, ["k"]), ["k"]), ["k"])
    total = table.where("k = 'p' and idade_grupo = 'TOTAL'").first()
    assert (total.masculino, total.feminino, total.pct_masculino, total.pct_do_total) == (3, 5, 37.5, 100.0)
    assert table.where("k = 'q'").agg(F.max("total")).first()[0] == 0


def test_half_even_share(spark):
    assert one(spark, [1.0, 49.0], lambda c: pyramid.share(F.col(c), F.lit(400.0)), "double") == [0.2, 12.2]


def test_chart_order(spark):
    rows = [("a", "0 a 4 anos"), ("a", "95 a 99 anos"), ("b", "70 anos ou mais"), ("b", "30 a 39 anos"), ("c", "7 anos"), ("c", "x")]
    got = {(r.k, r.idade_grupo): r.ordem for r in pyramid.chart_order(spark.createDataFrame(rows, "k string, idade_grupo string"), ["k"]).collect()}
    assert got == {("a", "0 a 4 anos"): 0, ("a", "95 a 99 anos"): 19, ("b", "70 anos ou mais"): 10, ("b", "30 a 39 anos"): 6, ("c", "7 anos"): 7, ("c", "x"): 99999}


def places(spark, rows):
    """rows: (municipality, RM, AU, immediate region, people of each cell)."""
    df = wide(spark, [(str(i), m, dict.fromkeys([f"Sexo {s}, {b}" for s in ("masculino", "feminino") for b in BANDS], str(v))) for i, (m, _, _, _, v) in enumerate(rows)])
    names = spark.createDataFrame([(str(i), rm, au, rgi) for i, (_, rm, au, rgi, _) in enumerate(rows)], "CD_SETOR string, RM_NOME string, AU_NOME string, NM_RGI string")
    return df.join(names, "CD_SETOR")


def test_comparator_holds_all_of_its_region(spark):
    rows = [("1", "A", "B", "I", 1), ("2", None, "B", "I", 10), ("3", None, None, "I", 100), ("4", None, None, None, 1000), ("5", "A", None, None, 5)]
    found = compare.municipal(places(spark, rows))
    assert {r.CD_MUN: r.comparador for r in found.collect()} == {"1": "RM — A", "2": "AU — B", "3": "Região Imediata — I", "4": WHOLE_STATE, "5": "RM — A"}
    bands = {(r.comparador, r.idade_grupo): r.total for r in compare.comparator_bands(found).collect()}
    # the immediate region holds municipalities of the RM and the AU; a municipality of an RM is not part of an AU
    assert [bands[c, BANDS[0]] for c in ("RM — A", "AU — B", "Região Imediata — I", WHOLE_STATE)] == [12, 20, 222, 2232]
    table = compare.band_table_with_delta(found)
    assert table.count() == 5 * 12 and table.where("idade_grupo <> 'TOTAL'").agg(F.max(F.abs("delta_pp"))).first()[0] == 0
    assert table.where("idade_grupo = 'TOTAL' and delta_pp is not null").count() == 0


def test_places_and_comparators_read_the_tracts_once(spark):
    from tractworks.plans import queries

    for name, scans in (("band_table_delta", 1), ("indicator_change", 1)):
        df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("lineitem.parquet") == scans, name


def test_widening(spark):
    rows = [("1", "7", "RM", "A", "I"), ("2", "7", "rm", "A", None), ("3", "8", "AU", "B", "I"), ("4", None, None, None, "I")]
    df = spark.createDataFrame(rows, "CD_SETOR string, CD_MUN string, TIPO_RM_AU string, NOME_RM_AU string, NM_RGI string")
    got = lambda scope: sorted(r.CD_SETOR for r in filters.widened(df, scope).collect())
    null = lambda frame, *names: frame.withColumns({n: F.lit(None).cast("string") for n in names})
    assert got(df.where("CD_SETOR = '1'")) == ["1"]
    assert got(df.where("CD_SETOR in ('1', '3')")) == ["1", "2", "3"]
    assert got(null(df.where("CD_SETOR = '2'"), "CD_SETOR", "CD_MUN")) == ["1", "2"]
    assert got(null(df.where("CD_SETOR = '4'"), "CD_SETOR")) == ["1", "3", "4"]
    assert got(null(df, *df.columns)) == ["1", "2", "3", "4"] == got(df.where("false"))
    assert filters.widened(df, df.drop(*df.columns[:5])).count() == 4


def test_labels_are_cleaned_on_load(spark):
    df = spark.createDataFrame([(" A ", "undefined", "nan", "x")], "`Nome do Município` string, RM string, NM_RGI string, other string")
    assert tuple(normalize.normalized(df).first()) == ("A", None, None, "x")


def test_profile_attributes(spark):
    df = spark.createDataFrame([("1", 2.0, None, "5"), ("x", float("nan"), 0, None)], "COD_TIPO_SETOR string, AREA double, v0005 int, CD_MUN string")
    got = {r.column: r for r in quality.described_profile(df).collect()}
    assert [(got[c].non_null, got[c].numeric, got[c].non_zero) for c in df.columns] == [(2, 1, 1), (2, 1, 1), (1, 1, 0), (1, 1, 1)]
    tipo, v = got["COD_TIPO_SETOR"], got["v0005"]
    assert (tipo.app_equivalent, tipo.app_type) == ("CD_TIPO", "categorical/int") and json.loads(tipo.code_map)["6"] == "Unidade prisional"
    assert (v.app_equivalent, v.app_type, v.human_alias[:5]) == ("V0005", "float64", "Média") and got["AREA"].app_equivalent is None and got["CD_MUN"].human_alias is None


def test_bar_series(spark):
    df = spark.createDataFrame([("m", 3, 1, 3)], "k string, a int, b int, c int")
    rows = household.bar_series(household.category_totals(df, ["k"], (("g", "G", "bar", ("a", "b", "c")),)), ["k"]).orderBy("posicao").collect()
    assert [r.column_name for r in rows] == ["b", "a", "c"]


def test_filters(spark):
    df = spark.createDataFrame([("Urbana", "1", "1.0"), ("Rural", "5", "x"), (None, None, None)], "SITUACAO string, CD_SITUACAO string, CD_TIPO string")
    assert filters.by_situation(df).count() == 2
    assert filters.by_situation(df, []).count() == 3
    assert filters.by_situation(df, [], on_empty="none").count() == 0
    assert filters.by_tract_type(df, [1]).count() == 1
    r = spark.createDataFrame([("rm", "A"), ("AU", "B")], "TIPO_RM_AU string, REGIAO_RM_AU string")
    assert filters.by_regions(r, ["RM: A"]).count() == 1 and filters.by_regions(r, ["Todas"]).count() == 2
    assert filters.at_place(r, "region", "B").count() == 1 and filters.at_place(r, "state").count() == 2


def test_regions(spark):
    t = spark.createDataFrame([("355", "N1", "SP"), ("355", "N2", "SP"), ("9", "R", "RJ"), ("8", None, "SP")], "cod_mun string, `Nome Catmetropol` string, sigla_uf string")
    assert [tuple(r) for r in readers.region_composition(t, "RM").collect()] == [("0000355", "N2")]
    other = spark.createDataFrame([("1", "X")], "CD_GEOCODM string, NOME_AU string")
    assert [tuple(r) for r in readers.region_composition(other, "AU").collect()] == [("0000001", "X")]
    df = spark.createDataFrame([("355", None), ("355", "old"), ("1", None)], "CD_MUN string, RM_NOME string")
    lookup = readers.region_composition(t, "RM")
    assert [r.RM_NOME for r in regions.fill_from_lookup(df, lookup, "RM_NOME").orderBy("CD_MUN", "RM_NOME").collect()] == [None, "N2", "old"]
    assert {r.RM_NOME for r in regions.fill_from_lookup(df, lookup, "RM_NOME", overwrite=True).collect()} == {"N2", None}


def test_indicators(spark):
    rows = [("a", "14.5", 10.0), ("a", "x", 5.0), ("a", "0", 1.0), ("a", "64", 500.0), ("b", "80", 3.0), ("b", "15", None), (None, "3", 1.0)]
    got = {r.k: r for r in indicators.indicators(spark.createDataFrame(rows, "k string, idade string, pop double"), ["k"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].pop_total, got["a"].pop_0_14, got["a"].denominador_pequeno) == (516.0, 1.0, False)
    assert got["b"].RDT is None and got["b"].pop_80p == 3 and got["b"].denominador_pequeno and got["b"].Prop_80p == 100


def test_quality(spark):
    df = wide(spark, [("a", "m", {"Sexo masculino, 0 a 4 anos": None}), ("b", "m", {})]).withColumn("V0001", F.lit("20"))
    row = quality.reconcile(df, ["CD_MUN"]).first()
    assert (row.contado, row.declarado, row.diferenca) == (43, 40.0, 3.0)
    assert tuple(quality.missing_coverage(df, ["CD_MUN"]).first()) == ("m", 1, 2, 50.0)
    v = spark.createDataFrame([("x", "5"), ("x", "5"), ("x", None), ("y", "1"), ("y", "2"), ("z", None)], "k string, V0001 string")
    assert {tuple(r) for r in quality.declared_total(v, ["k"]).collect()} == {("x", 5.0), ("y", 3.0), ("z", 0.0)}


def test_households(spark):
    df = spark.createDataFrame([("m", 1, 2), ("m", 3, None), ("n", 0, 5)], "k string, a int, b int")
    groups = (("g", "G", "pie", ("a", "b", "missing")), ("h", "H", "bar", ("a",)))
    got = {(r.k, r.group_id, r.column_name): r.share for r in household.with_group_share(household.category_totals(df, ["k"], groups), ["k"]).collect()}
    assert got == {("m", "g", "a"): 4 / 6, ("m", "g", "b"): 2 / 6, ("m", "h", "a"): 1.0, ("n", "g", "b"): 1.0}
    names = household.group_table(spark)
    assert names.select("group_id").distinct().count() == 19 and names.count() == 104


def test_statistics_and_pyramid_sources(spark, tmp_path):
    with_age = [{"D1C": "c"}, {"D1C": "1", "D1N": "n", "D2N": "Homens", "D3N": "0 a 4", "V": "7"}, {"D1C": "1", "D1N": "n", "D2N": "Homens", "D4N": "5 a 9", "V": "..."}]
    (tmp_path / "r.json").write_text(json.dumps(with_age))
    rows = [tuple(r) for r in readers.read_statistics(spark, str(tmp_path / "r.json")).collect()]
    assert rows == [("Homens", "0 a 4", 7.0, "1", "n"), ("Homens", "5 a 9", None, "1", "n")]
    (tmp_path / "p.csv").write_text("grupo_idade,sexo_cat,quantidade\n0-4,M,3\n5-9,F,x\n")
    p = readers.read_pyramid(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in p.select("idade_grupo", "valor", "cod").collect()] == [("0-4", 3, None), ("5-9", None, None)]
    with pytest.raises(ValueError):
        readers.pyramid_columns(spark.createDataFrame([(1,)], "a int"))
    m = spark.createDataFrame([("a", "A"), ("b", " "), ("c", "c"), (None, "x"), ("d", "D")], "parquet_column string, app_equivalent string")
    assert readers.column_map(m, ["a", "b", "c"]) == {"a": "A"}


def test_state_filter_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("35", 1), ("33", 2)], "uf_codigo string, x int")
    assert readers.of_state(df).count() == 1 and readers.of_state(df.drop("uf_codigo")).count() == 2 and readers.of_state(df, "33", 1).count() == 1
    writers.save_table(df.withColumnRenamed("uf_codigo", "CD_UF"), "tracts_saved")
    assert writers.state_count(spark, "tracts_saved", "35").first()[0] == 1
    writers.drop_table(spark, "tracts_saved")
    writers.export_csv(df.coalesce(1), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfuf_codigo,x")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_tracts(spark, str(tmp_path / "none.parquet"))


def test_state_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("35", 1, 2), ("33", 2, 3)], "CD_UF string, x int, y int").write.parquet(str(tmp_path / "t"))
    df = readers.read_tracts(spark, str(tmp_path / "t")).select("x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(CD_UF), EqualTo(CD_UF,35)]" in plan and "y:int" not in plan


def test_nearest(spark, monkeypatch):
    v = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None)], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(9, [3.0, 0.0])], "qid long, qvec array<float>")
    l2 = [(r.vec_id, r["rank"]) for r in search.nearest(v, q, 2).orderBy("rank").collect()]
    assert l2 == [(2, 1), (1, 2)]
    assert [r.vec_id for r in search.nearest(v, q, 2, "cosine").orderBy("rank").collect()] == [1, 2]
    assert search.nearest(v, q, 9).count() == 4 and search.nearest(v.limit(0), q).count() == 0 and search.nearest(v, q.limit(0)).count() == 0
    with pytest.raises(ValueError):
        search.nearest(v, q, 2, "dot")
    same = spark.createDataFrame([(i, [1.0, float(i % 3 == 0)]) for i in range(50)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in search.nearest(same, q, 4).orderBy("rank").collect()] == [1, 2, 4, 5]


def test_distances_of_many_equal_vectors_are_held_a_few_at_a_time():
    v, q = np.ones((1, 64)), np.full((1, 64), 2.0)
    at = np.zeros(300_000, np.int64)
    tracemalloc.start()
    try:
        found = [search.exact(v, q, at, at, metric) for metric in ("l2", "cosine")]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [set(x.tolist()) for x in found] == [{8.0}, {-127.0}]
    assert peak < 60e6  # all pairs at once take 150 MB for each of three arrays


def test_nearest_of_blocks_in_parts(spark):
    """More queries than are taken at once, vectors that are mostly equal; blocks are packed before the stage that searches."""
    points = [(i, [1.0, 0.0] if i % 5 else [float(i % 7), 1.0]) for i in range(600)]
    v = spark.createDataFrame(points, "vec_id long, embedding array<float>")
    asked = [(i, [float(i % 4), float(i % 3)]) for i in range(search.ROWS * 2 + 7)]
    q = spark.createDataFrame(asked, "qid long, qvec array<float>")
    found = search.nearest(v, q, 3)
    want = {(i, *pair) for i, x in asked for pair in enumerate([w for _, w in sorted((math.dist(x, y), w) for w, y in points)[:3]], 1)}
    assert {(r.qid, r["rank"], r.vec_id) for r in found.collect()} == want
    plan = found._jdf.queryExecution().sparkPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "CartesianProduct" in line or "BroadcastNestedLoopJoin" in line)
    assert sum("Exchange" in line or "RepartitionByExpression" in line or "hashpartitioning(xxhash64" in line for line in plan[join:]) == 2


def test_listing_and_titles(spark):
    df = spark.createDataFrame([("1", "7", "undefined", "t")] * 2, "CD_SETOR string, CD_MUN string, NM_MUN string, SITUACAO string")
    assert catalog.tract_listing(df).count() == 1
    assert catalog.municipality_options(df).count() == 0


def test_running_pyramid(spark, tmp_path):
    def run():
        stream = live.tract_stream(spark, str(tmp_path / "in"), schema)
        live.start(live.running_pyramid(stream, ["CD_MUN"]), str(tmp_path / "out"), str(tmp_path / "state"), ["CD_MUN"]).awaitTermination(60)
        return {(r.CD_MUN, r.m_0) for r in live.current(spark, str(tmp_path / "out"), ["CD_MUN"]).collect()}

    wide(spark, [("a", "m", {}), ("b", "n", {}), ("d", None, {})]).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    assert run() == {("m", 1), ("n", 1), (None, 1)}
    wide(spark, [("c", "m", {})]).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {("m", 2), ("n", 1), (None, 1)} == run()
