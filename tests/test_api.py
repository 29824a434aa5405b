"""The public names end to end."""

from __future__ import annotations

from tractworks import api
from tractworks.plans.views import raw_tracts

DIR = "/root/testdata/sf0.001"


def test_load_to_table(spark, tmp_path):
    raw_tracts(spark, DIR).write.parquet(str(tmp_path / "tracts"))
    rm = spark.createDataFrame([("2", "RM X", "SP"), ("7", "RM Y", "RJ")], "COD_MUN string, NOME_CATMETROPOL string, SIGLA_UF string")
    wide = api.load_sp_age_sex_enriched(spark, str(tmp_path / "tracts"), metropolitan=rm)
    assert {"CD_SETOR", "CD_MUN", "SITUACAO", "REGIAO_RM_AU", "TIPO_RM_AU", "V0001"} <= set(wide.columns)
    long = api.wide_to_long_pyramid(wide)
    assert long.count() == 22 * wide.count()
    a, b = (sorted(map(tuple, api.aggregate_pyramid(t, ["CD_MUN"]).select("CD_MUN", "idade_grupo", "sexo", "valor").collect())) for t in (wide, long))
    assert a == b
    table = api.build_abnt_demographic_table(long)
    assert [r.idade_grupo for r in table.collect()][-1] == "TOTAL" and table.count() == 12
    path = api.export_table(table, str(tmp_path), "RM — X")
    assert spark.read.csv(path, header=True).count() == 12
    api.municipality_lookup_csv(wide, rm, rm, str(tmp_path / "lookup"))
    assert spark.read.csv(str(tmp_path / "lookup"), header=True).columns == ["CD_MUN", "NM_MUN", "RM_NOME", "AU_NOME"]
    assert api.load_sp_age_sex_enriched(spark, str(tmp_path / "tracts"), limit=2).count() == 2


def test_aliases_are_the_same_functions():
    assert api.agregar_piramide is api.aggregate_pyramid and api.limpar_rotulo is api.clean_label and api.formatar_br is api.fmt_br
    assert all(hasattr(api, n) for n in api.__all__)
