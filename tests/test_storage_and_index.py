"""Saved tables, compacted streams, arrays in files and the vector index."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.test_operators import places, wide

from tractworks.functions import codes
from tractworks.operators import catalog, compare, filters, pyramid, quality, search, vector_index
from tractworks.plans import queries
from tractworks.sources import readers, storage, writers
from tractworks.streaming import live

DIR = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# --- saved tables -------------------------------------------------------------------------------------------------------


def rows_of(spark, name):
    return sorted((r.CD_UF, r.x) for r in spark.table(name).select(F.col("CD_UF").cast("string").alias("CD_UF"), "x").collect())


def test_replace_and_reload(spark, tmp_path):
    name, path = "tracts_replaced", str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "CD_UF string, x int")
    writers.save_table(frame([("35", 1), ("35", 2), ("33", 3)]), name, path=path)
    writers.reload_partitions(frame([("33", 30), ("31", 40)]), name)
    assert rows_of(spark, name) == [("31", 40), ("33", 30), ("35", 1), ("35", 2)]
    files = set((tmp_path / "t").glob("*/CD_UF=35/*.parquet"))
    writers.reload_partitions(frame([("33", 31)]), name)
    assert set((tmp_path / "t").glob("*/CD_UF=35/*.parquet")) == files  # not written again
    old, folder = spark.table(name), writers.table_path(spark, name)
    # a table may be replaced by what is read from it, and who reads the old one still can
    writers.save_table(old.where("x > 30").withColumn("x", F.col("x") + 1), name, path=path)
    assert rows_of(spark, name) == [("31", 41), ("33", 32)] and spark.read.parquet(folder).count() == 4
    for k in range(3):
        writers.save_table(frame([("35", k)]), name, path=path)
    assert rows_of(spark, name) == [("35", 2)] and len(list((tmp_path / "t").iterdir())) == 2
    with pytest.raises(Exception, match="boom"):
        writers.save_table(frame([("35", 9)]).withColumn("x", F.raise_error(F.lit("boom")).cast("int")), name, path=path)
    assert rows_of(spark, name) == [("35", 2)]
    writers.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError):
        writers.reload_partitions(frame([]), name)


def test_only_the_state_is_read(spark, tmp_path):
    writers.save_table(spark.createDataFrame([("35", 1), ("33", 3)], "CD_UF string, x int"), "tracts_pruned", path=str(tmp_path))
    assert "CD_UF=35" not in (plan := plan_of(spark.table("tracts_pruned").where("CD_UF = '35'"))) and "PartitionFilters: [isnotnull(CD_UF" in plan
    writers.drop_table(spark, "tracts_pruned")


def test_scratch_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError):
        storage.scratch(Session)
    Context.getCheckpointDir = staticmethod(lambda: "hdfs://x/y")
    assert storage.scratch(Session).startswith("hdfs://x/y/written-")


# --- streams ------------------------------------------------------------------------------------------------------------


def test_a_hundred_batches_leave_few_folders(spark, tmp_path):
    table = live.LatestRows(spark, str(tmp_path / "out"), ["k"], every=4)
    want, most = {}, 0
    for b in range(100):
        rows = [(b % 7, b), (None, -b)] if b % 3 else [(b % 7, b)]
        want |= dict(rows)
        table.put(spark.createDataFrame(rows, "k int, v int").coalesce(1), b)
        if b == 50:
            table.put(spark.createDataFrame(rows, "k int, v int").coalesce(1), b)  # done again after a restart
            assert {r.k: r.v for r in live.current(spark, str(tmp_path / "out"), ["k"]).collect()} == want
        if b == 51:  # stopped while the base was written, or before what it replaces went
            table.compact(b)
            (tmp_path / "out" / f"base={b}" / "_SUCCESS").unlink()
            assert {r.k: r.v for r in table.current().collect()} == want
            table.put(spark.createDataFrame(rows, "k int, v int").coalesce(1), b)
        most = max(most, len(list((tmp_path / "out").iterdir())))
    assert {r.k: r.v for r in table.current().collect()} == want
    assert most <= 2 + 2 * 4
    with pytest.raises(ValueError):
        live.LatestRows(spark, str(tmp_path / "none"), ["k"]).current()


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    schema = wide(spark, []).schema

    def run():
        stream = live.tract_stream(spark, str(tmp_path / "in"), schema, files_per_trigger=1)
        live.start(live.running_pyramid(stream, ["CD_MUN"]), str(tmp_path / "out"), str(tmp_path / "state"), ["CD_MUN"], compact_every=2).awaitTermination(120)
        return {r.CD_MUN: r.m_0 for r in live.current(spark, str(tmp_path / "out"), ["CD_MUN"]).collect()}

    for k in range(5):
        wide(spark, [(f"a{k}", "m", {}), (f"b{k}", f"n{k}", {})]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {"m": 5} | {f"n{k}": 1 for k in range(5)}
    wide(spark, [("c", "n0", {})]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {"m": 5, "n0": 2} | {f"n{k}": 1 for k in range(1, 5)} == run()


# --- arrays in files ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("texts", [["a", "é", ""], ["a}", '{"', "},{", '"}', "\\", '\\"}', "[", "],", "{[", "x\n}"]])
def test_array_elements(spark, tmp_path, indent, texts):
    """Braces, quotes and brackets in texts, any layout; files of one array, of none, and of several."""
    r = random.Random(4)
    arrays = [[{"k": f"{n}.{i}", "v": r.choice(texts)} for i in range(size)] for n, size in enumerate((300, 1, 0, 2, 40))]
    files = [[0], [1], [2], [3, 4]]
    for k, held in enumerate(files):
        (tmp_path / f"{k}.json").write_text("\n".join(json.dumps(arrays[n], indent=indent, ensure_ascii=k % 2 == 0) for n in held))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for skip in (True, False):
            found = readers.array_elements(spark, str(tmp_path), skip)
            got = sorted((x["k"], x["v"]) for x in (json.loads(row.value) for row in found.collect()))
            assert got == sorted((x["k"], x["v"]) for a in arrays for x in a[skip:])
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "0.json")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_million_elements_are_read_by_many_tasks(spark, tmp_path):
    n = 1_000_000
    with open(tmp_path / "one.json", "w") as f:
        f.write('[{"D1C":"c","D1N":"n","D2N":"s","D3N":"i","V":"v"}')
        f.writelines(f',{{"D1C":"{i}","D1N":"m","D2N":"Homens","D3N":"0 a 4 anos","V":"{i}"}}' for i in range(n))
        f.write("]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(8 << 20))
    try:
        rows = readers.read_statistics(spark, str(tmp_path / "one.json"))
        assert rows.rdd.getNumPartitions() >= 8
        found = rows.agg(F.count("valor").alias("n"), F.sum("valor").alias("s"), F.count_distinct("cod").alias("d")).first()
        assert (found.n, found.s, found.d) == (n, n * (n - 1) / 2, n)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- levels, comparators, selections ------------------------------------------------------------------------------------


def test_all_levels_from_one_scan(spark):
    df = queries.pyramid_all_levels(spark, DIR)
    assert plan_of(df).count("lineitem.parquet") == 1
    got = {tuple(r) for r in df.select("level", "place", "sexo", "idade_grupo", "valor").collect()}
    for level in ("region", "municipality"):
        alone = queries.QUERIES[f"pyramid_by_{level}"](spark, DIR)
        assert {tuple(r) for r in alone.select(F.lit(level), "place", "sexo", "idade_grupo", "valor").collect()} == {r for r in got if r[0] == level}


def test_level_options(spark):
    rows = [("1", "9", "Sé", "RM", "A"), ("2", "9", "Sé", "RM", "A"), ("3", "8", "Sé", "au", "Z"), ("4", "7", None, "RM", "nan"), ("5", None, "X", None, None)]
    df = spark.createDataFrame(rows, "CD_SETOR string, CD_MUN string, NM_MUN string, TIPO_RM_AU string, REGIAO_RM_AU string")
    got = [(r.level, r.dentro, r.rotulo, r.posicao) for r in catalog.level_options(df).collect()]
    assert sorted(got, key=str) == sorted([("state", None, "Estado de São Paulo", 1), ("region", None, "AU — Z", 1), ("region", None, "RM — A", 2), ("municipality", None, "8 — Sé", 1), ("municipality", None, "9 — Sé", 2), ("tract", "9", "Setor 1", 1), ("tract", "9", "Setor 2", 2), ("tract", "8", "Setor 3", 1), ("tract", "7", "Setor 4", 1), ("tract", None, "Setor 5", 1)], key=str)


def test_divided_municipality(spark):
    """Tracts of one municipality that name different regions count where they belong."""
    rows = [("1", "A", None, "I", 1), ("1", "B", None, "I", 10), ("1", None, "C", None, 100), ("2", "B", None, None, 1000)]
    found = compare.municipal(places(spark, rows))
    assert {r.CD_MUN: r.comparador for r in found.collect()} == {"1": "RM — A", "2": "RM — B"}
    totals = {r.comparador: r.totals[0] for r in compare.region_sums(found).collect()}
    assert totals == {"RM — A": 2, "RM — B": 2020, "AU — C": 200, "Região Imediata — I": 22, "Estado de São Paulo": 2222}
    assert {r.CD_MUN: r.masculino[0] for r in found.collect()} == {"1": 111, "2": 1000}


def test_included_excluded(spark):
    rows = [("a", "1", True), ("a", "1", False), ("a", "2", False), ("b", "2", None), ("b", "9", True), ("c", "x", True), ("d", "2.0", True), (None, "1", True)]
    df = spark.createDataFrame(rows, "CD_MUN string, c string, k boolean")
    found = filters.included_excluded(df, F.col("k"), "c", {1: "um", 2: "dois"})
    assert {r.CD_MUN: (r.included, r.excluded, r.is_subset) for r in found.collect()} == {"a": (["um"], ["dois"], True), "b": ([], ["dois"], True), "d": (["dois"], [], False), None: (["um"], [], False)}
    plan = plan_of(queries.included_excluded(spark, DIR))
    assert plan.count("lineitem.parquet") == 1


def test_widening_reads_the_tracts_twice(spark):
    assert plan_of(queries.scope_widening(spark, DIR)).count("lineitem.parquet") == 2


def test_declared_totals(spark):
    rows = [("a", "m", {}), ("b", "m", {}), ("c", "n", {}), ("d", "n", {}), ("e", "o", {})]
    df = wide(spark, rows).join(spark.createDataFrame([("a", "5"), ("b", "5"), ("c", "3"), ("d", "4"), ("e", None)], "CD_SETOR string, V0001 string"), "CD_SETOR")
    assert {r.CD_MUN: r.declarado for r in quality.declared_total(df, ["CD_MUN"]).collect()} == {"m": 5.0, "n": 7.0, "o": 0.0}
    # of a long table each value would count 22 times
    assert {r.CD_MUN: r.declarado for r in quality.declared_total(pyramid.to_long(df), ["CD_MUN"]).collect()}["n"] == 7.0 * 22
    larger = "/root/testdata/sf0.01"  # with several tracts a municipality
    declared, summed = ({r.CD_MUN: r.declarado for r in f(spark, larger).collect()} for f in (queries.declared_totals, queries.reconcile_municipality))
    several = {r.CD_MUN for r in queries.tracts(spark, larger).groupBy("CD_MUN").agg(F.count_distinct("V0001").alias("n")).where("n > 1").collect()}
    assert several and all(declared[m] == summed[m] for m in several)


def test_numbers_are_what_a_parse_gives(spark):
    values = [" 1 ", "1e3", "+.5", "-2", "-Infinity", "inf", "NaN", "nan ", "1d", "0x1p3", "abc", "", ".", "+", "-", "١", "N", "R", "n/d", "12,5", "1 2", "\t7\n", None, "infinite", "1_000"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i")
    plain = F.expr("CASE WHEN NOT isnan(try_cast(v AS double)) THEN try_cast(v AS double) END")
    assert all(a == b for a, b in df.select(codes.number("v"), plain).collect())
    for kind in ("int", "double", "bigint", "decimal(9,2)"):
        typed = df.select(F.col("i").cast(kind).alias("x")).select(codes.number("x").alias("n"))
        assert [r.n for r in typed.collect()] == list(map(float, range(len(values)))) and "RLIKE" not in plan_of(typed)


# --- vector index -------------------------------------------------------------------------------------------------------


def vectors(spark, seed=1, clusters=12, each=60, size=8):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, size)) * 10
    x = [(int(i), (centres[i % clusters] + r.normal(size=size)).astype(np.float32).tolist()) for i in range(clusters * each)]
    x += [(10_000 + i, x[3][1]) for i in range(250)]  # a vector that a quarter of all rows hold
    x += [(20_000, None)]
    v = spark.createDataFrame(x, "vec_id long, embedding array<float>").repartition(5)
    q = v.where("vec_id % 37 = 0 or vec_id = 20000").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    return v, q


def results(df):
    return sorted((r.qid, r["rank"], r.vec_id, r.distance) for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_index_finds_what_the_search_of_all_finds(spark, metric, monkeypatch):
    monkeypatch.setattr(vector_index, "VECTORS", 64)  # crowded cells are many blocks
    monkeypatch.setattr(vector_index, "QUERIES", 8)
    v, q = vectors(spark)
    unit = metric == "cosine"
    centroids = vector_index.fit_cells(v, 24, unit)
    index = vector_index.build(v, centroids, unit)
    assert index.agg(F.sum("n")).first()[0] == v.where("embedding is not null").count() and index.agg(F.max("n")).first()[0] <= 64
    true = search.nearest(v, q.where("qvec is not null"), 5, metric)
    assert results(vector_index.search(index, centroids, q, 5, metric, n_probes=1, certain=True)) == results(true)
    n = vector_index.probes_for(v, index, centroids, metric=metric)
    found = vector_index.search(index, centroids, q, 5, metric, n_probes=n)
    assert vector_index.recall(found, true).first().recall >= 0.9
    cost = vector_index.work(index, vector_index.probes(q, centroids, n, unit)).first()
    assert cost.computed < 0.4 * cost.pairs


def test_index_is_saved_and_grows(spark, tmp_path):
    v, q = vectors(spark, 2)
    path = str(tmp_path / "index")
    some = v.where("vec_id % 3 <> 1")
    centroids = vector_index.fit_cells(some)
    vector_index.save(vector_index.build(some, centroids), centroids, path)
    files = set((tmp_path / "index" / "blocks").glob("*.parquet"))
    vector_index.append(spark, path, v.where("vec_id % 3 = 1"))
    assert files < set((tmp_path / "index" / "blocks").glob("*.parquet"))
    index, again = vector_index.load(spark, path)
    assert (again == centroids).all()
    assert results(vector_index.search(index, again, q, 3, certain=True)) == results(search.nearest(v, q.where("qvec is not null"), 3))
    none = vector_index.fit_cells(v.where("false"))
    vector_index.save(vector_index.build(v.where("false"), none), none, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        vector_index.append(spark, str(tmp_path / "none"), v)


def test_index_of_few_or_no_vectors(spark):
    v, q = vectors(spark)
    none = v.where("false")
    centroids = vector_index.fit_cells(none)
    assert vector_index.search(vector_index.build(none, centroids), centroids, q).count() == 0
    two = v.where("vec_id in (1, 2)")
    centroids = vector_index.fit_cells(two)
    index = vector_index.build(two, centroids)
    assert vector_index.search(index, centroids, q, 5, certain=True).groupBy("qid").count().agg(F.max("count")).first()[0] == 2
    with pytest.raises(ValueError):
        vector_index.search(index, centroids, q, 5, "dot")
