"""The exact operators against brute force and SQL, with odd rows."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.oracle import assert_same, connect

from tractworks.llm import common, decontaminate, quality_rules, recompression, simhash, suffix_dedup
from tractworks.llm.registry import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, spans int, score double"


def docs_of(spark, rows):
    """Rows (id, text) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "k", 1, None) for i, t in rows], SCHEMA)


def random_texts(seed, n, words, alphabet="abc", runs=True):
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and r.random() < 0.4:
            t = r.choice(texts).split(" ")
            a = r.randrange(len(t))
            t = t[a:] + [r.choice(alphabet)] + t[:a] if r.random() < 0.5 else t
        else:
            t = []
            while len(t) < r.randrange(1, words):
                t += [r.choice(alphabet)] * (r.randrange(1, 30) if runs and r.random() < 0.1 else 1)
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, DIR), connect(DIR), SQL[name])


ODD = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one two"), (None, "one two three four"), (5, "ONE two x  y"), (5, "ONE two x  y"), (6, "a " * 5000), (7, "ação " * 50)]


# --- SimHash ------------------------------------------------------------------------------------------------------------


def test_fingerprints():
    r = random.Random(1)
    for t in [None, "", "a", "A b", "a b c", *(" ".join(r.choice("abcdé") for _ in range(r.randrange(60))) for _ in range(30))]:
        assert simhash.fingerprint(t and t.encode()) == brute.fingerprint(t)


@pytest.mark.parametrize("long_list", [0, 2, 32])
def test_links_hold_components(spark, long_list):
    r = random.Random(long_list)
    values = {r.getrandbits(64)}
    while len(values) < 160:
        v = r.choice(sorted(values))
        for _ in range(r.randrange(1, 5)):
            v ^= 1 << r.randrange(64)
        values.add(v)
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), long_list=long_list)
    assert all((signed[a] ^ signed[b]).bit_count() <= 2 for a, b in links.collect())
    roots = {a: b for a, b in simhash.connected(links).collect()}
    want = brute.components({s: v for s, v in signed.items()})
    assert {s: roots.get(s, s) for s in signed} == want


def test_crowded_lists_are_split(spark):
    """All pairs of a dense region: lists of four and of six equal bytes overflow, those of the last split do not."""
    r = random.Random(5)
    base = r.getrandbits(64)
    values = {base ^ sum(1 << b for b in r.sample(range(16), r.randrange(5))) for _ in range(500)} | {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 64, 5)}
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    got = {tuple(x) for x in simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), long_list=8).collect()}
    names = sorted(signed)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if (signed[a] ^ signed[b]).bit_count() <= 2}
    assert got == want and len(want) > 3000


def test_positions_guarantee_their_matches():
    first, second, third = simhash.split_positions()
    assert [len(first), len(second), len(third)] == [1, 6, 28]
    free = {m: 64 - (m & (1 << 64) - 1).bit_count() for ms in third.values() for m in ms}
    assert set(free.values()) == {8}
    for a in range(64):
        for b in range(a, 64):
            x = 1 << a | 1 << b
            for step in (first, second, third):  # whatever lists two fingerprints share, they share one of the next step
                for m, ms in step.items():
                    assert m & x or any(not y & x for y in ms)


def test_chains_settle(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert {tuple(r) for r in simhash.connected(links).collect()} == {(i, 0) for i in range(1, 201)}


def test_components_of_odd_rows(spark):
    got = simhash.components(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r.component for r in got if r.doc_id is not None}
    assert by[0] == by[1] == by[2] == 0 and by[5] == 5
    assert [r.component for r in got if r.doc_id is None] == [None]
    assert simhash.components(docs_of(spark, [])).count() == 0
    kept = simhash.keep_one(docs_of(spark, ODD))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(by.values())) and kept.columns == ["doc_id", "text", "kept", "spans", "score"]


def test_kept_rows_are_told_apart_by_id_and_text(spark):
    one, two, three = ("alpha beta gamma delta", "red green blue white black", "un deux trois quatre cinq six")
    rows = [(1, one), (1, two), (2, one), (None, two), (None, three), (None, three), (3, two)]
    kept = simhash.keep_one(docs_of(spark, rows))
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == sorted([(1, one), (1, two), (0, three)])


def test_simhash_query(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    fps = {i: brute.fingerprint(t) for i, t in rows.items()}
    want = brute.components(fps)
    got = QUERIES["op4_simhash"](spark, DIR).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in rows}


# --- line rules -----------------------------------------------------------------------------------------------------------


def test_line_rules(spark):
    prose = "The quick brown fox jumps over the lazy dog near a river bank, and then it sleeps in the warm sun until evening comes again.\n"
    rows = [*ODD, (10, prose), (11, prose + "Home | About | News | Contact\n"), (12, "Home | About | News | Contact\n" * 9 + prose), (13, "THIS IS ALL SHOUTING TEXT WITHOUT END AND WITHOUT ANY SENSE AT ALL FOR EVERY READER HERE NOW OK FINE DONE YES\n"), (14, prose + "All rights reserved.")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs_of(spark, rows), with_text=True).collect()}
    assert got[10].kept and got[11].kept and not got[12].kept and not got[13].kept and got[14].kept
    assert got[11].clean_text == prose and got[12].n_dup_lines == 8 and got[0].base_failed and got[6].n_repeat_words == 5000
    assert quality_rules.keep_good(docs_of(spark, rows)).columns == ["doc_id", "text", "kept", "spans", "score"]
    assert sorted(r.doc_id for r in quality_rules.keep_good(docs_of(spark, rows)).collect()) == [10, 11, 14]
    assert quality_rules.keep_good(docs_of(spark, [])).count() == 0


def test_repeated_words():
    r = random.Random(4)
    for _ in range(200):
        words = [r.choice([b"a", b"b"]) for _ in range(r.randrange(40))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        want = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        assert quality_rules.repeated_words(words) == len(want)


# --- repeated words and bytes ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("seed", "alphabet", "together"), [(1, "ab", 64), (2, "abcdefghij", 64), (3, "abc", 0)])
def test_repeated_word_windows(spark, monkeypatch, seed, alphabet, together):
    monkeypatch.setattr(recompression.repeated_spans, "__defaults__", (together,))
    texts = random_texts(seed, 40, 120, alphabet)
    rows = list(enumerate(texts))
    want = brute.removed_words(rows, 20)
    for r in recompression.substring_dedup(docs_of(spark, rows)).collect():
        words = texts[r.doc_id].split(" ")
        gone = want.get(r.doc_id, set())
        assert r.n_removed == len(gone)
        assert r.kept == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_repeated_words_of_odd_rows(spark):
    got = recompression.substring_dedup(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert (by[6].n_words, by[6].n_removed) == (5000, 4999) and by[7].n_removed == 49 and by[0].n_words == 0 and by[5].n_removed == 0
    assert recompression.substring_dedup(docs_of(spark, [])).count() == 0
    copies = [(3, "w%d " * 30 % tuple(range(30))), (None, "w%d " * 30 % tuple(range(30))), (1, "w%d " * 30 % tuple(range(30)))]
    assert {r.doc_id: r.n_removed for r in recompression.substring_dedup(docs_of(spark, copies)).collect()} == {1: 0, 3: 30, None: 30}


def test_repeated_rows_and_ids(spark, tmp_path):
    a, b = (" ".join(f"{x}{i}" for i in range(25)) for x in "ab")
    rows = [(1, a), (1, a), (1, b), (2, a), (2, b), (3, a)]
    frame = docs_of(spark, rows)
    frame.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "documents"))
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in recompression.substring_dedup(frame).collect())
    assert got == [(1, 25, 0), (1, 25, 0), (1, 25, 0), (2, 25, 25), (2, 25, 25), (3, 25, 25)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(r[:3] for r in con.execute(SQL["op6_substring_dedup"]).fetchall()) == got
    with pytest.raises(ValueError):
        recompression.substring_dedup(frame.withColumn("doc_id", F.col("doc_id").cast("string")))
    both = simhash.components(frame).collect()
    assert len(both) == 6 and {r.component for r in both} == {1}
    cut = suffix_dedup.suffix_dedup(frame, threshold=40, digit=12).collect()
    assert all(r.n_removed == r.n_bytes for r in cut)
    named = suffix_dedup.suffix_dedup(frame.withColumn("doc_id", F.concat(F.lit("x"), "doc_id")), threshold=40, digit=12).collect()
    assert sorted((r.doc_id, r.n_removed) for r in named) == sorted((f"x{r.doc_id}", r.n_removed) for r in cut)


@pytest.mark.parametrize(("seed", "alphabet"), [(1, "ab"), (2, "abcdefghijklmnop"), (3, "abé"), (4, "xyz中")])
def test_repeated_byte_windows(spark, seed, alphabet):
    texts = [t.replace(" ", "") for t in random_texts(seed, 40, 200, alphabet)]
    want = brute.removed_bytes(texts, 40)
    for r in suffix_dedup.suffix_dedup(docs_of(spark, list(enumerate(texts))), threshold=40, digit=12).collect():
        gone = want[r.doc_id]
        assert r.n_removed == len(gone) and r.n_spans == sum(p - 1 not in gone for p in gone)
        assert bytes(r.kept) == bytes(b for p, b in enumerate(texts[r.doc_id].encode()) if p not in gone)


def test_repeated_bytes_of_odd_rows(spark):
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(docs_of(spark, ODD)).collect()}
    assert got[6].n_removed == 10000 and got[0].n_bytes == 0 and got[3].n_removed == 0
    twice = suffix_dedup.suffix_dedup(docs_of(spark, [(1, "x" * 150 + "y" * 150), (1, "x" * 150 + "y" * 150), (2, "z" * 199)])).collect()
    assert sorted(r.n_removed for r in twice) == [0, 300, 300]
    assert suffix_dedup.suffix_dedup(docs_of(spark, [])).count() == 0
    cut = suffix_dedup.remove_repeats(docs_of(spark, [(1, "é" * 300), (2, "b"), (3, None)]))
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "", 2: "b", 3: None}


# --- shared helpers -----------------------------------------------------------------------------------------------------


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_pydict({"i": list(range(100)), "t": ["x" * (5000 if i == 7 else 10) for i in range(100)]})
    parts = list(common.slices(batch, 600))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(100))
    assert all(p.num_rows == 1 or p.nbytes <= 600 for p in parts) and len(parts) > 4
    seen = list(common.lean(lambda batches: (b.num_rows for b in batches))(iter([batch, batch.slice(0, 0)])))
    assert seen == [100, 0]


def test_row_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "b"), (None, None), (1, "a")], "i long, t string")
    keys = [tuple(r) for r in rows.select(*common.row_keys(rows, "i", "t")).collect()]
    assert len(set(keys)) == 5 and keys[0] == keys[5] and keys[0][0] == 1
    named = rows.withColumn("i", F.col("i").cast("string"))
    assert len({tuple(r) for r in named.select(*common.row_keys(named, "i", "t")).collect()}) == 5


# --- decontamination ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_benchmark_hits(spark, seed):
    items = [(i, t) for i, t in enumerate(random_texts(seed, 12, 30, "abcd", runs=False))] + [(90, None), (91, "!!"), (92, "q w"), (93, "Long ONE"), (3, "u v w x y z u v w x y z u v")]
    rows = [(i, t) for i, t in enumerate(random_texts(seed + 9, 30, 80, "abcde"))]
    rows += [(200, "x y q, W z"), (201, items[0][1].upper()), (202, "k " * 40 + "u v w x y z u v w x y z u v " + "k " * 40), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs_of(spark, rows), bench).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), n, h, sorted(map(str, f)), h > 0 and 20 * h >= n) for i, t in rows for n, h, f in [brute.hits(t, items)])
    assert sorted((str(g.doc_id), g.n_words, g.n_hit, list(g["items"]), g.contaminated) for g in got) == want
    kept = decontaminate.drop_contaminated(docs_of(spark, rows), bench)
    assert kept.count() == sum(not w[4] for w in want) and kept.columns == ["doc_id", "text", "kept", "spans", "score"]


def test_passage_of_many_items(spark):
    """A passage that many items share is met once by a document and gives all of the items."""
    passage = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(i, f"{passage} own{i} end") for i in range(60)], "item_id long, text string")
    rows = [(1, f"x {passage} y"), (2, "nothing of it"), (3, None)]
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs_of(spark, rows), items).collect()}
    assert list(got[1]["items"]) == sorted(map(str, range(60))) and got[1].n_hit == 30 and not got[2].contaminated and not got[3].contaminated


def test_no_items_or_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs_of(spark, ODD), none).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs_of(spark, []), none).count() == 0
