"""Tree concatenation against the tokenizers library, with odd rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tractworks.llm import tree_bpe
from tractworks.llm.common import read

DIR = "/root/testdata/sf0.001"
ALPHABETS = ["a", "ab", " a", "'re s", "a<|endoftext|>", "  \n\tb", "é日ab ", "0aA! ", "-=", "'lvtdm x", " \x1c\x85 a", "🙂‍ "]
LONG = ["a" * 3000, "ab" * 1500, "-" * 2000 + "=" * 1500, " " * 1500 + "b", "日本" * 700, "x" * 700 + "<|endoftext|>" + "x" * 900]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tree_bpe.TOKENIZER)


def random_texts(seed, n, most=150):
    r = random.Random(seed)
    for _ in range(n):
        letters = r.choice(ALPHABETS)
        t = "".join(r.choice(letters) for _ in range(r.randrange(most)))
        k = r.randrange(len(t) + 1)
        yield t[:k] + "<|endoftext|>" * r.randrange(1, 3) + t[k:] if r.random() < 0.3 else t


def tree(merges, text, leaf):
    depth = max(-(-len(text) // leaf) - 1, 0).bit_length()
    nodes = [merges.encoded(text[len(text) * k >> depth : len(text) * (k + 1) >> depth]) for k in range(1 << depth)]
    while len(nodes) > 1:
        nodes = [merges.joined(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0]


def test_joins_are_exact(library):
    merges, r = tree_bpe.loaded(tree_bpe.TOKENIZER), random.Random(2)
    for t in [*random_texts(1, 1500), *LONG]:
        whole = merges.encoded(t)
        assert (np.frombuffer(whole, np.int32) >> 1).tolist() == library.encode(t, add_special_tokens=False).ids
        assert tree(merges, t, r.choice([1, 2, 3, 7, 16, 40])) == whole, t


def test_special_strings_as_text(library):
    plain = Tokenizer.from_file(tree_bpe.TOKENIZER)
    plain.encode_special_tokens = True
    merges = tree_bpe.loaded(tree_bpe.TOKENIZER, False)
    for t in random_texts(4, 300):
        assert (np.frombuffer(tree(merges, t, 5), np.int32) >> 1).tolist() == plain.encode(t, add_special_tokens=False).ids


def test_both_ways_of_merging_agree():
    merges, r = tree_bpe.loaded(tree_bpe.TOKENIZER), random.Random(5)
    for _ in range(300):
        ids = [merges.of_byte[r.choice(b"abcdeth ")] for _ in range(r.randrange(2, 60))]
        assert merges._few(list(ids)) == merges._many(list(ids))


def test_merging_many_pieces_at_once():
    r = random.Random(8)
    pieces = {"".join(r.choice(r.choice(["ab", "etaoin shrdlu", "é日a", "= -"])) for _ in range(r.randrange(1, 80))) for _ in range(3000)}
    merges = tree_bpe.Merges(open(tree_bpe.TOKENIZER, "rb").read(), False)
    merges.learn(pieces)
    assert set(merges) == {p for p in pieces if len(p.encode()) <= tree_bpe.SHORT}
    alone = tree_bpe.Merges(open(tree_bpe.TOKENIZER, "rb").read(), False)
    assert all(merges[p] == alone[p] for p in pieces)


def test_frames(spark, library):
    """Every kind of row, cut into parts of eight characters; names of the operator's own are taken by the input."""
    texts = [None, "", " ", "one", *random_texts(6, 40), *LONG]
    rows = [(i if i % 5 else None, t, "k", i, "n", "z") for i, t in enumerate(texts)] * 2  # every row twice
    rows += [(7, "another text under one id, longer than a leaf", "k", 0, "n", "z"), (7, "a third one under that id, also a long text", "k", 0, "n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, __c0 long, __key string, node string").repartition(3)
    for leaf_chars in (8, 100):
        out = tree_bpe.decode(tree_bpe.encode(docs, leaf_chars=leaf_chars)).collect()
        assert len(out) == len(rows)
        assert sorted((str(r.doc_id), str(r.text), r["__c0"], r["__key"], r.node) for r in out) == sorted((str(i), str(t), c, k, n) for i, t, _, c, k, n in rows)
        for r in out:
            assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids
            assert r.decoded == (r.text or "")


def test_empty_table(spark):
    out = tree_bpe.encode(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "text", "token_ids"] and out.count() == 0


def test_decode(spark, library):
    ids = [[], [50256, 64], [161], [161, 104], library.encode("é日🙂", add_special_tokens=False).ids[:-1]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)] + [(9, None)], "k int, token_ids array<int>")
    got = {r.k: r.decoded for r in tree_bpe.decode(rows).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)} | {9: None}


@pytest.mark.parametrize("leaf_chars", [300, tree_bpe.LEAF_CHARS])
def test_query_is_the_library(spark, library, monkeypatch, leaf_chars):
    monkeypatch.setattr(tree_bpe.encode, "__defaults__", (*tree_bpe.encode.__defaults__[:-1], leaf_chars))
    got = {r.doc_id: tuple(r)[1:] for r in tree_bpe.op11_tree_bpe(spark, DIR).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = read(spark, DIR, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
