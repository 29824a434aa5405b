"""Alignment against a plain version with both libraries, with odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tractworks.llm import token_alignment as ta
from tractworks.llm import tree_bpe
from tractworks.llm.common import read

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokens():
    """text -> ([(a id, end)], [(b id, end)]), empty where the bytes differ."""
    bpe = Tokenizer.from_file(tree_bpe.TOKENIZER)
    bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=ta.MODEL)
    letters = tree_bpe.byte_letters()
    vocabulary = bpe.get_vocab(with_added_tokens=False)
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()}

    def b_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def of(text):
        if not text:
            return [], []
        out = []
        for ids, written in ((bpe.encode(" " + text, add_special_tokens=False).ids, a_bytes.__getitem__), (pieces.encode(text), b_bytes)):
            at, side, whole = 0, [], b""
            for i in ids:
                whole += written(i)
                at += len(written(i))
                side.append((i, at))
            if whole != (" " + text).encode():
                return [], []
            out.append(side)
        return tuple(out)

    return of


def brute(tokens, texts):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, groups)] of texts."""
    rows, count = [], Counter()
    for t in texts:
        a, b = tokens(t)
        shared = sorted({e for _, e in a} & {e for _, e in b})
        cut = {e: [[], []] for e in shared}
        for side, rest in enumerate((a, b)):
            k = 0
            for i, e in rest:
                k += e > shared[k]
                cut[shared[k]][side].append(str(i))
        groups = ";".join("|".join(map(",".join, cut[e])) for e in shared)
        ends = dict((e, j) for j, e in b)
        links = [(i, ends[e]) for i, e in a if e in ends]
        count.update(links)
        rows.append((len(a), len(b), len(shared), links, groups))
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(na, nb, ng, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), groups) for na, nb, ng, links, groups in rows]


def random_texts(seed, n):
    r = random.Random(seed)
    words = ["the", "Haus", " ", "\n", "été", "日本", "<|endoftext|>", "<0x41>", "▁", "x" * 30, "don't", "12,345", "🙂", "\t", "</s>", "und", "ing"]
    for _ in range(n):
        yield r.choice(["", " "]).join(r.choice(words) for _ in range(r.randrange(25)))


def test_cuts_are_the_shared_ends():
    r = np.random.default_rng(1)
    for _ in range(400):
        n = int(r.integers(1, 400))
        a, b = (np.unique(np.append(r.integers(1, n * int(r.integers(1, 6)) + 2, n), n * 7)) for _ in range(2))
        got = ta.cut_up(a, b, *(np.array([x]) for x in (0, len(a), 0, len(b))))
        shared = np.intersect1d(a, b)
        assert (a[got[0] - 1] == shared).all() and (b[got[1] - 1] == shared).all()


def test_no_cut_in_a_long_text():
    a, b = np.append(np.arange(2, 200_000, 2), 200_001), np.append(np.arange(1, 200_000, 2), 200_001)
    assert [x.tolist() for x in ta.cut_up(a, b, *(np.array([x]) for x in (0, len(a), 0, len(b))))] == [[len(a)], [len(b)]]


def test_frames(spark, tokens):
    """Odd rows, every row twice, columns of the operator's own names."""
    texts = [None, "", " ", "  two  spaces ", "a▁b", "\x00", "tail \n", "x" * 3000, "日本" * 300, *random_texts(3, 60)] * 2
    docs = spark.createDataFrame([(i, t, "g", 1, "p") for i, t in enumerate(texts)], "doc_id long, text string, groups string, n_best int, pair string").repartition(3)
    kept = ta.align(docs)
    out = sorted(ta.counted(kept, ta.pair_counts(kept)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in out] == texts and {r.pair for r in out} == {"p"}
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in out] == brute(tokens, texts)


def test_empty_table(spark):
    kept = ta.align(spark.createDataFrame([], "doc_id long, text string"))
    assert ta.counted(kept, ta.pair_counts(kept)).count() == 0


def test_query(spark, tokens):
    docs = {r.doc_id: r.text for r in read(spark, DIR, "documents").select("doc_id", "text").collect()}
    want = {i: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "") for i, w in zip(docs, brute(tokens, docs.values()))}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in ta.op13_token_alignment(spark, DIR).collect()}
    assert got == want and any(w[0] for w in want.values())
