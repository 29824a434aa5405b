"""The manifest against a plain Merkle tree, with odd rows; its query is held against SQL in test_exact."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tractworks.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int, g string, node string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(hs):
    """Levels from the leaves to the root."""
    out = [hs]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield "".join(run[: i % 8]), "".join(run[i % 8 + 1 :])
        i //= 8


def first(x):
    return (x is not None, x if x is not None else 0)


def brute(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] of rows (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {n: tree([leaf(r) for r in sorted(by[n], key=lambda r: (first(r[0]), leaf(r)))]) for n in names}
    top = tree([trees[n][-1][0] for n in names])
    out = []
    for g, n in enumerate(names):
        for i, r in enumerate(sorted(by[n], key=lambda r: (first(r[0]), leaf(r)))):
            steps = [*path(trees[n], i), *path(top, g)]
            tampered = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0 and r[4] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if tampered else r[4]
            h = leaf((*r[:4], text))
            for a, b in steps:
                h = sha(a, h, b)
            out.append((r[0], leaf(r), trees[n][-1][0], top[-1][0], sha(*(a + b for a, b in steps)), h, h == top[-1][0]))
    return out


def manifest(docs):
    shown = F.when(merkle.fold_of("doc_id", 3) == 0, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    rows = merkle.manifest(docs, shown={"text": shown})
    return [(r.doc_id, r.leaf, r.subroot, r.root, sha(*(s.before + s.after for s in r.path)), r.folded_root, r.verified) for r in rows.collect()]


def rows_of(seed, sizes):
    r = random.Random(seed)
    out = []
    for name, n in sizes:
        for i in range(n):
            text = r.choice([None, "", "A b", "É Ab çX", "x" * r.randrange(50), "Word " * r.randrange(5)])
            out.append((r.randrange(10**9), r.choice([None, "web", ""]), name, r.choice([None, i]), text))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_any_shape(spark, monkeypatch, digits):
    """Groups of one, of whole and of broken runs; many rounds where a block holds few digits."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    sizes = [(None, 9), ("de", 1), ("en", 8), ("fr", 65), ("é", 64), ("a", 2), ("Z", 7), ("", 530), ("q", 16), ("r", 3)]
    rows = rows_of(digits, sizes)
    rows += rows[:5] + [(None, None, "en", None, None), (None, "s", "en", None, "T"), (7, "s", "fr", 1, "A"), (7, "s", "fr", 1, "B")]
    docs = spark.createDataFrame([(*x, "l", 1, "g", "n") for x in rows], SCHEMA)
    order = lambda x: (first(x[0]), *map(str, x))
    assert sorted(manifest(docs), key=order) == sorted(brute(rows), key=order)


@pytest.mark.parametrize("sizes", [[], [("en", 1)], [("en", 9)], [(None, 1), ("en", 1)]])
def test_small_tables(spark, sizes):
    rows = rows_of(1, sizes)
    got = manifest(spark.createDataFrame([(*x, "l", 1, "g", "n") for x in rows], SCHEMA))
    assert sorted(got) == sorted(brute(rows))


def test_input_order_does_not_matter(spark):
    rows = rows_of(4, [("en", 300), ("de", 40)])
    docs = spark.createDataFrame([(*x, "l", 1, "g", "n") for x in rows], SCHEMA)
    assert sorted(manifest(docs)) == sorted(manifest(docs.repartition(7, "text")))
