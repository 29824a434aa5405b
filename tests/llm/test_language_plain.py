"""Language identification recomputed in plain Python: n-grams, frequencies, follow-the-regularised-leader, temperature, scores."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractworks.llm import language_id as op

LETTERS = {"aa": "abcde é", "bb": "cdefg ß", "cc": "eghij 日"}


def grams(text):
    clean, gap = [], True
    for c in (text or "").lower():
        if c.isalnum() and not (c.isdigit() or c.isdecimal()):
            clean.append(c)
            gap = False
        elif not gap:
            clean.append(" ")
            gap = True
    letters = "".join(clean).strip()
    if not any(c.isalpha() for c in letters):
        return None
    padded, out = f" {letters} ", Counter()
    for k in (1, 2, 3):
        for i in range(len(padded) - k + 1):
            h = 0
            for c, by in zip(padded[i : i + k], (0, 0x85EBCA77, 0xC2B2AE3D)):
                h = (h * by + ord(c) * 0x9E3779B1) % 2**32
            h = (h + k) % 2**32
            out[(h ^ h >> 15) * 0x85EBCA77 % 2**32 >> 32 - op.BUCKET_BITS] += 1
    return out


def inputs(counts, idf):
    x = {b: (1 + math.log(n)) * idf[b] for b, n in counts.items()}
    size = math.sqrt(sum(v * v for v in x.values()))
    return {b: v / size for b, v in x.items()} | {"bias": 0.1}


def softmax(v):
    e = [math.exp(x - max(v)) for x in v]
    return [x / sum(e) for x in e]


def plain(rows, keys):
    """{place: (language, score)} of rows (id, text, lang); keys: place -> what orders the training texts."""
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows]
    learned = [k for k, (_, t, lang) in enumerate(rows) if not held[k] and lang is not None]
    seen, total = Counter(), 0
    for k in learned:
        if (g := grams(rows[k][1])) is not None:
            seen.update(g.keys())
            total += 1
    idf = [math.log((1 + total) / (1 + seen[b])) + 1 for b in range(op.BUCKETS)]
    names = sorted({rows[k][2] for k in learned})
    some = [(inputs(g, idf), names.index(rows[k][2])) for k in sorted(learned, key=lambda k: (keys[k], rows[k][2])) if (g := grams(rows[k][1])) is not None]
    kept = some[::5] if len(some) >= 50 else []
    used = [s for i, s in enumerate(some) if i % 5 or not kept]
    z, n = Counter(), Counter()

    def weight(c, b):
        s = z[c, b]
        return 0.0 if abs(s) <= op.L1 else -(s - math.copysign(op.L1, s)) / ((op.BETA + math.sqrt(n[c, b])) / op.ALPHA + op.L2)

    def logits(x):
        return [sum(weight(c, b) * v for b, v in x.items()) for c in range(len(names))]

    for e in range(op.EPOCHS):
        for i in np.random.default_rng(e).permutation(len(used)):
            x, y = used[i]
            now = {(c, b): weight(c, b) for c in range(len(names)) for b in x}
            p = softmax(logits(x))
            for c in range(len(names)):
                for b, v in x.items():
                    g = (p[c] - (c == y)) * v
                    z[c, b] += g - (math.sqrt(n[c, b] + g * g) - math.sqrt(n[c, b])) / op.ALPHA * now[c, b]
                    n[c, b] += g * g
    heat = 1.0
    if kept:
        scores = [(logits(x), y) for x, y in kept]
        wrong = 1 / (len(kept) + 2)

        def loss(t):
            logs = [([math.log(p) for p in softmax([v / t for v in vs])], y) for vs, y in scores]
            return -sum((1 - wrong) * p[y] + wrong * sum(p) / len(p) for p, y in logs) / len(logs)

        heat = min(np.geomspace(0.05, 20, 121), key=loss)
    out = {}
    for k, (_, t, _) in enumerate(rows):
        g = grams(t)
        p = softmax([v / heat for v in logits(inputs({b: c for b, c in g.items()}, idf))]) if g else None
        out[k] = (names[p.index(max(p))], max(p)) if p else (op.UNKNOWN, 0.0)
    return out, held


@pytest.mark.parametrize("n", [30, 160])
def test_scores(spark, n):
    """With and without texts kept out for the temperature."""
    r = random.Random(n)
    rows = [(i, "".join(r.choice(LETTERS[lang] + LETTERS[r.choice("abc") * 2][:2]) for _ in range(r.randrange(1, 40))), lang if i % 11 else None) for i in range(n) for lang in [r.choice(list(LETTERS))]]
    rows += [(n, None, "aa"), (n + 1, "", "bb"), (n + 2, " 12 ½ !", "cc"), (n + 3, "Ab 12cD", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    keys = {x.doc_id: x.k for x in docs.select("doc_id", F.xxhash64(F.lit("sample"), "doc_id", "text").alias("k")).collect()}
    want, held = plain(rows, keys)
    got = {x.doc_id: x for x in op.language_id(docs).collect()}
    assert len(got) == len(rows)
    for k in range(len(rows)):
        assert (got[k].held_out, got[k].lang_pred) == (held[k], want[k][0])
        assert got[k].score == pytest.approx(want[k][1], abs=1e-9)
