"""Line-first cleaning: lines are judged one by one, then the document by how much text it lost.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n``. A line that has words fails if one of these holds:

* symbols: more than ``symbols_per_10_words`` of ``#*$%&|<>`` for ten words;
* navigation: at least two separators (``|``, ``»``, ``›``, ``•``, ``·``) and one for every four words or more;
* boilerplate: at most 40 words and a stock phrase (licence, cookie, sign-in lines ...);
* capitals: ten or more of A-Z and over four for each of a-z;
* punctuation: no letter, digit or non-ASCII character at all, or 40 words or more without one of ``.!?:;,``.

A document is rejected if the base rules fail (under 20 words, or over 30 % of its words in repeated 8-word windows)
or if failed lines hold over ``most_lost_percent`` of its word characters. Null texts count as empty and are rejected;
an empty table gives an empty result; repeated rows are judged each on its own; ``keep_good`` keeps all other columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import MIX, lean, read

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
WINDOW = 8
#: Stock phrases in English, German, French, Spanish and Portuguese; A-Z are lower-cased before they are looked for.
BOILERPLATE = (
    "all rights reserved|licensed under|copyright \\(c\\)|cookie policy|use of cookies|privacy policy|terms of service|"
    "terms of use|sign in|log in|subscribe to our|click here|read more|skip to content|enable javascript|"
    "alle rechte vorbehalten|lizenziert unter|datenschutzerklärung|allgemeine geschäftsbedingungen|verwendet cookies|jetzt anmelden|hier klicken|weiterlesen|zum inhalt springen|javascript aktivieren|"
    "tous droits réservés|sous licence|politique de confidentialité|conditions d'utilisation|utilise des cookies|se connecter|cliquez ici|lire la suite|aller au contenu|activer javascript|"
    "todos los derechos reservados|bajo licencia|política de privacidad|condiciones de uso|términos de uso|utiliza cookies|iniciar sesión|haga clic aquí|leer más|saltar al contenido|"
    "todos os direitos reservados|sob licença|política de privacidade|termos de uso|clique aqui|leia mais"
)
_BOILER = re.compile(BOILERPLATE.encode())
_SEPARATORS = re.compile("[|»›•·]".encode().decode())
_BODY = re.compile(rb"[0-9A-Za-z\x80-\xff]")
_MARK = re.compile(rb"[.!?:;,]")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more in the list; equal hashes are compared word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(names) > len(words) - 2:  # two equal windows share at least one word that occurs twice
        if len(names) == len(words):
            return 0
    u = ids.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h += u[j : j + n] * MIX[j]
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)[at]
    _, group, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[counts[group.ravel()] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def line_fails(line: bytes, n_words: int, symbols_per_10_words: int) -> bool:
    """Whether a line with words breaks one of the rules above."""
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if 10 * symbols > symbols_per_10_words * n_words:
        return True
    if b"|" in line or b"\xc2" in line or b"\xe2" in line:
        bars = len(_SEPARATORS.findall(line.decode("utf-8", "replace")))
        if bars >= 2 and 4 * bars >= n_words:
            return True
    if n_words <= 40 and _BOILER.search(line.lower()):
        return True
    upper = len(line) - len(line.translate(None, UPPER))
    if upper >= 10 and upper > 4 * (len(line) - len(line.translate(None, LOWER))):
        return True
    return not _BODY.search(line) or (n_words >= 40 and not _MARK.search(line))


def code_points(line: bytes) -> int:
    """Code points of a line outside its spaces."""
    return len(line.decode("utf-8", "replace").translate(_NO_SPACE))


_NO_SPACE = dict.fromkeys(SPACES)


def judge(text: bytes | None, symbols_per_10_words: int, most_lost_percent: int) -> tuple[tuple, list[bytes]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars), and the kept lines."""
    text = text or b""
    words = text.split()
    n = len(words)
    word_chars = code_points(text)
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = lost = 0
    good: list[bytes] = []
    for line in text.split(b"\n"):
        k = len(line.split())
        if not k:
            good.append(line)
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        if line_fails(line, k, symbols_per_10_words):
            lost += code_points(line)
        else:
            good.append(line)
    repeat = repeated_words(words)
    base_failed = n < 20 or 100 * repeat > 30 * n
    kept = not base_failed and 100 * lost <= most_lost_percent * word_chars
    return (n, word_chars, n_symbols, dup, repeat, base_failed, kept, lost), good


FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lost_chars", pa.int64())]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols_per_10_words: int = 3, most_lost_percent: int = 50, with_text: bool = False) -> DataFrame:
    """Per row the id, the figures of :func:`judge` and, on request, the text without failed lines (``clean_text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for t in batch.column(1).to_pylist():
                row, good = judge(t, symbols_per_10_words, most_lost_percent)
                rows.append(row)
                if with_text:
                    texts.append(b"\n".join(good).decode("utf-8", "replace"))
            cols = list(zip(*rows, strict=True)) or [[] for _ in FIELDS]
            arrays = [batch.column(0), *(pa.array(c, kind) for c, (_, kind) in zip(cols, FIELDS, strict=True))]
            names = [id_col, *(n for n, _ in FIELDS)]
            if with_text:
                arrays.append(pa.array(texts, pa.string()))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kinds = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType()}
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, kinds[k]) for n, k in FIELDS)])
    if with_text:
        schema = schema.add("clean_text", T.StringType())
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(lean(run), schema)


def keep_good(docs: DataFrame, text_col: str = "text", symbols_per_10_words: int = 3, most_lost_percent: int = 50) -> DataFrame:
    """The rows that pass, without their failed lines; other columns as they were, but ``n_chars``, where there is one, follows.

    Rows are judged where they lie, without a shuffle.
    """
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, texts = [], []
            for t in batch.column(at).to_pylist():
                row, good = judge(t and t.encode(), symbols_per_10_words, most_lost_percent)
                kept.append(row[6])
                if row[6]:
                    texts.append(b"\n".join(good).decode("utf-8", "replace"))
            cols = batch.filter(pa.array(kept, pa.bool_())).columns
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.mapInArrow(lean(run), docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


_BOIL_SQL = BOILERPLATE.replace("'", "''")
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT doc_id, r, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i : i + 7], ' ') AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(8) x(j) GROUP BY r),
l AS (SELECT r, p, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k FROM
  (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM d)),
f AS (SELECT r, p, line, k, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
  length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS sym,
  length(line) - length(regexp_replace(line, '[|»›•·]', '', 'g')) AS bars,
  length(line) - length(regexp_replace(line, '[A-Z]', '', 'g')) AS up,
  length(line) - length(regexp_replace(line, '[a-z]', '', 'g')) AS low,
  regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BOIL_SQL}') AS boil,
  regexp_matches(line, '[0-9A-Za-z]|[^\x00-\x7F]') AS body, regexp_matches(line, '[.!?:;,]') AS mark,
  row_number() OVER (PARTITION BY r, line ORDER BY p) AS nth FROM l WHERE k > 0),
g AS (SELECT r, sum(CASE WHEN nth > 1 THEN 1 ELSE 0 END) AS dup, sum(CASE WHEN 10 * sym > 3 * k OR (bars >= 2 AND 4 * bars >= k)
  OR (k <= 40 AND boil) OR (up >= 10 AND up > 4 * low) OR NOT body OR (k >= 40 AND NOT mark) THEN chars ELSE 0 END) AS lost FROM f GROUP BY r),
a AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_chars
  FROM w LEFT JOIN rep USING (r) LEFT JOIN g USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost_chars <= 50 * word_chars AS kept, n_lost_chars FROM a
"""
