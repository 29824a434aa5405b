"""A Merkle manifest of a dataset: nested structs rolled up by the digits of ranks.

Each row is a leaf. Leaves are ranked within their group, and the digits of the rank to base eight are grouped away one after
another, lowest first: what a digit's group collects, in order, are the children of one node. Four digits make a block of at most
4,096 leaves, which is one row with a struct for each node and its children inside it; all four groupings need one shuffle. The roots
of blocks are the leaves of the next round, up to one root a group; the roots of the groups, ranked by group, go the same way.

Proofs come down the same structs: the children of a node are taken apart with what stands before and behind each. A block and the
proof of its own root meet by a grouping of two rows, so nothing is joined below the ranks and no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tractworks.llm.common import fold_of, read, settle

#: Children of a node, and digits that a block holds.
FAN, DIGITS = 8, 4
#: The fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: of each field its bytes in UTF-8, a colon and the value, or a hyphen where it is null."""

    def written(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(written, fields))


def height(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return sum(((n > FAN**k).cast("int") for k in range(20)), F.lit(0))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with their rank within ``g`` by ``order`` (nulls first, from zero) and the group's size ``n``.

    Rows are sorted over all tasks and kept; a row's number in its partition and the sizes of partitions give its rank.
    """
    at = rows.orderBy(F.asc_nulls_first("g"), *(F.asc_nulls_first(c) for c in order)).withColumn("at", F.monotonically_increasing_id())
    kept = settle(at).withColumn("part", F.shiftright("at", 33))
    runs = kept.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))  # a row a partition, and one more a group
    w = Window.partitionBy("g")
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("n", F.sum("rows").over(w))
    runs = runs.select(F.col("g").alias("__g"), F.col("part").alias("__part"), "first", "before", "n")
    placed = kept.join(runs, kept["g"].eqNullSafe(runs["__g"]) & (kept["part"] == runs["__part"]))
    return placed.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "n")


def rolled(nodes: DataFrame) -> DataFrame:
    """(g, height, block, node) of nodes (g, height, rank, node): each block of ``FAN ** DIGITS`` ranks as one nested node."""
    digits = [f"d{k}" for k in range(DIGITS)]
    rows = nodes.select("g", "height", F.expr(f"rank div {FAN**DIGITS}").alias("block"), *(F.expr(f"rank div {FAN**k} % {FAN}").alias(d) for k, d in enumerate(digits)), "node").repartition("g", "block")
    for k, digit in enumerate(digits):
        keys = ["g", "height", "block", *digits[k + 1 :]]
        kids = F.array_sort(F.collect_list(F.struct(digit, "node"))).alias("kids")
        rows = rows.groupBy(*keys).agg(kids).select(*keys, F.col("kids.node").alias("kids"))
        # above the group's root there is one child, which is the node itself
        h = F.when(F.col("height") > k, F.sha2(F.array_join(F.col("kids.h"), ""), 256)).otherwise(F.col("kids")[0]["h"])
        rows = rows.select(*keys, F.struct(h.alias("h"), "kids").alias("node"))
    return rows


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of each round, lowest first; in the last one each group is one block."""
    most = nodes.agg(F.max("height")).first()[0] or 0  # one number
    out = []
    for _ in range(max(1, -(-most // DIGITS))):
        blocks = settle(rolled(nodes))
        out.append(blocks)
        nodes = blocks.select("g", F.greatest(F.col("height") - DIGITS, F.lit(0)).alias("height"), F.col("block").alias("rank"), F.struct(F.col("node.h").alias("h")).alias("node"))
    return out


def opened(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes of nested blocks (g, rank, height, node, path, carried): each with the path from itself to the root.

    A path is an array of what stands before and behind the node on each level, lowest first.
    """
    rows = blocks
    for k in reversed(range(DIGITS)):
        near = F.transform("node.kids", lambda c, i: F.struct(i.alias("i"), c.alias("node"), F.array_join(F.slice("node.kids.h", F.lit(1), i), "").alias("before"), F.array_join(F.slice("node.kids.h", i + 2, F.lit(FAN)), "").alias("after")))
        rows = rows.select("g", "rank", "height", "path", *carried, F.explode(near).alias("s"))
        step = F.array(F.struct("s.before", "s.after"))
        rows = rows.select("g", (F.col("rank") * FAN + F.col("s.i")).alias("rank"), "height", F.when(F.col("height") > k, F.concat(step, "path")).otherwise(F.col("path")).alias("path"), *carried, F.col("s.node").alias("node"))
    return rows


def descended(rounds: list[DataFrame], top: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The lowest nodes with their paths; ``top``: (g, path, carried) of each group's root."""
    above = top.select("g", F.lit(0).cast("bigint").alias("rank"), "path", *carried)
    rows = above
    for blocks in reversed(rounds):
        both = blocks.select("g", F.col("block").alias("rank"), "height", "node").unionByName(above, allowMissingColumns=True)
        met = both.groupBy("g", "rank").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "path", *carried)))
        rows = opened(met, carried)
        above = rows.select("g", "rank", "path", *carried)
    return rows


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", shown: dict[str, Column] | None = None) -> DataFrame:
    """order, leaf, subroot, root, path, shown_leaf, folded_root, verified: a row's leaf, the roots above it and the proof of its place.

    ``path`` lists what stands before and behind the row's node on each level, up to the root. ``shown`` gives other values of some
    fields, as they are shown to a verifier: ``folded_root`` is what the leaf of these and the path lead to, ``verified`` whether
    that is the root. Groups come null first, rows by ``order``, nulls first, ties by leaf; so repeated rows are leaves of their own and
    the result does not depend on the order of input rows. Null fields count as null, empty texts as empty; an empty table has no
    rows and no root. Columns other than the named ones are not looked at.
    """
    column = lambda c: F.col(f"`{c}`")
    leaf = leaf_of([column(c) for c in fields])
    seen = leaf_of([(shown or {}).get(c, column(c)) for c in fields])
    rows = docs.select(column(group).alias("g"), column(order).alias("key"), leaf.alias("leaf"), (seen if shown else leaf).alias("seen"))
    placed = ranked(rows, ["key", "leaf"])
    low = climbed(placed.select("g", height(F.col("n")).alias("height"), "rank", F.struct(F.col("leaf").alias("h"), "key", "seen").alias("node")))
    groups = low[-1].select(F.lit(0).alias("g"), F.col("g").alias("name"), F.col("node.h").alias("h"))
    high = climbed(ranked(groups, ["name"]).select("g", height(F.col("n")).alias("height"), "rank", F.struct("h", "name").alias("node")))
    root = high[-1].select("g", F.array().cast("array<struct<before:string,after:string>>").alias("path"), F.col("node.h").alias("root"))
    tops = descended(high, root, ["root"]).select(F.col("node.name").alias("g"), "path", "root", F.col("node.h").alias("subroot"))
    found = descended(low, tops, ["root", "subroot"])
    folded = F.aggregate("path", F.col("node.seen"), lambda h, s: digest(s["before"], h, s["after"]))
    out = found.select(F.col("node.key").alias(order), F.col("node.h").alias("leaf"), "subroot", "root", "path", F.col("node.seen").alias("shown_leaf"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document; every third one's text is shown in lower case."""
    docs = read(spark, sf_dir, "documents").select(*FIELDS)
    shown = F.when(fold_of("doc_id", 3) == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = manifest(docs, shown={"text": shown})
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def _sql(levels: int = 8, group_levels: int = 4) -> str:
    """The same with a level a step; ``levels`` hold 8 ** 8 documents a language."""
    crc = "SELECT i, i AS v FROM range(256) r(i)"
    for _ in range(8):
        crc = f"SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({crc})"
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    parts = [
        f"crc AS (SELECT list(v ORDER BY i) AS tab FROM ({crc}))",
        "id AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x) + 1), lambda k: ascii(x[k])::BIGINT)), lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM (SELECT *, coalesce(doc_id::VARCHAR, '') AS x FROM documents), crc)",
        f"leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(f'''CASE WHEN crc % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END''')} AS f FROM id)",
        "p AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM leaves)",
        "a0 AS (SELECT g, r, n, leaf AS h FROM p)",
    ]

    def up(name: str, k: int) -> list[str]:
        runs = f"{name}r{k} AS (SELECT g, r // {FAN} AS r, any_value(n) AS n, list(h ORDER BY r) AS hs FROM {name}{k} GROUP BY g, r // {FAN})"
        return [runs, f"{name}{k + 1} AS (SELECT g, r, (n + {FAN - 1}) // {FAN} AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{k})"]

    for k in range(levels):
        parts += up("a", k)
    parts.append(f"b0 AS (SELECT 0 AS g, g AS r, count(*) OVER () AS n, h FROM a{levels})")
    for k in range(group_levels):
        parts += up("b", k)
    now = "p0"
    parts.append(f"p0 AS (SELECT p.*, '' AS proof, s.h AS subroot, t.h AS root FROM p JOIN a{levels} s USING (g) CROSS JOIN b{group_levels} t)")
    for name, count, rank, key in (("a", levels, "r", "x.g"), ("b", group_levels, "g", "0")):
        for k in range(count):
            at = f"{rank} // {FAN**k} % {FAN}"
            before, after = f"array_to_string(hs[1:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"
            new = f"{name}p{k}"
            parts.append(f"{new} AS (SELECT * EXCLUDE (hs, before, after, more), proof || CASE WHEN more THEN before || after ELSE '' END AS proof2, CASE WHEN more THEN sha256(before || f || after) ELSE f END AS f2 FROM (SELECT x.*, y.hs, {before.replace(rank + ' //', 'x.' + rank + ' //')} AS before, {after.replace(rank + ' //', 'x.' + rank + ' //')} AS after, y.n > 1 AS more FROM {now} x JOIN {name}r{k} y ON y.g = {key} AND y.r = x.{rank} // {FAN ** (k + 1)}))")
            parts.append(f"{new}n AS (SELECT * EXCLUDE (proof, f, proof2, f2), proof2 AS proof, f2 AS f FROM {new})")
            now = f"{new}n"
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM {now}"


SQL = _sql()
