"""Row filters on tract tables, wide or long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractworks.functions.codes import clean_label, whole
from tractworks.vocabulary import BANDS, LEVELS


def _member(df: DataFrame, value: Column, chosen: Sequence | None, on_empty: str) -> DataFrame:
    if chosen is None:
        return df.where(value.isNotNull())
    if not chosen:
        return df if on_empty == "all" else df.where("false")
    return df.where(value.isin(*chosen))


def by_situation(df: DataFrame, chosen: Sequence[str] | None = None, on_empty: str = "all") -> DataFrame:
    """Urban or rural; ``None`` keeps all rows that have a class, an empty choice all rows or none (``on_empty``)."""
    return _member(df, F.col("SITUACAO"), chosen, on_empty)


def by_situation_code(df: DataFrame, chosen: Sequence[int] | None = None, on_empty: str = "all") -> DataFrame:
    return _member(df, whole("CD_SITUACAO"), chosen, on_empty)


def by_tract_type(df: DataFrame, chosen: Sequence[int] | None = None, on_empty: str = "all") -> DataFrame:
    return _member(df, whole("CD_TIPO"), chosen, on_empty)


def by_regions(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows of the regions named ``TYPE — name`` (also ``TYPE: name``); ``Todas`` or nothing keeps all rows."""
    if not labels or "Todas" in labels:
        return df
    pairs = []
    for label in labels:
        kind, _, name = label.partition(" — ") if " — " in label else label.partition(": ")
        pairs.append((kind.strip().upper(), name.strip()))
    match = F.lit(False)
    for kind, name in pairs:
        match = match | ((F.upper("TIPO_RM_AU") == kind) & (F.col("REGIAO_RM_AU") == name))
    return df.where(match)


def place_key(level: str) -> Column:
    """The column that names a row's place at a level; one value for the whole state."""
    return F.lit("state") if LEVELS[level] is None else F.col(LEVELS[level]).cast("string")


def available_levels(df: DataFrame) -> DataFrame:
    """level, n_places of the levels whose column exists and holds values."""
    there = {k: c for k, c in LEVELS.items() if c is None or c in df.columns}
    counts = df.agg(*((F.max(F.lit(1)) if c is None else F.count_distinct(clean_label(c))).cast("bigint").alias(k) for k, c in there.items()))
    return counts.unpivot([], list(there), "level", "n_places").where("n_places > 0")


def at_place(df: DataFrame, level: str, place: str | None = None) -> DataFrame:
    """Rows of one place of a level."""
    return df if LEVELS[level] is None else df.where(place_key(level) == place)


def canonical_bands(df: DataFrame, band: str = "idade_grupo") -> DataFrame:
    return df.where(F.col(band).isin(*BANDS))


#: What widening goes by, in this order; regions by type and name.
WIDENING = (("CD_SETOR",), ("CD_MUN",), ("TIPO_RM_AU", "NOME_RM_AU"), ("RM_NOME",), ("AU_NOME",), ("NM_RGI",), ("NM_RGINT",))


def widened(df: DataFrame, scope: DataFrame) -> DataFrame:
    """The full data of the places that a filtered scope touches, by the first key for which the scope holds values.

    A scope of one single tract widens to that tract; then come municipalities, region pairs, single region names, immediate and
    intermediate regions; a scope without any gives all rows. The scope's distinct keys are joined in Spark, none go through the driver.
    """
    keys = [k for k in WIDENING if all(c in df.columns and c in scope.columns for c in k)]
    if not keys:
        return df

    def key(columns: tuple[str, ...]) -> Column:
        parts = [F.upper(c) if c == "TIPO_RM_AU" else F.col(c).cast("string") for c in columns]
        return F.when(F.lit(True) if len(parts) == 1 else parts[0].isNotNull() & parts[1].isNotNull(), F.concat_ws("\x1f", *parts) if len(parts) > 1 else parts[0])

    slots = [F.struct(F.lit(WIDENING.index(k)).alias("slot"), key(k).alias("key")) for k in keys]
    have = scope.select(F.inline(F.array(*slots))).where("key is not null").distinct()
    valid = have.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("slot <> 0 or n = 1")
    chosen = valid.agg(F.coalesce(F.min("slot"), F.lit(-1)).alias("slot"))  # one row
    places = have.join(F.broadcast(chosen), "slot").select(F.col("key").alias("__key")).unionByName(chosen.where("slot = -1").select(F.lit("").alias("__key")))
    one = F.broadcast(chosen.select(F.lit(1).alias("__one"), F.col("slot").alias("__slot")))
    own = F.when(F.col("__slot") == -1, F.lit(""))
    for k in keys:
        own = own.when(F.col("__slot") == WIDENING.index(k), key(k))
    rows = df.withColumn("__one", F.lit(1)).join(one, "__one").withColumn("__key", own)
    return rows.join(places, "__key", "left_semi").select(*(F.col(f"`{c}`") for c in df.columns))


def included_excluded(rows: DataFrame, kept: Column, code: str, labels: dict[int, str], place: str = "CD_MUN") -> DataFrame:
    """Per place the labels of a code that a selection keeps and leaves out, and whether it is a true subset.

    ``kept`` says whether the selection keeps a row (null: no). Codes become bits of one number (``labels`` has at most 63 of them, other
    codes do not count), so one pass over the rows ors two numbers a place. Places without a known code have no row.
    """
    codes = sorted(labels)
    if len(codes) > 63:
        raise ValueError("more codes than bits")
    bit = F.coalesce(*(F.when(whole(code) == c, F.lit(1 << k)) for k, c in enumerate(codes)))
    both = rows.groupBy(place).agg(F.bit_or(bit).alias("__all"), F.bit_or(F.when(kept, bit)).alias("__kept")).where("__all is not null")
    has = lambda bits: F.array_sort(F.array_compact(F.array(*(F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, F.lit(labels[c])) for k, c in enumerate(codes)))))
    held = F.coalesce(F.col("__kept"), F.lit(0))
    left = F.col("__all").bitwiseAND(F.bitwise_not(held))
    return both.select(place, has(held).alias("included"), has(left).alias("excluded"), (left != 0).alias("is_subset"))
