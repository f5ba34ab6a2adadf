"""Looking texts up in a memory: single keys, ordered fallback keys, layers, membership.

The memory side is a DataFrame and is joined, never collected; whether it is broadcast is
AQE's decision by its measured size. Distinct texts are looked up once and joined back, so a
text that stands in a third of all rows costs one lookup, and AQE splits its rows in the join
back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def exact(rows: DataFrame, memory: DataFrame, text_col: str = "source") -> DataFrame:
    """rows with `target` and `state`: translated, identity, blank or missing."""
    m = memory.select(F.col("source").alias("_key"), "target", F.lit(True).alias("_hit"))
    joined = rows.join(m, F.col(text_col) == F.col("_key"), "left").drop("_key")
    state = F.when(F.col("_hit").isNull(), "missing").when(T.is_blank(F.col("target")), "blank").when(F.col("target") == F.col(text_col), "identity").otherwise("translated")
    return joined.withColumn("state", state).drop("_hit")


def raw_and_unescaped(text: Column) -> list[Column]:
    """The text as it stands, trimmed, unescaped, unescaped and trimmed."""
    return [text, T.ws_trim(text), T.unescape(text), T.ws_trim(T.unescape(text))]


def escaped_forms(text: Column) -> list[Column]:
    """The text, with control characters written out, and fully escaped; each also trimmed."""
    forms = [text, T.escape_controls(text), T.escape_dump(text)]
    return [x for f in forms for x in (f, T.ws_trim(f))]


def fallback(rows: DataFrame, memory: DataFrame, keys=raw_and_unescaped, text_col: str = "source", unescape_value: bool = False) -> DataFrame:
    """rows with `target` and `matched` (from 1): the first key with a usable target wins; null if none has one."""
    distinct = rows.select(F.col(text_col).alias("_text")).filter("_text is not null").distinct()
    candidates = distinct.select("_text", F.posexplode(F.array_distinct(F.array(*keys(F.col("_text"))))).alias("_i", "_key"))
    m = memory.filter(~T.is_blank(F.col("target"))).select(F.col("source").alias("_key"), F.col("target").alias("_target"))
    best = candidates.join(m, "_key").groupBy("_text").agg(F.min_by("_target", "_i").alias("target"), (F.min("_i") + 1).alias("matched"))
    if unescape_value:
        best = best.withColumn("target", T.unescape(F.col("target")))
    return rows.join(best, F.col(text_col) == F.col("_text"), "left").drop("_text")


def layered(rows: DataFrame, layers: list[tuple[str, DataFrame]], text_col: str = "source") -> DataFrame:
    """rows with `target` and `layer`: the first layer with a usable target wins."""
    tagged = [m.filter(T.usable(F.col("target"))).select("source", "target", F.lit(i).alias("_rank"), F.lit(name).alias("layer")) for i, (name, m) in enumerate(layers)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    best = union.groupBy(F.col("source").alias("_key")).agg(F.min_by("target", "_rank").alias("target"), F.min_by("layer", "_rank").alias("layer"))
    return rows.join(best, F.col(text_col) == F.col("_key"), "left").drop("_key")


def known_targets(rows: DataFrame, memory: DataFrame, text_col: str) -> DataFrame:
    """rows with `known`: whether the text is a target of the memory, unescaped, whatever its source."""
    targets = memory.select(T.unescape(F.col("target")).alias("_t")).filter("_t is not null").distinct().withColumn("known", F.lit(True))
    return rows.join(targets, F.col(text_col) == F.col("_t"), "left").drop("_t").withColumn("known", F.coalesce("known", F.lit(False)))


def asset_or_memory(rows: DataFrame, memory: DataFrame, fall_back: bool = False) -> DataFrame:
    """rows (en, br) with `chosen`, `origin` and `conflict`: the asset's own text before the memory's."""
    m = memory.filter(T.usable(F.col("target"))).select(F.col("source").alias("_key"), F.col("target").alias("_mem"))
    own = F.when(T.usable(F.col("br")), F.col("br"))
    joined = rows.join(m, F.col("en") == F.col("_key"), "left")
    chosen = F.coalesce(own, F.col("_mem"), *([F.col("en")] if fall_back else []))
    origin = F.when(own.isNotNull(), "asset").when(F.col("_mem").isNotNull(), "memory").otherwise("missing")
    conflict = F.coalesce(own.isNotNull() & (F.col("_mem") != own), F.lit(False))
    return joined.withColumn("chosen", chosen).withColumn("origin", origin).withColumn("conflict", conflict).drop("_key", "_mem")


def marked_members(rows: DataFrame, memory: DataFrame, text_col: str = "source", flag: str = "in_memory") -> DataFrame:
    keys = memory.select(F.col("source").alias("_k")).distinct().withColumn("_in", F.lit(True))
    return rows.join(keys, F.col(text_col) == F.col("_k"), "left").withColumn(flag, F.col("_in").isNotNull()).drop("_k", "_in")
