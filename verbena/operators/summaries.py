"""Small summaries over entries, reports and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def without(df: DataFrame, reasons: list[str], column: str = "reason") -> tuple[DataFrame, DataFrame]:
    """The rows whose reason isn't one of these, and how many rows each of these took away."""
    hit = F.coalesce(F.col(column).isin(reasons), F.lit(False))
    return df.filter(~hit), df.filter(hit).groupBy(column).agg(F.count("*").alias("n"))


def keys_by_source(entries: DataFrame, prefix: str = "character_name_") -> DataFrame:
    """source, entries, keys (sorted), only_prefixed: whether every key of a source starts with a prefix."""
    every = F.bool_and(F.coalesce(F.col("key").startswith(prefix), F.lit(False)))
    return entries.groupBy("source").agg(F.count("*").alias("entries"), F.array_join(F.array_sort(F.collect_set("key")), ",").alias("keys"), every.alias("only_prefixed"))


def blank_memory(missing: DataFrame) -> DataFrame:
    """Each missing text once with an empty target, to be filled in."""
    return missing.select("source").filter(~T.is_blank(F.col("source"))).distinct().withColumn("target", F.lit(""))


def file_pairs(exported: DataFrame, translated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """source and target of entries with one file and id, the last pair of a source; and counts of found and not found."""
    t = translated.select("file", "id", F.col("text").alias("target"))
    joined = exported.select("file", "id", "line_no", F.col("text").alias("source")).join(t, ["file", "id"], "left")
    counts = joined.agg(F.count("target").alias("found"), F.count_if(F.col("target").isNull()).alias("not_found"))
    pairs = joined.filter("target is not null").groupBy("source").agg(F.max_by("target", F.struct("file", "line_no")).alias("target"))
    return pairs, counts


def relocation_counts(relocated: DataFrame) -> DataFrame:
    """place, strings: how many strings are found exactly, mentioned only, or not at all."""
    place = F.when(F.col("exact_in").isNotNull(), "exact").when(F.col("mentioned_in").isNotNull(), "mentioned").otherwise("nowhere")
    return relocated.groupBy(place.alias("place")).agg(F.count("*").alias("strings"))


def memory_of_flow(flow: Column, routes: dict[str, str], default: str) -> Column:
    """The memory that a flow's translations belong to."""
    out = None
    for name, memory in routes.items():
        out = F.when(flow == name, memory) if out is None else out.when(flow == name, memory)
    return F.lit(default) if out is None else out.otherwise(default)


def change_log(changes: DataFrame) -> DataFrame:
    """line: one line per changed text, line breaks written out."""
    cell = lambda c: F.coalesce(T.escape_controls(F.col(c)), F.lit(""))
    return changes.filter(~F.col("before").eqNullSafe(F.col("after"))).select(F.concat(cell("source"), F.lit(": "), cell("before"), F.lit(" -> "), cell("after")).alias("line"))


def first_entries(memory: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """The first n entries in their order: a run's test mode."""
    return memory.orderBy(order).limit(n)
