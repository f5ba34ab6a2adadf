"""Coverage of entries by a memory, and the gates that rest on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import lookup, pair_counts, substrings


def by_flow(entries: DataFrame, memory: DataFrame, keys=lookup.escaped_forms, flow: str = "flow", asset: str = "asset") -> DataFrame:
    """flow, occurrences, empty, translated, missing, missing_unique, ready. Blank texts are counted, not missing."""
    looked = lookup.fallback(entries, memory, keys)
    blank = T.is_blank(F.col("source"))
    missing = ~blank & F.col("target").isNull()
    # one row per asset and text first: a text standing in a third of all rows is summed on the map side
    parts = looked.groupBy(flow, asset, "source").agg(F.count("*").alias("_n"), F.count_if(blank).alias("_e"), F.count_if(missing).alias("_m"))
    return parts.groupBy(flow).agg(
        F.sum("_n").alias("occurrences"),
        F.sum("_e").alias("empty"),
        (F.sum("_n") - F.sum("_e") - F.sum("_m")).alias("translated"),
        F.sum("_m").alias("missing"),
        F.count_if(F.col("_m") > 0).alias("missing_unique"),
    ).withColumn("ready", F.col("missing") == 0)


def missing_texts(entries: DataFrame, memory: DataFrame, keys=lookup.escaped_forms, asset: str = "asset") -> DataFrame:
    """asset, source, occ_count of non-blank texts without a translation."""
    looked = lookup.fallback(entries, memory, keys).filter(F.col("target").isNull() & ~T.is_blank(F.col("source")))
    return looked.groupBy(asset, "source").agg(F.count("*").alias("occ_count"))


def by_table(rows: DataFrame, memory: DataFrame) -> DataFrame:
    """table_name, english, existing, from_memory, conflicts, missing of delimited tables."""
    chosen = lookup.asset_or_memory(rows.filter(~T.is_blank(F.col("en"))), memory)
    return chosen.groupBy("table_name").agg(
        F.count("*").alias("english"),
        F.count_if(F.col("origin") == "asset").alias("existing"),
        F.count_if(F.col("origin") == "memory").alias("from_memory"),
        F.count_if("conflict").alias("conflicts"),
        F.count_if(F.col("origin") == "missing").alias("missing"),
        F.count_distinct(F.when(F.col("origin") == "missing", F.col("en"))).alias("missing_unique"),
    )


def missing_unique(rows: DataFrame, memory: DataFrame) -> DataFrame:
    """One row: the missing texts of all tables, and how many of them are different; not a sum over tables."""
    chosen = lookup.asset_or_memory(rows.filter(~T.is_blank(F.col("en"))), memory).filter("origin = 'missing'")
    parts = chosen.groupBy("en").agg(F.count("*").alias("_n"))  # equal texts are put together on the map side
    return parts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("missing"), F.count("*").alias("missing_unique"))


def verified(written: DataFrame, expected: DataFrame, key: tuple[str, ...], value: str) -> DataFrame:
    """Rows that were read back and aren't what was chosen: key, expected, actual."""
    a = expected.select(*key, F.col(value).alias("expected"))
    b = written.select(*key, F.col(value).alias("actual"))
    return a.join(b, list(key), "full").filter(~F.col("expected").eqNullSafe(F.col("actual")))


def metric(df: DataFrame, name: str, column: str) -> DataFrame:
    """check, actual: one number of a one-row frame."""
    return df.select(F.lit(name).alias("check"), F.col(column).cast("long").alias("actual"))


def expectations(metrics: DataFrame, expected: dict[str, int]) -> DataFrame:
    """check, expected, actual, ok: each metric (check, actual) against what it must be."""
    wanted = F.create_map(*[F.lit(x) for k, v in expected.items() for x in (k, int(v))])
    rows = metrics.withColumn("expected", F.try_element_at(wanted, F.col("check")).cast("long"))
    return rows.select("check", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("ok"))


def status(checks: DataFrame) -> DataFrame:
    """One row: whether all checks hold, and the word for it."""
    return checks.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ready"), F.count_if(~F.col("ok")).alias("failed")).withColumn("status", F.when(F.col("ready"), "pronto").otherwise("revisao_necessaria"))


def artifact_state(current: DataFrame, previous: DataFrame) -> DataFrame:
    """flow, name, sha256, changed, no_history of each current artifact."""
    p = previous.select("flow", "name", F.col("sha256").alias("_old"))
    joined = current.join(p, ["flow", "name"], "left")
    return joined.select("flow", "name", "sha256", F.coalesce(F.col("_old") != F.col("sha256"), F.lit(False)).alias("changed"), F.col("_old").isNull().alias("no_history"))


def relocation(strings: DataFrame, files: DataFrame, text_col: str = "source") -> DataFrame:
    """source, exact_in, mentioned_in: names of files that hold a string as an entry, and of others that hold it within one.

    `files` has name and text, a row per entry. Every string is searched for in every entry, as
    part of a word too; a file counts as exact or as mentioning, string by string. Null and
    empty strings are left out, repeated ones stand once; null texts hold nothing. Texts are scanned,
    not cut into pieces (`substrings`): only bytes that a string may have are shuffled.
    """
    s = strings.select(F.col(text_col).alias("source")).filter("source is not null and source <> ''").distinct()
    hits = substrings.candidates(s, files.select("name", "text").filter("name is not null"))
    held = hits.groupBy("found", "name").agg(F.bool_or("whole").alias("_exact"))
    names = lambda hit: F.array_join(F.sort_array(F.collect_list(F.when(hit, F.col("name")))), ",")
    places = held.groupBy("found").agg(names(F.col("_exact")).alias("exact_in"), names(~F.col("_exact")).alias("mentioned_in"))
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    return s.join(places, F.col("source").cast("binary") == F.col("found"), "left").select("source", blank("exact_in"), blank("mentioned_in"))


def binary_windows(binaries: DataFrame, strings: DataFrame, size: int = 1 << 16) -> DataFrame:
    """name, text: overlapping windows of binary files (name, content), a character for each byte, for `binary_places`."""
    most = strings.agg(F.max(F.octet_length("source"))).first()[0] or 0
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("content"), F.lit(1)), F.lit(size))
    return binaries.select("name", "content", F.explode(starts).alias("_at")).select("name", F.decode(F.substring("content", F.col("_at"), F.lit(size + most)), "ISO-8859-1").alias("text"))


def binary_places(strings: DataFrame, binaries: DataFrame) -> DataFrame:
    """source, name of each binary file (name, content) whose bytes hold a string's UTF-8 bytes."""
    s = strings.select("source").filter("source is not null and source <> ''").distinct()
    shown = s.select("source", F.decode(F.encode("source", "UTF-8"), "ISO-8859-1").alias("_shown"))
    windows = binary_windows(binaries, s)
    held = substrings.candidates(shown.select(F.col("_shown").alias("source")), windows).select("name", "found").distinct()
    return held.join(shown, F.col("found") == F.col("_shown").cast("binary")).select("source", "name")


def relocation_by_asset(strings: DataFrame, relocated: DataFrame, binary: DataFrame | None = None) -> DataFrame:
    """asset, strings, exact, mentioned, nowhere, exact_files, mentioned_files, in_binaries of each asset's distinct strings.

    `strings` has asset and source, `binary` source and name. A string is nowhere if no file and
    no binary holds it, mentioned if it is in files but exact in none. Lists of files are sorted.
    """
    s = strings.select("asset", "source").filter("source is not null and source <> ''").distinct().join(relocated, "source", "left")
    places = binary.groupBy("source").agg(F.count("*").alias("_b")) if binary is not None else None
    s = s.join(places, "source", "left") if places is not None else s.withColumn("_b", F.lit(None).cast("long"))
    exact, mentioned = F.col("exact_in").isNotNull(), F.col("mentioned_in").isNotNull()
    files = lambda c: F.array_join(F.sort_array(F.array_distinct(F.split(F.array_join(F.collect_list(c), ","), ","))), ",")
    return s.groupBy("asset").agg(
        F.count("*").alias("strings"),
        F.count_if(exact).alias("exact"),
        F.count_if(~exact & mentioned).alias("mentioned"),
        F.count_if(~exact & ~mentioned & F.col("_b").isNull()).alias("nowhere"),
        F.count("_b").alias("in_binaries"),
        files("exact_in").alias("exact_files"),
        files("mentioned_in").alias("mentioned_files"),
    )


def relocation_by_destination(strings: DataFrame, relocated: DataFrame) -> DataFrame:
    """asset, destination, exact, mentioned: how many of an asset's distinct strings each file holds, and how.

    The rows grow as the square of the tables, for a word like `No` is in many assets and files; they are
    made where they are summed (`pair_counts`).
    """
    s = strings.select("asset", "source").filter("source is not null and source <> ''").distinct()
    assets = s.groupBy("source").agg(F.collect_list(F.struct("asset")).alias("assets"))
    places = lambda c: F.coalesce(F.split(c, ","), F.array().cast("array<string>")).alias(c)
    held = relocated.filter("exact_in is not null or mentioned_in is not null").join(assets, "source").select("assets", places("exact_in"), places("mentioned_in"))
    return pair_counts.by_pair(held, "assets", "exact_in", "mentioned_in").toDF("asset", "destination", "exact", "mentioned")
