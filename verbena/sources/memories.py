"""Translation memories: JSON objects of source and target, as rows memory_id, ord, source, target.

A key that stands several times counts once, with its last value and its first place. `ord`
is the place in the file; a memory is never a dictionary on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMORY = "memory_id string, ord long, source string, target string"


def last_wins(entries: DataFrame, key: str = "source", value: str = "target", order: str = "ord", by: tuple[str, ...] = ("memory_id",)) -> DataFrame:
    """One row a key: its last value, its first place."""
    return entries.groupBy(*by, key).agg(F.min(order).alias(order), F.max_by(value, order).alias(value))


def first_wins(entries: DataFrame, key: str = "source", value: str = "target", order: str = "ord", by: tuple[str, ...] = ("memory_id",)) -> DataFrame:
    return entries.groupBy(*by, key).agg(F.min(order).alias(order), F.min_by(value, order).alias(value))


def objects(texts: DataFrame, text_col: str = "value", id_col: str = "memory_id") -> DataFrame:
    """Entries of JSON objects, one text each; texts that are no object give no entry."""
    body = F.regexp_replace(F.col(text_col), "^﻿", "")
    entries = F.map_entries(F.from_json(F.when(body.rlike(r"(?s)^\s*\{"), body), "map<string,string>"))
    rows = texts.select(F.col(id_col).alias("memory_id"), F.posexplode(entries).alias("ord", "e"))
    return last_wins(rows.select("memory_id", F.col("ord").cast("long"), F.col("e.key").alias("source"), F.col("e.value").alias("target")))


def faults(texts: DataFrame, text_col: str = "value", id_col: str = "memory_id") -> DataFrame:
    """Memories that aren't objects of strings: id, fault."""
    body = F.regexp_replace(F.col(text_col), "^﻿", "")
    parsed = F.try_parse_json(body)
    kinds = F.transform(F.map_values(F.from_json(body, "map<string,variant>")), lambda v: F.schema_of_variant(v))
    fault = (
        F.when(~F.coalesce(body.rlike(r"(?s)^\s*\{"), F.lit(False)), "not_an_object")
        .when(parsed.isNull() & F.from_json(body, "map<string,string>").isNull(), "invalid_json")
        .when(F.exists(kinds, lambda k: k != "STRING"), "value_is_no_string")
    )
    return texts.select(F.col(id_col).alias("memory_id"), fault.alias("fault")).filter("fault is not null")


def read_lenient(spark: SparkSession, *paths: str) -> DataFrame:
    """Memories of files; files that are missing or hold no object give no rows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
    if not there:
        return spark.createDataFrame([], MEMORY)
    return objects(_whole(spark, *there))


def read_strict(spark: SparkSession, *paths: str, typed: bool = False) -> DataFrame:
    """Memories of files; the read fails on a file that is no object, with `typed` also on values that are no strings."""
    texts = _whole(spark, *paths)
    bad = faults(texts).filter("typed or fault <> 'value_is_no_string'".replace("typed", str(typed).lower()))
    first = bad.first()
    if first:
        raise ValueError(f"{first.memory_id}: {first.fault}")
    return objects(texts)


def _whole(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_name").alias("memory_id"), "value")


def replacement_value(value: Column) -> Column:
    """A change record's new text: a string itself, or the first of depois, pt_final and sugestao of an object."""
    named = F.coalesce(*[F.get_json_object(value, f"$.{k}") for k in ("depois", "pt_final", "sugestao")])
    return F.when(value.rlike(r"(?s)^\s*\{"), named).otherwise(value)


def as_of(versions: DataFrame, at: Column, key: tuple[str, ...] = ("memory_id", "source"), version: str = "version") -> DataFrame:
    """The rows of each key's last version not after `at`: a snapshot of a versioned memory."""
    rest = [c for c in versions.columns if c not in key]
    last = versions.filter(F.col(version) <= at).groupBy(*key).agg(F.max_by(F.struct(*rest), version).alias("_r"))  # on the map side first
    return last.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in versions.columns])


def salvaged_object(answer: Column) -> Column:
    """The JSON object of an answer: the whole text, else from its first brace to its last; null if neither parses."""
    cut = F.regexp_extract(answer, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(answer).isNotNull() & answer.rlike(r"(?s)^\s*\{"), answer).when(F.try_parse_json(cut).isNotNull(), cut)
