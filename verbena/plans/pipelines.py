"""Named pipelines: status, generate and validate, over entries, memories and written outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audits, coverage, lookup

#: What a run's state is called, by whether entries miss and checks fail.
READY, MISSING = "pronto", "faltando"


def status(entries: DataFrame, memory: DataFrame) -> DataFrame:
    """Coverage of each flow, and one word for it."""
    c = coverage.by_flow(entries, memory)
    return c.withColumn("status", F.when(F.col("ready"), READY).otherwise(MISSING))


def generate(entries: DataFrame, memory: DataFrame, fall_back: bool = False) -> DataFrame:
    """entries with `output`: the translation; with `fall_back` the source text where there is none."""
    looked = lookup.fallback(entries, memory, lookup.escaped_forms)
    return looked.withColumn("output", F.coalesce("target", "source") if fall_back else F.col("target"))


def validate(entries: DataFrame, memory: DataFrame, written: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """check, expected, actual, ok: nothing missing, nothing written otherwise than chosen, only known targets, clean values."""
    made = generate(entries, memory)
    wrong = coverage.verified(written, made.filter("output is not null"), key, "output").agg(F.count("*").alias("n"))
    unknown = lookup.known_targets(written.filter("output is not null"), memory, "output").agg(F.count_if(~F.col("known")).alias("n"))
    missing = coverage.missing_texts(entries, memory, asset=key[0]).agg(F.count("*").alias("n"))
    unclean = audits.values_are_clean(audits.encoding_findings(memory)).withColumnRenamed("value_findings", "n")
    named = {"missing": missing, "written_otherwise": wrong, "unknown_targets": unknown, "value_findings": unclean}
    metrics = [coverage.metric(df, name, "n") for name, df in named.items()]
    return coverage.expectations(reduce(DataFrame.unionByName, metrics), dict.fromkeys(named, 0))
