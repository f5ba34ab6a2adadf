"""Audits of memories: encoding, untranslated texts, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions import text as T
from ..functions.udfs import faults_with_context, is_nfc
from ..session import ship


def encoding_findings(memory: DataFrame, with_context: bool = False, raw: bool = False) -> DataFrame:
    """source, side (key or value), type, match of each fault; texts that aren't NFC have a row without match.

    `with_context` adds `code_points` of the match and `context`, up to 35 characters on both
    sides of it (the first 100 of a text that isn't NFC); only texts with a fault leave the JVM
    for it. `raw` says that the texts are JSON as written, where lone surrogates can be seen.
    """
    ship(memory.sparkSession)
    sides = []
    for side, column in (("key", "source"), ("value", "target")):
        rows = memory.select("source", F.lit(side).alias("side"), F.col(column).alias("_t")).filter("_t is not null")
        text = F.col("_t")
        if with_context:
            found = F.explode(faults_with_context(F.when(F.exists(F.array(*[text.rlike(p) for p in T.ENCODING_FAULTS.values()]), lambda x: x), text)))
            sides.append(rows.select("source", "side", found.alias("f")).select("source", "side", "f.type", "f.match", T.code_points(F.col("f.match")).alias("code_points"), "f.context"))
        else:
            sides.append(rows.select("source", "side", F.explode(T.encoding_faults(text)).alias("f")).select("source", "side", "f.type", "f.match"))
        none = F.lit(None).cast("string")
        if raw:
            alone = rows.select("source", "side", F.lit("lone_surrogate").alias("type"), F.explode(T.lone_surrogates(text)).alias("match"), *([none.alias("code_points"), none.alias("context")] if with_context else []))
            sides.append(alone.withColumn("code_points", F.concat(F.lit("U+"), F.upper(F.substring("match", 3, 4)))) if with_context else alone)
        # pure ASCII is NFC; only other texts go through the UDF
        unsafe = rows.filter(text.rlike(r"[^\x00-\x7F]")).filter(~is_nfc("_t"))
        sides.append(unsafe.select("source", "side", F.lit("not_nfc_normalized").alias("type"), none.alias("match"), *([none.alias("code_points"), F.left(text, F.lit(100)).alias("context")] if with_context else [])))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out


def punctuation_warnings(memory: DataFrame) -> DataFrame:
    """source, excess: targets with more question marks than their source and none within a word."""
    excess = T.question_excess(F.col("source"), F.col("target"))
    inside = F.col("target").rlike(T.ENCODING_FAULTS["question_mark_inside_word"])
    return memory.filter((excess > 0) & ~inside).select("source", excess.alias("excess"))


def values_are_clean(findings: DataFrame) -> DataFrame:
    """One row: findings in keys, in values, and whether the values have none; keys don't gate."""
    return findings.agg(F.count_if(F.col("side") == "key").alias("key_findings"), F.count_if(F.col("side") == "value").alias("value_findings")).withColumn("clean_values", F.col("value_findings") == 0)


def identity_class(source: Column, exceptions: dict[str, str] | None = None) -> Column:
    """What a target equal to its source is: technical, ambiguous or untranslated. `exceptions` names texts' classes."""
    strong = T.lexicon_hits(source, lexicon.STRONG_ENGLISH)
    told = F.when(T.technical(source), "technical_or_nonlinguistic")
    for text, kind in (exceptions or {}).items():
        told = told.when(source == text, kind)
    return told.when((F.size(T.words(source)) >= 4) | (F.size(strong) > 0), "untranslated").otherwise("ambiguous_identity")


def untranslated(exported: DataFrame, output: DataFrame, memory: DataFrame, exceptions: dict[str, str] | None = None) -> DataFrame:
    """source, target, occurrences, first_line, bucket, matched, still_english of each distinct exported text.

    `exported` and `output` have file, place and value (`exported` also line_no); rows at the
    same place of a file belong together. Buckets: missing_memory, empty_translation, the
    classes of identity, partial_english, translated.
    """
    out = output.select("file", "place", F.col("value").alias("_out"))
    paired = exported.filter(~T.is_blank(F.col("value"))).join(out, ["file", "place"], "left")
    same = F.coalesce(F.col("_out") == F.col("value"), F.lit(False))
    unique = paired.groupBy(F.col("value").alias("source")).agg(F.count("*").alias("occurrences"), F.min("line_no").alias("first_line"), F.bool_or(same).alias("output_as_source"))
    joined = unique.join(memory.select("source", "target", F.lit(True).alias("_known")), "source", "left")
    partial = T.lexicon_hits(F.col("target"), lexicon.PARTIAL_ENGLISH)
    bucket = (
        F.when(F.col("_known").isNull(), "missing_memory")
        .when(T.is_blank(F.col("target")), "empty_translation")
        .when(F.col("target") == F.col("source"), identity_class(F.col("source"), exceptions))
        .when(F.size(partial) > 0, "partial_english")
        .otherwise("translated")
    )
    rows = joined.withColumn("bucket", bucket)
    matched = F.when(F.col("bucket") == "partial_english", partial).when(F.col("bucket") == "untranslated", T.lexicon_hits(F.col("source"), lexicon.STRONG_ENGLISH))
    translated = F.col("bucket").isin("partial_english", "translated")
    return rows.select(
        "source", "target", "occurrences", "first_line", "bucket", F.array_join(F.array_sort(matched), ",").alias("matched"),
        (F.col("output_as_source") & (F.col("bucket") == "untranslated")).alias("still_english"),
        (F.col("output_as_source") & translated).alias("not_in_output"),
    )


def name_findings(memory: DataFrame, names: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """source, target, name, kind: names changed where they are the whole text, missing from the target, or not in their canonical form.

    `names` is a cast of characters, a bounded list; each text is searched for all of them at once.
    """
    rows = memory.select("source", F.coalesce("target", F.lit("")).alias("target"))
    here = rows.withColumn("_there", T.names_in(F.col("target"), names)).withColumn("name", F.explode(T.names_in(F.col("source"), names)))
    trimmed = T.ws_trim
    kind = F.when((trimmed(F.col("source")) == F.col("name")) & (trimmed(F.col("target")) != F.col("name")), "exact_name_changed").when(~F.array_contains("_there", F.col("name")), "missing_from_target")
    out = here.select("source", "target", "name", kind.alias("kind")).filter("kind is not null")
    for canonical, forms in (aliases or {}).items():
        shown, answer = T.strip_for_names(F.col("source")), T.strip_for_names(F.col("target"))
        any_form = T.has_displayed_name(shown, forms[0])
        for form in forms[1:]:
            any_form = any_form | T.has_displayed_name(shown, form)
        bad = rows.filter(any_form & ~T.has_displayed_name(answer, canonical))
        out = out.unionByName(bad.select("source", "target", F.lit(canonical).alias("name"), F.lit("canonical_form").alias("kind")))
    return out


def relevant_files(blocks: DataFrame) -> DataFrame:
    """file, valid_blocks, keep: files with a localized English block whose text can be translated."""
    valid = (F.col("title") == "en") & F.coalesce(F.col("type_string").contains("Localization"), F.lit(False)) & T.translatable(F.col("value"))
    return blocks.groupBy("file").agg(F.count_if(valid).alias("valid_blocks")).withColumn("keep", F.col("valid_blocks") > 0)
