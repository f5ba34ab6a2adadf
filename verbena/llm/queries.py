"""Queries of the training-data operators: name -> callable, and their SQL where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, table
from . import bpe_automaton, encoding_repair, format_copies, languages, mixing, pair_defects, term_counts, visual_forms

#: The folder of the public vocabularies.
TOKENIZERS = os.environ.get("VERBENA_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
#: Fixed value: how byte_bpe_50k splits text before its merges.
BYTE_BPE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: How many days before the newest arrival the last delta of p2 starts.
LAST_DELTA_DAYS = 7


def _p1_records(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    entries, missing = table(spark, sf_dir, "localized_entries"), table(spark, sf_dir, "missing_text")
    return [
        format_copies.canonical_records(entries, "localized_entries", "row_id", "asset_file", "m_localized"),
        format_copies.canonical_records(missing, "missing_text", "row_id", "asset", "source_text"),
    ]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _p1_records(spark, sf_dir)
    return format_copies.copies(first.unionByName(second))


def p1_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _p1_records(spark, sf_dir)
    return format_copies.representatives(first.unionByName(second))


def _p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by two deltas: the rows of all days but the last ones; then the late rows, and those of the day
    before, which a loader delivers once more, as changed records: withdrawn and added again."""
    missing = table(spark, sf_dir, "missing_text").select("source_text", "occ_count", "loaded_at")
    newest = missing.agg(F.max("loaded_at")).first()[0]
    loaded = F.coalesce(F.col("loaded_at"), F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"))
    first = (newest or datetime(1970, 1, 1)) - timedelta(days=LAST_DELTA_DAYS)
    late, again = loaded > F.lit(first), (loaded <= F.lit(first)) & (loaded > F.lit(first - timedelta(days=1)))
    signs = F.when(again, F.array(F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(1)))
    changes = missing.filter(late | again).select("source_text", "occ_count", F.explode(signs).alias("sign"))
    store = term_counts.TermStore(spark, scratch(spark, "terms"))
    store.apply(term_counts.delta(missing.filter(~late), "source_text", "occ_count"), "all days")
    store.apply(term_counts.delta(changes, "source_text", "occ_count", "sign"), "last days")
    return term_counts.marked(store.read())


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p2_counts(spark, sf_dir).filter("mark <> 'useful'").select("term", "mark")


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p2_counts(spark, sf_dir)


def _p4_garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, changes = table(spark, sf_dir, "localized_entries"), table(spark, sf_dir, "change_records")
    records = entries.select(F.lit("localized_entries").alias("table_name"), "row_id", F.col("m_localized").alias("text")).unionByName(
        changes.select(F.lit("change_records").alias("table_name"), F.col("change_id").alias("row_id"), F.col("antes").alias("text"))
    )
    # answers are clean twins of the texts handed in
    repair = encoding_repair.learn(records.select("text").unionByName(changes.select(F.col("depois").alias("text"))))
    return encoding_repair.garbled_records(records, repair)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p4_garbled(spark, sf_dir).select("table_name", "row_id")


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p4_garbled(spark, sf_dir).select("table_name", "row_id", "restored", "restorable")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "change_records").select("change_id", "source_text", "antes", "depois")
    judge = pair_defects.learn(changes, table(spark, sf_dir, "documents"), table(spark, sf_dir, "lang_labels"), "antes")
    return pair_defects.pair_defects(changes, judge, "change_id", "antes", "depois", "source_text")


def _p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields, entries = table(spark, sf_dir, "dialogue_fields"), table(spark, sf_dir, "localized_entries")
    return fields.select(F.lit("dialogue_fields").alias("table_name"), F.col("field_id").alias("row_id"), F.col("field_value").alias("text")).unionByName(
        entries.select(F.lit("localized_entries").alias("table_name"), "row_id", F.col("m_localized").alias("text"))
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual_forms.changed_records(_p6_records(spark, sf_dir), "text").select("table_name", "row_id")


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual_forms.one_form(_p6_records(spark, sf_dir), "text").select("table_name", "row_id", "form")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_automaton.with_ids(documents, "text", BYTE_BPE, BYTE_BPE_SPLIT)


def _p8_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").filter("source is not null").select("doc_id", "source", "text")
    return mixing.token_sizes(bpe_automaton.with_token_count(documents, "text", BYTE_BPE, BYTE_BPE_SPLIT))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_p8_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, targets = _p8_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    return mixing.shares(sizes, mixing.mix(sizes, targets), targets)


def _p9_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, languages.PieceModels]:
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "lang_labels")
    return documents, labels, languages.learn(documents, labels, PIECES)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels, models = _p9_models(spark, sf_dir)
    return languages.label_faults(languages.with_languages(documents, models), labels).select("doc_id", "kind", "lang")


def p9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _, models = _p9_models(spark, sf_dir)
    return languages.with_languages(documents, models).select("doc_id", F.col("detected").alias("lang"), "confidence", F.size("langs").alias("n_langs"))


def p9_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _, models = _p9_models(spark, sf_dir)
    return languages.with_segments(documents, models)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_copies": p1_copies,
    "p2_found": p2_found,
    "p2_counts": p2_counts,
    "p4_found": p4_found,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_forms": p6_forms,
    "p7_ids": p7_ids,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_languages": p9_languages,
    "p9_segments": p9_segments,
}

_P1 = r"""
with t as (
  select 'localized_entries' as table_name, row_id, asset_file as g, m_localized as x from localized_entries
  union all select 'missing_text', row_id, asset, source_text from missing_text),
p as (
  select *, lower(regexp_replace(x, '[^\pL\p{Nd}]', '', 'g')) as plain,
    list_filter(regexp_split_to_array(regexp_replace(x, '\s*([:=])\s*', '\1', 'g'), '[\n\r\t|;,/•·]+|\s[-–—]+\s'), lambda q: regexp_matches(q, '[\pL\p{Nd}]')) as parts
  from t where x is not null),
k as (
  select table_name, row_id, g,
    case when regexp_matches(x, '[:=]') and len(parts) >= 2
        and len(list_filter(parts, lambda q: not regexp_full_match(q, '(?s)[^\pL\p{Nd}:=]*\pL[^:=]*[:=][^:=]*[\pL\p{Nd}][^:=]*'))) = 0
      then array_to_string(list_sort(list_transform(parts, lambda q: lower(regexp_replace(split_part(regexp_replace(q, '=', ':'), ':', 1), '[^\pL\p{Nd}]', '', 'g')) || chr(1)
        || lower(regexp_replace(split_part(regexp_replace(q, '=', ':'), ':', 2), '[^\pL\p{Nd}]', '', 'g')))), chr(2))
      else plain end as k
  from p where plain <> '')
"""
_P2 = r"""
with t as (select row_number() over () as r, source_text as x, greatest(coalesce(occ_count, 1), 1) as w from missing_text),
e as (select r, w, lower(unnest(regexp_extract_all(x, '\pL+'))) as term from t),
c as (select term, cast(sum(w) as bigint) as occurrences, count(distinct r) as records from e group by term),
m as (select term, occurrences, records,
    case when records > 0.1 * (select count(*) from missing_text) then 'common' when occurrences < 5 then 'rare' else 'useful' end as mark
  from c)
"""
SQL: dict[str, str] = {
    "p1_found": _P1
    + """select table_name, first_id, row_id as copy_id from (
  select table_name, row_id, min(row_id) over (partition by table_name, g, k) as first_id from k) where first_id <> row_id""",
    "p1_copies": _P1 + "select table_name, min(row_id) as first_id, count(*) as copies from k group by table_name, g, k",
    "p2_found": _P2 + "select term, mark from m where mark <> 'useful'",
    "p2_counts": _P2 + "select term, occurrences, records, mark from m",
}
