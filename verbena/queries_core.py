"""Queries of the core: name -> callable, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import lexicon
from .functions import text as T
from .functions import tokens as K
from .functions.udfs import unescape_python
from .operators import audits, coverage, guards, lookup, maintenance, parse_failures, placeholders, rules, summaries
from .queries_sql import SQL as _SQL
from .session import spread, table
from .sources import dumps, memories, sinks, tables
from .streaming import enrichment


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, known = table(spark, sf_dir, "missing_raw"), table(spark, sf_dir, "scan_tables")
    return parse_failures.failures(raw, known).select("line_id", "reason")


def p3_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, known = table(spark, sf_dir, "missing_raw"), table(spark, sf_dir, "scan_tables")
    return parse_failures.loaded(raw, known)


# The tables as memories, entries and dumps


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "change_records")
    return c.select("change_id", F.col("source_text").alias("source"), F.col("antes").alias("before"), F.col("depois").alias("after"), F.col("decisao").alias("decision"), F.col("sugestao").alias("suggestion"), F.col("motivo").alias("reason"))


def _versions(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """A memory: the last text of each source, `before` or `after` the change."""
    rows = _changes(spark, sf_dir).filter("source is not null").select(F.lit("changes").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col(column).alias("target"))
    return memories.last_wins(rows)


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir, "after")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "missing_text").select("row_id", "flow", "asset", "table_name", F.col("source_text").alias("source"))


def _general_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "localized_entries").filter("m_id is not null and m_localized is not null")
    two = F.array(F.concat(F.lit("0 SInt64 m_Id = "), "m_id"), F.concat(F.lit('1 string m_Localized = "'), T.escape_dump(F.col("m_localized")), F.lit('"')))
    return rows.select(F.col("asset_file").alias("file"), "row_id", F.posexplode(two).alias("i", "line")).select("file", (F.col("row_id") * 2 + F.col("i")).alias("line_no"), "line")


def _dialogue_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    named = lambda name, c: F.concat(F.lit(f'1 string {name} = "'), T.escape_dump(F.col(c)), F.lit('"'))
    four = F.array(F.lit("0 Field data"), named("title", "field_title"), named("value", "field_value"), named("typeString", "type_string"))
    return f.select(F.concat(F.lit("conversation-"), F.col("conversation_id").cast("string")).alias("file"), "field_id", F.posexplode(four).alias("i", "line")).select("file", (F.col("field_id") * 4 + F.col("i")).alias("line_no"), "line")


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'en' and field_value is not null")
    a = table(spark, sf_dir, "actors").select("actor_id", F.col("actor_name"))
    return f.select("field_id", "conversation_id", "actor_id", F.col("field_value").alias("source")).join(F.broadcast(a), "actor_id", "left")  # the cast is a fixed table


def _portuguese(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'pt-BR' and field_value is not null")
    return spread(f.select(F.col("field_id").alias("ord"), F.col("field_value").alias("source"), F.col("field_value").alias("target"), "actor_id"))


def coverage_by_flow(spark, sf_dir):
    return coverage.by_flow(_entries(spark, sf_dir), _memory(spark, sf_dir))


def missing_texts_by_asset(spark, sf_dir):
    return coverage.missing_texts(_entries(spark, sf_dir), _memory(spark, sf_dir))


def missing_by_source(spark, sf_dir):
    return coverage.missing_texts(_entries(spark, sf_dir), _memory(spark, sf_dir)).groupBy("source").agg(F.sum("occ_count").alias("occurrences"), F.count_distinct("asset").alias("assets"))


def memory_states(spark, sf_dir):
    return lookup.exact(_entries(spark, sf_dir), _memory(spark, sf_dir)).select("row_id", "state")


def memory_fallback(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'en'").select("field_id", F.col("field_value").alias("source"))
    return lookup.fallback(f, _memory(spark, sf_dir)).select("field_id", "target", "matched")


def memory_layers(spark, sf_dir):
    c = _changes(spark, sf_dir).filter("source is not null")
    layer = lambda column: memories.last_wins(c.select(F.lit("m").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col(column).alias("target")))
    e = _entries(spark, sf_dir).select("row_id", "source")
    return lookup.layered(e, [("manual", layer("suggestion")), ("auto", layer("after")), ("translator", layer("before"))]).select("row_id", "target", "layer")


def targets_known(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").select("row_id", "m_localized")
    return lookup.known_targets(e, _memory(spark, sf_dir), "m_localized").select("row_id", "known")


def table_coverage(spark, sf_dir):
    e = _entries(spark, sf_dir).filter("flow = 'chef'").select("row_id", "table_name", F.col("source").alias("en"))
    own = _versions(spark, sf_dir, "before").select(F.col("source").alias("en"), F.col("target").alias("br"))
    return coverage.by_table(e.join(own, "en", "left"), _memory(spark, sf_dir))


def memory_diff(spark, sf_dir):
    reviewed = memories.last_wins(_changes(spark, sf_dir).filter("source is not null and decision is not null").select(F.lit("m").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col("before").alias("target")))
    answered = memories.last_wins(_changes(spark, sf_dir).filter("source is not null and suggestion is null").select(F.lit("m").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col("after").alias("target")))
    return maintenance.difference(reviewed, answered)


def memory_review_status(spark, sf_dir):
    return maintenance.review_status(_versions(spark, sf_dir, "before"), _memory(spark, sf_dir))


def merge_outcomes(spark, sf_dir):
    return maintenance.merged(_versions(spark, sf_dir, "before"), _memory(spark, sf_dir)).select("source", "target", "outcome")


def _patch(spark, sf_dir):
    rows = _changes(spark, sf_dir).filter("source is not null and suggestion is not null")
    return memories.last_wins(rows.select(F.lit("p").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col("suggestion").alias("target")))


def patch_outcomes(spark, sf_dir):
    texts = memories.last_wins(_entries(spark, sf_dir).filter("source is not null").select(F.lit("m").alias("memory_id"), F.col("row_id").alias("ord"), "source", F.col("source").alias("target")))
    return maintenance.patch_outcomes(texts, _patch(spark, sf_dir))


def patched_memory(spark, sf_dir):
    return maintenance.patched(_memory(spark, sf_dir), _patch(spark, sf_dir)).select("source", "target")


def reverted_memory(spark, sf_dir):
    log = _versions(spark, sf_dir, "before").select("source", F.col("target").alias("before"))
    keys = _changes(spark, sf_dir).filter("upper(decision) = 'REPROVAR'").select("source")
    return maintenance.reverted(_memory(spark, sf_dir), log, keys)[0].select("source", "target")


def pending_texts(spark, sf_dir):
    return maintenance.pending(_entries(spark, sf_dir).filter("source is not null").select("row_id", "source"), _memory(spark, sf_dir))


def first_wins_entries(spark, sf_dir):
    e = _entries(spark, sf_dir).filter("source is not null").select(F.col("flow").alias("memory_id"), F.col("row_id").alias("ord"), "source", F.col("asset").alias("target"))
    return memories.first_wins(e)


def upserted_memory(spark, sf_dir):
    old = memories.last_wins(_entries(spark, sf_dir).filter("source is not null").select(F.lit("m").alias("memory_id"), F.col("row_id").alias("ord"), "source", F.lit("").alias("target")))
    return maintenance.upserted(old, _memory(spark, sf_dir))


def keys_in_several_assets(spark, sf_dir):
    return maintenance.duplicate_keys(_entries(spark, sf_dir).filter("source is not null").select("source", F.col("asset").alias("file")))


def repaired_keys(spark, sf_dir):
    d = table(spark, sf_dir, "localized_entries").select(F.col("m_localized").alias("source")).filter("source is not null")
    a = d.select(T.escape_controls(F.col("source")).alias("source"))
    return maintenance.repaired_keys(d, a)


def answer_id_check(spark, sf_dir):
    asked = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'en' and actor_id is not null").select(F.col("actor_id").alias("id"))
    return maintenance.id_check(table(spark, sf_dir, "actors").select(F.col("actor_id").alias("id")), asked)


def table_set_gate(spark, sf_dir):
    found = _entries(spark, sf_dir).filter("table_name is not null").select("table_name").distinct()
    return maintenance.set_gate(table(spark, sf_dir, "scan_tables").select("table_name"), found)


def review_batches(spark, sf_dir):
    return maintenance.batch_report(maintenance.batches(_memory(spark, sf_dir).select("source", "target"), 50, "source"))


def positional_pairs(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    side = lambda title: f.filter(F.col("field_title") == title).select("conversation_id", "field_id", "field_value")
    return maintenance.positional(side("en"), side("pt-BR"), ("conversation_id",), "field_id").select("conversation_id", "place", "field_id", "field_id_right", "field_value_right")


def context_index(spark, sf_dir):
    c = _contexts(spark, sf_dir).filter("source <> ''")
    # a row for each text, conversation and speaker: no text's contexts are one value
    return c.groupBy("source", "conversation_id", "actor_name").agg(F.count("*").alias("entries"), F.min("field_id").alias("first_field"))


def single_speakers(spark, sf_dir):
    c = _contexts(spark, sf_dir).filter("actor_name is not null")
    return c.groupBy("source").agg(F.min("actor_name").alias("speaker"), F.max("actor_name").alias("_o")).filter("speaker = _o").select("source", "speaker")


def dump_entries(spark, sf_dir):
    return dumps.localized_entries(_general_dump(spark, sf_dir)).select("file", "id", "text")


def dump_field_blocks(spark, sf_dir):
    return dumps.field_blocks(_dialogue_dump(spark, sf_dir)).select("file", "block_id", "title", "value", "type_string")


def dump_english_values(spark, sf_dir):
    return dumps.adjacent_values(_dialogue_dump(spark, sf_dir)).select("file", "line_no", "value", "status")


def dump_rewritten(spark, sf_dir):
    lines = _general_dump(spark, sf_dir)
    m = table(spark, sf_dir, "change_records").filter("antes is not null").groupBy(T.escape_dump(F.col("antes")).alias("_k")).agg(F.max("depois").alias("_new"))
    pattern = r'^(\s*1 string m_Localized = ")(.*)("\s*)$'
    joined = lines.withColumn("_value", dumps.captured(F.col("line"), pattern, 2)).join(m, F.col("_value") == F.col("_k"), "left")
    return dumps.rewritten(joined, pattern, T.escape_dump(T.clean_for_dump(F.col("_new")))).select("file", "line_no", "line")


def relevant_files(spark, sf_dir):
    return audits.relevant_files(dumps.field_blocks(_dialogue_dump(spark, sf_dir)))


def rule_counts(spark, sf_dir):
    return rules.rule_counts(spark, rules.audited(_memory(spark, sf_dir)))


def _audited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portuguese fields, and answers of the log with their English source."""
    answers = _changes(spark, sf_dir).select((-F.col("change_id")).alias("ord"), F.coalesce("source", F.lit("")).alias("source"), F.col("after").alias("target")).filter("target is not null")
    return _portuguese(spark, sf_dir).select("ord", "source", "target").unionByName(spread(answers))


def rule_candidates(spark, sf_dir):
    found = rules.candidates(rules.audited(_audited_texts(spark, sf_dir)))
    return rules.in_review_order(found).select("ord", "rank", F.array_join("reasons.id", ",").alias("ids"))


def rule_categories(spark, sf_dir):
    return rules.category_counts(rules.audited(_audited_texts(spark, sf_dir)))


def gender_mismatches(spark, sf_dir):
    pt = _portuguese(spark, sf_dir)
    cast = table(spark, sf_dir, "actors").select(F.col("actor_name").alias("name"), F.when(F.col("gender") == "f", "feminino").when(F.col("gender") == "m", "masculino").alias("gender"), "actor_id")
    # the person addressed is the next one of the cast
    addressed = cast.select((F.col("actor_id") - 1).alias("actor_id"), F.col("name").alias("conversant_name"))
    contexts = pt.join(F.broadcast(cast), "actor_id", "left").join(F.broadcast(addressed), "actor_id", "left").select("source", F.col("name").alias("actor_name"), "conversant_name")
    greeted = lambda c: F.concat(F.lit("Bem-vinda, "), F.col(c)).alias(c)
    contexts = contexts.unionByName(contexts.select(greeted("source"), "actor_name", "conversant_name"))
    memory = pt.select("source", "target").unionByName(pt.select(greeted("source"), greeted("target"))).distinct()
    audit = rules.with_gender_reasons(memory.withColumn("reasons", rules.no_reasons()), contexts, cast)
    return audit.filter("size(reasons) > 0").select("source", F.array_join("reasons.id", ",").alias("ids"))


def encoding_findings(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").select(F.col("m_id").alias("source"), F.col("m_localized").alias("target"))
    return audits.encoding_findings(e).groupBy("source", "side", "type").agg(F.count("*").alias("n"))


def punctuation_warnings(spark, sf_dir):
    return audits.punctuation_warnings(_memory(spark, sf_dir))


def values_clean(spark, sf_dir):
    return audits.values_are_clean(audits.encoding_findings(_memory(spark, sf_dir)))


def untranslated_buckets(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'en' and field_value is not null")
    exported = f.select(F.col("conversation_id").alias("file"), F.col("field_id").alias("place"), F.col("field_id").alias("line_no"), F.col("field_value").alias("value"))
    names = table(spark, sf_dir, "actors").select(F.col("actor_name").alias("source"), F.col("actor_name").alias("target"), F.col("actor_id").cast("long").alias("ord"))
    memory = memories.last_wins(_memory(spark, sf_dir).select("source", "target", "ord").unionByName(names).withColumn("memory_id", F.lit("m"))).drop("memory_id", "ord")
    # the output was made when only approved answers had been taken over, and late rows weren't there yet
    approved = memories.last_wins(_changes(spark, sf_dir).filter("source is not null and upper(trim(decision)) = 'APROVAR'").select(F.lit("m").alias("memory_id"), F.col("change_id").alias("ord"), "source", F.col("after").alias("target")))
    written = lookup.exact(f.filter("loaded_at < exported_at + interval 1 day").select("conversation_id", "field_id", F.col("field_value").alias("source")), approved)
    output = written.select(F.col("conversation_id").alias("file"), F.col("field_id").alias("place"), F.coalesce("target", "source").alias("value"))
    return audits.untranslated(exported, output, memory)


def name_findings(spark, sf_dir):
    names = [r.actor_name for r in table(spark, sf_dir, "actors").select("actor_name").distinct().orderBy("actor_name").collect()]  # the cast is a fixed table
    return audits.name_findings(_memory(spark, sf_dir), names, {names[0]: [names[0], names[1]]} if len(names) > 1 else None)


def relocated_names(spark, sf_dir):
    names = table(spark, sf_dir, "actors").select(F.col("actor_name").alias("source"))
    files = table(spark, sf_dir, "localized_entries").select(F.col("asset_file").alias("name"), F.col("m_localized").alias("text"))
    return coverage.relocation(names, files)


def guard_outcomes(spark, sf_dir):
    c = _changes(spark, sf_dir)
    return guards.guarded(c, {"winter map": "mapa do inverno"}, ["dedal de prata"], ["Viduba", "Zomune"]).select("change_id", "guard", "result")


def decisions(spark, sf_dir):
    return guards.decided(_changes(spark, sf_dir)).select("change_id", "decision", "suggestion")


def decision_counts(spark, sf_dir):
    return guards.decision_counts(guards.decided(_changes(spark, sf_dir)))


def corrected_texts(spark, sf_dir):
    pt = _portuguese(spark, sf_dir)
    cast = table(spark, sf_dir, "actors").select("actor_id", F.when(F.col("gender") == "f", "feminino").when(F.col("gender") == "m", "masculino").alias("gender"))
    one = pt.join(F.broadcast(cast), "actor_id", "left").groupBy("source").agg(F.min("gender").alias("gender"), F.max("gender").alias("_o")).filter("gender = _o").drop("_o")
    manual = table(spark, sf_dir, "change_records").filter("antes is not null and depois is not null").groupBy(F.col("antes").alias("source")).agg(F.max("depois").alias("target"))
    return guards.corrected(pt.select("ord", "source", "target"), one, manual).select("ord", "corrected", "fault")


def placeholder_reasons(spark, sf_dir):
    return placeholders.reason_counts(table(spark, sf_dir, "localized_entries"), "m_localized")


def placeholder_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    braced = lambda family, c: F.concat(F.lit("{" + family + "."), F.regexp_replace(c, "[^A-Za-z0-9]", ""), F.lit("}"))
    value = (
        F.when(F.col("p_size") <= 10, F.concat_ws(" ", F.lit("{EffectFoodCommon.Food_Perfect}"), "p_name"))
        .when(F.col("p_size") <= 20, F.concat_ws(" ", braced("InteriorPropTheme", "p_brand"), "p_name"))
        .when(F.col("p_size") <= 30, F.concat_ws(" ", braced("People", "p_brand"), braced("InteriorPropBasicName", "p_type")))
        .when(F.col("p_size") <= 40, F.concat_ws(" ", braced("BroomstickTheme", "p_brand"), F.lit("{BroomstickCommon.Broomstick_Name}")))
        .otherwise(F.concat_ws(" ", "p_name", braced("InteriorPropBasicName", "p_type")))
    )
    return p.select("p_partkey", placeholders.reordered(value).alias("r")).select("p_partkey", "r.value", "r.changed", "r.reason")


def technical_tokens(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    return f.select("field_id", F.array_join(T.technical_tokens(F.col("field_value")), "~").alias("tokens"), F.array_join(T.token_signature(F.col("field_value")), "~").alias("signature"))


def stripped_texts(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    return f.select("field_id", T.strip_technical(F.col("field_value")).alias("stripped"), T.strip_for_names(F.col("field_value")).alias("for_names"))


def word_counts(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    return f.select("field_title", F.explode(T.words(F.col("field_value"))).alias("word")).groupBy("field_title", "word").agg(F.count("*").alias("n"))


def lexicon_hits(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    hits = lambda entries: F.size(T.lexicon_hits(F.col("field_value"), entries))
    return f.select("field_id", hits(lexicon.STRONG_ENGLISH).alias("strong"), hits(lexicon.PARTIAL_ENGLISH).alias("partial"))


def text_predicates(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields")
    v = F.col("field_value")
    return f.select("field_id", T.is_blank(v).alias("blank"), T.usable(v).alias("usable"), T.translatable(v).alias("translatable"), T.technical(v).alias("technical"), T.has_cjk(v).alias("cjk"), T.passes_through(v).alias("passes"))


def escaped_texts(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    v = F.col("m_localized")
    return e.select("row_id", T.escape_dump(v).alias("dump"), T.escape_controls(v).alias("controls"), T.escape_markdown(v).alias("markdown"), T.csv_cell(v).alias("cell"), (T.unescape(T.escape_dump(v)) == v).alias("same"))


def cleaned_texts(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    v = F.col("m_localized")
    return e.select("row_id", T.normalize_punctuation(v).alias("punctuation"), T.squeeze(v).alias("squeezed"), T.clean_for_dump(v).alias("cleaned"), T.comparable_key(v).alias("comparable"))


def repaired_texts(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    v = F.col("m_localized")
    return e.select("row_id", T.repair_guarded(v).alias("repaired"), F.size(T.variants(v)).alias("forms"))


def protected_texts(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    p, t = K.protect(F.col("field_value"), K.MARKUP), K.tokens_of(F.col("field_value"), K.MARKUP)
    return f.select("field_id", F.size(t).alias("tokens"), K.restore(p, t, K.MARKUP).alias("restored"), F.size(K.lost(p, t, K.MARKUP)).alias("lost"))


def text_sentences(spark, sf_dir):
    e = table(spark, sf_dir, "missing_text").filter("source_text is not null")
    return e.select("row_id", F.posexplode(T.sentences(F.col("source_text"))).alias("n", "sentence"))


def table_lines(spark, sf_dir):
    e = _entries(spark, sf_dir).filter("table_name is not null").select("table_name", F.col("row_id").alias("row_no"), F.array(F.col("row_id").cast("string"), F.coalesce("source", F.lit(""))).alias("cells"))
    return sinks.csv_lines(e)


def report_lines(spark, sf_dir):
    return sinks.markdown_rows(_changes(spark, sf_dir), "change_id", "before", "after")


def memory_json_lines(spark, sf_dir):
    return sinks.json_lines(_memory(spark, sf_dir)).select("ord", "line")


def artifact_state(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    bundle = lambda df: df.select(F.lit("geral").alias("flow"), F.col("m_id").alias("name"), F.sha2("m_localized", 256).alias("sha256")).groupBy("flow", "name").agg(F.max("sha256").alias("sha256"))
    return coverage.artifact_state(bundle(e), bundle(e.filter("loaded_at < exported_at + interval 1 day")))


def stale_outputs(spark, sf_dir):
    names = table(spark, sf_dir, "missing_text").select(F.concat(F.lit("translated-"), "asset").alias("name")).distinct()
    exports = table(spark, sf_dir, "localized_entries").select(F.col("asset_file").alias("name")).distinct()
    return sinks.quarantine(names, exports)


def status_rollup(spark, sf_dir):
    c = coverage_by_flow(spark, sf_dir).agg(F.sum("missing").alias("m"), F.sum("empty").alias("e"))
    known = targets_known(spark, sf_dir).agg(F.count_if(~F.col("known")).alias("u"))
    metrics = coverage.metric(c, "missing", "m").unionByName(coverage.metric(c, "empty", "e")).unionByName(coverage.metric(known, "unknown_targets", "u"))
    return coverage.status(coverage.expectations(metrics, {"missing": 0, "empty": 0, "unknown_targets": 0}))


def event_properties(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"))


def keys_by_source(spark, sf_dir):
    e = table(spark, sf_dir, "missing_text").filter("flow = 'chef' and source_text is not null")
    return summaries.keys_by_source(e.select(F.col("source_text").alias("source"), F.col("entry_key").alias("key")))


def blank_memory(spark, sf_dir):
    return summaries.blank_memory(coverage.missing_texts(_entries(spark, sf_dir), _memory(spark, sf_dir)))


def unfaulted_targets(spark, sf_dir):
    m = _memory(spark, sf_dir).withColumn("reason", T.replacement_fault(F.col("source"), F.col("target")))
    return summaries.without(m, ["null", "blank", "cjk", "equal_to_source"])[0].select("source", "target")


def faulted_targets(spark, sf_dir):
    m = _memory(spark, sf_dir).withColumn("reason", T.replacement_fault(F.col("source"), F.col("target")))
    return summaries.without(m, ["null", "blank", "cjk", "equal_to_source"])[1]


def file_pairs(spark, sf_dir):
    f = table(spark, sf_dir, "dialogue_fields").filter("field_value is not null")
    side = lambda title: f.filter(F.col("field_title") == title).select(F.col("conversation_id").alias("file"), F.col("actor_id").cast("string").alias("id"), F.col("field_id").alias("line_no"), F.col("field_value").alias("text")).filter("id is not null")
    one = lambda df: df.groupBy("file", "id").agg(F.max_by("text", "line_no").alias("text"), F.max("line_no").alias("line_no"))
    return summaries.file_pairs(one(side("en")), one(side("pt-BR")))[0]


def _asset_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "missing_text").select("asset", F.col("source_text").alias("source"))


def _relocated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "localized_entries").select(F.col("asset_file").alias("name"), F.col("m_localized").alias("text"))
    return coverage.relocation(_asset_strings(spark, sf_dir), files)


def relocation_by_asset(spark, sf_dir):
    return coverage.relocation_by_asset(_asset_strings(spark, sf_dir), _relocated_strings(spark, sf_dir)).drop("in_binaries")


def relocation_by_destination(spark, sf_dir):
    return coverage.relocation_by_destination(_asset_strings(spark, sf_dir), _relocated_strings(spark, sf_dir))


def asset_names(spark, sf_dir):
    name = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("name"))
    return maintenance.name_sets(name("missing_text", "asset"), name("localized_entries", "asset_file"))


def tables_missing_unique(spark, sf_dir):
    e = _entries(spark, sf_dir).filter("flow = 'chef'").select("table_name", F.col("source").alias("en"), F.lit(None).cast("string").alias("br"))
    return coverage.missing_unique(e, _memory(spark, sf_dir))


def protected_forms(spark, sf_dir):
    """Marked texts and their tokens in two styles, over texts with brackets of every kind and real line breaks."""
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    v = F.concat(F.col("m_localized"), F.lit(" (snake_case) (Word)\n[name]<a b>{x}"))
    forms = [c for n, s in (("markup", K.MARKUP), ("snake", K.SNAKE)) for c in (K.protect(v, s).alias(n), F.size(K.tokens_of(v, s)).alias(f"{n}_tokens"))]
    return e.select("row_id", *forms)


def repaired_latin(spark, sf_dir):
    """Texts whose UTF-8 bytes were read as Latin-1, put right again."""
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    bad = F.decode(F.encode(F.col("m_localized"), "UTF-8"), "ISO-8859-1")
    return e.select("row_id", T.repair_latin1(bad).alias("repaired"))


def decoded_strings(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    return e.select("row_id", T.decode_json_string(T.encode_json_string(F.col("m_localized"))).alias("decoded"), T.line_body(F.col("m_localized")).alias("body"))


def verified_outputs(spark, sf_dir):
    """Rows of the written output that aren't what the memory chose."""
    e = _entries(spark, sf_dir).filter("source is not null").select("row_id", "source")
    chosen = lookup.exact(e, _memory(spark, sf_dir)).select("row_id", "target")
    written = lookup.exact(e, _versions(spark, sf_dir, "before")).select("row_id", "target")
    return coverage.verified(written, chosen, ("row_id",), "target")


def routed_assets(spark, sf_dir):
    assets = table(spark, sf_dir, "localized_entries").select(F.col("asset_file").alias("name")).distinct()
    named = assets.select(F.concat(F.col("name"), F.lit("-resources.assets-7")).alias("name"))
    return sinks.routed(assets.unionByName(named))


def memory_as_of(spark, sf_dir):
    """The memory as it stood on a day of the log."""
    c = table(spark, sf_dir, "change_records").filter("source_text is not null")
    rows = c.select(F.lit("m").alias("memory_id"), F.col("source_text").alias("source"), F.col("depois").alias("target"), F.struct("changed_at", "change_id").alias("version"))
    return memories.as_of(rows, F.struct(F.expr("timestamp_ntz'2025-03-01'").alias("changed_at"), F.lit(0).cast("long").alias("change_id"))).select("source", "target")


def _text_table_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text tables, a file for each asset: three languages, and a field with its texts for each entry."""
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null and m_id is not null")
    head = [
        "1 vector m_languageKeys", '1 string data = "en"', '1 string data = "pt-BR"', '1 string data = "de"', "1 vector m_languageValues", "0 int data = 7", "0 int data = 2", "0 int data = 5",
    ]
    files = e.select(F.col("asset_file").alias("file")).distinct().select("file", F.posexplode(F.array(*map(F.lit, head))).alias("i", "line")).select("file", F.col("i").cast("long").alias("line_no"), "line")
    text = T.escape_dump(F.col("m_localized"))
    shown = lambda c: F.concat(F.lit('1 string data = "'), c, F.lit('"'))
    body = F.array(
        F.lit("1 TextTableField data"), F.concat(F.lit('1 string m_fieldName = "'), "m_id", F.lit('"')), F.lit("0 vector m_keys"), F.lit("0 int data = 2"), F.lit("0 int data = 7"),
        F.lit("0 string m_values"), shown(text), shown(F.concat(F.lit("en: "), text)),
    )
    fields = e.select(F.col("asset_file").alias("file"), "row_id", F.posexplode(body).alias("i", "line")).select("file", (F.col("row_id") * 10 + 100 + F.col("i")).alias("line_no"), "line")
    return files.unionByName(fields)


def text_table_languages(spark, sf_dir):
    return dumps.text_tables(_text_table_dump(spark, sf_dir))[0]


def text_table_texts(spark, sf_dir):
    languages, fields = dumps.text_tables(_text_table_dump(spark, sf_dir))
    return dumps.language_texts(languages, fields, "en").select("file", "field_id", "field_name", "position", "text")


def dump_actor_names(spark, sf_dir):
    return dumps.actor_names(_graph_dump(spark, sf_dir))


def csv_cells(spark, sf_dir):
    """Cells of CSV texts: each entry as a text of a header and a row that may hold commas, quotes and line breaks."""
    e = table(spark, sf_dir, "missing_text").filter("source_text is not null")
    text = F.concat(F.lit("\ufeffkey,en,br\r\n"), F.array_join(F.transform(F.array(F.col("row_id").cast("string"), F.col("source_text"), F.lit("")), T.csv_cell), ","), F.lit("\r\n"))
    return tables.csv_rows(tables.csv_records(e.select(F.col("row_id").cast("string").alias("table_name"), text.alias("text")))).select("table_name", "row_no", "key", "en", "br")


def report_entries(spark, sf_dir):
    """Scan reports by flow and by table, written as JSON and read again."""
    e = _entries(spark, sf_dir).filter("source is not null")
    flows = F.to_json(F.struct(F.array(F.struct(F.col("flow").alias("Flow"), F.array(F.struct(F.col("asset").alias("Asset"), F.col("source").alias("Source"), F.lit(2).alias("Count"))).alias("Missing"))).alias("Flows")))
    return tables.flow_report(e.select(flows.alias("value"))).groupBy("flow", "asset", "source").agg(F.sum("occ_count").alias("n"))


def catalog_names(spark, sf_dir):
    ids = table(spark, sf_dir, "localized_entries").filter("asset_file is not null").select(F.concat(F.lit("Assets/Data/TextTable/"), "asset_file", F.lit(".asset")).alias("id")).distinct()
    return tables.catalog_names(ids.select(F.to_json(F.struct(F.array("id").alias("m_InternalIds"))).alias("value")))


def salvaged_answers(spark, sf_dir):
    """The objects of answers that stand between other words."""
    c = _changes(spark, sf_dir).filter("after is not null")
    answer = F.concat(F.lit("Segue o resultado:\n"), F.to_json(F.struct(F.col("after").alias("v"))), F.lit("\nok"))
    return c.select("change_id", F.get_json_object(memories.salvaged_object(answer), "$.v").alias("v"), memories.salvaged_object(F.lit("no object")).alias("none"))


def unescaped_texts(spark, sf_dir):
    """Texts with every character beyond ASCII written as an escape, read as a Python string; an ellipsis keeps their bytes from being put right."""
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    point = lambda c: F.concat(F.lit("\\U"), F.lpad(F.hex(F.ascii(c)), 8, "0"))
    written = F.array_join(F.transform(F.split(F.concat(F.replace("m_localized", F.lit("\\"), F.lit("\\\\")), F.lit("…")), ""), lambda c: F.when(F.ascii(c) > 126, point(c)).otherwise(c)), "")
    return e.select("row_id", unescape_python(written).alias("text"))


def memory_members(spark, sf_dir):
    return lookup.marked_members(_entries(spark, sf_dir).select("row_id", "source"), _memory(spark, sf_dir))


def outer_spaces(spark, sf_dir):
    e = table(spark, sf_dir, "localized_entries").filter("m_localized is not null")
    before, core, after = T.outer_space(F.concat(F.lit(" \t"), F.col("m_localized")))
    return e.select("row_id", F.length(before).alias("before"), core.alias("core"), F.length(after).alias("after"))


def translated_names(spark, sf_dir):
    """Missing texts through a translator that puts them in capitals, tokens protected."""
    capitals = lambda texts: texts.str.upper()
    return enrichment.translated(_entries(spark, sf_dir), capitals, style=K.MARKUP)


def first_sources(spark, sf_dir):
    return summaries.first_entries(_memory(spark, sf_dir).select("source", "ord"), 100)


def relocation_counts(spark, sf_dir):
    return summaries.relocation_counts(relocated_names(spark, sf_dir))


def flow_memories(spark, sf_dir):
    e = _entries(spark, sf_dir)
    memory = summaries.memory_of_flow(F.col("flow"), {"dialogos": "memoria_dialogos", "missoes": "memoria_missoes", "missoes_resources": "memoria_missoes"}, "memoria_geral")
    return e.groupBy(memory.alias("memory")).agg(F.count("*").alias("entries"))


def change_log(spark, sf_dir):
    return summaries.change_log(_changes(spark, sf_dir))


def filled_missing(spark, sf_dir):
    return enrichment.fill_missing(_memory(spark, sf_dir), _entries(spark, sf_dir), enrichment.identity)


def _graph_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "dialogue_fields").filter("field_title = 'en' and field_value is not null")
    file = F.concat(F.lit("conversation-"), F.col("conversation_id").cast("string")).alias("file")
    pair = lambda title, value: [F.lit(f'1 string title = "{title}"'), F.concat(F.lit('1 string value = "'), value, F.lit('"'))]
    number = lambda c: F.concat(F.lit("0 int id = "), F.col(c).cast("string"))
    cast = f.select(file, "actor_id").distinct().join(F.broadcast(table(spark, sf_dir, "actors").select("actor_id", "actor_name")), "actor_id")
    parts = (
        (cast, F.col("actor_id").cast("long") * 10, [F.lit("0 Actor data"), number("actor_id"), *pair("Name en", F.col("actor_name"))]),
        (f.select(file, "conversation_id").distinct(), F.lit(10_000).cast("long"), [F.lit("0 Conversation conversations"), F.lit("0 Conversation data"), number("conversation_id")]),
        (f.select(file, "field_id", "entry_id", "actor_id", "field_value"), F.col("field_id") * 10 + 100_000, [F.lit("0 DialogueEntry data"), number("entry_id"), *pair("en", T.escape_dump(F.col("field_value"))), *pair("Actor", F.coalesce(F.col("actor_id").cast("string"), F.lit("")))]),
    )
    out = [df.select("file", base.alias("_b"), F.posexplode(F.array(*lines)).alias("i", "line")).select("file", (F.col("_b") + F.col("i")).alias("line_no"), "line") for df, base, lines in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def dialogue_contexts(spark, sf_dir):
    return dumps.dialogue_contexts(dumps.dialogue_graph(_graph_dump(spark, sf_dir))).select("file", "source", "conversation_id", "entry_id", "actor_id", "actor_name")


_NAMED = (
    p3_found, p3_loaded, coverage_by_flow, missing_texts_by_asset, missing_by_source, memory_states, memory_fallback, memory_layers, targets_known, table_coverage,
    memory_diff, memory_review_status, merge_outcomes, patch_outcomes, patched_memory, reverted_memory, pending_texts, first_wins_entries, upserted_memory,
    keys_in_several_assets, repaired_keys, answer_id_check, table_set_gate, review_batches, positional_pairs, context_index, single_speakers, dump_entries,
    dump_field_blocks, dump_english_values, dump_rewritten, relevant_files, rule_counts, rule_candidates, rule_categories, gender_mismatches, encoding_findings,
    punctuation_warnings, values_clean, untranslated_buckets, name_findings, relocated_names, guard_outcomes, decisions, decision_counts, corrected_texts,
    placeholder_reasons, placeholder_names, technical_tokens, stripped_texts, word_counts, lexicon_hits, text_predicates, escaped_texts, cleaned_texts, repaired_texts,
    protected_texts, text_sentences, table_lines, report_lines, memory_json_lines, artifact_state, stale_outputs, status_rollup, event_properties,
    relocation_by_asset, relocation_by_destination, text_table_languages, text_table_texts, dump_actor_names, csv_cells, report_entries, catalog_names, salvaged_answers, unescaped_texts, memory_members, outer_spaces, translated_names, first_sources,
    asset_names, tables_missing_unique, protected_forms, repaired_latin, decoded_strings, verified_outputs, routed_assets, memory_as_of,
    keys_by_source, blank_memory, unfaulted_targets, faulted_targets, file_pairs, relocation_counts, flow_memories, change_log, filled_missing, dialogue_contexts,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _NAMED}

_FIELD = '("([^"]|"")*"|[^",]*)'
_P3_PARSED = f"""
with q as (
  select line_id, raw_line,
    regexp_full_match(raw_line, '(?s){_FIELD}(,{_FIELD})*') as ok
  from missing_raw),
f as (
  select line_id, raw_line, ok,
    case when ok then 1 + length(regexp_replace(raw_line, '(?s)"([^"]|"")*"|[^,"]', '', 'g')) end as n,
    case when ok then regexp_extract(raw_line, '(?s)^{_FIELD},{_FIELD},{_FIELD},{_FIELD},{_FIELD}$', ['a','a1','b','b1','c','c1','d','d1','e','e1']) end as m
  from q),
v as (
  select line_id, raw_line, ok, n,
    list_transform([m.a, m.b, m.c, m.d, m.e], lambda x: case when starts_with(x, '"') then replace(x[2:-2], '""', '"') else x end) as c
  from f),
r as (
  select line_id, c,
    case when raw_line is null then 'column_count' when not ok then 'bad_quoting' when n <> 5 then 'column_count'
      when not regexp_matches(c[2], '[^\\s\\pZ\\pC]') or not regexp_matches(c[3], '[^\\s\\pZ\\pC]') then 'invalid_value'
      when c[1] not in (select table_name from scan_tables) then 'invalid_value'
      when not regexp_full_match(c[4], '[0-9]+') or not regexp_full_match(c[5], '[0-9]+') then 'invalid_value'
      when coalesce(try_cast(c[4] as hugeint), 0) not between 1 and 2147483647 then 'invalid_value'
      when coalesce(try_cast(c[5] as hugeint), 0) not between 1 and 2147483647 then 'invalid_value' end as reason
  from v)
"""
SQL: dict[str, str] = {
    **_SQL,
    "p3_found": _P3_PARSED + "select line_id, reason from r where reason is not null",
    "p3_loaded": _P3_PARSED
    + "select line_id, c[1] as table_name, c[2] as entry_key, c[3] as source_text, cast(c[4] as integer) as row_no, cast(c[5] as integer) as occ_count from r where reason is null",
}
