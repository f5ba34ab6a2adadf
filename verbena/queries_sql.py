"""The core's queries in SQL for DuckDB, over the same tables."""

from __future__ import annotations

from .functions import lexicon
from .operators import rules

WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank(x: str) -> str:
    return f"coalesce({trim(x)} = '', true)"


def usable(x: str) -> str:
    return f"coalesce(not {blank(x)} and regexp_matches({trim(x)}, '[^#]'), false)"


def controls(x: str) -> str:
    return rf"replace(replace(replace({x}, chr(13), '\r'), chr(10), '\n'), chr(9), '\t')"


def dump(x: str) -> str:
    return controls(rf"""replace(replace({x}, '\', '\\'), '"', '\"')""")


def unescape(x: str) -> str:
    return rf"""array_to_string(list_transform(regexp_extract_all({x}, '(?s)\\.|[^\\]+|\\'), lambda p:
      case p when '\n' then chr(10) when '\r' then chr(13) when '\t' then chr(9) when '\\' then '\' when '\"' then '"' else p end), '')"""


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\[lua\((?:[^()]|\([^()]*\))*\)\]', ' ', 'g'), '\[/?em\d+\]', ' ', 'g'), '</?[^>]+>', ' ', 'g'), '\{{[^}}]+\}}', ' ', 'g')"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({strip(x)}), '\pL+(?:[''’]\pL+)?')"


def hits(x: str, entries: list[str]) -> str:
    found = ", ".join(q(e) for e in dict.fromkeys(entries))
    return f"list_filter(list_distinct({words(x)}), lambda w: list_contains([{found}], w))"


def technical(x: str) -> str:
    t = trim(x)
    return rf"coalesce(not regexp_matches({t}, '[A-Za-z]{{2}}') or regexp_matches({t}, '(?i)^(?:GetQuest|SetQuest|SendMessage|SetFace|Variable|Actor|Conversation|Sequencer|Lua|\[lua|\{{|\()') or regexp_matches({t}, '^[_A-Z0-9.:-]+$'), false)"


def last(column: str, where: str = "true") -> str:
    return f"select source_text as source, arg_max_null({column}, change_id) as target, min(change_id) as ord from change_records where source_text is not null and {where} group by source_text"


def first_of(keys: list[str]) -> str:
    return "coalesce(" + ", ".join(f"(select u.target from u where u.source = {k})" for k in keys) + ")"


MEM = f"with mem as ({last('depois')}), u as (select * from mem where not {blank('target')})"
_FORMS = [f(x) for x in ("m.source_text", controls("m.source_text"), dump("m.source_text")) for f in (str, trim)]
ENTRIES = f"{MEM}, e as (select m.row_id, m.flow, m.asset, m.table_name, m.source_text as source, {first_of(_FORMS)} as target from missing_text m)"
MISSED = f"{ENTRIES}, x as (select asset, source, count(*) as occ_count from e where target is null and not {blank('source')} group by asset, source)"
COVER = f"""{ENTRIES}, p as (select flow, asset, source, count(*) as n, count(*) filter ({blank("source")}) as e, count(*) filter (not {blank("source")} and target is null) as m from e group by all),
 c as (select flow, cast(sum(n) as bigint) as occurrences, cast(sum(e) as bigint) as empty, cast(sum(n) - sum(e) - sum(m) as bigint) as translated, cast(sum(m) as bigint) as missing, count(*) filter (m > 0) as missing_unique, sum(m) = 0 as ready from p group by flow)"""
_RAW = ["f.field_value", trim("f.field_value"), unescape("f.field_value"), trim(unescape("f.field_value"))]


def fault(source: str, target: str) -> str:
    return f"""case when {target} is null then 'null' when {blank(target)} then 'blank'
      when regexp_matches({target}, '[\\x{{3400}}-\\x{{4DBF}}\\x{{4E00}}-\\x{{9FFF}}\\x{{3040}}-\\x{{30FF}}\\x{{AC00}}-\\x{{D7AF}}]') then 'cjk' when {trim(target)} = {trim(source)} then 'equal_to_source' end"""


def rule_test(r: rules.Rule, source: str = "s", target: str = "t") -> str:
    test = f"regexp_matches({target}, {q('(?i)' + r.target)})"
    return f"(regexp_matches({source}, {q('(?i)' + r.source)}) and {test})" if r.source else test


_AUDITED = "list_filter([" + ", ".join(f"case when {rule_test(r)} then {q(r.id)} end" for r in rules.RULES) + "], lambda x: x is not null)"
PT = f"with pt as (select field_id as ord, field_value as source, actor_id, {strip('field_value')} as s, {strip('field_value')} as t from dialogue_fields where field_title = 'pt-BR' and field_value is not null)"
RULED = f"{PT}, both_kinds as (select ord, s, t from pt union all select -change_id, {strip("coalesce(source_text, '')")}, {strip('depois')} from change_records where depois is not null), a as (select ord, {_AUDITED} as ids from both_kinds)"
_RULE_ROWS = ", ".join(f"({q(r.id)}, {q(r.category)}, {q(r.severity)}, {rules.SEVERITY[r.severity]})" for r in (*rules.RULES, rules.ACTOR_MISMATCH, rules.CONVERSANT_MISMATCH))
RULE_TABLE = f"r(id, category, severity, rank) as (values {_RULE_ROWS})"
_TAGS = r"\[lua\(.*?\)\]|\[/?em\d*\]|<[^<>]+>|\{[^{}]+\}|%[sdif]|\\n|\\r"
_FAULTS = {
    "replacement_character": r"\x{FFFD}",
    "format_or_invisible": r"[\x{AD}\x{61C}\x{200B}\x{200C}\x{200D}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FEFF}]",
    "question_mark_inside_word": r"(?:\pL\?+\pL|\?+\p{Ll})",
    "common_mojibake": r"[\x{C2}\x{C3}][\x{80}-\x{BF}]|\x{E2}[\x{80}-\x{BF}€™‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜š›œžŸ]|\x{F0}Ÿ|\x{EF}\x{BB}\x{BF}",
    "literal_unicode_escape": r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}",
    "private_use": r"[\x{E000}-\x{F8FF}]|[\x{F0000}-\x{FFFFD}]|[\x{100000}-\x{10FFFD}]",
    "unicode_noncharacter": "[\\x{FDD0}-\\x{FDEF}]|[" + "".join(f"\\x{{{p * 65536 + 65534:X}}}-\\x{{{p * 65536 + 65535:X}}}" for p in range(17)) + "]",
    "invalid_control": r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{7F}-\x{9F}]",
}
_SIGNATURE = [r"\[(?:/?em\d+|lua\([^\]]+\))\]", r"</?[A-Za-z][^>]*>", r"\\r"]
_DF = "from dialogue_fields where field_value is not null"
_LE = "from localized_entries where m_localized is not null"


def speaks(x: str, gender: str) -> str:
    marks = "|".join(p[gender == "feminino"] for p in lexicon.GENDER_PAIRS if p[0] != "obrigado")
    return rf"(regexp_matches({x}, '(?i)(?:^|[^\pL])(?:eu\s+)?(?:estou|sou|fiquei|me sinto|continuo|ficarei|estarei)\s+(?:muito\s+|bem\s+|realmente\s+|tão\s+)?(?:{marks})(?:$|[^\pL])') or regexp_matches({x}, '(?i)(?:^|[^\pL])obrigad{'a' if gender == 'feminino' else 'o'}(?:$|[^\pL])'))"


def speaks_to(x: str, gender: str) -> str:
    end = "a" if gender == "feminino" else "o"
    marks = "|".join(p[gender == "feminino"] for p in lexicon.GENDER_PAIRS if p[0] != "obrigado")
    few = r"(?:muito\s+|bem\s+|realmente\s+|tão\s+)?"
    tests = (
        rf"(?i)(?:^|[^\pL])você\s+(?:está|é|ficou|parece|anda|continua)\s+{few}(?:{marks})(?:$|[^\pL])",
        rf"(?i)(?:^|[.!?]\s+)(?:esteja|fique|seja)\s+(?:muito\s+|bem\s+)?(?:{marks})(?:$|[^\pL])",
        rf"(?i)(?:^|[^\pL])bem-vind{end}(?:$|[^\pL])",
    )
    return "(" + " or ".join(f"regexp_matches({x}, {q(t)})" for t in tests) + ")"


def findings(id_col: str, rows: str) -> str:
    """Rows (source, side, type, match) of the encoding audit over rows (source, side, t)."""
    parts = [f"select source, side, {q(k)} as type, unnest(regexp_extract_all(t, {q(v)})) as match from {rows}" for k, v in _FAULTS.items()]
    return " union all ".join([*parts, f"select source, side, 'not_nfc_normalized', null from {rows} where t <> nfc_normalize(t)"])


def guarded_forms(x: str, gender: str) -> str:
    forms = ", ".join(q(p[gender == "feminino"]) for p in lexicon.GUARDED_GENDER)
    return rf"len(list_filter(regexp_extract_all(lower({x}), '[\pL\pN_]+'), lambda w: list_contains([{forms}], w)))"


def _guard() -> str:
    tokens = lambda x: f"coalesce(regexp_extract_all({x}, {q(_TAGS)}), [])"
    has = lambda x, term: f"contains(coalesce({x}, ''), {q(term)})"
    terms = f"({has('s', 'winter map')} and not {has('a', 'mapa do inverno')}) or ({has('b', 'dedal de prata')} and not {has('a', 'dedal de prata')})"
    names = " or ".join(f"({has('b', n)} and not {has('a', n)})" for n in ("Viduba", "Zomune"))
    turned = lambda x, y: f"({guarded_forms('b', x)} > 0 and {guarded_forms('a', y)} > 0)"
    return f"""case when {blank("a")} then 'empty' when len(list_filter(list_concat({tokens("s")}, {tokens("b")}), lambda k: not contains(coalesce(a, ''), k))) > 0 then 'tokens'
      when {terms} then 'terms' when {names} then 'names' when {turned("masculino", "feminino")} or {turned("feminino", "masculino")} then 'gender' end"""


_MARKUP = r"\r\n|\r|\n|\[lua\((?s:.*?)\)\]|\[[^\]]+\]|<[^>]+>|\{[^{}]+\}"
_SNAKE = r"\r\n|\r|\n|\[[^\]]+\]|<[^>]+>|\{[^{}]+\}|\([a-z_][a-z0-9_]*\)|_"
RELOCATED = """with s as ({strings}), f as (select distinct asset_file as name, m_localized as text from localized_entries where m_localized is not null),
 h as (select source, name, bool_or(text = source) as e from s join f on contains(text, source) group by 1, 2),
 g as (select source, string_agg(name, ',' order by name) filter (e) as exact_in, string_agg(name, ',' order by name) filter (not e) as mentioned_in from h group by 1),
 r as (select s.source, exact_in, mentioned_in from s left join g using (source))"""
_BY_ASSET = RELOCATED.format(strings="select distinct source_text as source from missing_text where source_text <> ''") + ", s0 as (select distinct asset, source_text as source from missing_text where source_text <> '')"
_PLACED = """select p_partkey, case when p_size <= 10 then '{EffectFoodCommon.Food_Perfect} ' || p_name
   when p_size <= 20 then '{InteriorPropTheme.' || regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') || '} ' || p_name
   when p_size <= 30 then '{People.' || regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') || '} {InteriorPropBasicName.' || regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') || '}'
   when p_size <= 40 then '{BroomstickTheme.' || regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') || '} {BroomstickCommon.Broomstick_Name}'
   else p_name || ' {InteriorPropBasicName.' || regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') || '}' end as v, p_size as k, p_name, p_brand, p_type from part"""

SQL: dict[str, str] = {
    "coverage_by_flow": f"{COVER} select * from c",
    "missing_texts_by_asset": f"{MISSED} select * from x",
    "missing_by_source": f"{MISSED} select source, cast(sum(occ_count) as bigint) as occurrences, count(distinct asset) as assets from x group by source",
    "memory_states": f"{MEM} select row_id, case when mem.source is null then 'missing' when {blank('target')} then 'blank' when target = source_text then 'identity' else 'translated' end as state from missing_text left join mem on source = source_text",
    "memory_fallback": f"{MEM}, k as (select f.field_id, [{', '.join(_RAW)}] as k from dialogue_fields f where field_title = 'en'), h as (select field_id, k, i, (select u.target from u where u.source = k[i]) as target from k, range(1, 5) as x(i))"
    " select field_id, arg_min(target, i) filter (target is not null) as target, cast(min(len(list_distinct(k[1:i]))) filter (target is not null) as integer) as matched from h group by field_id",
    "memory_layers": f"with a as ({last('sugestao')}), b as ({last('depois')}), c as ({last('antes')}), z as (select m.row_id, case when {usable('a.target')} then a.target end as x, case when {usable('b.target')} then b.target end as y, case when {usable('c.target')} then c.target end as w"
    " from missing_text m left join a on a.source = m.source_text left join b on b.source = m.source_text left join c on c.source = m.source_text) select row_id, coalesce(x, y, w) as target, case when x is not null then 'manual' when y is not null then 'auto' when w is not null then 'translator' end as layer from z",
    "targets_known": f"{MEM} select row_id, coalesce(m_localized in (select {unescape('target')} from mem where target is not null), false) as known from localized_entries",
    "table_coverage": f"{MEM}, own as ({last('antes')}), r as (select m.table_name, m.source_text as en, case when {usable('own.target')} then own.target end as br, case when {usable('mem.target')} then mem.target end as mt from missing_text m left join own on own.source = m.source_text left join mem on mem.source = m.source_text where m.flow = 'chef' and not {blank('m.source_text')})"
    " select table_name, count(*) as english, count(br) as existing, count(*) filter (br is null and mt is not null) as from_memory, count(*) filter (br is not null and mt <> br) as conflicts, count(*) filter (br is null and mt is null) as missing, count(distinct case when br is null and mt is null then en end) as missing_unique from r group by table_name",
    "memory_diff": f"with a as ({last('antes', 'decisao is not null')}), b as ({last('depois', 'sugestao is null')}) select coalesce(a.source, b.source) as source, a.target as before, b.target as after, case when a.source is null then 'new' when b.source is null then 'removed' when a.target is not distinct from b.target then 'unchanged' else 'modified' end as status from a full join b on a.source = b.source",
    "memory_review_status": f"with a as ({last('antes')}), b as ({last('depois')}) select b.source, b.target, case when a.source is null then 'new' when a.target is not distinct from b.target then 'unreviewed' else 'reviewed' end as status from b left join a on a.source = b.source",
    "merge_outcomes": f"with a as ({last('antes')}), b as ({last('depois')}), j as (select a.source, a.target, b.target as n, b.source is not null as f, {fault('a.source', 'b.target')} as x from a left join b on a.source = b.source), o as (select *, case when not f then 'not_found' when x is not null then 'ignored_' || x when n = target then 'equal' else 'replaced' end as outcome from j) select source, case when outcome = 'replaced' then n else target end as target, outcome from o",
    "patch_outcomes": f"with p as ({last('sugestao', 'sugestao is not null')}), m as (select distinct source_text from missing_text where source_text is not null) select p.source, p.target, case when m.source_text is null then 'key_not_found' when p.target = m.source_text then 'equal' else 'applied' end as outcome from p left join m on m.source_text = p.source",
    "patched_memory": f"with p as ({last('sugestao', 'sugestao is not null')}), m as ({last('depois')}) select m.source, case when p.source is not null then p.target else m.target end as target from m left join p on p.source = m.source",
    "reverted_memory": f"with l as ({last('antes')}), m as ({last('depois')}) select m.source, case when m.source in (select source_text from change_records where upper(decisao) = 'REPROVAR' and source_text is not null) then l.target else m.target end as target from m left join l on l.source = m.source",
    "pending_texts": f"{MEM} select row_id, source_text as source from missing_text where source_text is not null and source_text not in (select source from mem)",
    "first_wins_entries": "select flow as memory_id, source_text as source, min(row_id) as ord, arg_min(asset, row_id) as target from missing_text where source_text is not null group by flow, source_text",
    "upserted_memory": f"{MEM}, o as (select source_text as source, min(row_id) as ord from missing_text where source_text is not null group by source_text) select coalesce(o.source, mem.source) as source, case when mem.source is not null then mem.target else '' end as target, case when o.source is null then 1 else 0 end as late, coalesce(o.ord, mem.ord) as ord from o full join mem on o.source = mem.source",
    "keys_in_several_assets": "with f as (select source_text as source, list_sort(list(distinct asset)) as f from missing_text where source_text is not null group by source_text) select source, f[1] as first_file, array_to_string(f[2:], ',') as later_files from f where len(f) > 1",
    "repaired_keys": rf"""with d as (select distinct m_localized as s from localized_entries where m_localized is not null), a as (select distinct {controls("s")} as s from d),
      n as (select 'm' as k, s from d where s not in (select s from a) union all select 'x', s from a where s not in (select s from d)),
      c as (select k, s, replace(replace(replace(replace(replace(replace(replace(s, '\\u00a0', chr(160)), ' ', chr(160)), chr(160), ' '), '\\r', chr(13)), '\r', chr(13)), '\\n', chr(10)), '\n', chr(10)) as n from n),
      g as (select k, n, min(s) as s from c group by k, n having count(*) = 1) select m.s as expected, x.s as answered from g m join g x on m.n = x.n where m.k = 'm' and x.k = 'x'""",
    "answer_id_check": "with a as (select distinct actor_id as id from actors), b as (select distinct actor_id as id from dialogue_fields where field_title = 'en' and actor_id is not null) select coalesce(a.id, b.id) as id, case when b.id is null then 'missing' when a.id is null then 'extra' else 'ok' end as status from a full join b on a.id = b.id",
    "table_set_gate": "with f as (select distinct table_name as t from missing_text where table_name is not null), m as (select table_name from scan_tables except all select t from f), x as (select t from f except all select table_name from scan_tables) select (select count(*) from m) as missing, (select count(*) from x) as extra, (select count(*) from m) = 0 and (select count(*) from x) = 0 as ok",
    "review_batches": f"{MEM}, n as (select source, row_number() over (order by source) - 1 as n from mem) select n // 50 + 1 as batch, count(*) as entries, arg_min(source, n) as first_key, arg_max(source, n) as last_key from n group by 1",
    "positional_pairs": "with f as (select conversation_id, field_id, field_value, field_title, row_number() over (partition by conversation_id, field_title order by field_id) as place from dialogue_fields where field_value is not null) select a.conversation_id, a.place, a.field_id, b.field_id as field_id_right, b.field_value as field_value_right from f a left join f b on a.conversation_id = b.conversation_id and a.place = b.place and b.field_title = 'pt-BR' where a.field_title = 'en'",
    "context_index": "select field_value as source, conversation_id, actor_name, count(*) as entries, min(field_id) as first_field from dialogue_fields left join actors using (actor_id) where field_title = 'en' and field_value <> '' group by 1, 2, 3",
    "single_speakers": "select field_value as source, min(actor_name) as speaker from dialogue_fields join actors using (actor_id) where field_title = 'en' and field_value is not null group by field_value having min(actor_name) = max(actor_name)",
    "dump_entries": f"select asset_file as file, m_id as id, arg_max({dump('m_localized')}, row_id) as text {_LE} and m_id is not null group by 1, 2",
    "dump_field_blocks": f"select 'conversation-' || conversation_id as file, row_number() over (partition by conversation_id order by field_id) as block_id, field_title as title, {dump('field_value')} as value, type_string {_DF}",
    "dump_english_values": f"select 'conversation-' || conversation_id as file, field_id * 4 + 2 as line_no, {dump('field_value')} as value, 'ok' as status {_DF} and field_title = 'en'",
    "dump_rewritten": rf"""with m as (select {dump("antes")} as k, max(depois) as n from change_records where antes is not null group by 1), e as (select asset_file, row_id, m_id, {dump("m_localized")} as v {_LE} and m_id is not null)
      select asset_file as file, row_id * 2 as line_no, '0 SInt64 m_Id = ' || m_id as line from e union all
      select asset_file, row_id * 2 + 1, '1 string m_Localized = "' || coalesce({dump(("regexp_replace(translate(m.n, '‘’“”' || chr(160) || chr(65279), '''''\"\" '), '[" + chr(92) + "x00-" + chr(92) + "x08" + chr(92) + "x0A-" + chr(92) + "x1F]', '', 'g')"))}, v) || '"' from e left join m on m.k = v""",
    "relevant_files": rf"""with f as (select 'conversation-' || conversation_id as file, field_title = 'en' and contains(type_string, 'Localization') and regexp_matches({dump("field_value")}, '[A-Za-z]') and not regexp_matches({trim(dump("field_value"))}, '^[-._\s]+$') as ok {_DF}) select file, count(*) filter (ok) as valid_blocks, count(*) filter (ok) > 0 as keep from f group by file""",
    "rule_counts": f"with m as ({last('depois')}), pt as (select {strip('source')} as s, {strip(chr(99) + 'oalesce(target, ' + chr(39) * 2 + ')')} as t from m), {RULE_TABLE}, i as (select unnest({_AUDITED}) as id from pt) select r.id, category, severity, count(i.id) as n from r left join i on i.id = r.id group by all",
    "rule_candidates": f"{RULED}, {RULE_TABLE} select ord, cast((select min(rank) from r where list_contains(a.ids, r.id)) as integer) as rank, array_to_string(ids, ',') as ids from a where len(ids) > 0",
    "rule_categories": f"{RULED}, {RULE_TABLE}, i as (select unnest(ids) as id from a) select category, count(*) as n from i join r using (id) group by category",
    "gender_mismatches": f"{PT}, pp as (select source, actor_id, t from pt union all select 'Bem-vinda, ' || source, actor_id, 'Bem-vinda, ' || t from pt), c as (select source, actor_name, gender from pp join actors using (actor_id) where actor_name is not null), o as (select source, min(gender) as g from c group by source having min(actor_name) = max(actor_name)),"
    f" cc as (select source, a.actor_name, a.gender from pp join actors a on a.actor_id = pp.actor_id + 1 where a.actor_name is not null), oo as (select source, min(gender) as h from cc group by source having min(actor_name) = max(actor_name)), t as (select distinct source, t from pp),"
    f" z as (select source, coalesce((g = 'f' and {speaks('t', 'masculino')}) or (g = 'm' and {speaks('t', 'feminino')}), false) as x, coalesce((h = 'f' and {speaks_to('t', 'masculino')}) or (h = 'm' and {speaks_to('t', 'feminino')}), false) as y from t left join o using (source) left join oo using (source))"
    " select source, case when x and y then 'verified_actor_gender_mismatch,verified_conversant_gender_mismatch' when x then 'verified_actor_gender_mismatch' else 'verified_conversant_gender_mismatch' end as ids from z where x or y",
    "encoding_findings": f"with l as (select m_id as source, 'key' as side, m_id as t from localized_entries where m_id is not null union all select m_id, 'value', m_localized {_LE}), x as ({findings('source', 'l')}) select source, side, type, count(*) as n from x group by all",
    "punctuation_warnings": f"{MEM}, x as (select source, len(regexp_extract_all(target, '\\?')) - len(regexp_extract_all(source, '\\?')) as e, target from mem) select source, cast(e as integer) as excess from x where e > 0 and not regexp_matches(target, {q(_FAULTS['question_mark_inside_word'])})",
    "values_clean": f"{MEM}, l as (select source, 'key' as side, source as t from mem union all select source, 'value', target from mem where target is not null), x as ({findings('source', 'l')}) select count(*) filter (side = 'key') as key_findings, count(*) filter (side = 'value') as value_findings, count(*) filter (side = 'value') = 0 as clean_values from x",
    "untranslated_buckets": f"""{MEM}, al as (select source, target, ord from mem union all select actor_name, actor_name, actor_id from actors), mm as (select source, arg_max_null(target, ord) as target from al group by source),
      ap as ({last("depois", "upper(trim(decisao)) = 'APROVAR'")}),
      e as (select field_value as source, count(*) as occurrences, min(field_id) as first_line, bool_or(loaded_at < exported_at + interval 1 day and coalesce(ap.target, field_value) = field_value) as same
        from dialogue_fields left join ap on ap.source = field_value where field_title = 'en' and not {blank("field_value")} group by 1),
      b as (select e.*, mm.target, mm.source is not null as known, {hits("mm.target", lexicon.PARTIAL_ENGLISH)} as p, {hits("e.source", lexicon.STRONG_ENGLISH)} as s from e left join mm on mm.source = e.source),
      c as (select *, case when not known then 'missing_memory' when {blank("target")} then 'empty_translation' when target = source then case when {technical("source")} then 'technical_or_nonlinguistic' when len({words("source")}) >= 4 or len(s) > 0 then 'untranslated' else 'ambiguous_identity' end when len(p) > 0 then 'partial_english' else 'translated' end as bucket from b)
      select source, target, occurrences, first_line, bucket, case bucket when 'partial_english' then array_to_string(list_sort(p), ',') when 'untranslated' then array_to_string(list_sort(s), ',') end as matched, same and bucket = 'untranslated' as still_english, same and bucket in ('partial_english', 'translated') as not_in_output from c""",
    "name_findings": rf"""{MEM}, r as (select source, coalesce(target, '') as target from mem), n as (select distinct actor_name as name from actors), w as (select source, target, unnest(list_distinct(regexp_extract_all(source, '\pL+'))) as name from r),
      k as (select source, target, name, case when {trim("source")} = name and {trim("target")} <> name then 'exact_name_changed' when not list_contains(regexp_extract_all(target, '\pL+'), name) then 'missing_from_target' end as kind from w semi join n using (name)),
      f as (select (select min(name) from n) as c, (select name from n order by name limit 1 offset 1) as o),
      v as (select source, target, regexp_extract_all(regexp_replace(source, '\{{[^}}]+\}}', ' ', 'g'), '[\pL\pN_]+') as sw, regexp_extract_all(regexp_replace(target, '\{{[^}}]+\}}', ' ', 'g'), '[\pL\pN_]+') as tw from r)
      select source, target, name, kind from k where kind is not null union all select source, target, c, 'canonical_form' from v, f where (list_contains(sw, c) or list_contains(sw, o)) and not list_contains(tw, c)""",
    "relocated_names": RELOCATED.format(strings="select distinct actor_name as source from actors") + " select * from r",
    "relocation_by_asset": _BY_ASSET + """, z as (select asset, source, exact_in, mentioned_in from s0 join r using (source))
      select asset, count(*) as strings, count(exact_in) as exact, count(*) filter (exact_in is null and mentioned_in is not null) as mentioned, count(*) filter (exact_in is null and mentioned_in is null) as nowhere,
        coalesce((select string_agg(distinct n, ',' order by n) from (select unnest(string_split(y.exact_in, ',')) as n from z y where y.asset = z.asset and y.exact_in is not null)), '') as exact_files,
        coalesce((select string_agg(distinct n, ',' order by n) from (select unnest(string_split(y.mentioned_in, ',')) as n from z y where y.asset = z.asset and y.mentioned_in is not null)), '') as mentioned_files
      from z group by asset""",
    "relocation_by_destination": _BY_ASSET + """ select asset, name as destination, count(*) filter (e) as exact, count(*) filter (not e) as mentioned from s0 join h using (source) group by 1, 2""",
    "text_table_languages": f"with f as (select distinct asset_file as file {_LE} and m_id is not null) select file, l.language, l.id from f, (values ('en', 7), ('pt-BR', 2), ('de', 5)) as l(language, id)",
    "text_table_texts": f"select asset_file as file, row_number() over (partition by asset_file order by row_id) as field_id, m_id as field_name, 1 as position, 'en: ' || {dump('m_localized')} as text {_LE} and m_id is not null",
    "dump_actor_names": f"select distinct {trim('actor_name')} as name from dialogue_fields join actors using (actor_id) where field_title = 'en' and field_value is not null and {trim('actor_name')} not in ('', 'System')",
    "csv_cells": "select cast(row_id as varchar) as table_name, 1 as row_no, cast(row_id as varchar) as key, source_text as en, '' as br from missing_text where source_text is not null",
    "report_entries": "select flow, asset, source_text as source, cast(2 * count(*) as bigint) as n from missing_text where source_text is not null group by all",
    "catalog_names": "select distinct asset_file || '.asset' as name from localized_entries where asset_file is not null",
    "salvaged_answers": "select change_id, depois as v, cast(null as varchar) as none from change_records where depois is not null",
    "unescaped_texts": f"select row_id, m_localized || '…' as text {_LE}",
    "memory_members": f"{MEM} select row_id, source_text as source, coalesce(source_text in (select source from mem), false) as in_memory from missing_text",
    "outer_spaces": f"with t as (select row_id, ' ' || chr(9) || m_localized as v, {trim('m_localized')} as core {_LE}) select row_id, cast(case when core = '' then length(v) else length(v) - length(regexp_replace(v, '^{WS}+', '')) end as integer) as before, core, cast(case when core = '' then 0 else length(v) - length(regexp_replace(v, '{WS}+$', '')) end as integer) as after from t",
    "translated_names": rf"""with s as (select distinct source_text as source from missing_text where not {blank('source_text')}),
      p as (select source, regexp_extract_all(source, '{_MARKUP}') as t, regexp_split_to_array(source, '{_MARKUP}') as x from s)
      select source, upper(x[1]) || array_to_string(list_transform(range(1, len(x)), lambda i: t[i] || upper(x[i + 1])), '') as target, 'ok' as status from p""",
    "first_sources": f"{MEM} select source, ord from mem order by ord limit 100",
    "asset_names": "with a as (select distinct asset as name from missing_text where asset is not null), b as (select distinct asset_file as name from localized_entries where asset_file is not null) select coalesce(a.name, b.name) as name, case when b.name is null then 'removed' when a.name is null then 'added' else 'both' end as side from a full join b on a.name = b.name",
    "tables_missing_unique": f"{MEM}, g as (select source from mem where {usable('target')}), m as (select source_text as en from missing_text where flow = 'chef' and not {blank('source_text')} and source_text not in (select source from g)) select count(*) as missing, count(distinct en) as missing_unique from m",
    "protected_forms": rf"""with t as (select row_id, m_localized || ' (snake_case) (Word)' || chr(10) || '[name]<a b>{{x}}' as v {_LE}),
      k as (select row_id, v, regexp_extract_all(v, '{_MARKUP}') as a, regexp_extract_all(v, '{_SNAKE}') as b, regexp_split_to_array(v, '{_MARKUP}') as x, regexp_split_to_array(v, '{_SNAKE}') as y from t)
      select row_id, x[1] || array_to_string(list_transform(range(1, len(x)), lambda i: '__MARK_' || (i - 1) || '__' || x[i + 1]), '') as markup, cast(len(a) as integer) as markup_tokens,
        y[1] || array_to_string(list_transform(range(1, len(y)), lambda i: 'SNAKETOKEN' || (i - 1) || 'END' || y[i + 1]), '') as snake, cast(len(b) as integer) as snake_tokens from k""",
    "repaired_latin": f"select row_id, m_localized as repaired {_LE}",
    "decoded_strings": f"select row_id, m_localized as decoded, case when ends_with(m_localized, chr(13) || chr(10)) then m_localized[:-3] when ends_with(m_localized, chr(10)) or ends_with(m_localized, chr(13)) then m_localized[:-2] else m_localized end as body {_LE}",
    "verified_outputs": f"with a as ({last('depois')}), b as ({last('antes')}) select m.row_id, a.target as expected, b.target as actual from missing_text m left join a on a.source = m.source_text left join b on b.source = m.source_text where m.source_text is not null and a.target is distinct from b.target",
    "routed_assets": "with a as (select distinct asset_file as name from localized_entries) select name, case when contains(name, '-resources.assets-') then 'resources' else 'bundle' end as route from a union all select name || '-resources.assets-7', case when name is not null then 'resources' else 'bundle' end from a",
    "memory_as_of": "select source_text as source, arg_max_null(depois, (changed_at, change_id)) as target from change_records where source_text is not null and changed_at < timestamp '2025-03-01' group by 1",
    "guard_outcomes": f"with c as (select change_id, source_text as s, antes as b, depois as a from change_records), g as (select *, {_guard()} as guard from c) select change_id, guard, case when guard is null then a else b end as result from g",
    "decisions": f"with d as (select *, upper({trim('decisao')}) as w from change_records), e as (select *, case when w in ('APROVAR', 'APROVADO') then 'APROVAR' when w in ('REPROVAR', 'REPROVADO') then 'REPROVAR' else 'INVALIDA' end as decision from d) select change_id, decision, case decision when 'APROVAR' then depois when 'REPROVAR' then case when {blank('sugestao')} then antes else sugestao end end as suggestion from e",
    "decision_counts": f"with d as (select upper({trim('decisao')}) as w from change_records), c as (select count(*) filter (w in ('APROVAR', 'APROVADO')) as approved, count(*) filter (w in ('REPROVAR', 'REPROVADO')) as rejected, count(*) as total from d) select approved, rejected, total - approved - rejected as invalid, total from c",
    "placeholder_names": rf"""with p as ({_PLACED}), n as (select *, trim(regexp_replace(v, '\s+', ' ', 'g')) as c from p), r as (select p_partkey, v, c, k, case
        when k <= 10 then regexp_replace(c, '^(\S+) (.+)$', '\2 \1') when k <= 20 then regexp_replace(c, '^(\S+) (.+)$', '\2 \1') when k <= 30 then regexp_replace(c, '^(\S+) (\S+)$', '\2 de \1')
        when k <= 40 then regexp_replace(c, '^(\S+) (\S+)$', '\2 \1') else regexp_replace(c, '^(.+) (\S+)$', '\2 de \1') end as value from n)
      select p_partkey, value, value <> v as changed, case when k <= 10 then 'effectfood_qualidade_movida_para_o_final' when k <= 20 then 'interiorprop_theme_movido_para_o_final' when k <= 30 then 'referencia_antes_interiorbasic_corrigida_com_de'
        when k <= 40 then 'broomstick_theme_nome_corrigido_para_nome_theme' else 'texto_antes_interiorbasic_corrigido_com_de' end as reason from r""",
    "placeholder_reasons": f"select case when m_localized is null then 'valor_nao_string' when {trim('m_localized')} = '' then 'valor_vazio' else 'sem_placeholder_relevante' end as reason, count(*) as n, 0::bigint as changed from localized_entries group by 1",
    "technical_tokens": f"select field_id, array_to_string(regexp_extract_all(field_value, {q(_TAGS)}), '~') as tokens, array_to_string(list_concat(list_concat(regexp_extract_all(field_value, {q(_SIGNATURE[0])}), regexp_extract_all(field_value, {q(_SIGNATURE[1])})), regexp_extract_all(field_value, {q(_SIGNATURE[2])})), '~') as signature {_DF}",
    "stripped_texts": rf"select field_id, {strip('field_value')} as stripped, regexp_replace(regexp_replace(field_value, '\{{[^}}]+\}}', ' ', 'g'), '\[lua\((?:[^()]|\([^()]*\))*\)\]', ' ', 'g') as for_names {_DF}",
    "word_counts": f"with w as (select field_title, unnest({words('field_value')}) as word {_DF}) select field_title, word, count(*) as n from w group by all",
    "lexicon_hits": f"select field_id, cast(len({hits('field_value', lexicon.STRONG_ENGLISH)}) as integer) as strong, cast(len({hits('field_value', lexicon.PARTIAL_ENGLISH)}) as integer) as partial {_DF}",
    "text_predicates": rf"""select field_id, {blank("field_value")} as blank, {usable("field_value")} as usable, coalesce(regexp_matches(field_value, '[A-Za-z]') and not regexp_matches({trim("field_value")}, '^[-._\s]+$'), false) as translatable, {technical("field_value")} as technical,
      coalesce(regexp_matches(field_value, '[\x{{3400}}-\x{{4DBF}}\x{{4E00}}-\x{{9FFF}}\x{{3040}}-\x{{30FF}}\x{{AC00}}-\x{{D7AF}}]'), false) as cjk, coalesce({trim("field_value")} in ('???', '...', '-', '_'), false) as passes from dialogue_fields""",
    "escaped_texts": rf"""select row_id, {dump("m_localized")} as dump, {controls("m_localized")} as controls, replace(replace(replace(m_localized, '|', '\|'), chr(13), '`\r`'), chr(10), '<br>') as markdown, case when m_localized = '' then '' else '"' || replace(m_localized, '"', '""') || '"' end as cell, true as same {_LE}""",
    "cleaned_texts": rf"""select row_id, replace(translate(m_localized, '‘’‚‛“”„‟–—' || chr(160), repeat(chr(39), 4) || repeat(chr(34), 4) || '-- '), '…', '...') as punctuation, {trim(f"regexp_replace(m_localized, '{WS}+', ' ', 'g')")} as squeezed,
      {(r"regexp_replace(translate(m_localized, '‘’“”' || chr(160) || chr(65279), '''''"+ chr(34) * 2 + " '), '[" + chr(92) + "x00-" + chr(92) + "x08" + chr(92) + "x0A-" + chr(92) + "x1F]', '', 'g')")} as cleaned,
      replace(replace(replace(replace(replace(replace(replace(m_localized, '\\u00a0', chr(160)), ' ', chr(160)), chr(160), ' '), '\\r', chr(13)), '\r', chr(13)), '\\n', chr(10)), '\n', chr(10)) as comparable {_LE}""",
    "text_sentences": r"with t as (select row_id, regexp_split_to_array(regexp_replace(source_text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as s from missing_text where source_text is not null) select row_id, cast(i - 1 as integer) as n, s[i] as sentence from t, unnest(range(1, len(s) + 1)) as x(i)",
    "table_lines": """select table_name, row_id as row_no, '"' || row_id || '",' || case when coalesce(source_text, '') = '' then '' else '"' || replace(source_text, '"', '""') || '"' end as line from missing_text where table_name is not null""",
    "report_lines": "select '| ' || change_id || ' | ' || " + " || ' | ' || ".join(rf"coalesce(replace(replace(replace({c}, '|', '\|'), chr(13), '`\r`'), chr(10), '<br>'), '')" for c in ("antes", "depois")) + " || ' |' as line from change_records",
    "memory_json_lines": f"{MEM} select ord, '  ' || to_json(source) || ': ' || coalesce(to_json(target), 'null') as line from mem",
    "artifact_state": f"with a as (select 'geral' as flow, m_id as name, max(sha256(m_localized)) as sha256 {_LE} group by 2), b as (select m_id as name, max(sha256(m_localized)) as old {_LE} and loaded_at < exported_at + interval 1 day group by 1) select flow, a.name, sha256, coalesce(old <> sha256, false) as changed, old is null as no_history from a left join b on a.name is not distinct from b.name and a.name is not null",
    "stale_outputs": "select distinct 'translated-' || asset as name, 'stale' as reason from missing_text where asset not in (select asset_file from localized_entries where asset_file is not null)",
    "status_rollup": f"{COVER}, t as (select count(*) filter (not coalesce(m_localized in (select {unescape('target')} from mem where target is not null), false)) as k from localized_entries), m as (select unnest([(select sum(missing) from c), (select sum(empty) from c), (select k from t)]) as v) select bool_and(v = 0) as ready, count(*) filter (v <> 0) as failed, case when bool_and(v = 0) then 'pronto' else 'revisao_necessaria' end as status from m",
    "event_properties": "select event_type, count(k) as n, cast(sum(k) as bigint) as total from (select event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events) group by event_type",
    "keys_by_source": "select source_text as source, count(*) as entries, string_agg(distinct entry_key, ',' order by entry_key) as keys, bool_and(coalesce(starts_with(entry_key, 'character_name_'), false)) as only_prefixed from missing_text where flow = 'chef' and source_text is not null group by source_text",
    "blank_memory": f"{MISSED} select distinct source, '' as target from x",
    "unfaulted_targets": f"{MEM} select source, target from mem where {fault('source', 'target')} is null",
    "faulted_targets": f"{MEM} select {fault('source', 'target')} as reason, count(*) as n from mem where {fault('source', 'target')} is not null group by 1",
    "file_pairs": "with f as (select conversation_id as file, actor_id as id, field_title as t, arg_max(field_value, field_id) as x, max(field_id) as n from dialogue_fields where field_value is not null and actor_id is not null and field_title in ('en', 'pt-BR') group by 1, 2, 3) select a.x as source, arg_max(b.x, (a.file, a.n)) as target from f a join f b on a.file = b.file and a.id = b.id and b.t = 'pt-BR' where a.t = 'en' group by a.x",
    "flow_memories": "select case when flow = 'dialogos' then 'memoria_dialogos' when flow in ('missoes', 'missoes_resources') then 'memoria_missoes' else 'memoria_geral' end as memory, count(*) as entries from missing_text group by 1",
    "change_log": f"select coalesce({controls('source_text')}, '') || ': ' || coalesce({controls('antes')}, '') || ' -> ' || coalesce({controls('depois')}, '') as line from change_records where antes is distinct from depois",
    "filled_missing": f"{MEM} select distinct source_text as source, source_text as target, 'ok' as status from missing_text where not {blank('source_text')} and source_text not in (select source from u)",
    "protected_texts": rf"""select field_id, cast(len(regexp_extract_all(field_value, '{_MARKUP}')) as integer) as tokens, field_value as restored, 0 as lost {_DF}""",
    "dialogue_contexts": f"select 'conversation-' || conversation_id as file, {dump('field_value')} as source, cast(conversation_id as varchar) as conversation_id, cast(entry_id as varchar) as entry_id, coalesce(cast(actor_id as varchar), '') as actor_id, actor_name from dialogue_fields left join actors using (actor_id) where field_title = 'en' and field_value is not null",
}
SQL["relocation_counts"] = "with z as (" + SQL["relocated_names"] + ") select case when exact_in is not null then 'exact' when mentioned_in is not null then 'mentioned' else 'nowhere' end as place, count(*) as strings from z group by 1"
