import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from verbena import queries_core
from verbena.operators import audits, coverage, guards, lookup, maintenance, ordered, pair_counts, placeholders, rules, substrings
from verbena.plans import pipelines
from verbena.streaming import enrichment


@pytest.fixture
def memory(spark):
    def make(*pairs):
        return spark.createDataFrame([("m", i, s, t) for i, (s, t) in enumerate(pairs)], "memory_id string, ord long, source string, target string")

    return make


@pytest.fixture
def rows(spark):
    def make(*texts):
        return spark.createDataFrame([(i, t, "f", "a") for i, t in enumerate(texts)], "i int, source string, flow string, asset string")

    return make


def column(df, name="target", by="i"):
    return [r[name] for r in df.orderBy(by).collect()]


def test_lookups(memory, rows):
    m = memory(("a", "A"), ("b", " "), ("c", "c"), ("x\ny", "XY"), ("q\\n", "Q"))
    assert column(lookup.exact(rows("a", "b", "c", "d", None), m), "state") == ["translated", "blank", "identity", "missing", "missing"]
    got = lookup.fallback(rows(" a ", "x\\ny", "b", None, "a"), m)
    assert column(got) == ["A", "XY", None, None, "A"] and column(got, "matched") == [2, 2, None, None, 1]
    assert column(lookup.fallback(rows("q\n", " q\n"), m, lookup.escaped_forms)) == ["Q", "Q"]
    assert column(lookup.layered(rows("a", "b", "z"), [("first", memory(("a", ""), ("b", "1"))), ("second", memory(("a", "2"), ("b", "3")))]), "layer") == ["second", "first", None]
    assert column(lookup.known_targets(rows("A", "B"), m, "source"), "known") == [True, False]
    assert column(lookup.marked_members(rows("a", "z", "a"), m), "in_memory") == [True, False, True]


def test_asset_before_memory(spark, memory):
    df = spark.createDataFrame([(0, "a", "own"), (1, "a", "A"), (2, "a", "###"), (3, "z", None)], "i int, en string, br string")
    got = lookup.asset_or_memory(df, memory(("a", "A")), fall_back=True)
    assert column(got, "chosen") == ["own", "A", "A", "z"] and column(got, "origin") == ["asset", "asset", "memory", "missing"] and column(got, "conflict") == [True, False, False, False]


def test_difference_and_patch_give_the_new_memory(memory):
    old, new = memory(("a", "1"), ("b", "2"), ("c", "3")), memory(("a", "1"), ("b", "9"), ("d", "4"))
    d = {r.source: r.status for r in maintenance.difference(old, new).collect()}
    assert d == {"a": "unchanged", "b": "modified", "c": "removed", "d": "new"}
    assert {r.source: r.status for r in maintenance.review_status(old, new).collect()} == {"a": "unreviewed", "b": "reviewed", "d": "new"}
    changed = maintenance.difference(old, new).filter("status = 'modified'").select("source", F.col("after").alias("target"))
    assert {r.source: r.target for r in maintenance.patched(old, changed).collect()} == {"a": "1", "b": "9", "c": "3"}
    back, log = maintenance.reverted(maintenance.patched(old, changed), old.select("source", F.col("target").alias("before")), changed)
    assert {r.source: r.target for r in back.collect()} == {"a": "1", "b": "2", "c": "3"} and log.count() == 2
    assert {r.source: r.outcome for r in maintenance.patch_outcomes(old, memory(("a", "1"), ("b", "5"), ("z", "0"))).collect()} == {"a": "equal", "b": "applied", "z": "key_not_found"}
    assert {r.source: (r.target, r.late) for r in maintenance.upserted(old, new).collect()} == {"a": ("1", 0), "b": ("9", 0), "c": ("3", 0), "d": ("4", 1)}


def test_merge(memory):
    got = maintenance.merged(memory(("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "5"), ("f", "6")), memory(("a", "x"), ("b", "2"), ("c", "###"), ("d", "漢"), ("e", "e")))
    assert {r.source: r.outcome for r in got.collect()} == {"a": "replaced", "b": "equal", "c": "replaced", "d": "ignored_cjk", "e": "ignored_equal_to_source", "f": "not_found"}


def test_keys_and_gates(spark, memory):
    e = spark.createDataFrame([("a\\nb",), ("x",), ("p\\u00a0q",), ("p q",)], "source string")
    a = spark.createDataFrame([("a\nb",), ("x",), ("p q",)], "source string")
    assert [tuple(r) for r in maintenance.repaired_keys(e, a).collect()] == [("a\\nb", "a\nb")]
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    assert {r.id: r.status for r in maintenance.id_check(ids("0", "1"), ids("1", "2")).collect()} == {"0": "missing", "1": "ok", "2": "extra"}
    assert tuple(maintenance.set_gate(ids("a"), ids("a")).first()) == (0, 0, True) and not maintenance.set_gate(ids("a"), ids("b", "b")).first().ok
    files = spark.createDataFrame([("k", "1"), ("k", "3"), ("k", "2"), ("z", "1")], "source string, file string")
    assert [tuple(r) for r in maintenance.duplicate_keys(files).collect()] == [("k", "1", "2,3")]
    clean, changed = maintenance.cleaned(memory(("a", "“x”\n"), ("b", "y")))
    assert changed.first().changed == 1 and {r.target for r in clean.collect()} == {'"x"', "y"}
    assert maintenance.pending(memory(("a", ""), ("b", "")), memory(("a", ""))).count() == 1


@pytest.mark.parametrize("n", [0, 1, 10_014])
def test_batches_cover_the_input(spark, n):
    df = spark.range(n).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("source"))
    report = maintenance.batch_report(maintenance.batches(df.repartition(5), 1000, "source")).orderBy("batch").collect()
    assert sum(r.entries for r in report) == n and len(report) == -(-n // 1000)
    if n > 1:
        assert [r.entries for r in report] == [1000] * 10 + [14] and report[10].first_key == "k010000" and report[0].last_key == "k000999"


def test_positional(spark):
    left = spark.createDataFrame([("f", 1, "a"), ("f", 5, "b"), ("g", 1, "c")], "file string, n int, v string")
    right = spark.createDataFrame([("f", 2, "A")], "file string, n int, v string")
    assert [(r.v, r.place, r.v_right) for r in maintenance.positional(left, right, ("file",), "n").orderBy("file", "n").collect()] == [("a", 1, "A"), ("b", 2, None), ("c", 1, None)]


def test_coverage(memory, rows):
    m = memory(("a", "A"), ("b", ""))
    c = coverage.by_flow(rows("a", "b", "b", " ", None), m).first()
    assert (c.occurrences, c.empty, c.translated, c.missing, c.missing_unique, c.ready) == (5, 2, 1, 2, 1, False)
    assert [(r.source, r.occ_count) for r in coverage.missing_texts(rows("a", "b", "b", " "), m).collect()] == [("b", 2)]
    checks = coverage.expectations(coverage.metric(coverage.by_flow(rows("a"), m), "missing", "missing"), {"missing": 0})
    assert checks.first().ok and coverage.status(checks).first().status == "pronto"
    entries = rows("a", "b").withColumn("k", F.col("i"))
    made = pipelines.generate(entries, m).select("asset", "i", "output")
    got = {r.check: r.ok for r in pipelines.validate(entries, m, made, ("asset", "i")).collect()}
    assert got == {"missing": False, "written_otherwise": True, "unknown_targets": True, "value_findings": True}
    assert pipelines.status(rows("a"), m).first().status == "pronto" and column(pipelines.generate(rows("z"), m, fall_back=True), "output") == ["z"]


def test_artifacts_and_relocation(spark):
    a = spark.createDataFrame([("f", "x", "1"), ("f", "y", "2"), ("f", "z", "3")], "flow string, name string, sha256 string")
    b = spark.createDataFrame([("f", "x", "1"), ("f", "y", "9")], "flow string, name string, sha256 string")
    assert {r.name: (r.changed, r.no_history) for r in coverage.artifact_state(a, b).collect()} == {"x": (False, False), "y": (True, False), "z": (False, True)}
    s = spark.createDataFrame([("one two",), ("left out here",), ("ana",), ("none",)], "source string")
    f = spark.createDataFrame([("A", "one two"), ("B", "one two"), ("B", "he left out hereafter"), ("C", "see ana run"), ("C", "anatomy")], "name string, text string")
    assert {r.source: (r.exact_in, r.mentioned_in) for r in coverage.relocation(s, f).collect()} == {"one two": ("A,B", None), "left out here": (None, "B"), "ana": (None, "C"), "none": (None, None)}


def test_relocation_is_file_by_file_and_by_substring(spark):
    s = spark.createDataFrame([("ana",), ("ta lo",), ("!?",), ("a.b",)], "source string")
    f = spark.createDataFrame([("A", "ana"), ("A", "ana runs"), ("B", "see ana"), ("C", "banana"), ("C", "porta longa"), ("D", "what!?"), ("E", None), ("E", "acb")], "name string, text string")
    got = {r.source: (r.exact_in, r.mentioned_in) for r in coverage.relocation(s, f).collect()}
    assert got == {"ana": ("A", "B,C"), "ta lo": (None, "C"), "!?": (None, "D"), "a.b": (None, None)}


#: One text for each rule that it must hold for, and one that it mustn't. Borders know ASCII letters only:
#: none lies between an accented letter and a space.
RULE_CASES = {
    "plural_pronoun_singular_verb": ("", "Eles foi aqui", "Eles está aqui"), "singular_pronoun_plural_verb": ("", "Você são bons", "Vocês são"), "a_gente_plural": ("", "a gente vamos", "a gente vai"),
    "existential_haver_plural": ("", "Haviam casas", "havia"), "elapsed_time_fazer_plural": ("", "fazem dois anos", "faz dois anos"), "article_adjective_feminine": ("", "uma novo casa", "uma nova casa"),
    "article_adjective_masculine": ("", "um nova carro", "um novo carro"), "para_mim_infinitive": ("", "para mim fazer", "para eu fazer"), "entre_eu": ("", "entre você e eu", "entre mim"),
    "future_subjunctive_ver": ("", "se eu ver isso", "se eu vir"), "future_subjunctive_irregular": ("", "quando você fazer isso", "quando fizer"), "esperar_indicative": ("", "espero que ele vai", "espero que vá"),
    "talvez_indicative": ("", "talvez ele vai", "talvez vá"), "redundant_direction": ("", "subir para cima", "subir"), "redundant_time": ("", "há dois anos atrás", "há dois anos"), "redundant_adverb": ("", "repetir novamente", "repetir"),
    "literal_i_wonder": ("I wonder", "eu me pergunto", "será"), "literal_make_sure": ("Make sure", "certifique-se", "veja"), "literal_let_me": ("let me", "deixe-me", "posso"), "literal_sound": ("sounds", "soa bem", "parece"),
    "literal_take_a_look": ("take a look", "dar uma olhada", "ver"), "literal_look_at": ("look at", "olhe para", "veja"), "literal_check_out": ("check out", "verificar", "ver"), "literal_feel_free": ("feel free", "sinta-se livre", "à vontade"),
    "literal_take_your_time": ("take your time", "tome seu tempo", "calma"), "literal_good_time": ("have a good time", "tenha um bom tempo", "divirta-se"), "literal_here_you_go": ("here you go", "aqui vai vocês", "aqui está você"),
    "literal_good_for_you": ("good for you", "bom para vocês", "que bom"), "literal_you_bet": ("you bet", "você aposta", "claro"), "literal_i_see": ("I see.", "eu vejo", "entendo"), "literal_for_now": ("for now", "por agora", "por enquanto"),
    "false_friend_actually": ("actually", "atualmente", "na verdade"), "false_friend_eventually": ("eventually", "eventualmente", "enfim"), "false_friend_realize": ("realize", "realizou", "percebeu"),
    "false_friend_library": ("library", "livraria", "biblioteca"), "false_friend_parents": ("parents", "parentes", "pais"), "awkward_ser_capaz": ("", "foi capaz de", "pode"), "awkward_no_need": ("", "não há necessidade de", "não precisa"),
    "awkward_de_alguma_forma": ("", "de alguma forma", "não sei como"), "gendered_first_person": ("", "estou cansado", "está cansado"),
}


def test_every_rule(spark):
    assert set(RULE_CASES) == {r.id for r in rules.RULES} and len(rules.RULES) == 40
    data = [(k, i, s, t) for k, (s, good, bad) in RULE_CASES.items() for i, t in ((1, good), (0, bad))]
    audit = rules.audited(spark.createDataFrame(data, "rule string, n int, source string, target string"))
    got = {(r.rule, r.n): r.rule in [x["id"] for x in r.reasons] for r in audit.collect()}
    assert got == {(k, i): bool(i) for k in RULE_CASES for i in (0, 1)}
    counts = rules.rule_counts(spark, audit).collect()
    assert len(counts) == 42 and sum(r.n == 0 for r in counts) == 2
    assert rules.in_review_order(rules.candidates(audit)).first()["rank"] == 0 and rules.category_counts(audit).count() == 8


def test_gender_rules(spark):
    memory = spark.createDataFrame([("s1", "Estou cansado"), ("s2", "Estou cansado"), ("s3", "Você está pronta")], "source string, target string")
    contexts = spark.createDataFrame([("s1", "Ana", None), ("s1", "Ana", None), ("s2", "Ana", None), ("s2", "Bo", None), ("s3", None, "Bo")], "source string, actor_name string, conversant_name string")
    genders = spark.createDataFrame([("Ana", "feminino"), ("Bo", "masculino")], "name string, gender string")
    audit = rules.with_gender_reasons(rules.audited(memory), contexts, genders)
    got = {r.source: [x["id"] for x in r.reasons] for r in audit.collect()}
    assert "verified_actor_gender_mismatch" in got["s1"] and "verified_actor_gender_mismatch" not in got["s2"] and got["s3"] == ["verified_conversant_gender_mismatch"]


def test_audits(spark, memory):
    f = audits.encoding_findings(memory(("k​", "nÃ£o"), ("e", "é"), ("ok", "fine"), ("n", None)))
    assert {(r.side, r.type) for r in f.collect()} == {("key", "format_or_invisible"), ("value", "common_mojibake"), ("value", "not_nfc_normalized")}
    assert tuple(audits.values_are_clean(f).first()) == (1, 2, False)
    assert [r.source for r in audits.punctuation_warnings(memory(("a", "b?"), ("c?", "d?"), ("x", "a?b"))).collect()] == ["a"]
    got = {(r.name, r.kind) for r in audits.name_findings(memory(("Ana", "Anna"), ("Ana and Bo", "Bo e ela"), ("Teo", "Teo"), ("Theo", "Theo")), ["Ana", "Bo"], {"Theo": ["Theo", "Teo"]}).collect()}
    assert got == {("Ana", "exact_name_changed"), ("Ana", "missing_from_target"), ("Theo", "canonical_form")}
    x = spark.createDataFrame([("f", i, i, v) for i, v in enumerate(["the house", "Xyzzy", "GETQ_1", "no", "empty", "half", "done", " ", "done"])], "file string, place int, line_no int, value string")
    m = memory(("the house", "the house"), ("Xyzzy", "Xyzzy"), ("GETQ_1", "GETQ_1"), ("empty", " "), ("half", "metade the"), ("done", "feito"))
    out = {r.source: (r.bucket, r.occurrences, r.still_english, r.not_in_output) for r in audits.untranslated(x, x, m).collect()}
    assert out["the house"] == ("untranslated", 1, True, False) and out["Xyzzy"][0] == "ambiguous_identity" and out["GETQ_1"][0] == "technical_or_nonlinguistic"
    assert out["no"][0] == "missing_memory" and out["empty"][0] == "empty_translation" and out["half"] == ("partial_english", 1, False, True) and out["done"] == ("translated", 2, False, True)
    blocks = spark.createDataFrame([("a", "en", "Hi", "CustomFieldType_Localization"), ("b", "en", "...", "CustomFieldType_Localization")], "file string, title string, value string, type_string string")
    assert {r.file: r.keep for r in audits.relevant_files(blocks).collect()} == {"a": True, "b": False}


def test_guards(spark, memory):
    data = [(0, "x {0}", "y {0}", "z"), (1, "map", "m", "n"), (2, "a", "Ana", "Bo"), (3, "a", "obrigado", "obrigada"), (4, "a", "b", "c"), (5, "a", "b", " ")]
    got = guards.guarded(spark.createDataFrame(data, "i int, source string, before string, after string"), {"map": "mapa"}, [], ["Ana"])
    assert column(got, "guard") == ["tokens", "terms", "names", "gender", None, "empty"] and column(got, "result") == ["y {0}", "m", "Ana", "obrigado", "c", "b"]
    d = guards.decided(spark.createDataFrame([(0, "b", "a", "aprovar", "x"), (1, "b", "a", "REPROVAR", " "), (2, "b", "a", "Reprovado", "s"), (3, "b", "a", None, "s")], "i int, before string, after string, decision string, suggestion string"))
    assert column(d, "suggestion") == ["a", "b", "s", None] and tuple(guards.decision_counts(d).first()) == (1, 2, 1, 4)
    genders = spark.createDataFrame([("s", "feminino")], "source string, gender string")
    fixed = guards.corrected(memory(("s", "Estou cansado"), ("t <i>", "x"), ("u", "y")), genders, memory(("t <i>", "z"), ("u", "novo")))
    assert {r.source: (r.corrected, r.fault) for r in fixed.collect()} == {"s": ("Estou cansada", None), "t <i>": ("x", "tokens_changed"), "u": ("novo", None)}
    assert guards.duplicate_corrections(memory(("a", "1"), ("a", "2"), ("b", "3"))).count() == 1


PLACEHOLDERS = {
    None: (None, "valor_nao_string"), "  ": ("  ", "valor_vazio"), "{EffectFoodCommon.Tea_Description}": (None, "effectfood_descricao_nao_alterada"), "Tea {EffectFoodCommon.Food_Perfect}": (None, "ja_estava_correto_effectfood_nome_qualidade"),
    "{EffectFoodCommon.Food_Perfect} Green  Tea": ("Green Tea {EffectFoodCommon.Food_Perfect}", "effectfood_qualidade_movida_para_o_final"),
    "{BroomstickTheme.A_Description}\\n{BroomstickCommon.Broomstick_Type_B_Description}": (None, "broomstick_descricao_composta_nao_alterada"),
    "{BroomstickCommon.Broomstick_Name} {BroomstickTheme.A} {BroomstickCommon.Broomstick_Type_B}": (None, "ja_estava_correto_broomstick_nome_theme_tipo"), "{BroomstickCommon.Broomstick_Name} {BroomstickTheme.A}": (None, "ja_estava_correto_broomstick_nome_theme"),
    "{BroomstickCommon.Broomstick_Type_B} {BroomstickTheme.A} {BroomstickCommon.Broomstick_Name}": ("{BroomstickCommon.Broomstick_Name} {BroomstickTheme.A} {BroomstickCommon.Broomstick_Type_B}", "broomstick_tipo_theme_nome_corrigido_para_nome_theme_tipo"),
    "{BroomstickTheme.A} {BroomstickCommon.Broomstick_Name}": ("{BroomstickCommon.Broomstick_Name} {BroomstickTheme.A}", "broomstick_theme_nome_corrigido_para_nome_theme"),
    "{FishName.A} {InteriorPropBasicName.B}": (None, "fish_com_interiorprop_nao_alterado"), "{InteriorPropBasicName.B} de {People.A}": (None, "ja_estava_correto_interiorbasic_de_referencia"),
    "{People.A} {InteriorPropBasicName.B}": ("{InteriorPropBasicName.B} de {People.A}", "referencia_antes_interiorbasic_corrigida_com_de"),
    "{InteriorPropTheme.A} Small {InteriorPropBasicName.B}": ("Small {InteriorPropBasicName.B} {InteriorPropTheme.A}", "interiorprop_theme_movido_para_o_final"),
    "Mar {InteriorPropBasicName.B}": ("{InteriorPropBasicName.B} de Mar", "texto_antes_interiorbasic_corrigido_com_de"), "{BroomstickTheme.A} Thing": ("Thing {BroomstickTheme.A}", "broomstick_theme_movido_para_o_final_generico"),
    "a {EffectFoodCommon.Food_Perfect} b": (None, "effectfood_qualidade_existe_mas_nao_entrou_nas_regras"), "a {EffectFoodCommon.X} b": (None, "tem_effectfood_mas_nao_entrou_nas_regras"),
    "a {InteriorPropTheme.X} b": (None, "interiorprop_theme_existe_mas_nao_esta_no_inicio"), "{InteriorPropBasicName.B} b": (None, "tem_interiorprop_mas_nao_entrou_nas_regras"),
    "a {BroomstickTheme.X} b": (None, "broomstick_theme_existe_mas_nao_entrou_nas_regras"), "a {BroomstickCommon.X} b": (None, "tem_broomstick_mas_nao_entrou_nas_regras"), "plain": (None, "sem_placeholder_relevante"),
    "{InteriorPropTheme.A}": (None, "interiorprop_theme_existe_mas_nao_esta_no_inicio"),
    "{InteriorPropTheme.A}{InteriorPropTheme.B} X": ("X {InteriorPropTheme.A} {InteriorPropTheme.B}", "interiorprop_theme_movido_para_o_final"),
    " {InteriorPropTheme.A}  {InteriorPropTheme.B}Y{InteriorPropTheme.C}": ("Y{InteriorPropTheme.C} {InteriorPropTheme.A} {InteriorPropTheme.B}", "interiorprop_theme_movido_para_o_final"),
    "{BroomstickTheme.A}{BroomstickTheme.B} Thing": ("Thing {BroomstickTheme.A} {BroomstickTheme.B}", "broomstick_theme_movido_para_o_final_generico"),
}


def test_placeholders(values):
    got = values(placeholders.reordered, list(PLACEHOLDERS))
    for (text, (new, reason)), r in zip(PLACEHOLDERS.items(), got, strict=True):
        assert (r.value, r.reason, r.changed) == (text if new is None else new, reason, new is not None and new != text), text


def test_enrichment(spark, memory, rows, tmp_path):
    def translator(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t == "bad" else "lost" if "LOSE" in t else t.upper())

    got = {r.source: (r.target, r.status) for r in enrichment.translated(rows(" hi {0} ", "bad", "LOSE {1}", None, "bad", ""), translator).collect()}
    assert got == {" hi {0} ": (" HI {0} ", "ok"), "bad": (None, "failed"), "LOSE {1}": (None, "token_lost")}
    assert {r.source for r in enrichment.fill_missing(memory(("a", "A"), ("b", "")), rows("a", "b", "c"), enrichment.identity).collect()} == {"b", "c"}
    state = str(tmp_path / "state")
    assert enrichment.resumed(rows(*[f"t{i}" for i in range(5)]), state, translator, batch_size=2) == 3
    assert enrichment.resumed(rows(*[f"t{i}" for i in range(6)]), state, translator, batch_size=2) == 1
    assert spark.read.parquet(state).count() == 6


def test_variants_translators_and_sentences(spark, rows):
    asked = []

    def first(texts):
        raise OSError("no service")

    def second(texts: pd.Series) -> pd.Series:
        known = {"it's a map": "é um mapa", "One.": "Um.", "Two __MARK_0__!": "Dois __MARK_0__!", "[a] b": "no mark"}
        return texts.map(known.get)

    options = {"attempts": 2, "with_variants": True, "by_sentence": True}
    got = {r.source: (r.target, r.status) for r in enrichment.translated(rows("it\u2019s a map", " One. Two {0}! ", "One. Three.", "[a] b"), [first, second], **options).collect()}
    assert got["it\u2019s a map"] == ("é um mapa", "ok") and got[" One. Two {0}! "] == (" Um. Dois {0}! ", "ok")
    assert got["One. Three."] == (None, "failed") and asked == []


def test_review_repairs_keys_guards_and_resumes(spark, memory, tmp_path):
    state = str(tmp_path / "reviewed")
    old = memory(("a {0}", "um {0}"), ("b\\nc", "dois"), ("d", "ele está cansado"), ("e", "cinco"), (None, "x"))
    down = {"e"}

    def reviewer(batch: pd.DataFrame) -> pd.DataFrame:
        if down & set(batch["source"]):
            raise OSError("no service")
        said = {"a {0}": "um", "b\\nc": "dois\\n!", "d": "ela está cansada", "e": "cinco!"}
        return pd.DataFrame([(s.replace("\\n", "\n"), said[s]) for s in batch["source"]], columns=["source", "after"])

    got = {r.source: (r.guard, r.result) for r in enrichment.reviewed(old, state, reviewer, batch_size=1, per_write=2).collect()}
    assert got == {"a {0}": ("tokens", "um {0}"), "b\\nc": (None, "dois\\n!"), "d": ("gender", "ele está cansado")}
    down.clear()
    again = enrichment.reviewed(old, state, reviewer, batch_size=1).collect()
    assert sorted(r.source for r in again) == ["a {0}", "b\\nc", "d", "e"]


def test_audit_by_ids(spark, tmp_path):
    state = str(tmp_path / "audited")
    rows = [(f"s{i}", "antes", f"depois {i}") for i in range(4)]
    changes = spark.createDataFrame(rows, "source string, before string, after string")

    def auditor(batch: pd.DataFrame) -> pd.DataFrame:
        if "s3" in set(batch["source"]):
            return batch.iloc[:0].assign(decision="", suggestion="", reason="")
        kinds = [("APROVAR", "x") if s == "s0" else ("REPROVAR", " ") if s == "s1" else ("REPROVAR", "melhor") for s in batch["source"]]
        return pd.DataFrame({"id": batch["id"].to_numpy()[::-1], "decision": [k for k, _ in kinds][::-1], "suggestion": [s for _, s in kinds][::-1], "reason": "r"})

    got = {r.source: (r.decision, r.suggestion) for r in enrichment.audited(changes, state, auditor, batch_size=3).collect()}
    assert got == {"s0": ("APROVAR", "depois 0"), "s1": ("REPROVAR", "antes"), "s2": ("REPROVAR", "melhor")}


def test_comparable_keys_agree(values):
    from verbena.functions import text as T

    keys = ["a\\nb", "a\\\\nb", "x\\u00a0y", "x\u00a0y", "\\r\\n", "plain", ""]
    assert values(lambda t: T.comparable_key(t), keys) == list(map(enrichment.comparable, keys))


def test_stream_is_exactly_once(spark, tmp_path):
    folder, state, check = (str(tmp_path / x) for x in ("in", "state", "check"))
    spark.createDataFrame([("a",), ("b",)], "source string").write.json(folder)
    enrichment.stream(spark, folder, state, check, enrichment.identity).start().awaitTermination()
    spark.createDataFrame([("b",), ("c",)], "source string").write.mode("append").json(folder)
    for _ in range(2):
        enrichment.stream(spark, folder, state, check, enrichment.identity).start().awaitTermination()
    assert sorted(r.source for r in spark.read.parquet(state).collect()) == ["a", "b", "c"]


def _batches(state):
    return {int(p.name.split("=")[1]): p for p in Path(state).iterdir() if p.name.startswith("batch=")}


def test_stream_replays_a_batch_and_tries_again(spark, tmp_path):
    """A batch whose commit was lost is done again and loses nothing; a failed text is tried by the next batch."""
    folder, state, check = (str(tmp_path / x) for x in ("in", "state", "check"))
    down = {"b"}
    translator = lambda texts: texts.map(lambda t: None if t in down else t)
    spark.createDataFrame([("a",), ("b",)], "source string").write.json(folder)
    start = lambda: enrichment.stream(spark, folder, state, check, translator).start().awaitTermination()
    start()
    for name in ("0", ".0.crc"):
        (Path(check) / "commits" / name).unlink(missing_ok=True)
    start()
    ok = lambda: sorted(r.source for r in spark.read.parquet(state).filter("status = 'ok'").collect())
    assert ok() == ["a"] and set(_batches(state)) == {0}
    down.clear()
    spark.createDataFrame([("c",)], "source string").write.mode("append").json(folder)
    start()
    assert ok() == ["a", "b", "c"]


def test_relocation_against_brute_force(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "x" * 3000 + "needle" + "y" * 3000]
    files = [(rng.choice(["f1", "f2", "f3", None]), t) for t in texts]
    strings = ["a", "é", "ab", " ", "abc", "cab a", "needle", "zzz", "abcab", "", None, "x" * 50, *[t for t in texts[:4]]]
    got = {(r.source, r.exact_in, r.mentioned_in) for r in coverage.relocation(spark.createDataFrame([(s,) for s in strings], "source string"), spark.createDataFrame(files, "name string, text string")).collect()}
    want = set()
    for s in {s for s in strings if s}:
        exact = {n for n, t in files if t == s}
        held = {n for n, t in files if t is not None and s in t}
        join = lambda x: ",".join(sorted(n for n in x if n)) or None
        want.add((s, join(exact), join(held - exact)))
    assert got == want
    assert coverage.relocation(spark.createDataFrame([], "source string"), spark.createDataFrame(files, "name string, text string")).count() == 0


def test_relocation_by_asset_and_binaries(spark):
    strings = spark.createDataFrame([("a1", "Olá"), ("a1", "mapa"), ("a1", "gone"), ("a2", "mapa"), ("a2", None)], "asset string, source string")
    files = spark.createDataFrame([("f1", "Olá"), ("f2", "o mapa"), ("f3", "mapas")], "name string, text string")
    blob = bytearray(b"\x00" * 65530 + "gone Olá".encode() + b"\xff" * 10)
    binary = coverage.binary_places(strings.select("source"), spark.createDataFrame([("b1", blob), ("b2", bytearray())], "name string, content binary"))
    assert {(r.source, r.name) for r in binary.collect()} == {("gone", "b1"), ("Olá", "b1")}
    relocated = coverage.relocation(strings, files)
    got = {r.asset: tuple(r)[1:] for r in coverage.relocation_by_asset(strings, relocated, binary).collect()}
    assert got == {"a1": (3, 1, 1, 0, 2, "f1", "f2,f3"), "a2": (1, 0, 1, 0, 0, "", "f2,f3")}
    assert {tuple(r) for r in coverage.relocation_by_destination(strings, relocated).collect()} == {("a1", "f1", 1, 0), ("a1", "f2", 0, 1), ("a1", "f3", 0, 1), ("a2", "f2", 0, 1), ("a2", "f3", 0, 1)}


def test_relocation_shuffles_no_pieces(spark):
    """A text's pieces aren't exploded into rows; what leaves the scan is little more than what is held."""
    strings = spark.createDataFrame([("a1", f"string number {i}") for i in range(300)] + [("a1", "o")], "asset string, source string")
    files = spark.createDataFrame([(f"f{i % 7}", "lorem ipsum " * 40 + f"string number {i} dolor") for i in range(200)], "name string, text string")
    relocated = coverage.relocation(strings, files)
    assert "Generate" not in relocated._jdf.queryExecution().executedPlan().toString()
    held = sum(s in t for (s,) in strings.select("source").collect() for (t,) in files.select("text").collect())
    assert held <= substrings.candidates(strings, files).count() <= held * 1.1
    row = coverage.relocation_by_asset(strings, relocated).first()
    assert (row.strings, row.exact, row.mentioned, row.nowhere, row.mentioned_files) == (301, 0, 201, 100, "f0,f1,f2,f3,f4,f5,f6")


def test_relocation_in_ranges_and_over_borders(spark, monkeypatch):
    """Strings over the borders of scanned blocks, longer than a block, not of whole characters' lengths, and in several ranges."""
    rng = random.Random(6)
    long = "".join(rng.choice("abcdé") for _ in range(2 * substrings.BLOCK))
    border = len(long.encode()[: substrings.BLOCK].decode(errors="ignore"))
    strings = [long[border - 5 : border + 5], long[border - 300 : border + 1], long[-7:], long[:9], long[3 : border + 1000], "absent", long[border - 60 : border] + "x", "é" * 40]
    files = [("f1", long), ("f2", long[border - 5 : border + 5]), ("f3", ""), ("f4", "é" * 41)]
    for size in (substrings.RANGE, 3):
        monkeypatch.setattr(substrings, "RANGE", size)
        got = {(r.source, r.exact_in, r.mentioned_in) for r in coverage.relocation(spark.createDataFrame([(s,) for s in strings], "source string"), spark.createDataFrame(files, "name string, text string")).collect()}
        join = lambda x: ",".join(x) or None
        assert got == {(s, join(n for n, t in files if s == t), join(n for n, t in files if s in t and s != t)) for s in strings}


@pytest.mark.parametrize(
    ("query", "exploded"),
    [
        ("relocated_names", 0),
        ("relocation_counts", 0),
        ("relocation_by_destination", 1),  # of the lists of files
    ],
)
def test_relocation_queries_explode_no_texts(spark, query, exploded):
    plan = queries_core.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == exploded and plan.count("MapInArrow") == 1


def _shuffled(node):
    """Rows written by all exchanges of a plan that has run."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled(node.plan())
    children = node.children()
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(_shuffled(children.apply(i)) for i in range(children.size()))


def test_destinations_are_summed_where_pairs_are_made(spark, monkeypatch):
    """An asset without a name, several strings of an asset in one file, batches cut within an asset; pairs aren't shuffled."""
    monkeypatch.setattr(pair_counts, "ROWS", 7)
    strings = [(f"a{i}", x) for i in range(100) for x in ("No", "mapa", f"own {i}")] + [(None, "No"), (None, "No"), ("a0", "absent"), ("b", "absent")]
    files = [(f"f{i:03d}", x) for i in range(150) for x in ("No", f"o mapa {i}" if i % 3 else "mapa")] + [("f000", "own 5"), ("only", "No, own 7")]
    s, f = spark.createDataFrame(strings, "asset string, source string"), spark.createDataFrame(files, "name string, text string")
    want = {}
    for asset, source in set(strings):
        exact = {n for n, t in files if t == source}
        for name in {n for n, t in files if source in t}:
            e, m = want.get((asset, name), (0, 0))
            want[asset, name] = (e + (name in exact), m + (name not in exact))
    out = coverage.relocation_by_destination(s, coverage.relocation(s, f))
    got = out.collect()
    assert out.columns == ["asset", "destination", "exact", "mentioned"] and len(got) == len(want) > 15_000
    assert {(r.asset, r.destination): (r.exact, r.mentioned) for r in got} == want
    assert _shuffled(out._jdf.queryExecution().executedPlan()) < len(want) / 3


def test_name_sets_and_totals(spark, memory):
    a, b = (spark.createDataFrame([(x,) for x in xs], "name string") for xs in (["x", "y", "y", None], ["y", "z"]))
    assert {tuple(r) for r in maintenance.name_sets(a, b).collect()} == {("x", "removed"), ("y", "both"), ("z", "added")}
    rows = spark.createDataFrame([("t1", "m", None), ("t2", "m", None), ("t1", "k", "own"), ("t1", " ", None), ("t2", "n", None)], "table_name string, en string, br string")
    assert tuple(coverage.missing_unique(rows, memory(("n", "N"))).first()) == (2, 1)


def test_encoding_contexts_and_surrogates(spark):
    m = spark.createDataFrame([("k", "x" * 50 + "nÃ£o\n" + "y" * 50), ("k2", "cafe\u0301"), ("k3", "a\\ud800b"), ("k4", "fine"), ("k5", None)], "source string, target string")
    got = {(r.source, r.type): (r.match, r.code_points, r.context) for r in audits.encoding_findings(m, with_context=True, raw=True).collect()}
    assert got[("k", "common_mojibake")] == ("Ã£", "U+00C3 U+00A3", "x" * 34 + "nÃ£o\\n" + "y" * 33)
    assert got[("k2", "not_nfc_normalized")] == (None, None, "cafe\u0301")
    assert got[("k3", "lone_surrogate")][:2] == ("\\ud800", "U+D800") and ("k3", "literal_unicode_escape") in got
    assert {k for k, _ in got} == {"k", "k2", "k3"}


def test_states_are_carried_over_chunks(spark):
    """A third of all rows are of one group; any chunk length gives the same states."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "a", "b", None]), n, rng.choice([None, None, n])) for n in range(400)]
    df = spark.createDataFrame(rows, "file string, line_no long, x long")
    want = set()
    for f in ("a", "b", None):
        own = [(n, x) for g, n, x in rows if g == f]
        last, seen = None, 0
        for i, (n, x) in enumerate(own):
            last, seen = (x if x is not None else last), seen + (x is not None)
            want.add((f, n, last, seen, own[i - 1][1] if i else None, own[i + 1][0] if i + 1 < len(own) else None))
    for chunk in (1, 7, 1000):
        got = ordered.scanned(df, last={"l": F.col("x")}, count={"c": F.col("x")}, lag={"p": F.col("x")}, lead={"n": F.col("line_no")}, chunk=chunk)
        assert {(r.file, r.line_no, r.l, r.c, r.p, r.n) for r in got.collect()} == want, chunk
    assert ordered.scanned(df.limit(0), count={"c": F.col("x")}).count() == 0
