"""A rule engine for texts: each rule is a column, all rules are evaluated in one pass.

Rules are data: id, category, severity, a pattern for the source (or none) and one for the
target. They become literal patterns of generated columns, never a join of rows and rules.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


class Rule(NamedTuple):
    id: str
    category: str
    severity: str
    target: str
    source: str | None = None


_PRONOUN = r"(?:eu|você|ele|ela|a gente|nós|vocês|eles|elas)"
#: The rules for Portuguese translations of English dialogue.
RULES = (
    Rule("plural_pronoun_singular_verb", "concordancia_verbal", "alta", r"\b(?:eles|elas|vocês|nós)\s+(?:é|está|foi|tem|vai|pode|deve|parece|precisa|quer)\b"),
    Rule("singular_pronoun_plural_verb", "concordancia_verbal", "alta", r"\b(?:eu|você|ele|ela|isso|isto|aquilo|a gente)\s+(?:são|estão|foram|têm|vão|podem|devem|parecem|precisam|querem)\b"),
    Rule("a_gente_plural", "concordancia_verbal", "alta", r"\ba gente\s+(?:somos|estamos|fomos|temos|vamos|podemos|devemos|queremos|precisamos)\b"),
    Rule("existential_haver_plural", "concordancia_verbal", "media", r"\b(?:houveram|haviam|haverão)\b"),
    Rule("elapsed_time_fazer_plural", "concordancia_verbal", "alta", r"\bfazem\s+(?:(?:mais de|quase|uns?|alguns?)\s+)?(?:\d+|dois|três|quatro|cinco|seis|sete|oito|nove|dez|muitos?)?\s*(?:dias|anos|meses|semanas|horas|minutos|tempo)\b"),
    Rule("article_adjective_feminine", "concordancia_nominal", "alta", r"\b(?:uma|aquela|esta|essa)\s+(?:novo|bom|mau|pequeno|bonito|certo|errado|perfeito|ótimo|estranho|outro|único|primeiro|último|mesmo|próprio)\s+[\p{L}-]+"),
    Rule("article_adjective_masculine", "concordancia_nominal", "alta", r"\b(?:um|aquele|este|esse)\s+(?:nova|boa|má|pequena|bonita|certa|errada|perfeita|ótima|estranha|outra|única|primeira|última|mesma|própria)\s+[\p{L}-]+"),
    Rule("para_mim_infinitive", "regencia", "alta", r"\bpara mim\s+(?:fazer|ir|ver|pegar|levar|trazer|dizer|dar|resolver|cuidar|usar|preparar|ajudar|conseguir|encontrar|saber|entender|aprender|decidir)\b"),
    Rule("entre_eu", "regencia", "alta", r"\bentre eu e\b|\bentre [^,.!?]{1,30} e eu\b"),
    Rule("future_subjunctive_ver", "conjugacao", "alta", rf"\b(?:se|quando|assim que)\s+{_PRONOUN}\s+ver\b"),
    Rule("future_subjunctive_irregular", "conjugacao", "media", rf"\b(?:se|quando|assim que)\s+{_PRONOUN}\s+(?:fazer|trazer|dizer|ter|estar|manter|obter|poder|saber|querer|pôr)\b"),
    Rule("esperar_indicative", "conjugacao", "media", r"\b(?:espero|esperamos|tomara)\s+que\s+[^.!?]{0,55}\b(?:vai|vão|pode|podem|é|são|está|estão|tem|têm|fica|ficam|faz|fazem)\b"),
    Rule("talvez_indicative", "conjugacao", "media", r"\btalvez\s+[^.!?]{0,45}\b(?:vai|vão|é|são|está|estão|tem|têm|fica|ficam|faz|fazem|pode|podem)\b"),
    Rule("redundant_direction", "redundancia", "alta", r"\b(?:subir para cima|descer para baixo|entrar para dentro|sair para fora|encarar de frente)\b"),
    Rule("redundant_time", "redundancia", "alta", r"\bhá\s+[^.!?]{0,25}\s+atrás\b"),
    Rule("redundant_adverb", "redundancia", "media", r"\b(?:repetir novamente|continua ainda|apenas só|planejar antecipadamente|surpresa inesperada|outra alternativa)\b"),
    Rule("literal_i_wonder", "traducao_literal", "alta", r"\beu me pergunto\b", r"\bI wonder\b"),
    Rule("literal_make_sure", "traducao_literal", "alta", r"\bcertifi(?:que|car|cou|cado|cada|carmos|carei|cará|quem)-?se\b", r"\bmake sure\b"),
    Rule("literal_let_me", "traducao_literal", "media", r"\bdeix(?:a|e|em)-?me\b|\bdeixa eu\b", r"\blet me\b"),
    Rule("literal_sound", "traducao_literal", "alta", r"\bsoa(?:m|va|vam|ria|riam)?\b", r"\bsounds?\b"),
    Rule("literal_take_a_look", "traducao_literal", "media", r"\b(?:dar|dê|dá|dando|dei|demos|vamos dar) uma olhada\b", r"\btake a look\b"),
    Rule("literal_look_at", "traducao_literal", "media", r"\bolh(?:e|a|ar|ando) para\b", r"\blook at\b"),
    Rule("literal_check_out", "traducao_literal", "media", r"\bverific(?:ar|a|e|ando|ou|amos)\b", r"\bcheck(?:ed|ing)? out\b"),
    Rule("literal_feel_free", "traducao_literal", "alta", r"\bsinta-se livre\b", r"\bfeel free\b"),
    Rule("literal_take_your_time", "traducao_literal", "alta", r"\btome seu tempo\b|\bleve o seu tempo\b", r"\btake your time\b"),
    Rule("literal_good_time", "traducao_literal", "alta", r"\btenha um bom tempo\b", r"\bhave a good time\b"),
    Rule("literal_here_you_go", "traducao_literal", "alta", r"\baqui (?:vai|está) você\b", r"\bhere you go\b"),
    Rule("literal_good_for_you", "traducao_literal", "alta", r"\bbom para você\b", r"\bgood for you\b"),
    Rule("literal_you_bet", "traducao_literal", "alta", r"\bvocê aposta\b", r"\byou bet\b"),
    Rule("literal_i_see", "traducao_literal", "media", r"\beu vejo\b", r"^I see[,.!]?$"),
    Rule("literal_for_now", "traducao_literal", "alta", r"\bpor agora\b", r"\bfor now\b"),
    Rule("false_friend_actually", "falso_cognato", "alta", r"\batualmente\b", r"\bactually\b"),
    Rule("false_friend_eventually", "falso_cognato", "alta", r"\beventualmente\b", r"\beventually\b"),
    Rule("false_friend_realize", "falso_cognato", "alta", r"\brealiz(?:ar|ei|ou|ando|amos|aram|a|e)\b", r"\breali[sz](?:e|ed|ing|es)\b"),
    Rule("false_friend_library", "falso_cognato", "alta", r"\blivraria(?:s)?\b", r"\blibrar(?:y|ies)\b"),
    Rule("false_friend_parents", "falso_cognato", "alta", r"\bparentes\b", r"\bparents\b"),
    Rule("awkward_ser_capaz", "traducao_literal", "baixa", r"\b(?:ser|sou|é|somos|são|era|eram|foi|foram|serei|será|serão|seja|sejam|seria|seriam) capaz(?:es)? de\b"),
    Rule("awkward_no_need", "traducao_literal", "baixa", r"\bnão há necessidade de\b"),
    Rule("awkward_de_alguma_forma", "traducao_literal", "baixa", r"\bde alguma forma\b"),
    Rule("gendered_first_person", "genero_contextual", "baixa", r"\b(?:estou|estava|fiquei|ficarei|sou|me sinto|continuo)\s+(?:animad[oa]|cansad[oa]|preocupad[oa]|surpres[oa]|curios[oa]|ansios[oa]|aliviad[oa]|ocupad[oa]|confus[oa]|impressionad[oa]|interessad[oa]|empolgad[oa]|chocad[oa]|nervos[oa]|sozinh[oa]|grat[oa]|cert[oa]|convencid[oa]|perdid[oa]|pront[oa])\b"),
)
ACTOR_MISMATCH = Rule("verified_actor_gender_mismatch", "concordancia_genero", "alta", "")
CONVERSANT_MISMATCH = Rule("verified_conversant_gender_mismatch", "concordancia_genero", "alta", "")
SEVERITY = {"alta": 0, "media": 1, "baixa": 2}


def _reason(rule: Rule) -> Column:
    return F.struct(F.lit(rule.id).alias("id"), F.lit(rule.category).alias("category"), F.lit(rule.severity).alias("severity"))


def no_reasons() -> Column:
    return F.filter(F.array(_reason(RULES[0])), lambda _: F.lit(False))


def reasons(source: Column, target: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The rules that hold for a pair in small letters without technical parts, in their order."""
    held = []
    for rule in rules:
        test = target.rlike(T.regex(rule.target))
        if rule.source:
            test = source.rlike(T.regex(rule.source)) & test
        held.append(F.when(test, _reason(rule)))
    return F.array_compact(F.array(*held))


def audited(memory: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """memory with `reasons`, evaluated once a row: what follows filters the generated column."""
    small = lambda c: F.lower(T.strip_technical(c))
    sides = F.struct(small(F.col("source")).alias("s"), small(F.coalesce("target", F.lit(""))).alias("t"))
    found = T.let(sides, lambda x: reasons(x["s"], x["t"], rules))
    return memory.select(*[F.col(f"`{c}`") for c in memory.columns if c != "reasons"], F.explode(F.array(found)).alias("reasons"))


def with_gender_reasons(audit: DataFrame, contexts: DataFrame, genders: DataFrame) -> DataFrame:
    """Adds the reasons that speakers and addressees give.

    A source counts for a role if all its contexts name one person of known gender; `genders`
    has name and gender (masculino, feminino).
    """
    out = audit
    for role, rule, marks in (("actor", ACTOR_MISMATCH, T.speaks_as), ("conversant", CONVERSANT_MISMATCH, T.speaks_to)):
        name = F.col(f"{role}_name")
        alone = contexts.filter(name.isNotNull() & (name != "")).groupBy("source").agg(F.min(name).alias("_name"), F.max(name).alias("_other")).filter("_name = _other").select("source", "_name")
        known = alone.join(genders.select(F.col("name").alias("_name"), F.col("gender").alias("_gender")), "_name").select("source", "_gender")
        stripped = T.strip_technical(F.coalesce("target", F.lit("")))
        wrong = F.when(F.col("_gender") == "feminino", marks(stripped, "masculino")).when(F.col("_gender") == "masculino", marks(stripped, "feminino"))
        extra = F.when(F.coalesce(wrong, F.lit(False)), F.array(_reason(rule))).otherwise(no_reasons())
        out = out.join(known, "source", "left").withColumn("reasons", F.concat("reasons", extra)).drop("_gender")
    return out


def candidates(audit: DataFrame) -> DataFrame:
    """Entries with a reason, and `rank`, the most severe reason's."""
    ranks = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    return audit.filter(F.size("reasons") > 0).withColumn("rank", F.array_min(F.transform("reasons", lambda r: ranks[r["severity"]])))


def in_review_order(found: DataFrame) -> DataFrame:
    """By severity, then by source as readers sort it."""
    return found.orderBy("rank", F.collate("source", "en"), "source")


def rule_counts(spark: SparkSession, audit: DataFrame, rules: tuple[Rule, ...] = (*RULES, ACTOR_MISMATCH, CONVERSANT_MISMATCH)) -> DataFrame:
    """id, category, severity, n of every rule, those that never hold too."""
    table = spark.createDataFrame([(r.id, r.category, r.severity) for r in rules], "id string, category string, severity string")
    counts = audit.select(F.explode("reasons.id").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return table.join(F.broadcast(counts), "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def category_counts(audit: DataFrame) -> DataFrame:
    return audit.select(F.explode("reasons.category").alias("category")).groupBy("category").agg(F.count("*").alias("n"))
