"""Guards over answers of a reviewer: what an answer must keep, and what becomes of it.

Protected terms are data (a few hundred rows at most, passed as literals); a term counts as
kept if it stands anywhere in the new text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def lost_terms(source: Column, old: Column, new: Column, pairs: dict[str, str], kept: list[str]) -> Column:
    """Terms that the source or the old text calls for and the new text lacks."""
    has = lambda text, term: F.contains(F.coalesce(text, F.lit("")), F.lit(term))
    by_source = [F.when(has(source, en) & ~has(new, pt), F.lit(pt)) for en, pt in pairs.items()]
    by_old = [F.when(has(old, term) & ~has(new, term), F.lit(term)) for term in kept]
    return F.array_compact(F.array(*by_source, *by_old)) if by_source or by_old else F.array().cast("array<string>")


def guarded(changes: DataFrame, pairs: dict[str, str] | None = None, terms: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """changes (source, before, after) with `guard` and `result`: the first guard that fails keeps the old text."""
    source, old, new = F.col("source"), F.col("before"), F.col("after")
    guard = (
        F.when(T.is_blank(new), "empty")
        .when(F.size(T.missing_tokens(source, old, new)) > 0, "tokens")
        .when(F.size(lost_terms(source, old, new, pairs or {}, terms or [])) > 0, "terms")
        .when(F.size(lost_terms(source, old, new, {}, names or [])) > 0, "names")
        .when(T.gender_swapped(old, new).isNotNull(), "gender")
    )
    return changes.withColumn("guard", guard).withColumn("result", F.when(F.col("guard").isNull(), new).otherwise(old))


def decided(answers: DataFrame) -> DataFrame:
    """answers (before, after, decision, suggestion) with decision and suggestion in one form.

    An approved answer's suggestion is the answer; a rejected one without suggestion goes back
    to the old text; anything else isn't a decision.
    """
    word = F.upper(T.ws_trim(F.col("decision")))
    decision = F.when(word.isin("APROVAR", "APROVADO"), "APROVAR").when(word.isin("REPROVAR", "REPROVADO"), "REPROVAR").otherwise("INVALIDA")
    suggestion = F.when(F.col("decision") == "APROVAR", F.col("after")).when(F.col("decision") == "REPROVAR", F.when(T.is_blank(F.col("suggestion")), F.col("before")).otherwise(F.col("suggestion")))
    return answers.withColumn("decision", F.coalesce(decision, F.lit("INVALIDA"))).withColumn("suggestion", suggestion)


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.agg(*[F.count_if(F.col("decision") == d).alias(n) for d, n in (("APROVAR", "approved"), ("REPROVAR", "rejected"), ("INVALIDA", "invalid"))], F.count("*").alias("total"))


def same_tokens(source: Column, target: Column) -> Column:
    return T.token_signature(source) == T.token_signature(target)


def corrected(memory: DataFrame, contexts_gender: DataFrame, manual: DataFrame) -> DataFrame:
    """memory with `corrected` and `fault`: gendered forms flexed for the speaker, then manual corrections over them.

    `contexts_gender` has source and gender, `manual` source and target. A correction that
    changes technical tokens isn't applied; its row says so.
    """
    rows = memory.join(contexts_gender.select("source", F.col("gender").alias("_g")), "source", "left").join(manual.select("source", F.col("target").alias("_m")), "source", "left")
    wrong = F.when(F.col("_g") == "feminino", T.speaks_as(F.col("target"), "masculino")).when(F.col("_g") == "masculino", T.speaks_as(F.col("target"), "feminino"))
    flexed = F.when(wrong & (F.col("_g") == "feminino"), T.flex_gender(F.col("target"), "feminino")).when(wrong, T.flex_gender(F.col("target"), "masculino"))
    proposal = F.coalesce("_m", flexed)
    fault = F.when(proposal.isNotNull() & ~same_tokens(F.col("source"), proposal), "tokens_changed")
    return rows.withColumn("fault", fault).withColumn("corrected", F.when(fault.isNull(), F.coalesce(proposal, F.col("target"))).otherwise(F.col("target"))).drop("_g", "_m")


def duplicate_corrections(manual: DataFrame) -> DataFrame:
    return manual.groupBy("source").agg(F.count("*").alias("n")).filter("n > 1")
