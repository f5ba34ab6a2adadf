"""Micro-batch enrichment: texts go through translators and reviewers, with checkpointed resume.

Translators and reviewers are vectorized functions plugged in by the caller. A translator maps
texts to texts or nulls; a text is tried in each of its variants with each translator in turn,
then sentence by sentence. A reviewer gets a batch of a bounded number of rows and gives its
answers by key or by id; an answer whose keys or ids don't match, even after keys are repaired,
is asked for again, and a batch that never gets a sound answer stays pending. Guards then decide
what becomes of each answer. Work is written range by range of batches, so a run that is cut
off goes on where it stopped.

The stream form does the same for new files as they come. Each micro-batch owns one part of
the state, which it may overwrite but never reads: a batch that is replayed after a failure
does its work again and puts its own part in place, and nothing is counted twice or lost. Texts
that fail are kept in their batch's part and tried again by later batches, `retries` times.

Null and blank texts are never sent. Repeated texts are sent once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens
from ..operators import guards, maintenance
from ..session import file_system, scratch, ship

Translator = Callable[[pd.Series], pd.Series]
#: From rows (id, source, before) to rows (source, after); or from (id, source, before, after) to (id, decision, suggestion, reason).
Reviewer = Callable[[pd.DataFrame], pd.DataFrame]

FORMS = "array<struct<p:string,t:array<string>>>"
STATE = "source string, target string, status string"
REVIEWED = "batch long, source string, before string, after string, status string"
AUDITED = "batch long, source string, before string, after string, decision string, suggestion string, reason string, status string"
DECISIONS = ("APROVAR", "REPROVAR")


def identity(texts: pd.Series) -> pd.Series:
    """The stand-in of a translator: every text is its own translation."""
    return texts


def dictionary(entries: dict[str, str]) -> Translator:
    return lambda texts: texts.map(entries.get)


def _marks(style: tokens.Style, n: int) -> list[str]:
    return [f"{style.before}{i}{style.after}" for i in range(n)]


class Cascade:
    """Texts through all variants and translators until one gives an answer that keeps every token."""

    def __init__(self, translators: list[Translator], style: tokens.Style, attempts: int):
        self.translators, self.style, self.attempts = translators, style, attempts

    def _ask(self, translator: Translator, texts: list[str]) -> list[str | None]:
        for _ in range(self.attempts):
            try:
                return [a if isinstance(a, str) and a.strip() else None for a in translator(pd.Series(texts, dtype=object))]
            except Exception:  # noqa: BLE001, S112  a service's failure leaves these texts to the next try
                continue
        return [None] * len(texts)

    def answers(self, forms: list[list[dict]]) -> tuple[list[str | None], list[bool]]:
        """For each text, given in its protected forms: the answer with its tokens back, and whether an answer lost one."""
        out: list[str | None] = [None] * len(forms)
        lost = [False] * len(forms)
        for i in range(max(map(len, forms), default=0)):
            for translator in self.translators:
                left = [k for k, f in enumerate(forms) if out[k] is None and i < len(f)]
                if not left:
                    continue
                for k, answer in zip(left, self._ask(translator, [forms[k][i]["p"] for k in left]), strict=True):
                    if answer is None:
                        continue
                    own = list(forms[k][i]["t"])
                    marks = _marks(self.style, len(own))
                    if all(m in answer for m in marks):
                        for mark, token in zip(marks, own, strict=True):
                            answer = answer.replace(mark, token)
                        out[k] = answer
                    else:
                        lost[k] = True
        return out, lost


def translated(
    texts: DataFrame, translators: Translator | list[Translator], attempts: int = 3, style: tokens.Style = tokens.MARKUP, with_variants: bool = False, by_sentence: bool = False
) -> DataFrame:
    """source, target, status (ok, token_lost, failed) of distinct texts.

    Tokens are protected, put back and checked, outer white space is kept. `with_variants`
    tries the text repaired and with plain punctuation too, `by_sentence` what is left sentence
    by sentence; the answers of all sentences are then joined by a space.
    """
    ship(texts.sparkSession)
    cascade = Cascade(translators if isinstance(translators, list) else [translators], style, attempts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, lost = cascade.answers(list(batch["_forms"]))
            again = [k for k, parts in enumerate(batch["_parts"]) if out[k] is None and len(parts) > 1]
            flat = [(k, list(forms)) for k in again for forms in batch["_parts"].iloc[k]]
            said, gone = cascade.answers([f for _, f in flat])
            joined: dict[int, list[str | None]] = {k: [] for k in again}
            for (k, _), answer, g in zip(flat, said, gone, strict=True):
                joined[k].append(answer)
                lost[k] = lost[k] or g
            for k, answers in joined.items():
                if all(a is not None for a in answers):
                    out[k] = " ".join(answers)
            status = ["ok" if a is not None else "token_lost" if g else "failed" for a, g in zip(out, lost, strict=True)]
            target = [None if a is None else b + a + c for a, b, c in zip(out, batch["_before"], batch["_after"], strict=True)]
            yield pd.DataFrame({"source": batch["source"].to_numpy(), "target": pd.Series(target, dtype=object), "status": status})

    before, core, after = T.outer_space(F.col("source"))
    form = lambda t: F.struct(tokens.protect(t, style).alias("p"), tokens.tokens_of(t, style).alias("t"))
    forms = lambda t: F.transform(T.variants(t) if with_variants else F.array(t), form)
    parts = F.transform(T.sentences(core), forms) if by_sentence else F.array().cast(f"array<{FORMS}>")
    distinct = texts.select("source").filter(~T.is_blank(F.col("source"))).distinct()
    prepared = distinct.select("source", forms(core).alias("_forms"), parts.alias("_parts"), before.alias("_before"), after.alias("_after"))
    return prepared.mapInPandas(run, STATE)


def fill_missing(memory: DataFrame, missing: DataFrame, translators: Translator | list[Translator], **options) -> DataFrame:
    """source, target, status of texts that the memory lacks or holds blank; existing translations stay."""
    todo = maintenance.pending(missing.select("source").distinct(), memory.filter(~T.is_blank(F.col("target"))))
    return translated(todo, translators, **options)


def _state(spark: SparkSession, path: str, schema: str = STATE) -> DataFrame:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _ranges(todo: DataFrame, batch_size: int, per_write: int, order: str) -> tuple[DataFrame, list[int], int]:
    """todo with batch and id, written by ranges of batches; the ranges in order; the number of batches."""
    numbered = maintenance.batches(todo, batch_size, order).withColumn("_range", F.floor((F.col("batch") - 1) / per_write))
    path = scratch(todo.sparkSession, "batches")
    numbered.repartition("_range", "batch").write.partitionBy("_range").parquet(path)
    written = todo.sparkSession.read.schema(numbered.schema).parquet(path)
    # one row for each range; a range holds batch_size * per_write keys
    found = sorted((r["_range"], r.n) for r in written.groupBy("_range").agg(F.max("batch").alias("n")).collect())
    return written, [n for n, _ in found], found[-1][1] if found else 0


def resumed(entries: DataFrame, state_path: str, translators: Translator | list[Translator], batch_size: int = 50, per_write: int = 200, **options) -> int:
    """Translate what the state doesn't hold yet; the number of batches sent.

    Each range of `per_write` batches is appended to the state before the next is begun. Texts that fail stay pending.
    """
    todo = maintenance.pending(entries.select("source").filter(~T.is_blank(F.col("source"))).distinct(), _state(entries.sparkSession, state_path).filter("status = 'ok'"))
    written, ranges, sent = _ranges(todo, batch_size, per_write, "source")
    for n in ranges:
        translated(written.filter(F.col("_range") == n), translators, **options).filter("status = 'ok'").write.mode("append").parquet(state_path)
    return sent


def comparable(key: str) -> str:
    """functions.text.comparable_key of one text."""
    for written, real in (("u00a0", " "), ("r", "\r"), ("n", "\n")):
        key = key.replace("\\\\" + written, real).replace("\\" + written, real)
        if written == "u00a0":
            key = key.replace(" ", " ")
    return key


def keyed(asked: list[str], answered: dict[str, str | None]) -> dict[str, str | None]:
    """The answers by the keys that were asked for, a few keys repaired; an error if they can't be matched."""
    missing, extra = [k for k in asked if k not in answered], [k for k in answered if k not in set(asked)]
    if not missing and not extra:
        return answered
    by: dict[str, list[list[str]]] = {}
    for side, keys in enumerate((missing, extra)):
        for k in keys:
            by.setdefault(comparable(k), [[], []])[side].append(k)
    if any(len(m) != 1 or len(x) != 1 for m, x in by.values()):
        raise ValueError("keys don't match")
    names = {x[0]: m[0] for m, x in by.values()}
    return {names.get(k, k): v for k, v in answered.items()}


def _reviewed(batched: DataFrame, reviewer: Reviewer, attempts: int) -> DataFrame:
    """batch, source, before, after, status of each row; a batch without a sound answer has status failed."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        out, status = [None] * len(group), "failed"
        for _ in range(attempts):
            try:
                answer = reviewer(group[["id", "source", "before"]])
                found = keyed(list(group["source"]), dict(zip(answer["source"], answer["after"], strict=True)))
            except Exception:  # noqa: BLE001, S112
                continue
            out, status = [found[s] for s in group["source"]], "ok"
            break
        return pd.DataFrame({"batch": group["batch"], "source": group["source"], "before": group["before"], "after": pd.Series(out, index=group.index, dtype=object), "status": status})

    return batched.groupBy("batch").applyInPandas(run, REVIEWED)


def reviewed(
    memory: DataFrame, state_path: str, reviewer: Reviewer, batch_size: int = 25, per_write: int = 200, attempts: int = 3,
    pairs: dict[str, str] | None = None, terms: list[str] | None = None, names: list[str] | None = None,
) -> DataFrame:
    """The state after all pending sources of a memory (source, target) went through a reviewer by key.

    State: batch, source, before, after, status, guard, result. An answer that a guard refuses
    keeps the old text, with the guard's name; sources of failed batches stay pending.
    """
    spark = memory.sparkSession
    ship(spark)
    schema = REVIEWED + ", guard string, result string"
    todo = maintenance.pending(memory.filter("source is not null").select("source", F.col("target").alias("before")), _state(spark, state_path, schema))
    written, ranges, _ = _ranges(todo, batch_size, per_write, "source")
    for n in ranges:
        answers = _reviewed(written.filter(F.col("_range") == n), reviewer, attempts).filter("status = 'ok'")
        guards.guarded(answers, pairs, terms, names).write.mode("append").parquet(state_path)
    return _state(spark, state_path, schema)


def _audited(batched: DataFrame, auditor: Reviewer, attempts: int) -> DataFrame:
    """The rows of each batch with the auditor's decision by id; ids must agree and decisions be known."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        columns, status = {c: [None] * len(group) for c in ("decision", "suggestion", "reason")}, "failed"
        for _ in range(attempts):
            try:
                answer = auditor(group[["id", "source", "before", "after"]]).set_index("id")
                if set(answer.index) != set(group["id"]) or not answer.index.is_unique or not answer["decision"].isin(DECISIONS).all():
                    raise ValueError("ids or decisions don't match")
                if not answer[["suggestion", "reason"]].map(lambda x: isinstance(x, str)).all(axis=None):
                    raise ValueError("suggestion or reason is no text")
            except Exception:  # noqa: BLE001, S112
                continue
            answer = answer.loc[group["id"]]
            columns, status = {c: list(answer[c]) for c in columns}, "ok"
            break
        rows = {c: group[c] for c in ("batch", "source", "before", "after")} | {c: pd.Series(v, index=group.index, dtype=object) for c, v in columns.items()}
        return pd.DataFrame(rows | {"status": status})

    return batched.groupBy("batch").applyInPandas(run, AUDITED)


def audited(changes: DataFrame, state_path: str, auditor: Reviewer, batch_size: int = 25, per_write: int = 200, attempts: int = 3) -> DataFrame:
    """The state after all pending changes (source, before, after) were approved or rejected by id.

    An approved change's suggestion is the change itself; a rejected one without suggestion goes
    back to the old text. Changes of failed batches stay pending.
    """
    spark = changes.sparkSession
    ship(spark)
    todo = maintenance.pending(changes.filter("source is not null").select("source", "before", "after"), _state(spark, state_path, AUDITED))
    written, ranges, _ = _ranges(todo, batch_size, per_write, "source")
    for n in ranges:
        answers = _audited(written.filter(F.col("_range") == n), auditor, attempts).filter("status = 'ok'")
        guards.decided(answers).write.mode("append").parquet(state_path)
    return _state(spark, state_path, AUDITED)


def stream(spark: SparkSession, incoming: str, state_path: str, checkpoint: str, translators: Translator | list[Translator], schema: str = "source string", retries: int = 5, **options):
    """A streaming query that enriches each micro-batch of new files; the caller starts and stops it."""
    ship(spark)

    def one(batch: DataFrame, number: int) -> None:
        # the batch's own part may be left from an attempt that failed; it is never read
        state = _state(spark, state_path, STATE + ", batch long").filter(F.col("batch") != number)
        done = state.filter("status = 'ok'").select("source").distinct()
        again = state.filter("status <> 'ok'").groupBy("source").agg(F.count("*").alias("_n")).filter(F.col("_n") <= retries).select("source")
        todo = maintenance.pending(batch.select("source").unionByName(again).distinct(), done)
        translated(todo, translators, **options).write.mode("overwrite").parquet(f"{state_path}/batch={number}")

    return spark.readStream.schema(schema).json(incoming).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one)
