"""Keeping memories: differences, merges, patches, reverts, repairs and batches.

A memory has source, target and ord; results carry ord on, so the order of entries survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored
from .ordered import numbered


def difference(old: DataFrame, new: DataFrame, removed: bool = True) -> DataFrame:
    """source, before, after, status: unchanged, modified, new and, if asked for, removed."""
    a = old.select("source", F.col("target").alias("before"), F.lit(True).alias("_a"))
    b = new.select("source", F.col("target").alias("after"), F.lit(True).alias("_b"))
    status = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "unchanged").otherwise("modified")
    return a.join(b, "source", "full" if removed else "right").select("source", "before", "after", status.alias("status"))


def review_status(base: DataFrame, current: DataFrame) -> DataFrame:
    """source, target, status of the current entries: unreviewed (as before), reviewed (changed) or new."""
    d = difference(base, current, removed=False)
    return d.select("source", F.col("after").alias("target"), F.when(F.col("status") == "unchanged", "unreviewed").when(F.col("status") == "modified", "reviewed").otherwise("new").alias("status"))


def merged(current: DataFrame, extracted: DataFrame) -> DataFrame:
    """source, target, outcome: current entries with what was extracted, where that may replace them."""
    e = extracted.select("source", F.col("target").alias("_new"), F.lit(True).alias("_found"))
    joined = current.join(e, "source", "left")
    fault = T.replacement_fault(F.col("source"), F.col("_new"))
    outcome = (
        F.when(F.col("_found").isNull(), "not_found")
        .when(fault.isNotNull(), F.concat(F.lit("ignored_"), fault))
        .when(F.col("_new") == F.col("target"), "equal")
        .otherwise("replaced")
    )
    return joined.withColumn("outcome", outcome).withColumn("target", F.when(F.col("outcome") == "replaced", F.col("_new")).otherwise(F.col("target"))).drop("_new", "_found")


def patch_outcomes(memory: DataFrame, patch: DataFrame) -> DataFrame:
    """source, target, outcome of each patch row: applied, equal or key_not_found."""
    m = memory.select("source", F.col("target").alias("_old"), F.lit(True).alias("_known"))
    outcome = F.when(F.col("_known").isNull(), "key_not_found").when(F.col("_old").eqNullSafe(F.col("target")), "equal").otherwise("applied")
    return patch.join(m, "source", "left").select("source", "target", outcome.alias("outcome"))


def patched(memory: DataFrame, patch: DataFrame) -> DataFrame:
    """The memory with the patch's targets; keys that it doesn't have are left out."""
    p = patch.select("source", F.col("target").alias("_new"), F.lit(True).alias("_hit"))
    return memory.join(p, "source", "left").withColumn("target", F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("target"))).drop("_new", "_hit")


def reverted(memory: DataFrame, log: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The memory with the log's old targets for the keys, and the log without these rows."""
    back = log.join(keys.select("source").distinct(), "source", "left_semi").select("source", F.col("before").alias("target"))
    return patched(memory, back), log.join(keys.select("source"), "source", "left_anti")


def pending(entries: DataFrame, done: DataFrame, key: str = "source") -> DataFrame:
    return entries.join(done.select(key), key, "left_anti")


def upserted(memory: DataFrame, harvest: DataFrame) -> DataFrame:
    """source, target, ord: harvested targets win, new keys come after the old ones."""
    both = memory.select("source", "target", "ord", F.lit(0).alias("_r")).unionByName(harvest.select("source", "target", "ord", F.lit(1).alias("_r")))
    first = F.struct(F.col("_r"), F.col("ord"))
    best = both.groupBy("source").agg(F.max_by("target", first).alias("target"), F.min(first).alias("_first"))
    return best.select("source", "target", F.col("_first._r").alias("late"), F.col("_first.ord").alias("ord"))


def duplicate_keys(entries: DataFrame, key: str = "source", file: str = "file") -> DataFrame:
    """key, first_file, later_files: keys that stand in several files."""
    files = entries.groupBy(key).agg(F.array_sort(F.collect_set(file)).alias("_f")).filter("size(_f) > 1")
    return files.select(key, F.get("_f", F.lit(0)).alias("first_file"), F.array_join(F.slice("_f", 2, F.size("_f")), ",").alias("later_files"))


def repaired_keys(expected: DataFrame, answered: DataFrame, key: str = "source") -> DataFrame:
    """expected, answered: keys of neither other side whose comparable forms agree, alone on both sides."""
    left = expected.select(F.col(key).alias("expected")).distinct()
    right = answered.select(F.col(key).alias("answered")).distinct()
    missing = left.join(right, F.col("expected") == F.col("answered"), "left_anti").withColumn("_n", T.comparable_key(F.col("expected")))
    extra = right.join(left, F.col("expected") == F.col("answered"), "left_anti").withColumn("_n", T.comparable_key(F.col("answered")))
    single = lambda df, c: df.groupBy("_n").agg(F.min(c).alias(c), F.count("*").alias("_k")).filter("_k = 1").drop("_k")
    return single(missing, "expected").join(single(extra, "answered"), "_n").select("expected", "answered")


def id_check(expected: DataFrame, answered: DataFrame, key: str = "id") -> DataFrame:
    """id, status: ok, missing or extra."""
    a, b = expected.select(key).distinct().withColumn("_a", F.lit(True)), answered.select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full").select(key, F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("ok").alias("status"))


def name_sets(old: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """key, side: `both`, `removed` (old alone) or `added` (new alone) of each distinct name; nulls are no names."""
    a, b = (df.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True)) for df, flag in ((old, "_a"), (new, "_b")))
    return a.join(b, key, "full").select(key, F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").otherwise("both").alias("side"))


def set_gate(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """missing, extra, ok: whether two sets of rows are equal."""
    missing, extra = expected.exceptAll(actual), actual.exceptAll(expected)
    sides = missing.select(F.lit(1).alias("m"), F.lit(0).alias("e")).unionByName(extra.select(F.lit(0).alias("m"), F.lit(1).alias("e")))
    return sides.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("missing"), F.coalesce(F.sum("e"), F.lit(0)).alias("extra")).withColumn("ok", (F.col("missing") == 0) & (F.col("extra") == 0))


def ordinals(df: DataFrame, *order: str | Column, name: str = "n") -> DataFrame:
    """df with its rows' place (from 0) in a total order, without a single task for all rows.

    Rows are range-partitioned and sorted; the number of rows before each partition comes from
    one count per partition, the only thing that reaches the driver.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = stored(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_id", F.monotonically_increasing_id()), "ordinals")
    part = F.shiftright(F.col("_id"), 33)
    sizes = sorted((r.p, r.k) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("k")).collect())
    before, at = [], 0
    for p, k in sizes:
        before.append((p, at))
        at += k
    offsets = df.sparkSession.createDataFrame(before or [(0, 0)], "_p long, _before long")
    return placed.join(F.broadcast(offsets), part == F.col("_p")).withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_p", "_before")


def batches(df: DataFrame, size: int, *order: str | Column) -> DataFrame:
    """df with `batch` (from 1) and `id` within the batch (from 0)."""
    placed = ordinals(df, *order, name="_n")
    return placed.withColumn("batch", F.floor(F.col("_n") / size) + 1).withColumn("id", F.col("_n") % size).drop("_n")


def batch_report(batched: DataFrame, key: str = "source") -> DataFrame:
    return batched.groupBy("batch").agg(F.count("*").alias("entries"), F.min_by(key, "id").alias("first_key"), F.max_by(key, "id").alias("last_key"))


def positional(left: DataFrame, right: DataFrame, by: tuple[str, ...], order: str) -> DataFrame:
    """left rows with the right row at the same place of the same group, if there is one; right columns get `_right`.

    `order` is a whole number; places are counted over chunks of it, so a hot group isn't one task's.
    """
    a, b = numbered(left, by, order, "_i"), numbered(right, by, order, "_i")
    b = b.select(*by, "_i", *[F.col(c).alias(f"{c}_right") for c in right.columns if c not in by])
    return a.join(b, [*by, "_i"], "left").withColumnRenamed("_i", "place")


def cleaned(memory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The memory with every target fit for a dump, and how many targets that changed."""
    new = memory.withColumn("_new", T.clean_for_dump(F.col("target")))
    changed = new.agg(F.count_if(~F.col("_new").eqNullSafe(F.col("target"))).alias("changed"))
    return new.withColumn("target", F.col("_new")).drop("_new"), changed
