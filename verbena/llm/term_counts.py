"""Frequency of every term, kept up to date by signed deltas.

A store of counts lives in a folder as runs: tables of term, occurrences and records, hash-
partitioned by term. A change set names the records added (sign 1) and withdrawn (sign -1; a
changed record is both). Only these records are read; they are summed to one change per term
and become a new run. Runs of like size are merged, so there are only as many runs as the
logarithm of the store's size, and a delta costs in proportion to itself, not to the store.

What the store holds is said by numbered manifests, of which the newest counts. A manifest is
written aside and renamed into place last, so a failed merge leaves the former state; another
writer's manifest of the same number is an error. Manifests name the deltas that are in the
store, so a delta that is applied again under its name changes nothing.

A term is a longest run of letters, in lower case. Null texts hold no term but are records.
Weights that are null or below 1 count as 1. Repeated rows count as often as they stand.
Texts of any length are exploded term by term; within a record the terms are sorted, so its
first occurrence of each is known without a shuffle by record.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

TERM = r"\p{L}+"
COUNTS = "term string, occurrences long, records long"
#: The store's row for the number of all records; no term is empty.
TOTAL = ""


def terms_of(text: Column) -> Column:
    """Each term of a text with a flag for its first occurrence in it."""
    terms = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1)), lambda t: F.lower(t)))
    flags = F.zip_with(terms, F.concat(F.array(F.lit("")), F.slice(terms, 1, F.greatest(F.size(terms) - 1, F.lit(0)))), lambda t, before: F.struct(t.alias("term"), (t != before).cast("long").alias("first")))
    return F.filter(flags, lambda x: x["term"].isNotNull())


def delta(changes: DataFrame, text_col: str, weight_col: str | None = None, sign_col: str | None = None) -> DataFrame:
    """The change of each term's counts, and of the number of records, that the changed records make."""
    sign = F.col(sign_col).cast("long") if sign_col else F.lit(1).cast("long")
    weight = F.greatest(F.coalesce(F.col(weight_col).cast("long"), F.lit(1)), F.lit(1)) if weight_col else F.lit(1)
    rows = changes.select(F.col(text_col).alias("_text"), weight.cast("long").alias("_weight"), sign.alias("_sign"))
    # each record also holds the empty term once: the number of records comes from the same pass
    record = F.array(F.struct(F.lit(TOTAL).alias("term"), F.lit(1).cast("long").alias("first")))
    terms = F.concat(record, F.coalesce(terms_of(F.col("_text")), F.array().cast("array<struct<term:string,first:bigint>>")))
    exploded = rows.select("_weight", "_sign", F.explode(terms).alias("t"))
    occurrences = F.when(F.col("t.term") != TOTAL, F.col("_sign") * F.col("_weight")).otherwise(0)
    return exploded.groupBy(F.col("t.term").alias("term")).agg(F.sum(occurrences).alias("occurrences"), F.sum(F.col("_sign") * F.col("t.first")).alias("records"))


def summed(counts: DataFrame) -> DataFrame:
    """One row for each term; terms whose counts come to nothing go."""
    total = counts.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    return total.filter((F.col("occurrences") != 0) | (F.col("records") != 0))


class TermStore:
    """Persistent partitioned counts in a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifests(self) -> list[int]:
        fs, p = file_system(self.spark, self.root)
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"manifest-(\d+)\.json", n)))

    def manifest(self) -> dict:
        """number; runs as pairs of folder and rows, the oldest first; names of the deltas applied."""
        numbers = self._manifests()
        if not numbers:
            return {"number": 0, "runs": [], "deltas": []}
        path = f"{self.root}/manifest-{numbers[-1]:010d}.json"
        return json.loads("".join(r.value for r in self.spark.read.text(path).collect()))

    def _commit(self, manifest: dict) -> None:
        name = f"{self.root}/manifest-{manifest['number']:010d}.json"
        fs, aside = file_system(self.spark, f"{self.root}/new-{uuid.uuid4().hex}")
        out = fs.create(aside)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        _, place = file_system(self.spark, name)
        if fs.exists(place) or not fs.rename(aside, place):
            fs.delete(aside, False)
            raise OSError(f"{name} was written by another")

    def _runs(self, runs: list) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(*[f"{self.root}/{name}" for name, _ in runs])

    def read(self) -> DataFrame:
        """The counts of all terms."""
        runs = self.manifest()["runs"]
        return self._runs(runs) if len(runs) == 1 else summed(self._runs(runs))

    def _written(self, counts: DataFrame) -> list:
        name = f"run-{uuid.uuid4().hex}"
        counts.write.parquet(f"{self.root}/{name}")
        return [name, self.spark.read.schema(COUNTS).parquet(f"{self.root}/{name}").count()]  # rows, from the files' footers

    def apply(self, change: DataFrame, name: str | None = None) -> bool:
        """Merge a delta; false, and nothing done, if a delta of this name is in the store already."""
        old = self.manifest()
        if name is not None and name in old["deltas"]:
            return False
        runs = [*old["runs"], self._written(summed(change))]
        while len(runs) > 1 and 2 * runs[-1][1] >= runs[-2][1]:
            runs[-2:] = [self._written(summed(self._runs(runs[-2:])))]
        self._commit({"number": old["number"] + 1, "runs": runs, "deltas": old["deltas"] + ([name] if name is not None else [])})
        return True

    def vacuum(self) -> None:
        """Delete runs and manifests that the newest manifest doesn't name; for when nobody reads the store."""
        kept = self.manifest()
        names = {n for n, _ in kept["runs"]} | {f"manifest-{kept['number']:010d}.json"}
        fs, p = file_system(self.spark, self.root)
        for status in list(fs.listStatus(p)) if fs.exists(p) else []:
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)


def marked(counts: DataFrame, rare_below: int = 5, common_above: float = 0.1) -> DataFrame:
    """term, occurrences, records, mark: `common`, `rare` or `useful`."""
    total = counts.filter(F.col("term") == TOTAL).agg(F.sum("records")).first()[0] or 0
    mark = F.when(F.col("records") > F.lit(total * common_above), "common").when(F.col("occurrences") < rare_below, "rare").otherwise("useful")
    return counts.filter(F.col("term") != TOTAL).select("term", "occurrences", "records", mark.alias("mark"))
