"""Sinks: memories as JSON, tables as CSV, dumps as text, reports as Markdown or text.

Spark's commit protocol makes each write whole or absent; `replace_folder` writes beside the
target first and puts it in place by two renames, the old folder staying until the new one is in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import file_system

#: What a folder that is being replaced is called meanwhile.
ASIDE = "-replaced"


def json_lines(memory: DataFrame) -> DataFrame:
    """One line per entry of a JSON object, `"source": "target"`, indented by two, in order."""
    quoted = lambda c: F.concat(F.lit('"'), T.encode_json_string(F.col(c)), F.lit('"'))
    target = F.when(F.col("target").isNull(), F.lit("null")).otherwise(quoted("target"))
    return memory.select("memory_id", "ord", F.concat(F.lit("  "), quoted("source"), F.lit(": "), target).alias("line"))


def json_objects(memory: DataFrame) -> DataFrame:
    """memory_id, value: each memory as one pretty JSON text; a memory must fit a task."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "line")))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), ",\n")
    return json_lines(memory).groupBy("memory_id").agg(F.concat(F.lit("{\n"), body, F.lit("\n}\n")).alias("value"))


def csv_lines(records: DataFrame) -> DataFrame:
    """table_name, row_no, line: every non-empty cell quoted, empty ones bare."""
    return records.select("table_name", "row_no", F.array_join(F.transform("cells", T.csv_cell), ",").alias("line"))


def markdown_rows(df: DataFrame, *columns: str) -> DataFrame:
    """line: the columns as one row of a Markdown table."""
    cells = [F.coalesce(T.escape_markdown(F.col(c).cast("string")), F.lit("")) for c in columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def routed(outputs: DataFrame, name_col: str = "name") -> DataFrame:
    """The folder that a file's name sends it to."""
    return outputs.withColumn("route", F.when(F.col(name_col).contains("-resources.assets-"), "resources").otherwise("bundle"))


def quarantine(outputs: DataFrame, exports: DataFrame, prefix: str = "translated-") -> DataFrame:
    """name, reason of outputs without an export, and of base files, which must not be put out."""
    name = F.regexp_replace("name", f"^{T.quote(prefix)}", "")
    base = outputs.filter(F.lower(name).startswith("base-")).select("name", F.lit("forbidden").alias("reason"))
    stale = outputs.filter(~F.lower(name).startswith("base-")).withColumn("_k", name).join(exports.select(F.col("name").alias("_k")), "_k", "left_anti")
    return base.unionByName(stale.select("name", F.lit("stale").alias("reason")))


def table_file(table_name: str, path_id: int) -> str:
    return f"{table_name}-resources.assets-{path_id}.txt"


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Write df in full beside the folder, then put it in the folder's place.

    The old folder is moved aside, not deleted, before the new one is moved in, and goes last.
    A run that was cut off in between is made good by `recovered`, which comes first here too.
    """
    spark = df.sparkSession
    recovered(spark, path)
    fresh = f"{path}-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(fresh)
    fs, old = file_system(spark, path)
    new, aside = file_system(spark, fresh)[1], file_system(spark, path + ASIDE)[1]
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"can't rename {path}")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"can't rename {fresh} to {path}")
    fs.delete(aside, True)


def recovered(spark: SparkSession, path: str) -> str:
    """The folder's path, the folder put back if a replacement was cut off after moving it aside."""
    fs, here = file_system(spark, path)
    _, aside = file_system(spark, path + ASIDE)
    if fs.exists(aside):
        if fs.exists(here):
            fs.delete(aside, True)
        elif not fs.rename(aside, here):
            raise OSError(f"can't put {path} back")
    return path


def append_trail(df: DataFrame, path: str) -> None:
    """Add rows to an audit trail."""
    df.write.mode("append").parquet(path)
