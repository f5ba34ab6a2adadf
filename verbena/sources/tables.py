"""Delimited tables, reports, catalogs and listings as sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.parse_failures import fields_of

REQUIRED = ("key", "en", "br")
FLOWS = "struct<Flows:array<struct<Flow:string,Missing:array<struct<Asset:string,Source:string,Count:long>>>>>"
TABLES = "struct<Tables:array<struct<Table:string,PathId:long,Missing:array<struct<Table:string,Key:string,Source:string,Row:long>>>>>"


def csv_records(texts: DataFrame, name_col: str = "table_name", text_col: str = "text") -> DataFrame:
    """table_name, row_no (0 is the header), cells: ragged rows of whole CSV texts.

    Line breaks outside quotes end a record: pieces between quotes are told apart by their
    index, so each break outside is marked and the text is cut at the marks.
    """
    pieces = F.split(F.regexp_replace(F.col(text_col), "^﻿", ""), '"', -1)
    outside = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.regexp_replace(F.replace(p, F.lit("\u0003"), F.lit("")), "\r\n|\r|\n", "\u0003")).otherwise(p))
    rows = texts.select(F.col(name_col).alias("table_name"), F.posexplode(F.split(F.array_join(outside, '"'), "\u0003", -1)).alias("row_no", "_row"))
    kept = rows.filter(F.col("_row") != "").select("table_name", F.col("row_no").alias("_at"), fields_of(F.col("_row")).alias("cells"))
    return kept.withColumn("row_no", F.row_number().over(Window.partitionBy("table_name").orderBy("_at")) - 1).select("table_name", "row_no", "cells")


def csv_rows(records: DataFrame) -> DataFrame:
    """table_name, row_no, key, en, br, cells of rows long enough for them; the header names the columns."""
    head = records.filter("row_no = 0").select("table_name", *[(F.array_position("cells", c) - 1).alias(f"_{c}") for c in REQUIRED])
    rows = records.filter("row_no > 0").join(head, "table_name")
    long_enough = F.size("cells") > F.greatest(*[F.col(f"_{c}") for c in REQUIRED])
    return rows.filter(long_enough).select("table_name", "row_no", *[F.get("cells", F.col(f"_{c}").cast("int")).alias(c) for c in REQUIRED], "cells")


def header_faults(records: DataFrame) -> DataFrame:
    """Tables whose header lacks a required column: table_name, missing."""
    need = F.array(*map(F.lit, REQUIRED))
    return records.filter("row_no = 0").select("table_name", F.array_except(need, "cells").alias("missing")).filter("size(missing) > 0")


def flow_report(reports: DataFrame, text_col: str = "value") -> DataFrame:
    """flow, asset, source, occ_count of scan reports by flow."""
    r = reports.select(F.explode(F.from_json(text_col, FLOWS).getField("Flows")).alias("f"))
    return r.select(F.col("f.Flow").alias("flow"), F.explode("f.Missing").alias("m")).select("flow", F.col("m.Asset").alias("asset"), F.col("m.Source").alias("source"), F.col("m.Count").alias("occ_count"))


def table_report(reports: DataFrame, text_col: str = "value") -> DataFrame:
    """table_name, path_id, key, source, row_no of scan reports by table."""
    r = reports.select(F.explode(F.from_json(text_col, TABLES).getField("Tables")).alias("t"))
    m = r.select(F.col("t.Table").alias("table_name"), F.col("t.PathId").alias("path_id"), F.explode("t.Missing").alias("m"))
    return m.select("table_name", "path_id", F.col("m.Key").alias("key"), F.col("m.Source").alias("source"), F.col("m.Row").alias("row_no"))


def catalog_names(catalogs: DataFrame, text_col: str = "value") -> DataFrame:
    """Base names of a catalog's internal ids."""
    ids = F.explode(F.from_json(text_col, "struct<m_InternalIds:array<string>>").getField("m_InternalIds"))
    return catalogs.select(ids.alias("id")).select(F.regexp_extract("id", r"([^/\\]+)$", 1).alias("name")).distinct()


def listing(spark: SparkSession, folder: str, glob: str = "*", excluded_prefix: str = "base-") -> DataFrame:
    """name, bytes, sha256 of a folder's files, without those of the prefix in any case."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    rows = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return rows.filter(~F.lower("name").startswith(excluded_prefix))


def holds_bytes(content: Column, text: Column) -> Column:
    """Whether a file's bytes hold a text's UTF-8 bytes."""
    return F.contains(content, F.encode(text, "UTF-8"))


def byte_order_mark(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 3)) == "EFBBBF"


def strict_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))
