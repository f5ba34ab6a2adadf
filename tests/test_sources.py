import json

import pytest
from pyspark.sql import functions as F

from verbena.functions import text as T
from verbena.sources import dumps, memories, sinks, tables

GENERAL = '0 SInt64 m_Id = 1\n1 string m_Localized = "a \\"q\\" b"\r\n0 SInt64 m_Id = 2\n0 SInt64 m_Id = 3\n1 string m_Localized = ""\n1 string m_Localized = "orphan"\n0 SInt64 m_Id = 1\n1 string m_Localized = "last"\n'
BLOCKS = ' 0 Field data\n 1 string title = "en"\n 1 string value = "Hi"\n 1 string typeString = "CustomFieldType_Localization"\n 0 Field data\n 0 Field data\n 1 string title = "pt"\n 1 string value = "Oi"\n 1 string typeString = "X"\n'
GRAPH = """ 0 Actor data
 0 int id = 1
 0 int id = 99
 1 string title = "Name en"
 1 string value = "Ana"
 0 Actor data
 0 int id = 2
 1 string title = "Name"
 1 string value = "Bo"
 0 Conversation conversations
 0 Conversation data
 0 int id = 10
 1 string title = "Title"
 1 string value = "First"
 1 string title = "Actor"
 1 string value = "1"
 1 string title = "Conversant"
 1 string value = "2"
 0 DialogueEntry data
 0 int id = 100
 1 string title = "en"
 1 string value = "Hello"
 0 DialogueEntry data
 0 int id = 101
 1 string title = "Actor"
 1 string value = "2"
 1 string title = "en"
 1 string value = "Old"
 1 string title = "en"
 1 string value = "Bye"
"""
TABLE = """ 1 string m_languageKeys
 1 string data = "default"
 1 string data = "en"
 0 vector m_languageValues
 0 int data = 0
 0 int data = 7
 0 vector m_fieldKeys
 0 TextTableField data
 1 string m_fieldName = "f1"
 0 vector m_keys
 0 int data = 7
 0 int data = 0
 0 int data = 7
 1 string m_values
 1 string data = "Hi"
 1 string data = "Std"
 0 TextTableField data
 1 string m_fieldName = "f2"
 0 vector m_keys
 0 int data = 0
 1 string m_values
 1 string data = "x"
"""


@pytest.fixture
def lines(spark):
    def make(text, file="f"):
        return dumps.lines_of(spark.createDataFrame([(file, text)], "file string, text string"))

    return make


def test_memories(spark, tmp_path):
    (tmp_path / "m.json").write_text('﻿{"b": "1", "a": "x", "b": "2", "é": ""}', encoding="utf-8")
    (tmp_path / "list.json").write_text("[1]")
    (tmp_path / "typed.json").write_text('{"a": 1}')
    rows = memories.read_strict(spark, str(tmp_path / "m.json")).orderBy("ord").collect()
    assert [(r.source, r.target) for r in rows] == [("b", "2"), ("a", "x"), ("é", "")]
    assert memories.read_lenient(spark, str(tmp_path / "none.json")).count() == 0
    assert memories.read_lenient(spark, str(tmp_path / "list.json")).count() == 0
    with pytest.raises(ValueError, match="not_an_object"):
        memories.read_strict(spark, str(tmp_path / "list.json"))
    with pytest.raises(ValueError, match="no_string"):
        memories.read_strict(spark, str(tmp_path / "typed.json"), typed=True)
    pretty = sinks.json_objects(memories.read_strict(spark, str(tmp_path / "m.json"))).first().value
    assert json.loads(pretty) == {"b": "2", "a": "x", "é": ""} and pretty.startswith('{\n  "b": "2",\n')


def test_small_readers(values, spark):
    assert values(memories.replacement_value, ["plain", '{"antes": "a", "depois": "b"}', '{"sugestao": "c"}', '{"x": 1}']) == ["plain", "b", "c", None]
    assert values(memories.salvaged_object, ['{"a": 1}', 'so: {"a": 1} ok', "none", "{bad}"]) == ['{"a": 1}', '{"a": 1}', None, None]
    v = spark.createDataFrame([("m", "a", "1", 1), ("m", "a", "2", 3)], "memory_id string, source string, target string, version int")
    assert [r.target for r in memories.as_of(v, F.lit(2)).collect()] == ["1"]


def test_general_dump(lines):
    got = {r.id: r.text for r in dumps.localized_entries(lines(GENERAL)).collect()}
    assert got == {"1": "last", "3": ""}


def test_blocks(lines):
    got = sorted((r.block_id, r.title, r.value) for r in dumps.field_blocks(lines(BLOCKS)).collect())
    assert got == [(1, "en", "Hi"), (2, None, None), (3, "pt", "Oi")]
    assert dumps.field_blocks(lines(BLOCKS), flush_open=False).count() == 2
    assert [r.value for r in dumps.english_blocks(dumps.field_blocks(lines(BLOCKS))).collect()] == ["Hi"]
    assert [(r.line_no, r.value, r.status) for r in dumps.adjacent_values(lines(BLOCKS)).collect()] == [(3, "Hi", "ok")]
    assert [r.status for r in dumps.adjacent_values(lines(' 1 string title = "en"\n x\n')).collect()] == ["no_value"]


def test_graph(lines):
    got = {r.entry_id: r for r in dumps.dialogue_contexts(dumps.dialogue_graph(lines(GRAPH))).collect()}
    assert (got["100"].source, got["100"].actor_name, got["100"].conversant_name, got["100"].conversation_title) == ("Hello", "Ana", "Bo", "First")
    assert (got["101"].source, got["101"].actor_name, got["101"].conversation_id) == ("Bye", "Bo", "10")
    assert [r.name for r in dumps.actor_names(lines(GRAPH)).collect()] == ["Ana"]


def test_text_tables(lines):
    languages, fields = dumps.text_tables(lines(TABLE))
    assert {(r.language, r.id) for r in languages.collect()} == {("default", 0), ("en", 7)}
    assert [(r.field_name, r.position, r.text) for r in dumps.language_texts(languages, fields).collect()] == [("f1", 0, "Hi")]
    assert dumps.language_texts(languages, fields, every=True).count() == 1


def test_rewrite_keeps_everything_else(lines):
    pattern = r'^(\s*1 string m_Localized = ")(.*)("\s*)$'
    whole = lambda df: dumps.whole_files(df).first().text
    assert whole(dumps.rewritten(lines(GENERAL), pattern, F.lit(None).cast("string"))) == GENERAL
    new = F.when(dumps.captured(F.col("line"), pattern, 2) == "last", "novo")
    assert whole(dumps.rewritten(lines(GENERAL), pattern, new)) == GENERAL.replace('"last"', '"novo"')
    assert dumps.newline_style(lines(GENERAL)).first().newline == "crlf"


def test_dump_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿é\r\nb".encode())
    (tmp_path / "b.txt").write_bytes("é\n".encode("latin-1"))
    got = {(r.file, r.line_no): (r.line, r.line_end) for r in dumps.read_dumps(spark, str(tmp_path)).collect()}
    assert got == {("a.txt", 1): ("é", "\r\n"), ("a.txt", 2): ("b", ""), ("b.txt", 1): ("é", "\n")}
    # a file of several splits, with every kind of line end, gives the lines of the whole text
    text = "".join(f"linha é {i}" + ("\r\n", "\n", "\r", "\n\n")[i % 4] for i in range(900)) + "end"
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.txt").write_bytes(text.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = dumps.read_dumps(spark, str(tmp_path / "c"))
        assert spark.read.option("lineSep", "\n").text(str(tmp_path / "c")).rdd.getNumPartitions() > 1
        got = [(r.line_no, r.line, r.line_end) for r in lines.orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = dumps.lines_of(spark.createDataFrame([("c", text)], "file string, text string"))
    assert got == [(r.line_no, r.line, r.line_end) for r in whole.orderBy("line_no").collect()]
    rows = {r.name: r for r in tables.listing(spark, str(tmp_path)).collect()}
    assert rows["b.txt"].bytes == 2 and len(rows["a.txt"].sha256) == 64


def test_csv(spark):
    text = 'key,x,en,br\r\nk1,1,"a, ""b""\nc",t\nshort\r\n\r\nk2,,d,\n'
    records = tables.csv_records(spark.createDataFrame([("T", text)], "table_name string, text string"))
    cells = [r.cells for r in records.orderBy("row_no").collect()]
    assert cells == [["key", "x", "en", "br"], ["k1", "1", 'a, "b"\nc', "t"], ["short"], ["k2", "", "d", ""]]
    assert [(r.key, r.en, r.br) for r in tables.csv_rows(records).orderBy("row_no").collect()] == [("k1", 'a, "b"\nc', "t"), ("k2", "d", "")]
    assert tables.header_faults(records).count() == 0
    line = sinks.csv_lines(records).filter("row_no = 3").first().line
    assert line == '"k2",,"d",'
    again = tables.csv_records(spark.createDataFrame([("T", "\r\n".join(r.line for r in sinks.csv_lines(records).orderBy("row_no").collect()))], "table_name string, text string"))
    assert [r.cells for r in again.orderBy("row_no").collect()] == cells


def test_reports_and_catalogs(spark):
    flows = spark.createDataFrame([('{"Flows":[{"Flow":"a","Missing":[{"Asset":"x","Source":"s","Count":2}]},{"Flow":"b","Missing":[]}]}',)], "value string")
    assert [tuple(r) for r in tables.flow_report(flows).collect()] == [("a", "x", "s", 2)]
    t = spark.createDataFrame([('{"Tables":[{"Table":"T","PathId":4,"Missing":[{"Table":"T","Key":"k","Source":"s","Row":3}]}]}',)], "value string")
    assert [tuple(r) for r in tables.table_report(t).collect()] == [("T", 4, "k", "s", 3)]
    c = spark.createDataFrame([('{"m_InternalIds":["a/b.bundle","c\\\\d.bundle"]}',)], "value string")
    assert {r.name for r in tables.catalog_names(c).collect()} == {"b.bundle", "d.bundle"}
    b = spark.createDataFrame([(bytearray(b"\xef\xbb\xbfx\xc3\xa9"), "é"), (bytearray(b"\xe9"), "é")], "content binary, s string")
    got = b.select(tables.holds_bytes(F.col("content"), F.col("s")).alias("h"), tables.byte_order_mark(F.col("content")).alias("b"), tables.strict_utf8(F.col("content")).alias("u")).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, False)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", None)], "x string, y string")
    assert sinks.markdown_rows(df, "x", "y").first().line == "| a\\|b |  |"
    out = spark.createDataFrame([("translated-a",), ("translated-gone",), ("translated-BASE-x",)], "name string")
    assert {tuple(r) for r in sinks.quarantine(out, spark.createDataFrame([("a",)], "name string")).collect()} == {("translated-gone", "stale"), ("translated-BASE-x", "forbidden")}
    assert sinks.routed(spark.createDataFrame([("a-resources.assets-1.txt",), ("b",)], "name string")).select("route").distinct().count() == 2
    assert sinks.table_file("T", 3) == "T-resources.assets-3.txt"
    path = str(tmp_path / "out")
    for n in (3, 5):
        sinks.replace_folder(spark.range(n).toDF("x"), path)
        assert spark.read.parquet(path).count() == n
    # cut off between the two renames: the old folder stands aside
    (tmp_path / "out").rename(tmp_path / ("out" + sinks.ASIDE))
    assert spark.read.parquet(sinks.recovered(spark, path)).count() == 5
    # cut off before the old folder was deleted
    spark.range(9).write.parquet(path + sinks.ASIDE)
    sinks.replace_folder(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4 and not (tmp_path / ("out" + sinks.ASIDE)).exists()
    for _ in range(2):
        sinks.append_trail(spark.range(2).toDF("x"), str(tmp_path / "trail"))
    assert spark.read.parquet(str(tmp_path / "trail")).count() == 4
    assert T.quote("a.b") == "a\\.b"
