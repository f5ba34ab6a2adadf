"""Parsers of line dumps: state machines over lines, as states carried along a file's lines.

The input has a row per line: file, line_no, line. States are carried over chunks of lines
(operators.ordered), so a file of any size is parsed by many tasks; a state that is carried
forward is the last non-null value so far. A null line holds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import scanned

ID_LINE = r"^\s*0 SInt64 m_Id = (-?\d+)\s*$"
TEXT_LINE = r'^\s*1 string m_Localized = "(.*)"\s*$'
FIELD_START = r"^\s*0 Field data\s*$"
TITLE_LINE = r'^\s*1 string title = "(.*)"\s*$'
VALUE_LINE = r'^\s*1 string value = "(.*)"\s*$'
TYPE_LINE = r'^\s*1 string typeString = "(.*)"\s*$'
LOCALIZATION = "CustomFieldType_Localization"


def lines_of(texts: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """file, line_no (from 1), line, line_end of whole texts."""
    parts = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\r\n]*(?:\r\n|\n|\r)|[^\r\n]+\z)"), F.lit(1))
    rows = texts.select(F.col(file_col).alias("file"), F.posexplode(parts).alias("i", "_raw"))
    return rows.select("file", (F.col("i") + 1).cast("long").alias("line_no"), F.regexp_replace("_raw", r"[\r\n]+\z", "").alias("line"), F.regexp_extract("_raw", r"([\r\n]*)\z", 1).alias("line_end"))


def read_dumps(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of dump files: UTF-8, a byte order mark dropped, files that aren't UTF-8 read as Latin-1.

    Files are read in splits; a line's number is its place in its split and the number of lines
    of the splits before. Lines end at \\n, \\r\\n or \\r.
    """
    raw = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_split"), F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_seq"), F.col("value").cast("binary").alias("_bytes"),
    )
    # the last line has no end of its own if the lines with one would be a byte too long; the reader skips a byte order mark of three
    files = raw.groupBy("_path").agg(F.bool_and(F.is_valid_utf8(F.col("_bytes").cast("string"))).alias("_utf8"), (F.sum(F.octet_length("_bytes") + 1) - F.max("_size")).isin(1, -2).alias("_open"), F.max(F.struct("_split", "_seq")).alias("_last"))
    joined = raw.join(files, "_path")
    text = F.when(F.col("_utf8"), F.col("_bytes").cast("string")).otherwise(F.decode("_bytes", "ISO-8859-1"))
    end = F.when(F.col("_open") & (F.struct("_split", "_seq") == F.col("_last")), "").otherwise("\n")
    parts = F.regexp_extract_all(F.concat(text, end), F.lit(r"([^\r\n]*(?:\r\n|\n|\r)|[^\r\n]+\z)"), F.lit(1))
    rows = joined.select("file", "_path", "_split", "_seq", F.posexplode(parts).alias("_i", "_raw"))
    inside = F.row_number().over(Window.partitionBy("_path", "_split").orderBy("_seq", "_i"))
    splits = rows.groupBy("_path", "_split").agg(F.count("*").alias("_n"))
    before = splits.select("_path", "_split", F.coalesce(F.sum("_n").over(Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_inside", inside).join(before, ["_path", "_split"]).withColumn("line_no", (F.col("_inside") + F.col("_before")).cast("long"))
    line = F.regexp_replace("_raw", r"[\r\n]+\z", "")
    line = F.when(F.col("line_no") == 1, F.regexp_replace(line, "^\ufeff", "")).otherwise(line)
    return numbered.select("file", "line_no", line.alias("line"), F.regexp_extract("_raw", r"([\r\n]*)\z", 1).alias("line_end"))


def captured(line: Column, pattern: str, group: int = 1) -> Column:
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, group))


def localized_entries(lines: DataFrame) -> DataFrame:
    """file, id, text, line_no: each id with the next text; an id without one is dropped, the last of equal ids wins."""
    tagged = lines.withColumn("_id", captured(F.col("line"), ID_LINE)).withColumn("_text", captured(F.col("line"), TEXT_LINE))
    marked = tagged.filter(F.col("_id").isNotNull() | F.col("_text").isNotNull())
    paired = scanned(marked, lag={"_before": F.col("_id")}).filter("_text is not null and _before is not null")
    return paired.groupBy("file", F.col("_before").alias("id")).agg(F.max_by("_text", "line_no").alias("text"), F.max("line_no").alias("line_no"))


def field_blocks(lines: DataFrame, flush_open: bool = True) -> DataFrame:
    """file, block_id, title, value, type_string, value_line of each field block.

    A block ends where the next begins. With flush_open false, a block that is followed by
    another without a line of its own in between has no say (it is dropped if it has no type).
    """
    numbered = scanned(lines, count={"block_id": F.when(F.col("line").rlike(FIELD_START), 1)}).filter("block_id > 0")
    blocks = numbered.groupBy("file", "block_id").agg(
        F.max_by(captured(F.col("line"), TITLE_LINE), F.when(F.col("line").rlike(TITLE_LINE), F.col("line_no"))).alias("title"),
        F.max_by(captured(F.col("line"), VALUE_LINE), F.when(F.col("line").rlike(VALUE_LINE), F.col("line_no"))).alias("value"),
        F.max_by(captured(F.col("line"), TYPE_LINE), F.when(F.col("line").rlike(TYPE_LINE), F.col("line_no"))).alias("type_string"),
        F.max(F.when(F.col("line").rlike(VALUE_LINE), F.col("line_no"))).alias("value_line"),
    )
    return blocks if flush_open else blocks.filter("type_string is not null")


def english_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.filter((F.col("title") == "en") & (F.col("type_string") == LOCALIZATION))


def adjacent_values(lines: DataFrame, title: str = "en") -> DataFrame:
    """file, line_no, value, status: the line after each title line, `ok` if it holds a value, else `no_value`."""
    ahead = scanned(lines, lead={"_next": F.col("line"), "_next_no": F.col("line_no")})
    at = ahead.filter(captured(F.col("line"), TITLE_LINE) == title)
    value = captured(F.col("_next"), VALUE_LINE)
    return at.select("file", F.coalesce("_next_no", "line_no").alias("line_no"), value.alias("value"), F.when(value.isNull(), "no_value").otherwise("ok").alias("status"))


def text_tables(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Languages (file, language, id) and fields (file, field_id, field_name, keys, values) of text tables."""
    section = (
        F.when(F.col("line").contains("m_languageKeys"), "language_keys")
        .when(F.col("line").contains("m_languageValues"), "language_values")
        .when(F.col("line").rlike(r"vector m_fieldKeys|TextTableField data"), "fields")
        .when(F.col("line").rlike(r"vector m_keys"), "keys")
        .when(F.col("line").rlike(r"vector m_values|string m_values"), "values")
    )
    tagged = (
        scanned(lines, last={"_section": section}, count={"field_id": F.when(F.col("line").contains("TextTableField data"), 1)})
        .withColumn("_name", captured(F.col("line"), r'string m_fieldName = "(.*)"\s*$'))
        .withColumn("_text", captured(F.col("line"), r'string data = "(.*)"\s*$'))
        .withColumn("_int", captured(F.col("line"), r"int data = (-?\d+)\s*$").cast("int"))
    )
    item = lambda kind, value: F.collect_list(F.when((F.col("_section") == kind) & F.col(value).isNotNull(), F.struct("line_no", F.col(value).alias("v"))))
    ordered = lambda c: F.transform(F.array_sort(c), lambda x: x["v"])
    heads = tagged.filter("field_id = 0").groupBy("file").agg(ordered(item("language_keys", "_text")).alias("k"), ordered(item("language_values", "_int")).alias("v"))
    pairs = F.explode(F.arrays_zip("k", "v"))
    languages = heads.select("file", pairs.alias("p")).filter("p.k is not null and p.v is not null").select("file", F.col("p.k").alias("language"), F.col("p.v").alias("id"))
    fields = tagged.filter("field_id > 0").groupBy("file", "field_id").agg(F.max("_name").alias("field_name"), ordered(item("keys", "_int")).alias("keys"), ordered(item("values", "_text")).alias("values"))
    return languages, fields


def language_texts(languages: DataFrame, fields: DataFrame, language: str = "en", every: bool = False) -> DataFrame:
    """file, field_id, field_name, position, text of a language, found by its id in each file; the first place, or every."""
    ids = languages.filter(F.col("language") == language).select("file", F.col("id").alias("_id"))
    zipped = F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("position"), F.try_element_at("values", i + 1).alias("text")))
    hits = F.filter(zipped, lambda x: (x["k"] == F.col("_id")) & x["text"].isNotNull())
    rows = fields.join(ids, "file").select("file", "field_id", "field_name", F.explode(hits if every else F.slice(hits, 1, 1)).alias("x"))
    return rows.select("file", "field_id", "field_name", "x.position", "x.text")


def dialogue_graph(lines: DataFrame) -> DataFrame:
    """file, entity_id, kind, id, fields of Actor, Conversation and DialogueEntry entities.

    A header ends the entity before it, whatever its kind. The first id of an entity counts; of
    fields with one title, the last. A conversation's number stands with each of its entries.
    """
    kind = F.when(F.col("line").rlike(r"^\s*0 Actor data"), "actor").when(F.col("line").rlike(r"^\s*0 Conversation data"), "conversation").when(F.col("line").rlike(r"^\s*0 DialogueEntry data"), "entry")
    tagged = (
        scanned(lines.withColumn("_kind", kind), last={"_conversation": F.when(kind == "conversation", F.col("line_no"))}, count={"entity_id": kind}, lag={"_of": captured(F.col("line"), TITLE_LINE)})
        .withColumn("_value", F.when(F.col("_of").isNotNull(), captured(F.col("line"), VALUE_LINE)))
        .filter("entity_id > 0")
    )
    number = captured(F.col("line"), r"^\s*0 int id = (-?\d+)\s*$")
    pair = F.when(F.col("_value").isNotNull(), F.struct("line_no", F.col("_of").alias("title"), F.col("_value").alias("value")))
    grouped = tagged.groupBy("file", "entity_id").agg(
        F.max("_kind").alias("kind"),
        F.min("line_no").alias("line_no"),
        F.max("_conversation").alias("conversation_line"),
        F.min_by(number, F.when(number.isNotNull(), F.col("line_no"))).alias("id"),
        F.array_sort(F.collect_list(pair)).alias("_pairs"),
    )
    last = F.aggregate("_pairs", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["title"]), F.create_map(p["title"], p["value"])))
    return grouped.withColumn("fields", last).drop("_pairs")


def dialogue_contexts(graph: DataFrame, title: str = "en") -> DataFrame:
    """source, actor and conversant of each entry; what an entry lacks comes from its conversation, names from the actors."""
    field = lambda name: F.try_element_at("fields", F.lit(name))
    actors = graph.filter("kind = 'actor'").select("file", F.col("id").alias("_id"), F.coalesce(field("Name en"), field("Name")).alias("_name"))
    talks = graph.filter("kind = 'conversation'").select(
        "file", F.col("line_no").alias("conversation_line"), F.col("id").alias("conversation_id"), field("Title").alias("conversation_title"), field("Actor").alias("_actor"), field("Conversant").alias("_conversant")
    )
    entries = graph.filter("kind = 'entry'").select("file", "conversation_line", F.col("id").alias("entry_id"), "line_no", field(title).alias("source"), field("Actor").alias("_own_actor"), field("Conversant").alias("_own_conversant")).filter("source is not null")
    joined = entries.join(talks, ["file", "conversation_line"], "left").withColumn("actor_id", F.coalesce("_own_actor", "_actor")).withColumn("conversant_id", F.coalesce("_own_conversant", "_conversant"))
    for role in ("actor", "conversant"):
        names = actors.select("file", F.col("_id").alias(f"{role}_id"), F.col("_name").alias(f"{role}_name"))
        joined = joined.join(names, ["file", f"{role}_id"], "left")
    return joined.select("file", "source", "conversation_id", "conversation_title", "entry_id", "line_no", "actor_id", "conversant_id", "actor_name", "conversant_name")


def actor_names(lines: DataFrame, excluded: tuple[str, ...] = ("System",)) -> DataFrame:
    """Distinct names of the lines before the first conversation that follow a `Name en` title."""
    first = lines.filter(F.col("line").contains(" 0 Conversation conversations")).groupBy("file").agg(F.min("line_no").alias("_stop"))
    values = adjacent_values(lines, "Name en").filter("status = 'ok'").join(first, "file", "left")
    name = F.trim("value").alias("name")
    return values.filter("_stop is null or line_no < _stop").select(name).filter(~F.col("name").isin("", *excluded)).distinct()


def rewritten(lines: DataFrame, pattern: str, new_value: Column) -> DataFrame:
    """Lines with the captured part of matching lines replaced where new_value isn't null; everything else stays.

    The pattern has three groups: before, value, after. The value's group is greedy, so a value
    ends at the last quote of its line.
    """
    replaced = F.concat(F.regexp_extract("line", pattern, 1), new_value, F.regexp_extract("line", pattern, 3))
    return lines.withColumn("line", F.when(F.col("line").rlike(pattern) & new_value.isNotNull(), replaced).otherwise(F.col("line")))


def whole_files(lines: DataFrame) -> DataFrame:
    """file, text: the lines of each file with their own line ends. A file is one value, so it must fit a task."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", F.concat("line", "line_end").alias("t"))))
    return lines.groupBy("file").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("text"))


def newline_style(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file").agg(F.when(F.max(F.col("line_end") == "\r\n"), "crlf").otherwise("lf").alias("newline"))
